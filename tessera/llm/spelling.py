"""Groups spelling variants of a corpus vocabulary: words one edit apart, by dynamic programming over sorted lists.

Words are runs of letters, counted over whole texts. Every vocabulary word looks for the words at exactly one
inserted, deleted or replaced code point. Words of m and m + 1 code points that are one edit apart share their
first half or the rest after it, so each word is put under both halves for m = its length and its length - 1.
Under a key lies a sorted list of words. Its search goes down the list's prefixes: a range of words with a
common prefix of d code points has one row of the edit matrix per searching word, of which only the three
entries next to the diagonal can be one or less. The row of a longer prefix is made from that of the shorter
one, ranges are split where the longest common prefix of neighbours in the list ends, and a range whose row
has no entry below two is skipped with all its words. All searching words of a chunk of lists go down together
in numpy arrays.

A pair is found under one key only, the one told by its longest common prefix, so counts need no second look.
Lists of more than ``MOST`` words are split: what lies between the shared prefix and the shared suffix is halved
again, until lists are short or a single code point is left between; then the alphabet bounds a list by 90
words of m code points and 90 * 90 of m + 1. No list, word or partner is left out.

A word's form is its nearest word of largest count, if that count is ``factor`` times the word's; its root is the
end of the chain of forms, found by doubling. Counts grow along a chain, so it has no circle.

Null text has no words; a null id counts as empty text where the id enters a hash. Repeated rows count each.
Words are taken in code-point order where counts are equal. An empty table gives no rows; further columns of
the table play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ragged, slices, written

#: Words of fewer code points are left out.
SHORTEST = 7
#: Words that occur less often overall are left out.
LEAST = 2
#: How many times the count of a word its form must have.
FACTOR = 10
#: Words under one key; longer lists are split further.
MOST = 4000
#: Words searched together in a task.
CHUNK = 20_000
#: Entries of a state that are made at once.
WIDE = 300_000
#: Distinct words counted in a task before they are handed on.
HELD = 400_000

#: Letters of a run, A-Z folded; everything else becomes a blank. In Latin-1, where these letters are one byte.
_FOLDED = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0xC0 else 0x20 for i in range(256)
)


def runs_of(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z folded, as Latin-1."""
    return text.encode("latin-1", "replace").translate(_FOLDED).split()


def altered(run: bytes, before: int, every: int) -> bytes:
    """The run, less one letter where ``every`` divides the crc32 of id and run; ``before`` is that of the id."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, alter_every: int | None = None) -> DataFrame:
    """``word, n`` of all words of ``docs`` (doc_id, text).

    ``alter_every`` plants spelling errors: one letter is deleted from about one run of so many, told by a
    hash of the document's id and the run. A task adds up what it reads before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def held() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in found], pa.string())
            return pa.record_batch([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                runs = Counter(r for r in runs_of(text) if len(r) >= shortest)
                if alter_every is None:
                    found.update(runs)
                    continue
                before = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in runs.items():
                    word = altered(run, before, alter_every)
                    if len(word) >= shortest:
                        found[word] += n
            if len(found) > HELD:
                yield held()
                found.clear()
        yield held()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# A list is the words of m and m + 1 code points under one shared prefix of `lo` and one shared suffix of `hi`
# code points. Its pairs are those whose longest common prefix is below `cap`; others are found elsewhere.


def _key() -> Column:
    prefix = F.expr("substring(word, 1, lo)")
    suffix = F.expr("if(hi = 0, '', right(word, hi))")
    return F.xxhash64("m", "lo", "hi", prefix, suffix)


def _halved(lists: DataFrame) -> DataFrame:
    """Every row under two keys: a longer prefix or a longer suffix, the free part between them halved."""
    mid = F.expr("int((lo + m - hi + 1) div 2)")
    both = F.array(
        F.struct(F.col("m"), mid.alias("lo"), F.col("hi"), F.col("cap")),
        F.struct(F.col("m"), F.col("lo"), (F.col("m") - mid).alias("hi"), mid.alias("cap")),
    )
    rows = lists.select("word", "n", F.explode(both).alias("s")).select("word", "n", "s.*")
    return rows.withColumn("key", _key())


def _lists(words: DataFrame, shortest: int, most: int) -> DataFrame:
    """``key, m, lo, cap, word, n``: the words under all their keys, no list longer than ``most`` unless one
    code point is all that is free."""
    size = F.length("word").cast("int")
    lengths = F.when(size > shortest, F.array(size, size - 1)).otherwise(F.array(size))
    roots = words.select("word", "n", F.explode(lengths).alias("m"))
    roots = roots.select("*", F.lit(0).alias("lo"), F.lit(0).alias("hi"), (F.col("m") + 1).alias("cap"))
    open_rows, short = written(_halved(roots), "spelling-lists"), []
    while True:
        long_lists = open_rows.where("m - hi - lo > 1").groupBy("key").count().where(F.col("count") > most).select("key")
        long_lists = written(long_lists, "spelling-long")
        if long_lists.isEmpty():
            break
        # Rows of one long list are dealt over many tasks by a salt; its key is repeated for each salt.
        salt = F.pmod(F.xxhash64("word"), F.lit(64).cast("long"))
        salts = F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))
        salted = long_lists.select("key", F.explode(salts).alias("salt"), F.lit(True).alias("long"))
        told = open_rows.withColumn("salt", salt).join(salted, ["key", "salt"], "left").drop("salt")
        told = written(told, "spelling-told")
        short.append(told.where(F.col("long").isNull()).drop("long"))
        open_rows = written(_halved(told.where("long").drop("long", "key")), "spelling-lists")
    for rows in short:
        open_rows = open_rows.unionByName(rows)
    return open_rows.select("key", "m", "lo", "cap", "word", "n")


class _Chunk:
    """Some whole lists, sorted by key and word: letters in one array, and how much neighbours share."""

    def __init__(self, keys: np.ndarray, words: list[bytes]):
        self.flat = np.frombuffer(b"".join(words) or b"\0", np.uint8)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.lcp = np.full(len(words), -1, np.int64)  # -1 where a list begins
        alive = np.flatnonzero(keys[1:] == keys[:-1]) + 1
        self.lcp[alive] = 0
        depth = 0
        while len(alive):
            alive = alive[(self.sizes[alive] > depth) & (self.sizes[alive - 1] > depth)]
            alive = alive[self.flat[self.begins[alive] + depth] == self.flat[self.begins[alive - 1] + depth]]
            depth += 1
            self.lcp[alive] = depth

    def letter(self, word: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        """Letter ``at`` of each word, 0 outside of it."""
        inside = (at >= 0) & (at < self.sizes[word])
        return np.where(inside, self.flat[np.where(inside, self.begins[word] + at, 0)], 0)


def near_pairs(keys: np.ndarray, words: list[bytes], lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a list's words at distance one: searching word, found word, their longest common prefix.

    ``words`` are sorted within their key. A list whose words do not share its prefix of ``lo`` (two keys of one
    hash) is taken as several lists.
    """
    c = _Chunk(keys, words)
    n = len(words)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if n:
        heads = np.flatnonzero(c.lcp < lo)
        tails = np.append(heads[1:], n)
        many = tails - heads > 1
        heads, tails = heads[many], tails[many]
    if not n or not len(heads):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    # A state: depth, and per entry the searching word, the range of the list, how far the range's prefix and the
    # word agree, and the three entries next to the diagonal of the prefix's row. Wide states go on in parts.
    sizes = tails - heads
    starts = np.repeat(lo[heads], sizes)
    word = ragged(heads, sizes).astype(np.int64)
    begin, end = np.repeat(heads, sizes), np.repeat(tails, sizes)
    states = []
    for depth in np.unique(starts).tolist():
        at = starts == depth
        q = word[at]
        ahead = np.where(c.sizes[q] > depth, 1, 2).astype(np.int8)
        row = (np.full(len(q), 1 if depth else 2, np.int8), np.zeros(len(q), np.int8), ahead)
        states.append((depth, (q, begin[at], end[at], np.full(len(q), depth), *row)))
    cuts_at: dict[int, np.ndarray] = {}
    while states:
        depth, state = states.pop()
        # The first word of a range ends here if it is no longer than the prefix.
        q, b, e, agree, left, on, right = state
        if depth not in cuts_at:
            cuts_at[depth] = np.flatnonzero(c.lcp <= depth)
        cuts = cuts_at[depth]
        after = np.searchsorted(cuts, b, side="right")
        parts = np.searchsorted(cuts, e) - after + 1
        half = len(q) // 2
        if half and parts.sum() > WIDE:
            states += [(depth, tuple(x[:half] for x in state)), (depth, tuple(x[half:] for x in state))]
            continue
        ends = c.sizes[b] == depth
        off = c.sizes[q[ends]] - depth
        distance = np.select([off == -1, off == 0, off == 1], [left[ends], on[ends], right[ends]], 2)
        hit = distance == 1
        found.append((q[ends][hit], b[ends][hit], agree[ends][hit]))
        # Split ranges where neighbours share no more than the prefix. A word that ends here is a part of its own
        # unless equal words follow, and lists have none.
        at = np.repeat(np.arange(len(q)), parts)
        place = ragged(after - 1, parts)
        lower = np.maximum(cuts[place], b[at])
        upper = np.minimum(np.append(cuts, n)[place + 1], e[at])
        go = c.sizes[lower] > depth
        at, b, e = at[go], lower[go], upper[go]
        q, agree, left, on, right = q[at], agree[at], left[at], on[at], right[at]
        # The next row: entries at depth, depth + 1 and depth + 2 of the searching word.
        v = c.letter(b, depth)
        length = c.sizes[q]
        same = c.letter(q, depth) == v
        new_left = np.minimum(on + 1, left + (c.letter(q, depth - 1) != v))
        new_on = np.minimum(np.minimum(right, new_left) + 1, on + ~same)
        new_on[length < depth + 1] = 2
        new_right = np.minimum(new_on + 1, right + (c.letter(q, depth + 1) != v))
        new_right[length < depth + 2] = 2
        new_left[length < depth] = 2
        agree = agree + ((agree == depth) & same & (length > depth))
        left, on, right = (np.minimum(x, 2).astype(np.int8) for x in (new_left, new_on, new_right))
        # Skip ranges that are more than one edit away, and those of nothing but the searching word.
        go = ((left < 2) | (on < 2) | (right < 2)) & ~((b == q) & (e == q + 1))
        if go.any():
            states.append((depth + 1, tuple(x[go] for x in (q, b, e, agree, left, on, right))))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per list and word with near words there: how many, and the most frequent of them."""

    def searched(rows: pa.Table) -> pa.RecordBatch:
        keys, m = rows.column("key").to_numpy(), rows.column("m").to_numpy()
        lo, cap = rows.column("lo").to_numpy().astype(np.int64), rows.column("cap").to_numpy()
        names = rows.column("word").to_pylist()
        words = [w.encode("latin-1") for w in names]
        counts = rows.column("n").to_numpy()
        q, v, agree = near_pairs(keys, words, lo)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        mine = (agree < cap[q]) & (np.minimum(sizes[q], sizes[v]) == m[q])
        q, v = q[mine], v[mine]
        order = np.lexsort((v, -counts[v], q))  # words of a list are sorted, so places order them
        q, v = q[order], v[order]
        at = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
        some = np.diff(np.append(at, len(q)))
        best = v[at]
        return pa.record_batch(
            [
                pa.array([names[i] for i in q[at].tolist()], pa.string()),
                pa.array(some, pa.int64()),
                pa.array(counts[best], pa.int64()),
                pa.array([names[i] for i in best.tolist()], pa.string()),
            ],
            ["word", "n_near", "near_n", "near"],
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size < CHUNK:
            continue
        rows = pa.Table.from_batches(held)
        keys = rows.column("key").to_numpy()
        starts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if len(starts):  # the last list may go on in the next batch
            yield searched(rows.slice(0, int(starts[-1])))
            held = rows.slice(int(starts[-1])).combine_chunks().to_batches()
            size = sum(b.num_rows for b in held)
    if size:
        yield searched(pa.Table.from_batches(held))


def neighbours(words: DataFrame, shortest: int = SHORTEST, most: int = MOST) -> DataFrame:
    """``word, n_near, near, near_n`` for words that have near ones: how many, and the most frequent with its count.

    ``words`` has one row per word (word, n) of Latin-1 letters.
    """
    dealt = _lists(words, shortest, most).repartition("key").sortWithinPartitions("key", "word")
    found = dealt.mapInArrow(_search, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms`` (word, form): the end of each word's chain, found by doubling.

    Chains cannot be circles; a round halves what is left of the longest.
    """
    step = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = step.join(after, "root", "left")
        moved = written(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        step = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return step


def group(
    docs: DataFrame,
    shortest: int = SHORTEST,
    least: int = LEAST,
    factor: int = FACTOR,
    alter_every: int | None = None,
    most: int = MOST,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: the vocabulary with each word's standard spelling."""
    words = written(count_words(docs, shortest, least, alter_every), "spelling-words")
    told = words.join(neighbours(words, shortest, most), "word", "left")
    is_form = F.col("near_n") >= factor * F.col("n")
    told = told.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    told = written(told, "spelling-told")
    ends = roots(told.where(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
