"""Removal of repeated runs of lines by a suffix array over line ids.

The lines of a document that hold a word form its sequence. Prefix doubling gives every position the rank
of the 1, 2, 4, ... lines from there among all positions of the corpus: ranks of doubled length come from
sorting the pairs (rank here, rank that many lines on). Positions of one rank are an interval of the
suffix array with at least that common prefix. Only intervals of two or more positions are carried on,
since a run with a line that occurs once cannot repeat; in an ordinary corpus few lines are left after
the first step.

A run is worth removing from ``min_words`` words on. For each position that is the shortest window of
lines with so many words, at most ``min_words`` lines, so doubling ends after six steps whatever the
length of documents. Two windows are equal when the ranks at their begin and those that cover their end
are. All windows but the first of their interval, in order of document id and place, are deleted. That is
the rule of the comparison SQL; of a longer run it leaves the end that holds too few words after the begin
of the last window. ``whole`` takes the shortest windows back from each line as well. Every run of
``min_words`` words ends with one, which begins no later than the last window that fits from its begin, so
both kinds together cover exactly all runs of so many words that occurred before.

Sorting is by range partitions and ranks are numbers that follow that order, so no task sees all positions
and the line that a third of all documents hold is summed before it is shuffled. Null text has no lines
and stays null; blank lines stay. Rows with equal id and text count as one document and get the same
result; of rows with equal ids, equal lines at the same place are no copies of each other; null ids come
last. Other columns pass through. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import extended, slices, written

MIN_WORDS = 50

_HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

_DOC, _HASH = "__line_doc", "__line_hash"
_LINES = "doc long, hash long, i int, key1 long, key2 long, m int, back int"


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    doc = F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1))
    return docs.withColumns({_DOC: doc, _HASH: F.xxhash64(text)})


def shortest_windows(words: np.ndarray, min_words: int) -> np.ndarray:
    """For each line, how many lines from it hold ``min_words`` words; 0 where the document ends before."""
    ends = np.cumsum(words)
    stop = np.searchsorted(ends, ends - words + min_words)
    return np.where(stop < len(words), stop - np.arange(len(words)) + 1, 0)


def sequences(docs: DataFrame, min_words: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each line with a word: document, place, 128-bit line hash, lines in its shortest windows on and back."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, keys, places, windows, backs = [], [], [], [], []
            for t in batch.column("text").to_pylist():
                lines = [x for x in (t or "").split("\n") if _HAS_WORD.search(x)]
                words = np.array([len(_WORD.findall(x)) for x in lines], np.int64)
                counts.append(len(lines))
                keys += [xxhash.xxh3_128_digest(x) for x in lines]
                places.append(np.arange(len(lines), dtype=np.int32))
                windows.append(shortest_windows(words, min_words).astype(np.int32))
                backs.append(shortest_windows(words[::-1], min_words)[::-1].astype(np.int32))
            if not keys:
                continue
            rows = pa.array(np.repeat(np.arange(len(counts)), counts))
            pair = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(rows),
                    batch.column("hash").take(rows),
                    pa.array(np.concatenate(places)),
                    pa.array(np.ascontiguousarray(pair[:, 0])),
                    pa.array(np.ascontiguousarray(pair[:, 1])),
                    pa.array(np.concatenate(windows)),
                    pa.array(np.concatenate(backs)),
                ],
                names=[f.split()[0] for f in _LINES.split(", ")],
            )

    keyed = _keyed(docs.select(F.col(id_column), F.col(text).alias("text")), id_column, "text")
    return keyed.select(F.col(_DOC).alias("doc"), F.col(_HASH).alias("hash"), "text").mapInArrow(cut, _LINES)


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` whose keys occur more than once, with the keys replaced by their rank ``r``.

    Distinct keys are sorted by range partitions; partition and place there make a number that grows with
    the key.
    """
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    order = repeated.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranks = written(order.withColumn("r", F.monotonically_increasing_id()), f"{name}-ranks")
    return written(rows.join(ranks, keys).drop(*keys), name)


def suffix_ranks(lines: DataFrame, longest: int) -> list[DataFrame]:
    """For k = 0, 1, ...: doc, hash, i, m, r of all positions whose 2 ** k lines occur elsewhere too.

    Copies of one row become one position here, in the tasks before the shuffle: joins of positions would
    square their number at each level.
    """
    levels = [written(ranked(lines, ["key1", "key2"], "lines-0").distinct(), "positions")]
    while 2 ** len(levels) <= longest:
        step, last = 2 ** (len(levels) - 1), levels[-1]
        later = last.select("doc", "hash", (F.col("i") - step).alias("i"), F.col("r").alias("r2"))
        pairs = last.drop("back").withColumnRenamed("r", "r1").join(later, ["doc", "hash", "i"])
        levels.append(ranked(pairs, ["r1", "r2"], f"lines-{len(levels)}"))
    return levels


def _place() -> Column:
    """Order of positions in the corpus as one fixed-width number."""
    return (F.col("doc").cast("decimal(20,0)") * 1_000_000_000_000).cast("decimal(38,0)") + F.col("i")


def _copies(windows: DataFrame) -> DataFrame:
    """The windows (back, doc, hash, i, m, r_begin, r_end) that occurred before, those on and those back each among their own."""
    same = ["back", "m", "r_begin", "r_end"]
    windows = windows.withColumn("place", _place())
    first = windows.groupBy(*same).agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    return windows.join(first.hint("merge"), same).where("place > first").select("doc", "hash", "i", "m")


def later_copies(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text: str = "text", whole: bool = False
) -> DataFrame:
    """doc, hash and the places of lines (counting those with a word) inside windows that occurred before.

    The windows of all levels go through the same joins, told apart by their level ``k``, and are written before the
    next step: a plan with joins for each level runs them all at once, which the driver has to hold.
    """
    lines = written(sequences(docs, min_words, id_column, text), "sequences")
    levels = suffix_ranks(lines, min_words)
    longer = list(enumerate(levels))[1:] or [(0, levels[0])]  # windows of one line are known by one rank
    ranks = reduce(DataFrame.unionByName, [x.select("doc", "hash", "i", "r", F.lit(k).alias("k")) for k, x in longer])
    end = ranks.select("doc", "hash", "k", F.col("i").alias("e"), F.col("r").alias("r_end")).hint("merge")
    found = ["back", "doc", "hash", "i", "m", "r_begin", "r_end"]
    size = F.expr("shiftleft(1, k)")
    windows = reduce(DataFrame.unionByName, [x.select("doc", "hash", "i", "m", "r", F.lit(k).alias("k")) for k, x in enumerate(levels)])
    windows = windows.where((F.col("m") >= size) & (F.col("m") < 2 * size)).withColumn("back", F.lit(False)).withColumnRenamed("r", "r_begin")
    one, more = windows.where("k = 0"), windows.where("k > 0")
    more = more.withColumn("e", F.col("i") + F.col("m") - size).join(end, ["doc", "hash", "k", "e"])
    windows = one.withColumn("r_end", F.col("r_begin")).select(*found).unionByName(more.select(*found))
    if whole:  # windows of one line are the same on and back
        level = sum([(F.col("back") >= 2**k).cast("int") for k in range(1, len(levels))], F.lit(0))
        back = levels[0].where(f"back >= 2 AND back < {2 ** len(levels)}").withColumn("k", level)
        back = back.select(
            "doc", "hash", "k", (F.col("i") - F.col("back") + 1).alias("i"), F.col("back").alias("m"), (F.col("i") - size + 1).alias("e")
        )
        begin = ranks.withColumnRenamed("r", "r_begin").hint("merge")
        back = back.join(end, ["doc", "hash", "k", "e"]).join(begin, ["doc", "hash", "k", "i"])
        windows = windows.unionByName(back.withColumn("back", F.lit(True)).select(*found))
    copies = _copies(written(windows, "windows"))
    covered = F.explode(F.sequence("i", F.col("i") + F.col("m") - 1))
    return copies.select("doc", "hash", covered.alias("i")).groupBy("doc", "hash").agg(F.collect_set("i").alias("places"))


def remove(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text: str = "text", whole: bool = False
) -> DataFrame:
    """``docs`` without later copies of repeated runs, with n_lines, n_removed, n_runs and removed.

    ``whole`` deletes each run to its end, otherwise the windows of the comparison SQL are deleted.
    ``n_runs`` counts the removed runs and ``removed`` lists the places of the removed lines from 0.
    """
    copies = written(later_copies(docs, min_words, id_column, text, whole), "copies")
    copies = copies.select(F.col("doc").alias("c_doc"), F.col("hash").alias("c_hash"), F.col("places").alias("__places"))
    copies = copies.hint("merge")  # one plan at every size: texts are dealt out by key, nothing is broadcast
    keyed = _keyed(docs, id_column, text)
    joined = keyed.join(copies, (F.col(_DOC) == F.col("c_doc")) & (F.col(_HASH) == F.col("c_hash")), "left")
    kept, schema = extended(docs, "n_lines long, n_removed long, n_runs long, removed string")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts, counts, removed = [], [[], [], []], []
            for t, places in zip(batch.column(text).to_pylist(), batch.column("__places").to_pylist()):
                drop, n, lines = set(places or ()), 0, []
                for line in (t or "").split("\n"):
                    if _HAS_WORD.search(line):
                        if n not in drop:
                            lines.append(line)
                        n += 1
                    else:
                        lines.append(line)
                texts.append("\n".join(lines) if drop else t)
                removed.append(",".join(map(str, sorted(drop))))
                for c, v in zip(counts, (n, len(drop), sum(p - 1 not in drop for p in drop))):
                    c.append(v)
            arrays = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in kept]
            arrays += [pa.array(c, pa.int64()) for c in counts] + [pa.array(removed, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.select(*kept, "__places").mapInArrow(rebuild, schema)


#: The same rows in SQL: the text of each shortest window, and whether it occurred before.
ORACLE = r"""
WITH l AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS i, line,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM
    (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
s AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l),
e AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + 49
    AND b.upto >= a.upto - a.n + 50 GROUP BY 1, 2),
w AS (SELECT e.doc_id, e.i, e.j, string_agg(l.line, chr(10) ORDER BY l.i) AS body FROM e
    JOIN l ON l.doc_id = e.doc_id AND l.i BETWEEN e.i AND e.j GROUP BY 1, 2, 3),
o AS (SELECT *, min(doc_id * 1000000 + i) OVER (PARTITION BY body) AS first FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM o WHERE doc_id * 1000000 + i > first),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE fresh) AS n_runs,
    string_agg(i - 1, ',' ORDER BY i) AS removed FROM
    (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 1, TRUE) AS fresh FROM gone) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
    coalesce(removed, '') AS removed
FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN runs USING (doc_id)
"""
