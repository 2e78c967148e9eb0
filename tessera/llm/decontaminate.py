"""Benchmark decontamination by a distributed positional inverted index.

An item is cut into windows of consecutive words. The corpus frequency of every word of the items decides
the two rarest words of each window. The index is a written table of postings (term, document, position)
of these rare words over all documents. A window is looked up by joining the list of its rarest word with
the list of its second rarest at the position that their offsets ask for. What is left, gathered per
document, meets the text once, where the whole phrase is compared. Windows with a word that the corpus
lacks are left out at once.

Only DataFrame functions are used. Word lists of the items are broadcast after their bytes were summed up
and found few; beyond that they are joined by a shuffle.

Null text has no words; an item without words has no window and is never found. Items without an id count as
one item, which has no part in the digest of ids. Documents are told apart
by id and a hash of their text, so repeated rows get the same result each and null ids work. Other columns
are not read. Empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import text_or_empty, written

WINDOW = 10
#: Word lists are broadcast up to this size.
BROADCAST_BYTES = 32 << 20
#: Words are runs of digits, letters a-z and everything beyond ASCII, after folding A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: str = "text") -> Column:
    folded = F.translate(text_or_empty(text), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(folded, GAP), "")


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, at, words: every run of ``window`` words, or all words of a shorter item."""
    w = items.select(F.col("item_id"), words_of().alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - window))
    return w.withColumn("at", F.explode(starts)).select(
        "item_id", "at", F.slice("w", F.col("at") + 1, window).alias("words")
    )


def bounded(terms: DataFrame) -> DataFrame:
    """A written table with a column ``term``: to be broadcast if its bytes, summed up, are few enough."""
    size = terms.agg(F.sum(F.octet_length("term") + 64)).first()[0] or 0
    return F.broadcast(terms) if size <= BROADCAST_BYTES else terms


def anchored(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Windows whose words all occur, with term and offset of their rarest (1) and second rarest (2) word."""
    vocabulary = bounded(written(windows.select(F.explode("words").alias("term")).distinct(), "vocabulary"))
    corpus = docs.select(F.explode(words_of()).alias("term")).join(vocabulary, "term", "left_semi")
    counts = written(corpus.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "terms")
    placed = windows.select("item_id", "at", "words", F.posexplode("words").alias("offset", "term"))
    each = Window.partitionBy("item_id", "at", "words")
    ranked = placed.join(counts, "term", "left").withColumns(
        {"rank": F.row_number().over(each.orderBy(F.col("n").asc_nulls_first(), "offset")), "known": F.count("n").over(each)}
    )
    whole = ranked.where((F.col("known") == F.size("words")) & (F.col("rank") <= 2))
    return whole.groupBy("item_id", "at", "words").agg(
        *[F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"{c}{r}") for r in (1, 2) for c in ("term", "offset")]
    )


def index(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Postings of the anchors' terms: term, doc_id, text_hash, pos."""
    terms = anchors.select(F.explode(F.array("term1", "term2")).alias("term")).where("term IS NOT NULL").distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(words_of()).alias("pos", "term"))
    return rows.join(bounded(written(terms, "anchor-terms")), "term", "left_semi").select("term", "doc_id", "text_hash", "pos")


def _other(postings: DataFrame) -> DataFrame:
    names = {"term": "o_term", "doc_id": "o_doc", "text_hash": "o_hash", "pos": "o_pos"}
    return postings.select(*[F.col(c).alias(n) for c, n in names.items()])


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("text_hash") == F.col("o_hash")) & (F.col("term2") == F.col("o_term"))


def candidates(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, at, start where the two rarest words of a window stand as in the window."""
    found = (
        postings.withColumnRenamed("term", "term1")
        .join(anchors.drop("words"), "term1")
        .withColumn("start", F.col("pos") - F.col("offset1"))
        .where("start >= 0")
        .select("doc_id", "text_hash", "item_id", "at", "start", "term2", (F.col("start") + F.col("offset2")).alias("pos2"))
    )
    both = found.where("term2 IS NOT NULL").join(
        _other(postings), _same_document() & (F.col("pos2") == F.col("o_pos")), "left_semi"
    )
    return both.unionByName(found.where("term2 IS NULL")).select("doc_id", "text_hash", "item_id", "at", "start")


def near_hits(postings: DataFrame, anchors: DataFrame, slack: int = 3) -> DataFrame:
    """Proximity matches: the two rarest words stand at most ``slack`` words off their distance, not exactly at it."""
    one = postings.withColumnRenamed("term", "term1").join(anchors.drop("words"), "term1")
    off = F.col("o_pos") - F.col("pos") - (F.col("offset2") - F.col("offset1"))
    return one.join(_other(postings), _same_document()).where(off.between(-slack, slack) & (off != 0)).select(
        "doc_id", "text_hash", "item_id"
    ).distinct()


HITS, N_WORDS = "__hits", "__n_words"
_ROW = "__row"


def _found(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Id, text and, as one struct, so that they may have any names, the other columns of each row, with its hits.

    Candidates are gathered per document and meet its text in one join, where the whole phrase is compared.
    Items without an id are one item; their phrases are told apart by the comparison.
    """
    anchors = written(anchored(docs, windows_of(items, window)), "anchors")
    postings = written(index(docs, anchors), "postings")
    phrases = anchors.select(F.col("item_id").alias("p_item"), F.col("at").alias("p_at"), "words")
    same_window = F.col("item_id").eqNullSafe(F.col("p_item")) & (F.col("at") == F.col("p_at"))
    per_doc = candidates(postings, anchors).join(phrases, same_window).groupBy(
        F.col("doc_id").alias("c_doc"), F.col("text_hash").alias("c_hash")
    ).agg(F.collect_list(F.struct("item_id", "start", "words")).alias("candidates"))
    same = F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.xxhash64("text") == F.col("c_hash"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(None).alias("none")]
    rows = docs.select(F.struct(*others).alias(_ROW), "doc_id", "text")
    joined = rows.join(per_doc.hint("merge"), same, "left").withColumn("word_list", words_of())

    def exact(c: Column) -> Column:
        return F.slice("word_list", c["start"] + 1, F.size(c["words"])) == c["words"]

    hits = F.transform(
        F.filter("candidates", exact), lambda c: F.struct(c["item_id"], c["start"], F.size(c["words"]).alias("length"))
    )
    return joined.select("doc_id", "text", _ROW, F.size("word_list").cast("long").alias(N_WORDS), hits.alias(HITS))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(c) if c in ("doc_id", "text") else F.col(f"{_ROW}.`{c}`").alias(c) for c in docs.columns]


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the number of words and the confirmed hits of each row: item_id, start, length."""
    return _found(docs, items, window).select(*_columns(docs), N_WORDS, HITS)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit."""
    return _found(docs, items, window).where(F.coalesce(F.size(HITS), F.lit(0)) <= 0).select(*_columns(docs))


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated."""

    def widen(acc: Column, run: Column) -> Column:
        stop = run["start"] + run["length"]
        more = F.greatest(F.lit(0), stop - F.greatest(acc["stop"], run["start"]))
        return F.struct(F.greatest(acc["stop"], stop).alias("stop"), (acc["n"] + more).alias("n"))

    found = find(docs.select("doc_id", "text"), items, window)
    runs = F.sort_array(F.transform(HITS, lambda h: F.struct(h["start"], h["length"])))
    start = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("n"))
    item_ids = F.sort_array(F.array_distinct(F.transform(HITS, lambda h: h["item_id"].cast("string"))))
    counted = found.select(
        "doc_id",
        F.col(N_WORDS).alias("n_words"),
        F.coalesce(F.aggregate(runs, start, widen)["n"], F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(item_ids, F.array().cast("array<string>")).alias("items"),
    )
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: The same rows in SQL: windows of each length joined with the documents' runs of that length.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, phrase)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
