"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full sets.

1. Each text becomes the set of its five-word shingles (64-bit hashes), 128 MinHash values of it, 32 band
   keys of four values each, and an odd sketch: a 512-bit map in which every MinHash value flips one bit.
2. Documents with equal sets form one class and go on as its smallest id, so copies never meet in pairs.
3. In every band bucket each member is paired with the smallest one. The population count of the XOR of
   two odd sketches estimates the similarity; pairs far below the limit end there (the margin is more than
   five standard deviations). So do pairs whose parity maps of the whole sets differ in more bits than sets
   of that similarity can. The others are confirmed by intersecting the full sets.
4. Confirmed links give components by label propagation. Buckets whose members are still in several
   components are compared in full, in blocks: a task gets two blocks of members with their sketches, tests
   members of different components against each other in numpy, and passes on only pairs that withstand both
   tests, to be confirmed. A large bucket is many pairs of blocks, no group reaches one task, and no link
   between bucket members is lost.

Two sets at the limit of 0.75 share no bucket with a probability of 5e-6. Row by row: null or blank text
has an empty set and is linked with nothing. Rows with equal ids count as one document; a null id is
linked with nothing and kept. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import _offsets, own_texts, slices, written

WORDS = 5
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: Similarity in percent from which documents are linked.
LIMIT = 75
#: XOR bits beyond which a pair is not confirmed on its sets: expected at a similarity of 0.45.
MOST_XOR = 108
#: Bits of the parity map of a whole set, and members in a block of a bucket.
WHOLE_BITS = 1024
BLOCK = 512

_MASK = (1 << 64) - 1


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_MULTIPLY, _ADD = _constants(SAMPLES, 1), _constants(SAMPLES, 2)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Size of each text's shingle set, and the sorted hashes of all sets one after the other."""
    texts = pc.ascii_lower(own_texts(texts))
    for gap in "\t\n\v\f\r":
        texts = pc.replace_substring(texts, gap, " ")
    split = pc.split_pattern(texts, " ")
    bounds = _offsets(split).astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    bounds -= bounds[0]
    pieces = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(p) for p in pieces), np.uint64, len(pieces))
    codes = coded.indices.to_numpy()
    if "" in pieces:  # white space at an end of a text or in runs
        real = codes != pieces.index("")
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        codes = codes[real]
    h = hashes[codes]
    n = len(h) - words + 1
    rolled = np.zeros(max(0, n), np.uint64)
    for k in range(words):
        rolled = rolled * _BASE + h[k : k + len(rolled)]
    rolled = _mixed(rolled)
    sizes, sets = np.zeros(len(texts), np.int64), []
    for i, (b, e) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if e - b >= words:
            own = np.unique(rolled[b : e - words + 1])
        elif e > b:
            value = np.uint64(e - b)
            for x in h[b:e]:
                value = np.uint64((int(value) * int(_BASE) + int(x)) & _MASK)
            own = _mixed(np.array([value ^ np.uint64(0x5851F42D4C957F2D)]))
        else:
            continue
        sizes[i] = len(own)
        sets.append(own)
    return sizes, np.concatenate(sets) if sets else np.empty(0, np.uint64)


def min_hashes(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """SAMPLES rows, one column for each non-empty set."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    out = np.empty((SAMPLES, len(starts)), np.uint64)
    if len(starts):
        for k in range(SAMPLES):
            out[k] = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One row for each set, one column for each band."""
    keys = np.zeros((BANDS, samples.shape[1]), np.uint64)
    for r in range(ROWS):
        keys = keys * _BASE + _mixed(samples[r::ROWS])
    return _mixed(keys + (np.arange(BANDS, dtype=np.uint64)[:, None] + np.uint64(1)) * _MIX).T


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """One row of 64-bit words for each set; bit b is the parity of the values that fall on b."""
    place = _mixed(samples + np.arange(SAMPLES, dtype=np.uint64)[:, None] * _BASE) % np.uint64(SKETCH_BITS)
    out = np.zeros((samples.shape[1], SKETCH_BITS // 64), np.uint64)
    column = np.arange(samples.shape[1])
    for p in place:
        out[column, p >> np.uint64(6)] ^= np.uint64(1) << (p & np.uint64(63))
    return out


def whole_maps(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One row of 64-bit words for each non-empty set; bit b is the parity of the elements that fall on b.

    Two maps differ in at most as many bits as the sets differ in elements.
    """
    filled = int((sizes > 0).sum())
    row = np.repeat(np.arange(filled), sizes[sizes > 0])
    place = (_mixed(values + _BASE) % np.uint64(WHOLE_BITS)).astype(np.int64)
    odd = (np.bincount(row * WHOLE_BITS + place, minlength=filled * WHOLE_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64).reshape(filled, WHOLE_BITS // 64)


def estimated_similarity(xor_bits: float) -> float:
    """Similarity that the XOR count of two sketches points to."""
    rest = max(1e-9, 1 - 2 * xor_bits / SKETCH_BITS)
    return max(0.0, 1 + SKETCH_BITS / (4 * SAMPLES) * float(np.log(rest)))


_SIGNATURE = "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>, sketch array<long>, whole array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, set digest, band keys and odd sketch of every row with columns doc_id and text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, values = shingle_sets(batch.column("text"))
            filled = np.flatnonzero(sizes)
            samples = min_hashes(sizes, values)
            ends = np.cumsum(sizes)[filled]
            keys = np.zeros((len(sizes), 2), np.int64)
            for i, e in zip(filled.tolist(), ends.tolist()):
                keys[i] = np.frombuffer(xxhash.xxh3_128_digest(values[e - sizes[i] : e].tobytes()), np.int64)

            def lists(rows: np.ndarray) -> pa.Array:
                width = np.where(sizes > 0, rows.shape[1], 0)
                offsets = np.concatenate([[0], np.cumsum(width)]).astype(np.int32)
                return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.view(np.int64).reshape(-1)))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(keys[:, 0]),
                    pa.array(keys[:, 1]),
                    lists(np.ascontiguousarray(band_keys(samples))),
                    lists(odd_sketches(samples)),
                    lists(whole_maps(sizes, values)),
                ],
                names=[f.split()[0] for f in _SIGNATURE.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sign, _SIGNATURE)


def full_sets(docs: DataFrame) -> DataFrame:
    """node and its shingle hashes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, values = shingle_sets(batch.column("text"))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("node"), sets], names=["node", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    return rows.mapInArrow(make, "node long, shingles array<long>")


def xor_bits(a: str, b: str, bits: int) -> Column:
    """Population count of the XOR of two bit maps in array columns."""
    return reduce(add, [F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(bits // 64)])


_MAPS = ["n_shingles", "sketch", "whole"]


def likely(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs (a, b) that withstand both tests on bit maps."""
    for side in ("a", "b"):
        own = maps.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in _MAPS])
        pairs = pairs.join(own, side)
    total = F.col("n_shingles_a") + F.col("n_shingles_b")
    close = xor_bits("sketch_a", "sketch_b", SKETCH_BITS) <= MOST_XOR
    possible = (100 + LIMIT) * xor_bits("whole_a", "whole_b", WHOLE_BITS) <= (100 - LIMIT) * total
    return pairs.where(close & possible).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the limit."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - common
    return pairs.where(100 * common >= LIMIT * union).select("a", "b").distinct()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, width)


def _compare(node: np.ndarray, label: np.ndarray, own: np.ndarray, n: np.ndarray, sketch: np.ndarray, whole: np.ndarray):
    """Pairs of one group of rows: different labels, different blocks if there are two, both tests passed."""
    found = []
    two = own[0] != own[-1] if len(own) else False
    for i in range(len(node) - 1):
        other = np.flatnonzero((label[i + 1 :] != label[i]) & ((own[i + 1 :] != own[i]) | (not two))) + i + 1
        if len(other):
            bits = np.bitwise_count(whole[other] ^ whole[i]).sum(1, dtype=np.int64)
            other = other[(100 + LIMIT) * bits <= (100 - LIMIT) * (n[other] + n[i])]
        if len(other):
            other = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(1, dtype=np.int64) <= MOST_XOR]
            found += [(min(node[i], x), max(node[i], x)) for x in node[other].tolist()]
    return found


def block_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one bucket in different components that withstand both tests.

    ``members`` holds bucket, node, label, size (of the bucket), and the node's maps.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    key = ["bucket", "low", "high"]
    rows = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "label", *_MAPS
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table, last: bool):
            keys = np.stack([table.column(c).to_numpy() for c in key])
            edges = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [table.num_rows]])
            end = len(edges) - 1 if last else len(edges) - 2
            found: list[tuple[int, int]] = []
            if end > 0:
                part = table.slice(0, int(edges[end])).combine_chunks()
                node, label, own, n = (part.column(c).to_numpy() for c in ("node", "label", "own", "n_shingles"))
                sketch = _matrix(part.column("sketch").combine_chunks(), SKETCH_BITS // 64)
                whole = _matrix(part.column("whole").combine_chunks(), WHOLE_BITS // 64)
                for b, e in zip(edges[:end].tolist(), edges[1 : end + 1].tolist()):
                    found += _compare(node[b:e], label[b:e], own[b:e], n[b:e], sketch[b:e], whole[b:e])
            return found, table.slice(int(edges[end]))

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [pa.Table.from_batches([batch])] if rest is None else [rest, pa.Table.from_batches([batch])]
            found, rest = groups(pa.concat_tables(held), False)
            if found:
                yield _pairs(found)
        if rest is not None and rest.num_rows:
            found, _ = groups(rest, True)
            if found:
                yield _pairs(found)

    return rows.repartition(*key).sortWithinPartitions(*key, "own").mapInArrow(compare, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.unique(np.array(found, np.int64), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node, label: the smallest node that links reach; nodes without links are absent.

    Every round takes the least label among a node and its neighbours, then the label of that label. Both
    are sums over links in the tasks before any shuffle, so a node with very many links is no hot spot.
    """
    edges = links.select(F.col("a").alias("x"), F.col("b").alias("y"))
    edges = written(edges.union(edges.select("y", "x")).distinct(), "edges")
    start = edges.select(F.col("x").alias("node")).distinct()
    if labels is None:
        current = start.withColumn("label", F.col("node"))
    else:
        current = start.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    current = written(current, "labels")
    while True:
        told = edges.join(current.withColumnRenamed("node", "x"), "x").select(F.col("y").alias("node"), "label")
        least = current.union(told).groupBy("node").agg(F.min("label").alias("label"))
        jump = current.select(F.col("node").alias("label"), F.col("label").alias("next"))
        nearer = least.join(jump, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"))
        after = written(nearer, "labels")
        before = current.select("node", F.col("label").alias("old"))
        changed = after.join(before, "node").where("label <> old").limit(1).count()
        current = after
        if not changed:
            return current


def distinct_buckets(members: DataFrame) -> DataFrame:
    """bucket, center, size of buckets of two nodes or more; of those with the same members only the least.

    Close documents share most of their buckets. The sums of three hashes tell members apart; rows of a
    repeated id add up in them.
    """
    sums = [F.sum(F.xxhash64("node", F.lit(k)).bitwiseAND(F.lit((1 << 31) - 1))).alias(f"sum{k}") for k in (1, 2, 3)]
    buckets = members.groupBy("bucket").agg(
        F.min("node").alias("center"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"), *sums
    ).where("center <> last")
    same = buckets.groupBy("center", "last", "size", "sum1", "sum2", "sum3").agg(F.min("bucket").alias("bucket"))
    return same.select("bucket", "center", "size")


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row with columns doc_id and text."""
    signed = written(signatures(docs), "signatures")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(known.groupBy("key1", "key2").agg(F.min("doc_id").alias("node")), "classes")
    nodes = known.withColumnRenamed("doc_id", "node").join(classes, ["key1", "key2", "node"], "left_semi")

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    one = distinct_buckets(members)
    shared = written(members.join(one, "bucket"), "members")
    in_pairs = written(shared.select("node").distinct(), "in-pairs")
    maps = written(nodes.select("node", *_MAPS).join(in_pairs, "node", "left_semi"), "maps")
    texts = docs.select("doc_id", "text").join(
        in_pairs.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left_semi"
    )  # one plan at every size
    sets = written(full_sets(texts), "sets")

    star = shared.where("center <> node").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
    links = written(confirmed(likely(star, maps), sets), "links")
    labels = components(links)
    placed = shared.select("bucket", "node", "size").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    torn = placed.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    still_open = placed.join(torn.select("bucket"), "bucket", "left_semi").join(maps, "node")
    more = written(confirmed(block_pairs(still_open).distinct(), sets), "links")
    if more.limit(1).count():
        labels = components(links.union(more), labels)
    of_node = classes.join(labels, "node", "left").select("key1", "key2", F.coalesce("label", "node").alias("component_id"))
    rows = signed.select("doc_id", "n_shingles", "key1", "key2")
    joined = rows.join(of_node, ["key1", "key2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


#: The same rows in SQL: pairs by shared shingles, components by a recursive walk.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * k >= 75 * (ca.n + cb.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM t UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, coalesce(c.n, 0) AS n_shingles, m.component_id, m.doc_id = m.component_id AS kept
FROM m LEFT JOIN c USING (doc_id)
"""
