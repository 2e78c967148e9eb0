"""Token ids in files of compressed byte planes.

Documents are put in ascending id order by a range shuffle; every partition becomes one shard, encodes its
texts and cuts them into chunks of whole documents. The ids of a chunk, unsigned 32-bit, are cut into
blocks of fixed size. Each block is transposed into four byte planes, so that the slowly changing high
bytes lie side by side, and every plane is compressed with zstandard; a plane of zeros takes no bytes.
A chunk row stores the index next to the planes: how many ids come before it in its shard, the
documents and their numbers of ids, and the size of each plane. Rows are written by Spark's own committer
as Parquet, so a lost task leaves nothing behind and readers need no listing of their own.

Null text is empty and encodes to the end id alone. Rows with equal ids stay side by side, ordered by a
hash of their text; null ids come first. An empty table gives no chunk. Only the id column and the text
are read, whatever other columns there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import slices
from tessera.llm.tokens import encoder

#: Ids in a block, and ids from which a chunk is closed.
BLOCK = 1 << 16
CHUNK = 1 << 18
LEVEL = 3

CHUNK_SCHEMA = (
    "shard int, chunk int, first long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "plane_sizes array<int>, planes binary"
)


def pack_planes(ids: np.ndarray, block: int = BLOCK, level: int = LEVEL) -> tuple[list[int], bytes]:
    """Sizes of the compressed planes, four for each block, and the planes one after the other."""
    squeeze = zstandard.ZstdCompressor(level=level)
    sizes, parts = [], []
    for i in range(0, len(ids), block):
        planes = np.ascontiguousarray(ids[i : i + block].astype("<u4").view(np.uint8).reshape(-1, 4).T)
        for plane in planes:
            part = squeeze.compress(plane.tobytes()) if plane.any() else b""
            sizes.append(len(part))
            parts.append(part)
    return sizes, b"".join(parts)


def unpack_planes(n_ids: int, sizes: list[int], data: bytes, block: int = BLOCK) -> np.ndarray:
    """The ids that ``pack_planes`` got."""
    expand = zstandard.ZstdDecompressor()
    out = np.zeros((n_ids, 4), np.uint8)
    at = 0
    for k, size in enumerate(sizes):
        begin = k // 4 * block
        if size:
            rows = min(block, n_ids - begin)
            plane = expand.decompress(data[at : at + size], max_output_size=rows)
            out[begin : begin + rows, k % 4] = np.frombuffer(plane, np.uint8)
        at += size
    return out.view("<u4").reshape(-1)


def with_end(lengths: np.ndarray, ids: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids with the end id after them."""
    return lengths + 1, np.insert(ids, np.cumsum(lengths), np.uint32(end))


def write(
    docs: DataFrame, path: str, tokenizer: str, end: int, lower: bool = False, id_column: str = "doc_id", text: str = "text"
) -> None:
    """Encode ``text`` and write the chunks to ``path`` in ascending id order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, enc = TaskContext.get().partitionId(), encoder(tokenizer, lower)
        chunk, first = 0, 0
        held_docs: list = []
        held_lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            ids, lengths = np.concatenate(held), np.concatenate(held_lengths)
            sizes, planes = pack_planes(ids)
            row = [[shard], [chunk], [first], [len(ids)], [held_docs], [lengths.tolist()], [sizes], [planes]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

        for batch in slices(batches, "text", 4 << 20):
            lengths, ids = with_end(*enc.encode(batch.column("text")), end)
            doc_ids = batch.column("id").to_pylist()
            ends = np.cumsum(lengths)
            begin = 0
            while begin < len(lengths):
                room = CHUNK - sum(map(len, held))
                before = ends[begin - 1] if begin else 0
                stop = min(len(lengths), int(np.searchsorted(ends, before + room)) + 1)
                held_docs += doc_ids[begin:stop]
                held_lengths.append(lengths[begin:stop])
                held.append(ids[before : ends[stop - 1]])
                begin = stop
                if sum(map(len, held)) >= CHUNK:
                    yield close()
                    first, chunk = first + sum(map(len, held)), chunk + 1
                    held_docs, held_lengths, held = [], [], []
        if held:
            yield close()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    ordered.mapInArrow(encode, CHUNK_SCHEMA).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the ids as little-endian 32-bit words.

    The driver holds one sum per shard, that is per partition of the writing job.
    """
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    sums = {r["shard"]: r["n"] for r in chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for shard in sorted(sums):
        base[shard], total = total, total + sums[shard]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_planes(row["n_ids"], row["plane_sizes"], row["planes"])
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = base[row["shard"]] + row["first"] + ends - lengths
                data = ids.tobytes()
                parts = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(lengths), pa.array(parts, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return chunks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")
