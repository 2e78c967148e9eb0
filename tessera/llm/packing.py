"""Packing documents into sequences of fixed length by first-fit decreasing.

A document longer than a sequence is cut into full sequences and a remainder; full ones need no partner.
Remainders are dealt at random into groups of about ``GROUP`` and every group is packed by itself:
remainders in descending length go to the first sequence with room, found in logarithmic time in a
tournament tree whose inner nodes hold the largest room below them.

The encoded pieces (a few numbers each, no text) are written once, so the number of groups can follow
their count and the random deal stays the same if a task is repeated. Null text is empty and becomes its
end id alone. Rows with equal or null ids are documents of their own; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, written
from tessera.llm.token_files import with_end
from tessera.llm.tokens import encoder

LENGTH = 2048
GROUP = 8192


class Rooms:
    """Tournament tree over sequences: leaves hold the room left, inner nodes the larger room below."""

    def __init__(self, n: int, room: int):
        self.width = 1 << max(0, n - 1).bit_length()
        self.tree = [room] * (2 * self.width)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first sequence with room: its number, and its room before."""
        i, tree = 1, self.tree
        while i < self.width:
            i *= 2
            if tree[i] < size:
                i += 1
        room = tree[i]
        tree[i] = room - size
        bin_number = i - self.width
        while i > 1:
            i //= 2
            larger = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == larger:
                break
            tree[i] = larger
        return bin_number, room


def first_fit_decreasing(lengths: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item; equal lengths keep their order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms = Rooms(len(lengths), room)
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        bins[i], left = rooms.first_fit(sizes[i])
        offsets[i] = room - left
    return bins, offsets


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, row long"


def pieces(docs: DataFrame, tokenizer: str, end: int, lower: bool = True, length: int = LENGTH, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's ids cut every ``length``; ``part`` and ``row`` name a piece."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc, row = TaskContext.get().partitionId(), encoder(tokenizer, lower), 0
        for batch in slices(batches, "text", 4 << 20):
            lengths, ids = with_end(*enc.encode(batch.column("text")), end)
            cuts = -(-lengths // length)
            doc = np.repeat(np.arange(len(lengths)), cuts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * length
            size = np.minimum(length, lengths[doc] - start)
            begin = (np.cumsum(lengths) - lengths)[doc] + start
            data = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(doc)),
                    pa.array(start),
                    pa.array(size),
                    pa.array(crc, pa.int64()),
                    pa.array(lengths[doc]),
                    pa.array(np.full(len(doc), part, np.int32)),
                    pa.array(row + np.arange(len(doc))),
                ],
                names=[f.split()[0] for f in _PIECES.split(", ")],
            )
            row += len(doc)

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, _PIECES)


def pack(docs: DataFrame, tokenizer: str, end: int, lower: bool = True, length: int = LENGTH, group: int = GROUP, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Each piece with its sequence and its offset there; sequence numbers are unique, not gapless."""
    cut = written(pieces(docs, tokenizer, end, lower, length, id_column, text), "pieces")
    out = [f.split()[0] for f in _PIECES.split(", ")][:5]
    full = cut.where(F.col("length") == length).select(
        *out,
        ((F.shiftleft(F.col("part").cast("long"), 38) + F.col("row")) * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = cut.where(F.col("length") < length)
    groups = max(1, -(-rest.count() // group))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "row"], ignore_index=True)
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), length)
        return frame[out].assign(sequence_id=2 * ((int(key[0]) << 30) + bins) + 1, offset=offsets)

    dealt = rest.withColumn("__group", F.pmod(F.xxhash64("part", "row"), F.lit(groups)))
    return full.unionByName(dealt.groupBy("__group").applyInPandas(fit, schema))
