"""What the operators of this subpackage share: tables, written intermediate results, word patterns."""

from __future__ import annotations

import ctypes
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch

#: Words are runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder below the shared scratch root and read again.

    Cuts the lineage and keeps results that are used more than once from being computed twice. The
    files are in storage that every executor reaches, so a lost executor costs nothing.
    """
    path = scratch(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Taken:
    """Places of a text that are taken, as intervals in order that do not touch; asked by halving."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for begin, end in sorted(spans):
            if self.ends and begin <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(begin)
                self.ends.append(end)

    def meets(self, begin: int, end: int) -> bool:
        """Whether a place from ``begin`` up to ``end`` is taken."""
        i = bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > begin


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most_bytes`` at most, or one row.

    Between slices the worker gives free memory back, since idle workers stay beside busy ones.
    """
    for batch in batches:
        lengths = np.diff(_offsets(batch.column(column)))
        begin, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > most_bytes:
                yield batch.slice(begin, i - begin)
                _give_back()
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)
            _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def own_texts(texts: pa.Array) -> pa.Array:
    """The texts, null as empty, copied out of whatever larger array they are a slice of.

    Some string kernels misread arrays whose first offset is not zero.
    """
    return pc.fill_null(texts, "").cast(pa.large_string()).take(pa.array(np.arange(len(texts))))


def _offsets(array: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    return np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i]`` of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = starts - (ends - lengths)
    kind = np.int32 if max(total, int(np.abs(shift).max(initial=0)), int(starts.max(initial=0))) < 2**30 else np.int64
    out = np.repeat(shift.astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def extended(df: DataFrame, ddl: str, drop: str | None = None) -> tuple[list[str], T.StructType]:
    """Names of the columns of ``df`` that stay, and the schema with the columns of ``ddl`` after them.

    A column of the table that has the name of a new one gives way to it.
    """
    new = T.StructType.fromDDL(ddl).fields
    names = {f.name for f in new} | {drop}
    stay = [f for f in df.schema.fields if f.name not in names]
    return [f.name for f in stay], T.StructType(stay + new)
