"""A corpus pipeline: quality rules, repeated lines, near-duplicates, benchmark passages, packing.

Every stage takes the documents that the one before it kept and returns documents with the same columns,
the last one returns packed pieces. Stages write what they return as Parquet before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, near_dups, packing, quality
from tessera.llm.common import table, written
from tessera.llm.tokens import tokenizer_path


ROW = "__row"


def _wrapped(docs: DataFrame) -> DataFrame:
    """Id and text beside the rest of the row, whose columns then keep their values whatever an operator's are called."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias(ROW), "doc_id", "text")


def _unwrapped(columns: list[str]) -> dict[str, Column]:
    return {c: F.col("text") if c == "text" else F.col(f"{ROW}.`{c}`") for c in columns}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' votes keep."""
    kept = quality.judge(_wrapped(docs)).where("kept")
    return kept.select(*[e.alias(c) for c, e in _unwrapped(docs.columns).items()])


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; ``n_chars`` follows the text.

    A document that held nothing else stays as an empty one.
    """
    cleaned = line_dedup.remove(_wrapped(docs), whole=True)
    columns = _unwrapped(docs.columns)
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(columns["n_chars"])
    return cleaned.select(*[e.alias(c) for c, e in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; documents without an id stay."""
    dropped = near_dups.link(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), end=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("packed", packed),
]

#: Votes weighed by estimation and token ids cannot be expressed in SQL; tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
