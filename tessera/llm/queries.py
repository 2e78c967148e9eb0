"""The registered queries of this subpackage, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, html_text, line_dedup, lm_score, near_dups, packing, piece_codec, pii, quality, secret_scan, spelling, token_files, whitening
from tessera.llm.common import table
from tessera.llm.tokens import tokenizer_path
from tessera.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


@query
def op1_repeated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove(docs).drop("text")


ORACLES["op1_repeated_runs"] = line_dedup.ORACLE


@query
def op1_whole_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove(docs, whole=True).drop("text")


@query
def op2_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_plane_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "llm-planes")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end=2)
    read = token_files.read(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op5_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end=1)


@query
def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, keep_text=False).select("doc_id", *quality.MEASURES, "base_failed", "kept", "quality")


@query
def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op7_positional_index"] = decontaminate.ORACLE


@query
def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query
def op9_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op10_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.link(table(spark, sf_dir, "documents"))


ORACLES["op10_odd_sketches"] = near_dups.ORACLE


@query
def op11_sorted_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"), alter_every=31)


@query
def op12_prefix_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = piece_codec.decode(piece_codec.encode(docs, path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components_table(table(spark, sf_dir, "embeddings"))
