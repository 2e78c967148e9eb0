"""The pipeline: stages, columns, decisions, and the entry module without these packages."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from tessera.llm import queries
from tessera.llm.common import written
from tests.llm.odd_tables import odd
from tests.llm.test_groups import plain_components, plain_measures, plain_repeats

ROOT = Path(__file__).resolve().parents[2]


def test_stages_do_what_plain_versions_do(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    assert list(stages) == ["quality_rules", "repeated_lines", "near_duplicates", "benchmark_passages", "packed"]

    def rows(df):
        return {r.doc_id: r.text for r in df.collect()}

    before = rows(docs)
    docs = written(stages["quality_rules"](spark, docs, small), "t")
    kept = rows(docs)
    assert docs.columns == columns and kept.keys() < before.keys()
    for d in before.keys() - kept.keys():
        n = plain_measures(before[d])
        assert n[0] < 10 or 100 * n[4] > 20 * n[0] or n[2] * 4 > n[0]
    docs = written(stages["repeated_lines"](spark, docs, small), "t")
    gone = plain_repeats(sorted(kept.items()), 50)
    lined = rows(docs)
    assert docs.columns == columns and lined.keys() == kept.keys()
    assert {d for d in kept if kept[d] != lined[d]} == {d for d in gone if gone[d]}
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    docs = written(stages["near_duplicates"](spark, docs, small), "t")
    groups = plain_components(lined.items())
    assert rows(docs).keys() == {d for d, (_, c) in groups.items() if c == d}
    clean = written(stages["benchmark_passages"](spark, docs, small), "t")
    hit = {r.doc_id for r in queries.decontaminate.report(docs, spark.read.parquet(f"{small}/benchmark.parquet")).collect() if r.contaminated}
    assert rows(clean).keys() == rows(docs).keys() - hit
    pieces = stages["packed"](spark, clean, small)
    assert {r.doc_id for r in pieces.collect()} == rows(clean).keys()
    assert corpus_pipeline.run(spark, small).count() == pieces.count()


def test_stages_on_odd_rows(spark, small):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, small), "t")
        assert after.columns == docs.columns
        kept = {r.doc_id: (r.kept, r.n_words) for r in odd(spark).collect()}
        assert all((r.kept, r.n_words) == kept[r.doc_id] for r in after.collect())
        stage(spark, docs.where("false"), small).count()
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() > 0


def test_library_does_not_import_this_subpackage():
    code = "import tessera.suite, tessera.plans.jobs, sys; sys.exit(any(m.startswith('tessera.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
