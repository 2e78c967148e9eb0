"""End-to-end jobs: configuration rows in, one result row per entity, model or table out.

The driver loops over configuration rows; each step is a Spark job over whole tables. A failing
entity or model is recorded and does not stop the others; ``parallelism`` runs that many at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.config import Entity, Model, Rule, Transformation
from tessera.functions.columns import as_time, watermark_text
from tessera import layout as lake
from tessera.layout import LOAD, ROWS, Layout, bronze, gold, load_name, loads, quarantine, read_table, silver, table_exists
from tessera.operators import audit, drift, history, key_counts, maintain, profile, quality, sinks
from tessera.operators import gold as models
from tessera.operators import silver as transforms
from tessera.sources import readers
from tessera.streaming.tables import append_table

# --- bronze ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LoadResult:
    entity_id: int
    entity_name: str
    status: str
    rows_read: int = 0
    rows_written: int = 0
    watermark_after: str | None = None
    error: str | None = None


LOAD_RESULT = (
    "entity_id int, entity_name string, status string, rows_read long, rows_written long, "
    "watermark_after string, error string"
)


def _each(items: Iterable[Any], run: Callable[[Any], Any], parallelism: int) -> list[Any]:
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(run, items))


def target_of(base: str, entity: Entity) -> Layout:
    return bronze(base, (entity.table or entity.name.split(".")[0]).split(".")[-1])


def load_entity(
    spark: SparkSession,
    entity: Entity,
    base: str,
    run_id: str,
    as_of,
    rows: DataFrame | None = None,
) -> LoadResult:
    """Read, tag, reconcile the schema, write once, advance the watermark.

    FULL replaces the table; every other load type adds what lies above the last position, as the load of
    this run: a repeated run replaces what it brought. Row count and next watermark are observed on the
    write, so the source is read once.
    """
    source = readers.read_entity(spark, entity) if rows is None else rows
    column = "__$start_lsn" if entity.load_type == "CDC" else entity.watermark_column
    metrics = {}
    if column and column in source.columns:
        kind = source.schema[column].dataType
        newest = F.max(F.col(f"`{column}`"))
        text = F.hex(newest) if entity.load_type == "CDC" else watermark_text(newest, kind)
        metrics["watermark"] = text
    tagged = audit.bronze(
        source,
        entity.source_name,
        entity.name,
        entity.load_type,
        entity.last_watermark,
        run_id,
        f"{run_id}-{entity.entity_id}",
        as_of,
    )
    layout = target_of(base, entity)
    target = read_table(spark, layout) if table_exists(spark, layout) else None
    checked, _ = drift.handle(tagged, target, entity.drift_strategy)
    if entity.load_type == "FULL":
        observed = sinks.overwrite(checked, layout, metrics, load_name(run_id), keep_if_empty=True)
    else:
        observed = sinks.append(checked, layout, metrics, run_id)
    count = observed[ROWS]
    after = observed.get("watermark") or entity.last_watermark
    return LoadResult(entity.entity_id, entity.name, "SUCCEEDED", count, count, after)


def load_stream(
    spark: SparkSession, entity: Entity, stream: DataFrame, base: str, run_id: str, as_of, checkpoint: str
) -> LoadResult:
    """STREAMING load: everything that has arrived is appended, then the query stops."""
    layout = target_of(base, entity)
    counts: list[int] = []
    tagged = audit.bronze(
        stream, entity.source_name, entity.name, "STREAMING", None, run_id,
        f"{run_id}-{entity.entity_id}", as_of,
    )
    append_table(tagged, layout, checkpoint, on_rows=counts.append).awaitTermination()
    count = sum(counts)
    return LoadResult(entity.entity_id, entity.name, "SUCCEEDED", count, count, None)


def job_bronze(
    spark: SparkSession, entities: list[Entity], base: str, run_id: str, as_of, parallelism: int = 1
) -> DataFrame:
    def run(entity: Entity) -> LoadResult:
        try:
            return load_entity(spark, entity, base, run_id, as_of)
        except Exception as e:  # recorded; the other entities go on
            return LoadResult(
                entity.entity_id, entity.name, "FAILED", watermark_after=entity.last_watermark, error=str(e)
            )

    results = [tuple(asdict(r).values()) for r in _each(entities, run, parallelism)]
    return spark.createDataFrame(results, LOAD_RESULT)


# --- quality ---------------------------------------------------------------------------------------


def checked_layout(base: str, table: str) -> Layout:
    """Rows of a bronze table that passed its rules."""
    return bronze(base, table, "checked")


def job_quality(
    spark: SparkSession,
    table: str,
    rules: list[Rule],
    base: str,
    run_id: str,
    as_of,
    references: dict[str, DataFrame] | None = None,
    redo: Iterable[str] = (),
) -> DataFrame:
    """Evaluate rules on what arrived since the last run, keep the results, split good from bad rows.

    Only loads of the bronze table that are not checked yet, or named by ``redo``, are read. Good rows go to the
    checked table and bad ones with ``SourceTable`` and ``QuarantineTime`` to the quarantine, each as the load
    it came with, so repeating a run adds nothing. Loads that the bronze table holds no longer leave the checked
    table.

    Unique rules hold over all loads: counts of keys are kept per column (``key_counts``). Rows and failures of
    such a rule are those of the whole table, and earlier rows whose key is repeated by a new load move from
    the checked table to the quarantine; ``requarantined_count`` tells how many.
    """
    source, target, rejected = bronze(base, table), checked_layout(base, table), quarantine(base, table)
    lake.require(spark, source)
    present, checked_loads = loads(spark, source), loads(spark, target)
    done = {*checked_loads, *loads(spark, rejected)} - set(redo)
    fresh = [x for x in present if x not in done]
    gone = [x for x in checked_loads if x not in present]
    df = lake.read_whole(spark, source).where(F.col(LOAD).isin(fresh)) if fresh else lake.read_whole(spark, source).limit(0)

    unique = [r for r in rules if r.kind == "UNIQUE"]
    found = {c: key_counts.deliver(df, c, base, table, present) for c in dict.fromkeys(r.column for r in unique)}
    counted = {r.rule_id: (r, found[r.column].rows, found[r.column].keys) for r in unique}
    rest = quality.evaluate(df.drop(LOAD), [r for r in rules if r.kind != "UNIQUE"], references)
    results = rest.unionByName(quality.unique_results(spark, counted)) if unique else rest
    results = spark.createDataFrame(results.collect(), results.schema)  # one row per rule
    sinks.append(
        quality.results_table(results, f"{run_id}-{table}", as_of),
        Layout(base, "system", "dq", "results"),
        load=load_name(run_id, table),
    )

    stamp = {"SourceTable": F.lit(f"bronze.{table}"), "QuarantineTime": as_time(as_of)}
    repeated = {c: f.repeated for c, f in found.items()}
    checked = quality.failed_rules(df, rules, references, repeated=repeated)
    clean = F.size("_dq_failed_rules") == 0
    good, bad = checked.where(clean).drop("_dq_failed_rules"), checked.where(~clean).withColumns(stamp)
    _make_room(spark, target, good.drop(LOAD), [*gone, *fresh])
    _make_room(spark, rejected, bad.drop(LOAD), fresh)
    moved = _requarantine(spark, target, rejected, unique, found, fresh, stamp)
    _insert(good, target)
    count = _insert(bad, rejected)
    return quality.status(results).select(
        F.lit(table).alias("table_name"),
        "*",
        F.lit(count).cast("long").alias("quarantine_count"),
        F.lit(moved).cast("long").alias("requarantined_count"),
    )


def _make_room(spark: SparkSession, layout: Layout, rows: DataFrame, replaced: list[str]) -> None:
    """A table with the columns of ``rows`` and without the loads that are replaced."""
    if not table_exists(spark, layout):
        lake.create(spark, layout, rows.schema)
        return
    lake.evolve(spark, layout, rows.schema)
    lake.drop_partitions(spark, layout, [p for p in lake.partitions(spark, layout) if p[LOAD] in replaced])


def _insert(rows: DataFrame, layout: Layout) -> int:
    """Rows that bring their loads with them."""
    spark = rows.sparkSession
    wanted = StructType([*lake.fields(spark, layout).fields, rows.schema[LOAD]])
    return lake.insert(drift.conform(rows, wanted), layout)[ROWS]


def _requarantine(
    spark: SparkSession,
    target: Layout,
    rejected: Layout,
    unique: list[Rule],
    found: dict[str, key_counts.Found],
    fresh: list[str],
    stamp: dict[str, Column],
) -> int:
    """Move checked rows of earlier loads whose key is repeated now; only the loads that hold such rows are read."""
    held = set(loads(spark, target)) - set(fresh)
    hit = sorted(held & {x for r in unique if r.quarantine for x in found[r.column].loads})
    if not hit:
        return 0
    old = lake.read_whole(spark, target).where(F.col(LOAD).isin(hit))
    marked = quality.failed_rules(old, unique, repeated={c: f.repeated for c, f in found.items()})
    moved = marked.where(F.size("_dq_failed_rules") > 0).withColumns(stamp)
    before = lake.read_whole(spark, rejected).where(F.col(LOAD).isin(hit))
    wanted = lake.read_whole(spark, rejected).schema
    both = before.withColumn("__moved", F.lit(False)).unionByName(drift.conform(moved, wanted).withColumn("__moved", F.lit(True)))
    rows = lake.insert(both, rejected, {"moved": F.count_if("__moved")})["moved"]

    def rest(df: DataFrame) -> DataFrame:
        kept = quality.failed_rules(df, unique, repeated={c: f.repeated for c, f in found.items()})
        return kept.where(F.size("_dq_failed_rules") == 0).drop("_dq_failed_rules")

    sinks.rewrite(spark, target, rest, [{LOAD: x} for x in hit])
    return rows


# --- silver ----------------------------------------------------------------------------------------


def transform_table(
    spark: SparkSession,
    source: Layout,
    transformation: Transformation,
    target: Layout,
    references: dict[str, DataFrame],
    run_id: str,
    as_of,
) -> tuple[int, int]:
    """Run one transformation and write its result; returns the rows read and written.

    A history merges the loads that it has not taken yet, and that of this run. Other results depend on all
    rows, as a latest row per key does, and are made anew.
    """
    if transformation.kind == "SCD2":
        taken = set(taken_loads(spark, target)) - {load_name(run_id)}
        new = [x for x in loads(spark, source) if x not in taken]
        if not new:
            return 0, 0
        df = lake.read_whole(spark, source).where(F.col(LOAD).isin(new)).drop(LOAD)
        read = df.count()
        order = [F.col(transforms.INGESTED).desc()] if transforms.INGESTED in df.columns else []
        counts = history.merge_into(
            df,
            target,
            list(transformation.business_keys),
            transformation.logic.get("scd2_columns", []),
            as_of,
            order,
            transforms.scd_names(transformation.logic),
        )
        taken_rows = spark.createDataFrame([(target.name, x) for x in new], "target string, source_load string")
        sinks.append(taken_rows.coalesce(1), taken_layout(target.base), load=load_name(target.short_name, run_id))
        return read, counts["current"] + counts["closed"]
    df = read_table(spark, source)
    read = df.count()
    if read == 0:
        return 0, 0
    entity_run = f"{run_id}-{transformation.entity_id}"
    result = transforms.dispatch(df, transformation, references, run_id, entity_run, as_of)
    return read, sinks.overwrite(result, target)[ROWS]


def taken_layout(base: str) -> Layout:
    """The loads that each history has merged."""
    return Layout(base, "system", "loads", "taken")


def taken_loads(spark: SparkSession, target: Layout) -> list[str]:
    if not table_exists(spark, target) or not table_exists(spark, taken_layout(target.base)):
        return []
    rows = read_table(spark, taken_layout(target.base)).where(F.col("target") == target.name)
    return [r["source_load"] for r in rows.select("source_load").distinct().collect()]  # one row per load


def job_silver(
    spark: SparkSession,
    steps: list[tuple[Transformation, str, str]],
    base: str,
    run_id: str,
    as_of,
    references: dict[str, DataFrame] | None = None,
    source_schema: str = "raw",
) -> DataFrame:
    """Transformations in id order: (transformation, bronze table, silver table)."""
    results = []
    for transformation, source, target in sorted(steps, key=lambda s: s[0].transformation_id):
        row = (transformation.transformation_id, transformation.kind, target)
        try:
            read, written = transform_table(
                spark,
                bronze(base, source, source_schema),
                transformation,
                silver(base, target),
                references or {},
                run_id,
                as_of,
            )
            results.append((*row, "SUCCEEDED", read, written, None))
        except Exception as e:  # recorded; the other steps go on
            results.append((*row, "FAILED", 0, 0, str(e)))
    schema = (
        "transformation_id int, transformation_type string, table_name string, status string, "
        "rows_read long, rows_written long, error string"
    )
    return spark.createDataFrame(results, schema)


# --- gold ------------------------------------------------------------------------------------------


def _current_only(spark: SparkSession, layout: Layout) -> DataFrame:
    """A silver or gold table; of a stored history only the current rows, as models use no others."""
    return history.read_current(spark, layout) if history.is_history(spark, layout) else read_table(spark, layout)


def build_all(spark: SparkSession, configured: list[Model], base: str, run_id: str, as_of) -> DataFrame:
    """Build every model after those it depends on; sources come from silver, else from gold."""
    results = []
    for model in models.build_order(configured):
        try:
            sources = {
                name: _current_only(
                    spark, silver(base, name) if table_exists(spark, silver(base, name)) else gold(base, name)
                )
                for name in model.sources
            }
            rows = sinks.overwrite(models.build(sources, model, run_id, as_of), gold(base, model.name))[ROWS]
            results.append((model.name, model.kind, "SUCCEEDED", rows, None))
        except Exception as e:  # recorded; the other models go on
            results.append((model.name, model.kind, "FAILED", 0, str(e)))
    schema = "model_name string, model_type string, status string, rows_written long, error string"
    return spark.createDataFrame(results, schema)


def overall_status(results: DataFrame) -> DataFrame:
    """One row: SUCCEEDED, PARTIAL or FAILED, and the counts."""
    done = F.count_if(F.col("status") == "SUCCEEDED")
    failed = F.count_if(F.col("status") == "FAILED")
    counts = results.agg(
        F.count(F.lit(1)).alias("models_processed"), done.alias("succeeded"), failed.alias("failed")
    )
    status = (
        F.when(F.col("failed") == 0, "SUCCEEDED").when(F.col("succeeded") > 0, "PARTIAL").otherwise("FAILED")
    )
    return counts.select(status.alias("status"), *counts.columns)


def job_gold(spark: SparkSession, configured: list[Model], base: str, run_id: str, as_of) -> DataFrame:
    return build_all(spark, configured, base, run_id, as_of)


# --- profile, drift, maintenance -------------------------------------------------------------------


def job_profile(
    spark: SparkSession, tables: list[Layout], base: str, as_of, sample: tuple[float, list[str]] | None = None
) -> DataFrame:
    """Profile tables in full, or a share of their rows by key, and append the rows to the profile table."""
    target = Layout(base, "system", "profiles", "data_profiles")
    written = []
    for layout in tables:
        df = read_table(spark, layout)
        found = profile.sampled(df, *sample) if sample else profile.full(df)
        rows = profile.stamped(found.drop("table_rows"), layout.layer, layout.schema, layout.table, as_of)
        written.append((layout.table, sinks.append(rows, target, load=load_name(layout.short_name, as_of))[ROWS]))
    return spark.createDataFrame(written, "table_name string, columns_profiled long")


def job_drift(
    spark: SparkSession,
    batches: dict[int, tuple[DataFrame, Layout]],
    strategy: str,
    base: str,
    as_of,
) -> DataFrame:
    """Check landed batches against their tables, apply the strategy, log the drift.

    Schemas are compared on the driver; ``merge`` appends the batch, so the table gains its columns.
    """
    results = []
    for entity, (batch, layout) in batches.items():
        target = read_table(spark, layout) if table_exists(spark, layout) else None
        found = drift.compare(batch.schema, target.schema if target is not None else None)
        status = "CHECKED" if found.kind is None else strategy.upper()
        try:
            rows, _ = drift.handle(batch, target, strategy)
            if strategy in ("merge", "ignore"):
                sinks.append(rows, layout)
        except drift.SchemaDrift:
            status = "REJECTED"
        if found.kind:
            log = Layout(base, "system", "drift", "schema_drift_log")
            sinks.append(drift.log_entry(spark, entity, found, as_of).coalesce(1), log)
        counts = (len(found.added), len(found.removed), len(found.retyped))
        results.append((entity, layout.table, status, found.kind, *counts))
    schema = (
        "entity_id int, table_name string, status string, drift_type string, "
        "added int, removed int, retyped int"
    )
    return spark.createDataFrame(results, schema)


# A table counts as optimized when its small files were merged.
_OPTIMIZE = {"COMPACTED": "OPTIMIZED"}
MAINTENANCE = "table_name string, optimize string, compact string, cleanup string, removed long"


def maintain_table(
    spark: SparkSession, layout: Layout, files: int, days: int, as_of, max_files: int, dry_run: bool
) -> tuple:
    optimize = compacted = "SKIPPED"
    try:
        if files > max_files:
            compacted = maintain.compact(spark, layout, dry_run=dry_run)["status"]
            optimize = _OPTIMIZE.get(compacted, compacted)
        cleanup = maintain.retention(spark, layout, days, as_of, dry_run=dry_run)
        return layout.table, optimize, compacted, cleanup["status"], cleanup["removed"]
    except Exception:  # recorded; the other tables go on
        return layout.table, "FAILED", "FAILED", "FAILED", 0


def job_maintenance(
    spark: SparkSession,
    tables: list[Layout],
    days: int,
    as_of,
    max_files: int = maintain.MAX_FILES,
    dry_run: bool = False,
    parallelism: int = 1,
) -> DataFrame:
    """Statistics of all tables in one job, then compaction where needed and retention, per table."""
    stats = maintain.table_stats(spark, tables).select("layer", "schema", "table_name", "num_files")
    files = {tuple(r)[:3]: r["num_files"] for r in stats.collect()}  # one row per table

    def run(layout: Layout) -> tuple:
        count = files.get((layout.layer, layout.schema, layout.table), 0)
        return maintain_table(spark, layout, count, days, as_of, max_files, dry_run)

    return spark.createDataFrame(_each(tables, run, parallelism), MAINTENANCE)


def job_storage_review(
    spark: SparkSession,
    base: str,
    layers: list[str],
    action: str,
    days: int,
    as_of,
    dry_run: bool = True,
    max_files: int = maintain.MAX_FILES,
) -> DataFrame:
    """Sizes, compaction and, for the cleaning actions, retention over several layers."""
    tables = [t for layer in layers for t in maintain.list_tables(spark, base, layer)]
    sizes = maintain.table_stats(spark, tables)
    found = {(r["layer"], r["schema"], r["table_name"]): r for r in sizes.collect()}  # one per table
    rows = []
    for layout in tables:
        size = found[(layout.layer, layout.schema, layout.table)]
        action_days = days if action in ("cleanup", "optimize_all") else None
        optimize = compacted = cleanup = "SKIPPED"
        removed = 0
        if size["num_files"] > max_files:
            compacted = maintain.compact(spark, layout, dry_run=dry_run)["status"]
            optimize = _OPTIMIZE.get(compacted, compacted)
        if action_days is not None:
            result = maintain.retention(spark, layout, action_days, as_of, dry_run=dry_run)
            cleanup, removed = result["status"], result["removed"]
        rows.append(
            (layout.layer, layout.table, size["num_files"], size["size_in_bytes"], optimize, compacted,
             cleanup, removed)
        )
    schema = (
        "layer string, table_name string, num_files long, size_in_bytes long, optimize string, "
        "compact string, cleanup string, removed long"
    )
    return spark.createDataFrame(rows, schema)


# --- medallion -------------------------------------------------------------------------------------


RUN_EVENTS = (
    "RunKind string, RunId string, ParentRunId string, Name string, EventType string, EventTime timestamp_ntz, Status string, "
    "RowsRead long, RowsWritten long, RowsRejected long, WatermarkBefore string, WatermarkAfter string, ErrorMessage string"
)


def run_events_layout(base: str) -> Layout:
    """The table that every run adds its events to."""
    return Layout(base, "system", "runs", "run_events")


def run_entity(
    spark: SparkSession,
    entity: Entity,
    rules: list[Rule],
    steps: list[tuple[Transformation, str]],
    base: str,
    run_id: str,
    as_of,
    references: dict[str, DataFrame],
) -> LoadResult:
    """Bronze, quality and silver of one entity; only rows that pass the rules reach silver."""
    loaded = load_entity(spark, entity, base, run_id, as_of)
    table = target_of(base, entity).table
    rejected = 0
    schema = "raw"
    if rules:
        again = (load_name(run_id),) if loaded.rows_read else ()
        report = job_quality(spark, table, rules, base, run_id, as_of, references, again).first()
        rejected, schema = report["quarantine_count"], "checked"
    for transformation, target in sorted(steps, key=lambda s: s[0].transformation_id):
        transform_table(
            spark,
            bronze(base, table, schema),
            transformation,
            silver(base, target),
            references,
            run_id,
            as_of,
        )
    return replace(loaded, rows_written=loaded.rows_read - rejected)


def job_medallion(
    spark: SparkSession,
    entities: list[Entity],
    rules: dict[int, list[Rule]],
    steps: dict[int, list[tuple[Transformation, str]]],
    configured: list[Model],
    base: str,
    run_id: str,
    as_of,
    references: dict[str, DataFrame] | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """Bronze, quality and silver per entity, then gold. Returns the run events and adds them to their table.

    The run starts at ``as_of``; later events are later by the time that passed.
    """
    began = time.monotonic()
    first = datetime.fromisoformat(str(as_of))

    def now() -> datetime:
        return first + timedelta(seconds=time.monotonic() - began)

    def start(kind: str, number: str, name: str, before: str | None = None) -> tuple:
        parent = None if kind == "pipeline" else run_id
        return kind, number, parent, name, "start", now(), "RUNNING", None, None, None, before, None, None

    def end(begun: tuple, status: str, read=None, written=None, rejected=None, after=None, error=None) -> tuple:
        return (*begun[:4], "end", now(), status, read, written, rejected, begun[10], after, error)

    def run(entity: Entity) -> list[tuple]:
        begun = start("entity", f"{run_id}-{entity.entity_id}", entity.name, entity.last_watermark)
        try:
            r = run_entity(
                spark, entity, rules.get(entity.entity_id, []), steps.get(entity.entity_id, []),
                base, run_id, as_of, references or {},
            )
            rejected = r.rows_read - r.rows_written
            return [begun, end(begun, r.status, r.rows_read, r.rows_written, rejected, r.watermark_after)]
        except Exception as e:  # recorded; the other entities go on
            return [begun, end(begun, "FAILED", after=entity.last_watermark, error=str(e))]

    whole = start("pipeline", run_id, "medallion")
    events = [e for pair in _each(entities, run, parallelism) for e in pair]
    for r in build_all(spark, configured, base, run_id, as_of).collect():  # one row per model
        begun = start("gold", f"{run_id}-{r['model_name']}", r["model_name"])
        events += [begun, end(begun, r["status"], written=r["rows_written"], error=r["error"])]
    failed = sum(e[6] == "FAILED" for e in events)
    done = sum(e[6] == "SUCCEEDED" for e in events)
    status = "SUCCEEDED" if not failed else "PARTIAL" if done else "FAILED"
    report = spark.createDataFrame([whole, *events, end(whole, status)], RUN_EVENTS)
    sinks.append(report.coalesce(1), run_events_layout(base), load=run_id)
    return report
