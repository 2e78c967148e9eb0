"""Writing streams to lake tables. Every batch is a load, named by stream and number; repeated, it replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera import layout as lake
from tessera.layout import LOAD, Layout, read_table, table_exists
from tessera.operators import dedup, keyed, scd, sinks
from tessera.session import scratch

BATCH = "_batch_id"
#: Partition column of rows that are kept by day.
DAY = f"{lake.OWN}day"


def _start(stream: DataFrame, apply, checkpoint: str, mode: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(apply).outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_table(
    stream: DataFrame,
    layout: Layout,
    checkpoint: str,
    available_now: bool = True,
    on_rows: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Rows of a stream appended to a table, each batch once; ``on_rows`` is told the rows of each."""

    def apply(rows: DataFrame, number: int) -> None:
        observed = sinks.append(rows, layout, batch=(checkpoint, number))
        if on_rows is not None:
            on_rows(observed[lake.ROWS])

    return _start(stream, apply, checkpoint, "append", available_now)


def upsert_table(
    rollup: DataFrame, layout: Layout, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Changed rows of a windowed rollup added to a table, each batch once.

    A batch writes only what changed; ``read_upserted`` gives the last row per key, and
    ``fold_upserts`` rewrites the table to that state from time to time.
    """

    def apply(rows: DataFrame, number: int) -> None:
        numbered = rows.withColumn(BATCH, F.lit(number).cast("long"))
        sinks.append(numbered, layout, batch=(checkpoint, number))

    return _start(rollup, apply, checkpoint, "update", available_now)


def rollup_table(
    cleaned: DataFrame,
    kept: Layout,
    target: Layout,
    rollup: Callable[[DataFrame], DataFrame],
    keys: list[str],
    window: str,
    checkpoint: str,
    width: str = "1 hour",
    time: str = "Timestamp",
    touched: Callable[[DataFrame], DataFrame] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """A windowed rollup kept exactly, whatever order rows arrive in.

    Each batch appends its cleaned rows to ``kept``, finds the keys and windows that they touch, computes
    these again from the kept rows of just those with the batch function, and upserts them into ``target``. So
    late rows count, distinct counts are exact, and the stream has every column that the batch form has.
    ``kept`` is partitioned by day: only days that touched windows reach into are read, and of them the rows of
    touched keys and windows go into the aggregate.
    ``keys`` are the rollup's keys, its ``window`` column among them, and windows of ``width`` follow each other
    without overlap. ``touched`` gives the touched keys of new rows where the rollup itself leaves some out,
    as an alert with a limit does, or where it does more than its keys need.
    """
    others = [k for k in keys if k != window]

    def apply(rows: DataFrame, number: int) -> None:
        batch = (checkpoint, number)
        day = F.coalesce(F.to_date(time), F.lit("0001-01-01").cast("date"))
        sinks.append(rows.withColumn(DAY, day), kept, batch=batch, partitioned=(DAY,))
        # From the rows as kept, so that the batch is parsed and cleaned once; looked at twice, so written.
        brought = lake.read_whole(rows.sparkSession, kept).where(F.col(LOAD) == lake.load_name(*batch)).drop(DAY, LOAD)
        hit = _written((touched or rollup)(brought).select(*keys).distinct(), "touched")
        again = touched_rows(rows.sparkSession, kept, hit, others, window, width, time)
        if again is not None:
            sinks.append(rollup(again).withColumn(BATCH, F.lit(number).cast("long")), target, batch=batch)

    return _start(cleaned, apply, checkpoint, "append", available_now)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_rows(
    spark: SparkSession, kept: Layout, hit: DataFrame, others: list[str], window: str, width: str, time: str
) -> DataFrame | None:
    """The kept rows of the keys and windows in ``hit``; None where it is empty.

    The days that the windows reach into are collected, one value per day, and prune the partitions read.
    """
    end = F.col(window) + F.expr(f"INTERVAL {width}") - F.expr("INTERVAL 1 MICROSECOND")
    reached = F.explode(F.sequence(F.to_date(window), F.to_date(end))).alias("day")
    days = sorted(r["day"] for r in hit.select(window).distinct().select(reached).distinct().collect() if r["day"])
    if not days:
        return None
    rows = read_whole_days(spark, kept, days)
    named = hit.select(*[F.col(k).alias(f"__{k}") for k in others], F.col(window).alias("__window"))
    rows = rows.withColumn("__start", F.window(F.col(time), width)["start"].cast("timestamp_ntz"))
    same = F.col("__start") == F.col("__window").cast("timestamp_ntz")
    for k in others:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(named, same, "left_semi").drop("__start")


def read_whole_days(spark: SparkSession, kept: Layout, days: list) -> DataFrame:
    """The rows of some days of a table that is partitioned by day."""
    return lake.read_whole(spark, kept).where(F.col(DAY).isin(days)).drop(DAY, LOAD)


def latest_upserts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return dedup.latest(rows, keys, [F.col(BATCH).desc()], [])


def read_upserted(spark: SparkSession, layout: Layout, keys: list[str]) -> DataFrame:
    """The table as it stands: the row of the newest batch per key."""
    return latest_upserts(read_table(spark, layout), keys).drop(BATCH)


def fold_upserts(spark: SparkSession, layout: Layout, keys: list[str]) -> int:
    """Rewrite an upsert table to one row per key; returns the rows written.

    Rows keep the numbers of their batches, so a batch that is repeated later changes nothing.
    """
    return sinks.overwrite(latest_upserts(read_table(spark, layout), keys), layout)[lake.ROWS]


def change_table(
    changes: DataFrame, layout: Layout, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Change records appended to their log, each batch once; ``read_history`` gives the history.

    The log holds every change as it came, so the history is the same however the stream was cut into
    batches, late changes included.
    """
    return append_table(changes, layout, checkpoint, available_now)


def read_history(
    spark: SparkSession,
    layout: Layout,
    keys: list[str],
    tracked: list[str],
    time: str,
    position: list[Column] | None = None,
    deleted: Column | None = None,
) -> DataFrame:
    """The type-2 history of a change log as it stands."""
    return scd.from_changes(read_table(spark, layout), keys, tracked, time, position, deleted)


def fold_history(spark: SparkSession, layout: Layout, target: Layout, keys: list[str], tracked: list[str], time: str, **how) -> int:
    """Write the history of a change log to its own table; returns the versions written."""
    return sinks.overwrite(read_history(spark, layout, keys, tracked, time, **how), target)[lake.ROWS]


def change_history(
    changes: DataFrame,
    log: Layout,
    history: Layout,
    checkpoint: str,
    keys: list[str],
    tracked: list[str],
    time: str,
    position: list[Column] | None = None,
    deleted: Column | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Change records appended to their log, and the history of their keys kept up to date, batch by batch.

    A batch reads and rewrites the buckets of its keys only (``keyed.merge_changes``); the history equals
    ``read_history`` of the whole log after every batch.
    """

    def apply(rows: DataFrame, number: int) -> None:
        load = lake.load_name(checkpoint, number)
        keyed.merge_changes(rows, log, history, load, keys, tracked, time, position, deleted)

    return _start(changes, apply, checkpoint, "append", available_now)


def late_rows(query: StreamingQuery) -> int:
    """Rows a query dropped as later than its watermark, from the progress it still remembers."""
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)
