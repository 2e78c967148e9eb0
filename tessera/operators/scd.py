"""Type-2 history as a pure function: history and batch in, new history out.

History rows carry ``ValidFrom``, ``ValidTo`` and ``IsCurrent``; every key has at most one current
row. Closed rows never change, so they skip every join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tessera.functions.columns import OPEN_END, all_of, any_of, as_time, differs
from tessera.operators import dedup, drift
from tessera.plans.lookup import fits_broadcast


@dataclass(frozen=True)
class Names:
    """Names of the three history columns."""

    valid_from: str = "ValidFrom"
    valid_to: str = "ValidTo"
    is_current: str = "IsCurrent"

    @property
    def all(self) -> list[str]:
        return [self.valid_from, self.valid_to, self.is_current]


DEFAULT = Names()


def prepare(
    batch: DataFrame,
    keys: list[str],
    order: list[Column] | None = None,
    names: Names = DEFAULT,
) -> DataFrame:
    """The batch with one row per key, the latest; rows with a null key are left out."""
    rows = batch.drop(*names.all).where(all_of([F.col(k).isNotNull() for k in keys]))
    return dedup.latest(rows, keys, order or [])


def rejected(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows with a null key, which no history can hold."""
    return batch.where(any_of([F.col(k).isNull() for k in keys]))


def initial(batch: DataFrame, as_of, names: Names = DEFAULT) -> DataFrame:
    """First load: every row current and open-ended."""
    return batch.withColumns(
        {
            names.valid_from: as_time(as_of),
            names.valid_to: as_time(OPEN_END),
            names.is_current: F.lit(True),
        }
    )


def _compared(tracked: list[str], batch: DataFrame) -> list[str]:
    return [c for c in tracked if c in batch.columns]


def detect_changes(
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    tracked: list[str],
    names: Names = DEFAULT,
) -> DataFrame:
    """Batch rows that are new or differ, null-safely, from the current row in a tracked column.

    ``batch`` has one row per key, see ``prepare``. A small batch meets only the current rows it
    touches: they are picked by a broadcast join, and the second join is as small as the batch.
    """
    compared = _compared(tracked, batch)
    current = history.where(F.col(names.is_current)).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c).alias(f"__t_{c}") for c in compared],
        F.lit(True).alias("__present"),
    )
    if fits_broadcast(batch):
        wanted = batch.select(*[F.col(k).alias(f"__w_{k}") for k in keys])
        touches = all_of([F.col(f"__k_{k}") == F.col(f"__w_{k}") for k in keys])
        current = current.join(wanted, touches, "left_semi")
    joined = batch.join(current, all_of([batch[k] == current[f"__k_{k}"] for k in keys]), "left")
    changed = any_of([differs(F.col(c), F.col(f"__t_{c}")) for c in compared])
    return joined.where(F.col("__present").isNull() | changed).select(*batch.columns)


def expire(
    history: DataFrame,
    changed: DataFrame,
    keys: list[str],
    as_of,
    names: Names = DEFAULT,
) -> DataFrame:
    """Current rows, those of changed keys closed at ``as_of``."""
    current = history.where(F.col(names.is_current))
    closing = changed.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__close"))
    joined = current.join(closing, all_of([current[k] == closing[f"__k_{k}"] for k in keys]), "left")
    close = F.col("__close").isNotNull()
    return joined.withColumns(
        {
            names.valid_to: F.when(close, as_time(as_of)).otherwise(F.col(names.valid_to)),
            names.is_current: ~close,
        }
    ).select(*history.columns)


def merge_current(
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of,
    names: Names = DEFAULT,
    broadcast_batch: bool | None = None,
) -> DataFrame:
    """Current rows after the batch: kept, closed and new versions.

    A small batch against a large history is under Spark's broadcast limit, so the current rows stay
    where they are.
    Otherwise both are joined once by key, and each pair of rows yields one or two versions.
    ``broadcast_batch`` overrides the choice, for tests. Whatever the plan, both sides first take the merged
    schema: the wider of two types, and columns that only one side has.
    """
    history, batch = _one_schema(history, batch, names)
    if broadcast_batch is None:
        broadcast_batch = fits_broadcast(batch) and not fits_broadcast(history)
    merge = _merge_by_broadcast if broadcast_batch else _merge_by_full_join
    return merge(history, batch, keys, tracked, as_of, names)


def _one_schema(history: DataFrame, batch: DataFrame, names: Names) -> tuple[DataFrame, DataFrame]:
    """The history in the merged schema, and the batch's own columns in its types."""
    schema = drift.merged_schema(batch.drop(*names.all).schema, history.schema)
    kinds = {f.name: f.dataType for f in schema.fields}
    data = [f for f in schema.fields if f.name not in names.all]
    ends = [f for f in schema.fields if f.name in names.all]
    return drift.conform(history, StructType(data + ends)), batch.select(
        *[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in batch.columns if c not in names.all]
    )


def _merge_by_broadcast(
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of,
    names: Names,
) -> DataFrame:
    compared = _compared(tracked, batch)
    delivered = batch.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        *[F.col(c).alias(f"__t_{c}") for c in compared],
        F.lit(True).alias("__present"),
    )
    current = history.where(F.col(names.is_current))
    joined = current.join(delivered, all_of([current[k] == delivered[f"__k_{k}"] for k in keys]), "left")
    close = F.col("__present").isNotNull() & any_of([differs(F.col(c), F.col(f"__t_{c}")) for c in compared])
    kept = joined.withColumns(
        {
            names.valid_to: F.when(close, as_time(as_of)).otherwise(F.col(names.valid_to)),
            names.is_current: ~close,
        }
    ).select(*history.columns)
    opened = initial(detect_changes(history, batch, keys, tracked, names), as_of, names)
    return kept.unionByName(opened, allowMissingColumns=True).select(*history.columns)


def _merge_by_full_join(
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of,
    names: Names,
) -> DataFrame:
    types = {f.name: f.dataType for f in history.schema.fields}
    data = [c for c in history.columns if c not in names.all]
    current = history.where(F.col(names.is_current)).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys],
        F.struct(*[F.col(c) for c in history.columns]).alias("old"),
    )
    incoming = batch.select(
        *[F.col(k).alias(f"__b_{k}") for k in keys],
        F.struct(*[F.col(c) for c in batch.columns]).alias("new"),
    )
    on = all_of([F.col(f"__k_{k}") == F.col(f"__b_{k}") for k in keys])
    joined = current.join(incoming, on, "full")

    old, new = F.col("old"), F.col("new")
    both = old.isNotNull() & new.isNotNull()
    compared = _compared(tracked, batch)
    changed = both & any_of([differs(old[c], new[c]) for c in compared])

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in history.columns])

    kept = version(
        {
            **{c: old[c] for c in data},
            names.valid_from: old[names.valid_from],
            names.valid_to: F.when(changed, as_time(as_of)).otherwise(old[names.valid_to]),
            names.is_current: ~changed,
        }
    )
    opened = version(
        {
            **{c: new[c] if c in batch.columns else F.lit(None) for c in data},
            names.valid_from: as_time(as_of),
            names.valid_to: as_time(OPEN_END),
            names.is_current: F.lit(True),
        }
    )
    versions = F.array(F.when(old.isNotNull(), kept), F.when(old.isNull() | changed, opened))
    return joined.select(F.inline(F.array_compact(versions)))


def closed_rows(history: DataFrame, names: Names = DEFAULT) -> DataFrame:
    return history.where(~F.col(names.is_current))


def apply(
    history: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of,
    order: list[Column] | None = None,
    names: Names = DEFAULT,
) -> DataFrame:
    """New history: changed keys closed and reopened, new keys opened, all other rows as they were.

    Absent keys stay current. Applying the same batch again changes nothing.
    """
    if not keys:
        raise ValueError("a type-2 history needs business keys")
    rows = prepare(batch, keys, order, names)
    if history is None:
        return initial(rows, as_of, names)
    merged = merge_current(history, rows, keys, tracked, as_of, names)
    return drift.conform(closed_rows(history, names), merged.schema).unionByName(merged)


def from_changes(
    changes: DataFrame,
    keys: list[str],
    tracked: list[str],
    time: str,
    position: list[Column] | None = None,
    deleted: Column | None = None,
    names: Names = DEFAULT,
) -> DataFrame:
    """The type-2 history that a log of changes describes, whatever order the log is in.

    Versions open at their own change time. Of several changes of a key at one time the last by
    ``position`` counts; a change that repeats the tracked columns opens no version. ``deleted`` is true
    for changes that end a key: its version closes then, and a later change opens a new one. Changes
    without key or time are left out.
    """
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    usable = all_of([F.col(k).isNotNull() for k in [*keys, time]])
    rows = changes.withColumn("__gone", gone).where(usable).withColumn(time, F.col(time).cast("timestamp_ntz"))
    one = dedup.latest(rows, [*keys, time], position or [])
    by_time = Window.partitionBy(*keys).orderBy(time)
    state = F.struct("__gone", *[F.when(~F.col("__gone"), F.col(c)).alias(c) for c in tracked])
    before = F.lag(state).over(by_time)
    steps = one.withColumn("__step", before.isNull() | ~state.eqNullSafe(before)).where("__step")
    return (
        steps.withColumn("__next", F.lead(time).over(by_time))
        .where(~F.col("__gone"))
        .withColumns(
            {
                names.valid_from: F.col(time),
                names.valid_to: F.coalesce("__next", as_time(OPEN_END)),
                names.is_current: F.col("__next").isNull(),
            }
        )
        .drop("__gone", "__step", "__next")
    )


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    change: Column | str,
    updates: dict[str, Column],
) -> DataFrame:
    """Update matched target rows for which ``change`` holds; all others stay.

    ``source`` holds one row per key; ``change`` and ``updates`` name its columns as
    ``source.<column>`` and the target's as ``target.<column>``.
    """
    left, right = target.alias("target"), source.withColumn("__matched", F.lit(True)).alias("source")
    on = all_of([F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys])
    condition = F.expr(change) if isinstance(change, str) else change
    hit = F.col("source.__matched").isNotNull() & F.coalesce(condition, F.lit(False))
    columns = [
        F.when(hit, updates[c]).otherwise(F.col(f"target.{c}")).alias(c) if c in updates else F.col(f"target.{c}")
        for c in target.columns
    ]
    return left.join(right, on, "left").select(*columns)
