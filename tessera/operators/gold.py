"""Gold models: dimensions, facts, aggregates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.config import Model
from tessera.operators import audit, joins, standardize


def dimension(sources: dict[str, DataFrame], model: Model, run_id: str, as_of) -> DataFrame:
    """Current rows of the first source table."""
    rows = standardize.current_rows(sources[model.sources[0]])
    return audit.gold(rows, model.name, run_id, as_of)


def fact(sources: dict[str, DataFrame], model: Model, run_id: str, as_of) -> DataFrame:
    """Primary table joined to each dimension's current rows, with computed columns and date parts.

    A dimension that fits is broadcast, so the fact is scanned once and never shuffled; each larger
    one costs a shuffle whose skewed partitions Spark splits at run time.
    """
    rows = sources[model.sources[0]]
    for name in model.sources[1:]:
        column, how = model.joins.get(name, (None, "left"))
        rows = joins.join_dimension(rows, standardize.current_rows(sources[name]), name, column, how)
    computed = {
        name: text
        for name, text in model.calculated.items()
        if not text.strip().upper().startswith("SUM(")
    }
    rows = standardize.date_parts(standardize.calculated_columns(rows, computed))
    return audit.gold(rows, model.name, run_id, as_of)


def measure(spec: str) -> Column:
    """``SUM(c)``, ``COUNT(c)``, ``COUNT(DISTINCT c)`` or ``AVG(c)`` as an aggregate column."""
    found = re.fullmatch(r"\s*(SUM|COUNT|AVG)\s*\(\s*(DISTINCT\s+)?(\w+)\s*\)\s*", spec, re.IGNORECASE)
    if found is None:
        raise ValueError(f"not an aggregate: {spec}")
    function, distinct, column = found[1].upper(), found[2], found[3]
    if function == "COUNT":
        return F.count_distinct(column) if distinct else F.count(column)
    return {"SUM": F.sum, "AVG": F.avg}[function](column)


def aggregate(sources: dict[str, DataFrame], model: Model, run_id: str, as_of) -> DataFrame:
    """First source table grouped by the grain; without grain or measures its rows pass unchanged."""
    rows = sources[model.sources[0]]
    measures = [measure(text).alias(name) for name, text in model.calculated.items()]
    if model.grain and measures:
        rows = rows.groupBy(*model.grain).agg(*measures)
    return audit.gold(rows, model.name, run_id, as_of)


BUILDERS = {"DIMENSION": dimension, "FACT": fact, "AGGREGATE": aggregate}


def build(sources: dict[str, DataFrame], model: Model, run_id: str, as_of) -> DataFrame:
    if model.kind not in BUILDERS:
        raise ValueError(f"unknown model type: {model.kind}")
    return BUILDERS[model.kind](sources, model, run_id, as_of)


def select_models(models: DataFrame, name: str | None = None) -> DataFrame:
    """Active models, optionally one, by priority."""
    active = models.where("IsActive")
    if name and name != "all":
        active = active.where(F.col("ModelName") == name)
    return active.orderBy("Priority", "ModelId")


def build_order(models: list[Model]) -> list[Model]:
    """Models by priority, each after the models it depends on."""
    by_name = {m.name: m for m in models}
    done: list[Model] = []

    def visit(model: Model, path: tuple[str, ...]) -> None:
        if model.name in path:
            raise ValueError(f"models depend on each other: {' -> '.join((*path, model.name))}")
        if model in done:
            return
        for needed in model.depends_on:
            if needed in by_name:
                visit(by_name[needed], (*path, model.name))
        done.append(model)

    for model in sorted(models, key=lambda m: (m.priority, m.name)):
        visit(model, ())
    return done
