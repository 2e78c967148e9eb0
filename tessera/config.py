"""Configuration rows. They are few and are read on the driver; data never passes through here."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Entity:
    """One source entity to ingest."""

    entity_id: int
    name: str
    source_name: str
    source_type: str = ""
    location: str = ""
    table: str = ""
    load_type: str = "FULL"
    watermark_column: str | None = None
    watermark_type: str = "datetime"
    last_watermark: str | None = None
    filter_clause: str | None = None
    drift_strategy: str = "merge"
    options: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def from_row(row: Any, locations: dict[str, str] | None = None) -> "Entity":
        """A row of ``observe.entities_to_process``; ``locations`` resolves connection references."""
        reference = row["ConnectionStringRef"]
        names = [n for n in (row["SourceSchema"], row["TargetTableName"]) if n]
        return Entity(
            row["EntityId"],
            row["EntityName"],
            row["SourceName"],
            row["SourceType"] or "",
            (locations or {}).get(reference, reference or ""),
            ".".join(names),
            row["LoadType"] or "FULL",
            row["WatermarkColumn"],
            row["WatermarkDataType"] or "datetime",
            row["LastWatermark"],
            row["SourceFilterClause"],
        )


@dataclass(frozen=True)
class Rule:
    """One quality rule. ``reference`` is (table, column) for REF_INTEGRITY."""

    rule_id: int
    name: str
    kind: str
    column: str
    severity: str = "ERROR"
    quarantine: bool = True
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    ref_table: str | None = None
    ref_column: str | None = None


@dataclass(frozen=True)
class Transformation:
    """One silver transformation of an entity."""

    transformation_id: int
    entity_id: int
    kind: str = "STANDARDIZATION"
    logic: dict[str, Any] = field(default_factory=dict)
    business_keys: tuple[str, ...] = ()

    @staticmethod
    def from_row(row: Any) -> "Transformation":
        keys = (row["BusinessKeyColumns"] or "").split(",")
        return Transformation(
            row["TransformationId"],
            row["EntityId"],
            row["TransformationType"],
            json.loads(row["TransformationLogicJson"] or "{}"),
            tuple(k.strip() for k in keys if k.strip()),
        )


@dataclass(frozen=True)
class Model:
    """One gold model. ``joins`` maps a dimension to (column, join type)."""

    name: str
    kind: str
    sources: tuple[str, ...]
    grain: tuple[str, ...] = ()
    calculated: dict[str, str] = field(default_factory=dict)
    depends_on: tuple[str, ...] = ()
    priority: int = 100
    joins: dict[str, tuple[str, str]] = field(default_factory=dict)

    @staticmethod
    def from_row(row: Any) -> "Model":
        def parsed(name: str, empty: Any) -> Any:
            return json.loads(row[name]) if row[name] else empty

        present = row.asDict() if hasattr(row, "asDict") else row
        joins = json.loads(present.get("JoinConfigs") or "{}")
        return Model(
            row["ModelName"],
            row["ModelType"],
            tuple(parsed("SourceTables", [])),
            tuple(c.strip() for c in (row["GrainColumns"] or "").split(",") if c.strip()),
            parsed("CalculatedColumns", {}),
            tuple(parsed("DependencyModels", [])),
            row["Priority"],
            {name: (how.get("column"), how.get("type") or "left") for name, how in joins.items()},
        )
