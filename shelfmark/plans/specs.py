"""Plain descriptions that drive the operators: mappings, entities, rules, features and derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ColumnMapping:
    """One target column: its type, and the source column or formula that it comes from (neither: NULL)."""

    generic: str
    dtype: str
    source: str | None = None
    formula: str | None = None
    unique_by: bool = False
    is_null_allowed: bool = True
    is_attribute: bool = False


@dataclass(frozen=True)
class EntitySpec:
    """One entity: where it comes from, where it goes, and how its columns map."""

    name: str
    source_table: str
    destination_table: str
    mapping: tuple[ColumnMapping, ...]
    pull_type: str = "full"
    data_loss_threshold: float = 100.0

    @property
    def keys(self) -> list[str]:
        return [m.generic for m in self.mapping if m.unique_by]

    @property
    def required(self) -> list[str]:
        return [m.generic for m in self.mapping if not m.is_null_allowed]


@dataclass(frozen=True)
class Feature:
    name: str
    expr: str


@dataclass(frozen=True)
class Kpi:
    """A macro: ``code`` stands for ``query`` in rules."""

    code: str
    query: str


@dataclass(frozen=True)
class Rule:
    """A quality rule; ``outer`` is its condition, or the HAVING part of an aggregate rule (one with ``group_by``)."""

    name: str
    outer: str
    action: str  # DELETE, REPLACE, REPORT or PAUSE
    module: str = "validation"
    display_name: str = ""
    description: str = ""
    inner: str | None = None
    group_by: tuple[str, ...] = ()
    agg: tuple[str, ...] = ()
    threshold: str | None = None
    value: str | None = None
    column: str | None = None
    other_table: str | None = None
    on: tuple[str, ...] = ()


@dataclass
class RuleOutcome:
    clean: DataFrame
    anomaly: DataFrame
    summary: DataFrame
    paused: bool = False
    aggregates: dict[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class DerivedSpec:
    """A table made by SQL: run in ``order``; ``historic`` text for full runs, ``periodic`` for the others."""

    name: str
    order: int
    historic: str | Callable[..., DataFrame]
    periodic: str | Callable[..., DataFrame] | None = None
    replace: bool = True


class QualityError(Exception):
    """A table does not meet its declared quality."""


class SchemaDrift(Exception):
    """A table has columns that its target lacks."""


class EmptyPull(Exception):
    """A mandatory view has no rows."""


NOW = datetime
