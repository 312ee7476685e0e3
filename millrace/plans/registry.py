"""From registry tables to the routes of one identifier."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.config import ACTIVE_STATUS
from millrace.functions.paths import parse_path
from millrace.operators.project import FieldPlan
from millrace.sources.registry import Registry

log = logging.getLogger("millrace")


@dataclass(frozen=True)
class RoutePlan:
    """One route: who gets in, which columns come out and where they go.

    The id names identifier, position and table, also in reports and folders.
    """

    route_id: str
    structure: str
    predicate: str
    db: str
    table: str
    fields: tuple[FieldPlan, ...]

    @property
    def target(self) -> str:
        return target_name(self.db, self.table)


def target_name(db: str, table: str, pattern: str = "{db}.{table}") -> str:
    """Name of a route's target, e.g. for a connector that wants a prefix."""
    return pattern.format(db=db, table=table)


def routes_of(registry: Registry, identifier: str, active_only: bool = False) -> DataFrame:
    """Routes of an identifier. The status is looked at only on request."""
    routes = registry.routes.filter(F.col("identifier") == identifier)
    return routes.filter(F.col("status") == ACTIVE_STATUS) if active_only else routes


def fields_by_structure(registry: Registry) -> DataFrame:
    """One row per structure with its fields as an array in registry order."""
    entry = F.struct("ord", "path", "name", "type")
    return registry.fields.groupBy("structure").agg(
        F.sort_array(F.collect_list(entry)).alias("fields")
    )


def routes_with_fields(
    registry: Registry, identifier: str, active_only: bool = False
) -> DataFrame:
    """Routes of an identifier, each with the fields of its structure.

    A route of an undefined structure has null fields.
    """
    return routes_of(registry, identifier, active_only).join(
        fields_by_structure(registry), "structure", "left"
    )


def undefined_structures(registry: Registry) -> DataFrame:
    """Routes whose structure has no fields."""
    return registry.routes.join(registry.fields, "structure", "left_anti")


def compile_routes(
    registry: Registry, identifier: str, active_only: bool = False, skip_undefined: bool = False
) -> tuple[RoutePlan, ...]:
    """Routes of an identifier as plans, in registry order.

    A route of a structure without fields is refused, or with ``skip_undefined``
    logged and left out. Routes are configuration and are collected whole.
    """
    rows = routes_with_fields(registry, identifier, active_only).collect()
    if not rows:
        raise ValueError(f"the registry has no route for identifier {identifier!r}")
    orphans = sorted({row["structure"] for row in rows if not row["fields"]})
    if orphans and not skip_undefined:
        raise ValueError(f"structures without fields: {orphans}")
    if orphans:
        log.warning("identifier %s: routes of structures without fields left out: %s", identifier, orphans)
    rows.sort(key=lambda row: row["ord"])
    return tuple(_plan(number, row) for number, row in enumerate(rows, start=1) if row["fields"])


def _plan(number: int, row) -> RoutePlan:
    fields = tuple(FieldPlan(f["path"], f["name"], f["type"] or None) for f in row["fields"])
    for field in fields:
        parse_path(field.path)  # a malformed path is refused here, not in a batch
    names = [field.name.lower() for field in fields]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"structure {row['structure']!r} names a column twice: {repeated}")
    label = re.sub(r"\W+", "_", f"{row['identifier']}_{number:03d}_{row['table']}")
    return RoutePlan(
        label, row["structure"], row["predicate"], row["db"], row["table"], fields
    )
