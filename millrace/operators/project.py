"""Projection of nested paths to flat, named and typed columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import cast_column, target_type
from millrace.functions.paths import has_path, path_column, path_type, quote


@dataclass(frozen=True)
class FieldPlan:
    """One output column: where it is read, its name and its registry type name."""

    path: str
    name: str
    type: str | None = None


def present_fields(schema: T.StructType, fields: Sequence[FieldPlan]) -> list[FieldPlan]:
    """Fields whose path the schema has, in registry order."""
    return [field for field in fields if has_path(schema, field.path)]


def project_fields(
    df: DataFrame,
    fields: Sequence[FieldPlan],
    missing: str = "null",
    keep: Sequence[str] = (),
    cast: bool = True,
    extended: bool = False,
    known: T.StructType | None = None,
) -> DataFrame:
    """Select registry paths as named columns, in one projection.

    ``missing="omit"`` leaves out columns whose path the data lacks;
    ``missing="null"`` gives them as typed nulls, so the schema never changes.
    ``known`` is the schema that decides what is present, by default that of
    ``df``.
    """
    known = df.schema if known is None else known
    chosen = list(fields) if missing == "null" else present_fields(known, fields)
    columns = [
        field_column(known, field, extended, cast).alias(field.name) for field in chosen
    ]
    return df.select(*columns, *keep)


def untyped_fields(fields: Sequence[FieldPlan], extended: bool = False) -> list[str]:
    """Names of the columns whose type the registry leaves to the data."""
    return [field.name for field in fields if target_type(field.type, extended) is None]


def as_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns as text, nested values as JSON; the other columns as they are.

    So a column that is a number in one batch, absent in the next and text in
    another has one type in its target, and no value is lost.
    """
    wanted = {name.lower() for name in names}

    def text(field: T.StructField) -> Column:
        column = F.col(quote(field.name))
        if field.name.lower() not in wanted:
            return column
        nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        return (F.to_json(column) if nested else column.cast("string")).alias(field.name)

    return df.select(*[text(field) for field in df.schema.fields])


def field_column(
    known: T.StructType, field: FieldPlan, extended: bool = False, cast: bool = True
) -> Column:
    """Value of one field, cast by its type name; a typed null if ``known`` lacks its path."""
    source = path_type(known, field.path)
    if source is None:
        return F.lit(None).cast(target_type(field.type, extended) or T.StringType())
    column = path_column(field.path)
    return cast_column(column, source, field.type, extended) if cast else column


def cast_fields(
    df: DataFrame, types: dict[str, str | None], extended: bool = False
) -> DataFrame:
    """Cast named columns by registry type name, in one projection."""
    return df.select(
        *[
            cast_column(F.col(quote(f.name)), f.dataType, types.get(f.name), extended).alias(f.name)
            for f in df.schema.fields
        ]
    )
