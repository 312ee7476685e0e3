"""Registry tables: which routes exist and which fields a structure has.

Two DataFrames with named columns:

* routes: identifier, structure, predicate, db, table, status, ord
* fields: structure, path, name, type, ord

``ord`` keeps the order of the rows, since output columns follow it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUTE_COLUMNS = ("identifier", "structure", "predicate", "db", "table", "status")
FIELD_COLUMNS = ("path", "name", "type", "structure")

# Column names of existing route tables and what they mean here.
ROUTE_COLUMN_NAMES = {
    "IDENTIFICADOR": "identifier",
    "ESTRUCTURA": "structure",
    "PATH_CLASIFICADOR": "predicate",
    "BASE_DATOS": "db",
    "TABLA": "table",
    "ESTADO": "status",
}


@dataclass(frozen=True)
class Registry:
    routes: DataFrame
    fields: DataFrame


def registry_from_frames(
    routes: DataFrame,
    fields: DataFrame,
    route_names: Mapping[str, str] | None = None,
    field_names: Mapping[str, str] | None = None,
) -> Registry:
    """Registry from any two DataFrames, with columns renamed to the names above."""
    return Registry(
        _named(routes, ROUTE_COLUMNS, {**ROUTE_COLUMN_NAMES, **(route_names or {})}),
        _named(fields, FIELD_COLUMNS, dict(field_names or {})),
    )


def _named(df: DataFrame, columns: tuple[str, ...], names: Mapping[str, str]) -> DataFrame:
    lowered = {old.strip().lower(): new for old, new in names.items()}
    df = df.toDF(*[lowered.get(c.strip().lower(), c.strip().lower()) for c in df.columns])
    if "status" in columns and "status" not in df.columns:
        df = df.withColumn("status", F.lit(""))
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"registry lacks {absent}; it has {df.columns}")
    order = F.col("ord").cast("long") if "ord" in df.columns else F.monotonically_increasing_id()
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns]
    return df.select(*cells, order.alias("ord"))


def registry_from_csv(
    spark: SparkSession,
    routes_path: str,
    fields_path: str,
    sep: str = ";",
    routes_header: bool = True,
    fields_header: bool = False,
    leading_key: bool = False,
) -> Registry:
    """Registry from delimited text. Columns are positional, in the order above.

    ``leading_key`` says the files start with one extra key column. Quotes have
    no meaning, so predicate texts come through as written.
    """
    key = ("key",) if leading_key else ()

    def load(path: str, columns: tuple[str, ...], header: bool) -> DataFrame:
        schema = ", ".join(f"`{c}` STRING" for c in (*key, *columns))
        reader = spark.read.schema(schema).options(sep=sep, header=header, quote="", mode="PERMISSIVE")
        return reader.csv(path)

    return registry_from_frames(
        load(routes_path, ROUTE_COLUMNS, routes_header),
        load(fields_path, FIELD_COLUMNS, fields_header),
    )


def registry_from_tables(
    spark: SparkSession,
    routes_table: str,
    fields_table: str,
    route_names: Mapping[str, str] | None = None,
    field_names: Mapping[str, str] | None = None,
) -> Registry:
    """Registry from two catalog tables or views."""
    return registry_from_frames(
        spark.table(routes_table), spark.table(fields_table), route_names, field_names
    )


def registry_from_format(
    spark: SparkSession,
    fmt: str,
    routes_options: Mapping[str, str],
    fields_options: Mapping[str, str],
    route_names: Mapping[str, str] | None = None,
    field_names: Mapping[str, str] | None = None,
) -> Registry:
    """Registry from two tables of any Spark data source, e.g. a table store."""

    def load(options: Mapping[str, str]) -> DataFrame:
        return spark.read.format(fmt).options(**options).load()

    return registry_from_frames(
        load(routes_options), load(fields_options), route_names, field_names
    )
