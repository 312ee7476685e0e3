"""From raw message text to a typed message: prefix strip, parse, payload gate."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.paths import quote
from millrace.sources.sessions import run_with

# The text prefix allowed before the opening brace.
PREFIX_PATTERN = r"^[a-zA-Z0-9:\t]+\{"
PREFIX_REPLACEMENT = "{"

# For finding types only: empty text says nothing about a type, and a number with
# a zero fraction is a number with a fraction.
_EMPTY_TEXT = r"""([:,\[]\s*)(?:""|'')(?=\s*[,\]}])"""
_ZERO_FRACTION = r"([0-9])\.0+(?=\s*[,\]}])"

_UNREAD, _CORRUPT = "_unread", "_corrupt"

# VARIANT values that repeat a key, as JSON readers take them.
_REPEATED_KEYS = {"spark.sql.variant.allowDuplicateKeys": "true"}

log = logging.getLogger("millrace")

# What may stand before a JSON text: white space and a byte order mark.
_BLANK = " \t\r\n\ufeff"

_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT(?=<)")


def strip_prefix(df: DataFrame, column: str = "value") -> DataFrame:
    """Remove a leading run of letters, digits, ``:`` and TAB before the first ``{``."""
    return df.withColumn(
        column, F.regexp_replace(F.col(column), PREFIX_PATTERN, PREFIX_REPLACEMENT)
    )


def split_root_arrays(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per element for a message whose root is a JSON array of objects.

    Other rows pass as they are, null and malformed ones included; blank text
    and an empty array are no message at all.
    """
    text = F.col(column)
    elements = F.from_json(_bare(text), T.ArrayType(T.StringType()))
    objects = F.forall(elements, lambda element: F.ltrim(element).startswith("{"))
    return df.withColumn(
        column,
        F.explode(
            F.when(_bare(text) == "", F.array().cast("array<string>"))
            .when(_bare(text).startswith("[") & objects, elements)
            .otherwise(F.array(text))
        ),
    )


def _bare(text: Column) -> Column:
    return F.ltrim(text, F.lit(_BLANK))


def infer_message_schema(df: DataFrame, column: str = "value") -> T.StructType:
    """Schema of the JSON objects in a text column, found in one aggregation.

    Types are those Spark's JSON reader finds: conflicting types become STRING,
    fields only ever null or empty text become STRING, and fields without any
    content (empty objects) are left out. A key that a message repeats counts
    like any other. Objects that cannot be read give no fields; their number is
    logged. Each task sends one merged schema to the driver, never rows.
    """
    objects = df.filter(_bare(F.col(column)).startswith("{"))
    text = _bare(F.col(column))
    # A plain search first: few messages need the patterns, which cost more.
    quotes = text.contains('""') | text.contains("''")
    text = F.when(quotes, F.regexp_replace(text, _EMPTY_TEXT, "$1null")).otherwise(text)
    zeros = text.contains(".0")
    text = F.when(zeros, F.regexp_replace(text, _ZERO_FRACTION, "$1.5")).otherwise(text)
    variant = F.from_json(text, T.VariantType())
    # a step of its own, so that both aggregates read one parsed value
    values = run_with(objects.select(column), _REPEATED_KEYS).select(variant.alias("_value"))
    found = values.agg(
        F.schema_of_variant_agg("_value").alias("merged"), F.count_if(F.col("_value").isNull()).alias("unread")
    ).first()
    merged = found["merged"]
    if found["unread"]:
        log.warning("%d messages are no valid JSON objects and add no fields", found["unread"])
    if merged is None or not merged.startswith("OBJECT<"):
        return T.StructType()
    ddl = _OBJECT.sub(lambda m: "STRUCT" if m[0] == "OBJECT" else m[0], merged)
    return _settle(T.DataType.fromDDL(ddl)) or T.StructType()


def _settle(found: T.DataType) -> T.DataType | None:
    """Type used for parsing in place of one found by the variant aggregate."""
    if isinstance(found, T.StructType):
        fields = [(f.name, _settle(f.dataType)) for f in found.fields]
        kept = [T.StructField(name, kind) for name, kind in fields if kind is not None]
        return T.StructType(kept) if kept else None
    if isinstance(found, T.ArrayType):
        element = _settle(found.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(found, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(found, T.DecimalType) and found.scale > 0:
        return T.DoubleType()
    return found


def parse_messages(
    df: DataFrame, schema: str | T.StructType, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    """Parse JSON text and put the message fields in place of the text column.

    A malformed message keeps its row with every field null. ``corrupt`` names a
    column to add: the text and the reason for a message that cannot be read as a
    whole, null for others.
    """
    kept = [quote(c) for c in df.columns if c != column]
    if corrupt is None:
        parsed = df.select(*kept, F.from_json(F.col(column), schema).alias("_message"))
        return parsed.select("_message.*", *kept)
    fields = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    with_text = T.StructType([*fields.fields, T.StructField(_UNREAD, T.StringType())])
    parse = F.from_json(F.col(column), with_text, {"columnNameOfCorruptRecord": _UNREAD})
    parsed = df.select(*kept, F.col(column).alias("_text"), parse.alias("_message"))
    reason = _unread_reason(F.col("_text"), F.col(f"_message.{_UNREAD}"))
    record = F.when(reason.isNotNull(), F.struct(F.col("_text").alias("value"), reason.alias("reason")))
    return parsed.select(
        *[F.col(f"_message.{quote(f.name)}") for f in fields.fields], *kept, record.alias(corrupt)
    )


def _unread_reason(text: Column, unread: Column) -> Column:
    """Why a message cannot be read as a whole; null if it can."""
    return (
        F.when(text.isNull(), F.lit("no text"))
        .when(_bare(text) == "", F.lit("blank"))
        .when(~_bare(text).startswith("{"), F.lit("not an object"))
        .when(unread.isNotNull() & F.try_parse_json(text).isNull(), F.lit("malformed"))
        .when(unread.isNotNull(), F.lit("a field of another type"))
    )


def corrupt_messages(
    df: DataFrame, schema: str | T.StructType, column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``value, reason`` of the messages that cannot be read as a whole with ``schema``.

    Reasons: ``no text`` (null), ``blank``, ``not an object``, ``malformed`` (no
    JSON, or a key repeated in it beside another fault), ``a field of another
    type``. Such messages pass the other steps too, with null for what cannot be read.
    """
    marked = parse_messages(df, schema, column, _CORRUPT)
    rows = marked.select(F.explode_outer(F.array(_CORRUPT)).alias(_CORRUPT), *keep)
    return rows.where(F.col(_CORRUPT).isNotNull()).select(f"{_CORRUPT}.value", f"{_CORRUPT}.reason", *keep)


def payload_gate(df: DataFrame, payload_column: str, keep: tuple[str, ...] = ()) -> DataFrame | None:
    """Keep only the payload column, or ``None`` when the batch does not have it.

    The name test is case-sensitive. Rows without a payload stay, as null.
    """
    if payload_column not in df.columns:
        return None
    return df.select(F.col(f"`{payload_column}`"), *keep)
