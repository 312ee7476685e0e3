"""Messages and registries that Spark derives from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import PipelineConfig, Registry, registry_from_frames
from millrace.sources.messages import spread

TIME_ZONE = "America/Bogota"
IDENTIFIER = "events_app"

MESSAGE_SCHEMA = """
jsonPayload STRUCT<
  event_id: BIGINT, user_id: BIGINT, event_type: STRING, value: DOUBLE,
  value_text: STRING, ts_text: STRING, iso_text: STRING,
  props: STRUCT<k: INT>,
  details: ARRAY<STRUCT<name: STRING, value: STRING>>>
"""

ROUTES = [
    ("EV_BASE", "SELECT * FROM DataIN WHERE jsonPayload.event_type = 'purchase'", "sales", "purchases"),
    ("EV_BASE", "jsonPayload.event_type&error", "ops", "problems"),
    (
        "EV_STEPS",
        "SELECT * FROM DataIN WHERE jsonPayload.details.name[2] IS NULL AND jsonPayload.value >= 20",
        "ops",
        "short_visits",
    ),
]
FIELDS = {
    "EV_BASE": [
        ("jsonPayload.event_id", "event_id", "Bigint"),
        ("jsonPayload.user_id", "user_id", "Int"),
        ("jsonPayload.event_type", "event_type", "String"),
        ("jsonPayload.value_text", "whole_value", "Int"),
        ("jsonPayload.ts_text", "fecha_hora_operacion", "Timestamp_2"),
    ],
    "EV_STEPS": [
        ("jsonPayload.event_id", "event_id", "Bigint"),
        ("jsonPayload.user_id", "user_id", "Int"),
        ("jsonPayload.details.value[1]", "second_step", "String"),
        ("jsonPayload.details.name[3]", "fourth_step", "String"),
        ("jsonPayload.ts_text", "fecha_hora_operacion", "Timestamp_2"),
    ],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of(props: str = "props") -> Column:
    return F.from_json(props, "k INT")["k"]


def payload(k: str | Column = "k") -> Column:
    """Payload of one event. ``details`` has one to four entries."""
    k = F.col(k) if isinstance(k, str) else k
    entries = [
        ("K", k.cast("string")),
        ("USER", F.col("user_id").cast("string")),
        ("TYPE", F.col("event_type")),
        ("FOURTH", F.col("event_id").cast("string")),
    ]
    details = F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in entries])
    return F.struct(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("value").cast("string").alias("value_text"),
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'-05:00'").alias("iso_text"),
        F.struct(k.alias("k")).alias("props"),
        F.slice(details, F.lit(1), 1 + k % 4).alias("details"),
    )


def with_message(
    events: DataFrame, payload_name: Column | str = "jsonPayload", prefix: Column | None = None
) -> DataFrame:
    """Events plus the column ``value``: a text prefix and the JSON message."""
    if prefix is None:
        prefix = F.concat(F.lit("ev:"), F.col("event_id").cast("string"), F.lit("\t"))
    if isinstance(payload_name, str):
        body = F.to_json(F.struct(payload().alias(payload_name)))
    else:
        body = F.concat(F.lit('{"'), payload_name, F.lit('":'), F.to_json(payload()), F.lit("}"))
    made = spread(events).withColumn("k", k_of()).withColumn("message", F.concat(prefix, body))
    return made.withColumnsRenamed({"value": "amount", "message": "value"})


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns ``value`` (message text) and ``ts`` (time of the event)."""
    return with_message(table(spark, sf_dir, "events")).select("value", "ts")


def event_registry(spark: SparkSession, extra_routes: tuple = ()) -> Registry:
    routes = [
        (IDENTIFIER, *route, "Activo", number)
        for number, route in enumerate([*ROUTES, *extra_routes])
    ]
    fields = [
        (structure, *field, number)
        for structure, listed in FIELDS.items()
        for number, field in enumerate(listed)
    ]
    return registry_from_frames(
        spark.createDataFrame(
            routes,
            "identifier string, structure string, predicate string, db string, `table` string, status string, ord int",
        ),
        spark.createDataFrame(fields, "structure string, path string, name string, type string, ord int"),
    )


def event_config(**changes) -> PipelineConfig:
    settings = dict(
        identifier=IDENTIFIER, message_schema=MESSAGE_SCHEMA, time_zone=TIME_ZONE
    )
    return PipelineConfig(**{**settings, **changes})


def derived_registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Route and field tables made from orders and line items.

    An identifier per order status, a route per status and priority, a structure
    per priority. Fields come from line numbers and cover only the first four
    structures.
    """
    level = F.substring("o_orderpriority", 1, 1)
    routes = (
        table(spark, sf_dir, "orders")
        .select("o_orderstatus", "o_orderpriority")
        .distinct()
        .select(
            F.concat(F.lit("orders_"), "o_orderstatus").alias("identifier"),
            F.concat(F.lit("S"), level).alias("structure"),
            F.concat(
                F.lit("SELECT * FROM DataIN WHERE priority = '"), "o_orderpriority", F.lit("'")
            ).alias("predicate"),
            F.concat(F.lit("db_"), F.lower("o_orderstatus")).alias("db"),
            F.concat(F.lit("prio_"), level).alias("table"),
            F.when(F.col("o_orderstatus") == "P", "Inactivo").otherwise("Activo").alias("status"),
            level.cast("int").alias("ord"),
        )
    )
    number = F.col("l_linenumber").cast("int")
    fields = (
        table(spark, sf_dir, "lineitem")
        .select("l_linenumber")
        .distinct()
        .select(
            F.concat(F.lit("lines.value["), (number - 1).cast("string"), F.lit("]")).alias("path"),
            F.concat(F.lit("line_"), number.cast("string")).alias("name"),
            F.when(number % 2 == 0, "Int").otherwise("").alias("type"),
            F.concat(F.lit("S"), (1 + (number - 1) % 4).cast("string")).alias("structure"),
            number.alias("ord"),
        )
    )
    return routes, fields
