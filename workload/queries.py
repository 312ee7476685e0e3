"""Spark queries by name. Each takes (spark, sf_dir) and reads the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import (
    ConnectorSink,
    FieldPlan,
    FileSink,
    RoutePlan,
    TableSink,
    compile_routes,
    run_batch,
    run_skipped,
    run_stream,
    write_batch,
)
from millrace.functions.times import normalise_iso_text
from millrace.operators.enrich import enrich
from millrace.operators.envelope import (
    infer_message_schema,
    parse_messages,
    payload_gate,
    split_root_arrays,
    strip_prefix,
)
from millrace.operators.index import row_index
from millrace.operators.latest import latest_by_key
from millrace.operators.project import cast_fields, project_fields
from millrace.operators.route import count_matches, fan_out, match_routes, route_filter, unmatched
from millrace.operators.split import split_wide
from millrace.plans.registry import routes_with_fields, undefined_structures
from millrace.sources.messages import record_messages, spread, text_messages, text_values
from millrace.sources.registry import (
    Registry,
    registry_from_csv,
    registry_from_format,
    registry_from_frames,
    registry_from_tables,
)
from millrace.sources.storage import scratch_path
from millrace.streaming.recovery import file_batch, skipped_batches
from millrace.streaming.sinks import Sink
from workload.messages import (
    MESSAGE_SCHEMA,
    ROUTES,
    TIME_ZONE,
    derived_registry,
    event_config,
    event_messages,
    event_registry,
    k_of,
    payload,
    table,
    with_message,
)

STAMP = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
PREDICATES = {target: predicate for _, predicate, _, target in ROUTES}


def stamp(column: Column | str, pattern: str = STAMP) -> Column:
    return F.coalesce(F.date_format(column, pattern), F.lit("-"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed messages, one column ``jsonPayload``."""
    text = strip_prefix(event_messages(spark, sf_dir).select("value"))
    return payload_gate(parse_messages(text, MESSAGE_SCHEMA), "jsonPayload")


def flat(df: DataFrame, *paths: str, **options) -> DataFrame:
    fields = [FieldPlan(f"jsonPayload.{p}", p.rsplit(".", 1)[-1]) for p in paths]
    return project_fields(df, fields, **options)


BASE = ("event_id", "user_id", "event_type", "value", "props.k")


# -- envelope ---------------------------------------------------------------


def strip_prefix_query(spark, sf_dir):
    """Errors carry a prefix with a blank, which stays."""
    prefix = F.when(F.col("event_type") == "error", "ev 1:").otherwise("Ev1:\t:")
    messages = with_message(table(spark, sf_dir, "events"), prefix=prefix)
    return strip_prefix(messages).select(
        "event_id",
        F.col("value").startswith("{").alias("starts_with_brace"),
        F.substring_index("value", "{", 1).alias("kept_prefix"),
    )


def parse_declared(spark, sf_dir):
    return flat(parsed(spark, sf_dir), *BASE)


def parse_inferred(spark, sf_dir):
    """``mixed`` is a number in clicks, an object in errors and text elsewhere."""
    mixed = (
        F.when(F.col("event_type") == "click", F.col("k").cast("string"))
        .when(F.col("event_type") == "error", F.to_json(F.struct("k")))
        .otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    )
    messages = with_message(table(spark, sf_dir, "events"), prefix=F.lit(""))
    rest = F.substring("value", 2, 2**31 - 1)
    text = messages.select(F.concat(F.lit('{"mixed":'), mixed, F.lit(","), rest).alias("value"))
    message = parse_messages(text, infer_message_schema(text))
    return message.select(
        *[F.col(f"jsonPayload.{p}").alias(p.rsplit(".", 1)[-1]) for p in BASE], "mixed"
    )


def root_arrays(spark, sf_dir):
    """Each text is an array of two messages."""
    events = with_message(table(spark, sf_dir, "events"), prefix=F.lit(""))
    pair = events.select(F.concat(F.lit("["), "value", F.lit(", "), "value", F.lit("]")).alias("value"))
    return flat(parse_messages(split_root_arrays(pair), MESSAGE_SCHEMA), *BASE)


def payload_gate_query(spark, sf_dir):
    """Clicks and views carry another top key; their rows stay with a null payload."""
    name = F.when(F.col("event_type").isin("click", "view"), "heartbeat").otherwise("jsonPayload")
    text = strip_prefix(with_message(table(spark, sf_dir, "events"), name).select("value"))
    gated = payload_gate(parse_messages(text, infer_message_schema(text)), "jsonPayload")
    return gated.groupBy(
        F.coalesce("jsonPayload.event_type", F.lit("no payload")).alias("event_type")
    ).agg(F.count(F.lit(1)).alias("messages"), F.count("jsonPayload.event_id").alias("payloads"))


def batch_text_source(spark, sf_dir):
    """Messages written as text lines, read back as a batch input path."""
    path = scratch_path(spark, "text")
    event_messages(spark, sf_dir).select("value").write.text(path)
    text = strip_prefix(text_messages(spark, path))
    return flat(parse_messages(text, MESSAGE_SCHEMA), *BASE)


def binary_source(spark, sf_dir):
    """Messages held as bytes, the way a message broker hands them over."""
    records = event_messages(spark, sf_dir).select(F.encode("value", "UTF-8").alias("body"))
    return flat(parse_messages(strip_prefix(text_values(records, "body")), MESSAGE_SCHEMA), *BASE)


# -- projection -------------------------------------------------------------


def project_flat(spark, sf_dir):
    return flat(parsed(spark, sf_dir), *BASE, "ts_text")


def project_missing(spark, sf_dir):
    return flat(parsed(spark, sf_dir), "event_id", "note", "props.k", "props.z", "details.note[1]", missing="omit")


def project_missing_null(spark, sf_dir):
    return flat(parsed(spark, sf_dir), "event_id", "note", "props.k", missing="null").select(
        "event_id", "k", F.col("note").isNull().alias("note_is_null"), F.typeof("note").alias("note_type")
    )


def project_case(spark, sf_dir):
    """Paths resolve whatever their case."""
    fields = [FieldPlan("JSONPAYLOAD.Event_ID", "event_id"), FieldPlan("jsonpayload.PROPS.K", "user-k")]
    return project_fields(parsed(spark, sf_dir), fields)


def project_array_field(spark, sf_dir):
    df = flat(parsed(spark, sf_dir), "event_id", "details.name", "details.value")
    return df.select(
        "event_id",
        F.array_join("name", ",").alias("names"),
        F.array_join("value", ",").alias("texts"),
        F.size("name").alias("entries"),
    )


def project_array_index(spark, sf_dir):
    fields = [FieldPlan("jsonPayload.event_id", "event_id")]
    for i in (0, 1, 2, 3, 12):
        fields.append(FieldPlan(f"jsonPayload.details.value[{i}]", f"value_{i}"))
    fields.append(FieldPlan("jsonPayload.details[1].name", "name_1"))
    df = project_fields(parsed(spark, sf_dir), fields)
    return df.select("event_id", *[F.coalesce(c, F.lit("-")).alias(c) for c in df.columns[1:]])


# -- casts ------------------------------------------------------------------


def cast_scalar(spark, sf_dir):
    fields = [
        FieldPlan("jsonPayload.event_id", "event_id", "Bigint"),
        FieldPlan("jsonPayload.event_id", "id_text", "String"),
        FieldPlan("jsonPayload.value_text", "whole", "Int"),
        FieldPlan("jsonPayload.value_text", "whole_long", "Bigint"),
        FieldPlan("jsonPayload.value_text", "number", "Double"),
        FieldPlan("jsonPayload.value", "cut", "Int"),
        FieldPlan("jsonPayload.props.k", "k", "Double"),
        FieldPlan("jsonPayload.event_type", "bad_int", "Int"),
        FieldPlan("jsonPayload.event_type", "bad_long", "Bigint"),
        FieldPlan("jsonPayload.event_type", "bad_double", "Double"),
    ]
    df = project_fields(parsed(spark, sf_dir), fields)
    bad = [c for c in df.columns if c.startswith("bad_")]
    return df.select(
        *[c for c in df.columns if c not in bad], *[F.col(c).isNull().alias(c) for c in bad]
    )


def cast_passthrough(spark, sf_dir):
    """Unknown and blank type names leave a column alone; the opt-in names do not."""
    df = flat(parsed(spark, sf_dir), "event_id", "value_text", "event_type", "iso_text")
    plain = cast_fields(df, {"event_id": "", "value_text": "Integer", "event_type": "int", "iso_text": "Date"})
    both = plain.select("*", F.col("value_text").alias("whole"), F.substring("iso_text", 1, 10).alias("day"))
    cast = cast_fields(both, {"whole": "Integer", "day": "Date"}, extended=True)
    return cast.select(
        "event_id", "value_text", "event_type", "iso_text", "whole", F.col("day").cast("string").alias("day")
    )


def cast_timestamp(spark, sf_dir):
    """ISO text with a zone, epoch seconds, and text that is no timestamp."""
    fields = [
        FieldPlan("jsonPayload.event_id", "event_id", "Bigint"),
        FieldPlan("jsonPayload.iso_text", "iso", "Timestamp"),
        FieldPlan("jsonPayload.user_id", "epoch", "Timestamp"),
        FieldPlan("jsonPayload.ts_text", "slash", "Timestamp"),
    ]
    df = project_fields(parsed(spark, sf_dir), fields)
    return df.select(
        "event_id",
        F.unix_millis("iso").alias("iso_millis"),
        F.unix_seconds("epoch").alias("epoch_seconds"),
        F.col("slash").isNull().alias("slash_is_null"),
    )


def cast_timestamp_slash(spark, sf_dir):
    """Slash dates: with a fraction, with a thirteenth month, and plain."""
    kind, text = F.col("jsonPayload.event_type"), F.col("jsonPayload.ts_text")
    given = (
        F.when(kind == "click", F.concat(text, F.lit(".767")))
        .when(kind == "error", F.regexp_replace(text, "/0?[0-9]+/", "/13/"))
        .otherwise(text)
    )
    df = parsed(spark, sf_dir).select("jsonPayload.event_id", given.alias("given"))
    return cast_fields(df, {"given": "Timestamp_2"}).select("event_id", stamp("given").alias("given"))


# -- routing ----------------------------------------------------------------


def route_eq(spark, sf_dir):
    return flat(
        route_filter(parsed(spark, sf_dir), "SELECT * FROM DataIN WHERE jsonPayload.event_type = 'error'", parsed=True),
        *BASE,
    )


def route_null_and_index(spark, sf_dir):
    predicate = (
        "SELECT * FROM DataIN WHERE jsonPayload.details.name[0] = 'K' "
        "AND jsonPayload.details.name[3] IS NULL AND jsonPayload.event_type <> 'a[3] b'"
    )
    return flat(route_filter(parsed(spark, sf_dir), predicate, parsed=True), *BASE)


def route_legacy_pair(spark, sf_dir):
    predicate = "jsonPayload.event_type&view&jsonPayload.details.value[0]&7"
    return flat(route_filter(parsed(spark, sf_dir), predicate, parsed=True), *BASE)


def route_select(spark, sf_dir):
    """A predicate that is more than a condition runs as SQL."""
    predicate = (
        "SELECT jsonPayload FROM DataIN WHERE jsonPayload.value > 50 AND jsonPayload.event_type IN "
        "(SELECT DISTINCT jsonPayload.event_type FROM DataIN WHERE jsonPayload.value > 400)"
    )
    messages = parsed(spark, sf_dir).persist()  # the predicate names them twice
    return flat(route_filter(messages, predicate), *BASE)


def route_lenient(spark, sf_dir):
    """Comparing text with a number is null where the text is no number."""
    predicate = "SELECT * FROM DataIN WHERE jsonPayload.details.value[2] = 0 OR jsonPayload.value_text >= 100"
    return flat(route_filter(parsed(spark, sf_dir), predicate, parsed=True), *BASE)


def route_fanout(spark, sf_dir):
    return flat(fan_out(parsed(spark, sf_dir), PREDICATES), "event_id", "user_id", keep=["route"])


def route_counts(spark, sf_dir):
    counts = count_matches(match_routes(parsed(spark, sf_dir), PREDICATES), list(PREDICATES))
    return counts.filter("route <> 'partitions'")


def route_unmatched(spark, sf_dir):
    return flat(unmatched(parsed(spark, sf_dir), PREDICATES), *BASE)


# -- registry ---------------------------------------------------------------


def _plan_rows(registry: Registry, identifier: str) -> DataFrame:
    rows = routes_with_fields(registry, identifier)
    return rows.select(
        "identifier", "structure", "predicate", "db", "table", "status",
        F.col("ord").cast("int").alias("ord"), F.explode("fields").alias("field"),
    ).select(
        *["identifier", "structure", "predicate", "db", "table", "status", "ord"],
        "field.path", "field.name", "field.type", F.col("field.ord").cast("int").alias("field_ord"),
    )


def registry_plan(spark, sf_dir):
    return _plan_rows(registry_from_frames(*derived_registry(spark, sf_dir)), "orders_F")


def registry_orphans(spark, sf_dir):
    registry = registry_from_frames(*derived_registry(spark, sf_dir))
    return undefined_structures(registry).select("identifier", "structure", "db", "table")


def registry_csv(spark, sf_dir):
    """Both tables written as semicolon text, one with and one without a header."""
    routes, fields = derived_registry(spark, sf_dir)
    routes_path, fields_path = scratch_path(spark, "routes"), scratch_path(spark, "fields")
    order = ["identifier", "structure", "predicate", "db", "table", "status"]
    routes.select(*order).write.csv(routes_path, sep=";", header=True, quote="")
    fields.select("path", "name", "type", "structure").write.csv(
        fields_path, sep=";", quote="", emptyValue=""
    )
    return _plan_rows(registry_from_csv(spark, routes_path, fields_path), "orders_O").drop("ord", "field_ord")


def registry_table(spark, sf_dir):
    """Both tables as catalog views under the column names of older route tables."""
    routes, fields = derived_registry(spark, sf_dir)
    old = ["IDENTIFICADOR", "ESTRUCTURA", "PATH_CLASIFICADOR", "BASE_DATOS", "TABLA", "ESTADO", "ord"]
    routes.toDF(*old).createOrReplaceTempView("workload_routes")
    fields.createOrReplaceTempView("workload_fields")
    return _plan_rows(registry_from_tables(spark, "workload_routes", "workload_fields"), "orders_P")


def registry_store(spark, sf_dir):
    """Both tables read through a data source by format and options."""
    paths = []
    for df, label in zip(derived_registry(spark, sf_dir), ("routes", "fields")):
        paths.append(scratch_path(spark, label))
        df.write.parquet(paths[-1])
    registry = registry_from_format(spark, "parquet", {"path": paths[0]}, {"path": paths[1]})
    return _plan_rows(registry, "orders_F")


# -- enrichment, split, index, latest ----------------------------------------


def _event_times(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("clock"), (F.col("ts") - F.expr("INTERVAL 36 HOURS")).alias("fecha_hora_operacion")
    )


def enrich_period(spark, sf_dir):
    df = enrich(_event_times(spark, sf_dir), clock=F.col("clock"))
    return df.select("event_id", "periodo", stamp("fecha_hora_kudu", MICROS).alias("ingest"))


def enrich_period_event(spark, sf_dir):
    df = enrich(_event_times(spark, sf_dir), clock=F.col("clock"), period_source="fecha_hora_operacion")
    return df.select("event_id", "periodo")


def enrich_tz_shift(spark, sf_dir):
    """Day key before the shift, times after it."""
    df = enrich(_event_times(spark, sf_dir), TIME_ZONE, F.col("clock"))
    return df.select(
        "event_id",
        "periodo",
        stamp("fecha_hora_kudu", MICROS).alias("ingest"),
        stamp("fecha_hora_operacion", MICROS).alias("operation"),
    )


def enrich_tz_dst(spark, sf_dir):
    """The shift follows the zone's summer time; each event comes a month later a row more, for a year."""
    months = F.explode(F.sequence(F.lit(0), F.lit(11)))
    events = table(spark, sf_dir, "events").select("event_id", "ts", months.alias("month"))
    later = events.withColumn("clock", F.col("ts") + F.make_ym_interval(F.lit(0), F.col("month")))
    df = enrich(later, "America/New_York", F.col("clock"))
    return df.select("event_id", "month", "periodo", stamp("fecha_hora_kudu", MICROS).alias("ingest"))


def normalise_iso_text_query(spark, sf_dir):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    text = table(spark, sf_dir, "events").select("event_id", normalise_iso_text(iso).alias("text"))
    return text.select("event_id", "text", stamp(F.to_timestamp("text")).alias("read_back"))


CHUNKS = ["c0", "c1", "c2", "c3"]


def split_wide_strided(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_wide(df, "text", 5001, CHUNKS, layout="strided", rest="rest")


def split_wide_contiguous(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_wide(df, "text", 5001, CHUNKS, rest="rest")


def row_index_query(spark, sf_dir):
    """Numbered by user and event: a few users hold many rows each."""
    df = table(spark, sf_dir, "events").select("event_id", "user_id")
    return row_index(df, ["user_id", "event_id"])


def row_index_arrival(spark, sf_dir):
    """Numbered in partition order; the numbers have no gap and no repeat."""
    df = row_index(table(spark, sf_dir, "events").select("event_id"))
    return df.agg(
        F.min("index").alias("first"),
        F.max("index").alias("last"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("index").alias("total"),
    )


def latest_by_key_query(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    latest = latest_by_key(df, ["user_id"], ["ts", "event_id"])
    return latest.withColumn("ts", stamp("ts", MICROS))


# -- whole pipeline -----------------------------------------------------------

def _union(frames: dict[str, DataFrame]) -> DataFrame:
    named = [df.withColumn("route", F.lit(route)) for route, df in frames.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)


def _shown(df: DataFrame) -> DataFrame:
    """Stable columns of the routed events, for comparing."""
    texts = ["event_type", "second_step", "fourth_step"]
    return df.select(
        "route",
        "event_id",
        "user_id",
        "periodo",
        F.coalesce("whole_value", F.lit(-1)).alias("whole_value"),
        *[F.coalesce(c, F.lit("-")).alias(c) for c in texts],
        stamp("fecha_hora_operacion").alias("operation"),
        stamp("fecha_hora_kudu", MICROS).alias("ingest"),
    )


def pipeline_batch(spark, sf_dir):
    """All routes of an identifier with a declared schema, in one pass; nothing runs yet."""
    frames = run_batch(event_messages(spark, sf_dir), event_registry(spark), event_config(), "ts")
    return _shown(frames.together())


def pipeline_frames(spark, sf_dir):
    """The same from one frame per route."""
    frames = run_batch(event_messages(spark, sf_dir), event_registry(spark), event_config(), "ts")
    return _shown(_union(frames))


def pipeline_inferred(spark, sf_dir):
    """The same with the schema found in the data."""
    config = event_config(message_schema=None)
    frames = run_batch(event_messages(spark, sf_dir), event_registry(spark), config, "ts")
    return _shown(frames.together())


def pipeline_many_routes(spark, sf_dir):
    """A route for every user, and one per value of a nested number; rows of each route."""
    users = [r[0] for r in table(spark, sf_dir, "events").select("user_id").distinct().collect()]
    fields = (FieldPlan("jsonPayload.event_id", "event_id", "Bigint"),)
    plans = [RoutePlan(f"user_{u}", "U", f"jsonPayload.user_id&{u}", "by_user", f"u{u}", fields) for u in sorted(users)]
    plans += [
        RoutePlan(f"k_{k}", "K", f"SELECT * FROM DataIN WHERE jsonPayload.details.value[0] = '{k}'", "by_k", f"k{k}", fields)
        for k in range(100)
    ]
    frames = run_batch(event_messages(spark, sf_dir), plans, event_config(time_zone=None), "ts")
    return frames.together().groupBy("route").agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"))


def pipeline_split(spark, sf_dir):
    """Whole documents as messages, routed by language, the text split over columns."""
    body = F.struct(F.struct("doc_id", "lang", "text").alias("jsonPayload"))
    messages = spread(table(spark, sf_dir, "documents")).select(F.to_json(body).alias("value"))
    fields = tuple(FieldPlan(f"jsonPayload.{n}", n, t) for n, t in (("doc_id", "Bigint"), ("lang", "String"), ("text", "String")))
    plans = [
        RoutePlan(lang, "DOC", f"jsonPayload.lang&{lang}", "docs", lang, fields) for lang in ("en", "de")
    ]
    config = event_config(
        message_schema="jsonPayload STRUCT<doc_id: BIGINT, lang: STRING, text: STRING>",
        split_column="text",
        split_capacity=5001,
        split_names=tuple(CHUNKS),
        split_rest="rest",
    )
    return _union(run_batch(messages, plans, config)).drop("fecha_hora_kudu", "periodo")


def parse_repeated_keys(spark, sf_dir):
    """Messages that repeat a key; a field of only such messages is found all the same."""
    events = spread(table(spark, sf_dir, "events")).withColumn("k", k_of())
    twice = F.format_string('{"id": %d, "z": 1, "z": 2, "err": "e%d"}', "event_id", "k")
    once = F.format_string('{"id": %d, "z": 3}', "event_id")
    messages = events.select(F.when(F.col("k") % 3 == 0, twice).otherwise(once).alias("value"))
    parsed = parse_messages(messages, infer_message_schema(messages))
    return parsed.select(F.col("id").alias("event_id"), F.coalesce("err", F.lit("-")).alias("err"))


def split_wide_default(spark, sf_dir):
    """Chunks and the rest that is kept without being asked for join up to the text."""
    df = table(spark, sf_dir, "documents").select("doc_id", "text", F.md5("text").alias("whole"))
    out = split_wide(df, "text", 101, ["c0", "c1"])
    return out.select("doc_id", (F.md5(F.concat("c0", "c1", "text_rest")) == F.col("whole")).alias("same"))


def registry_skip_orphan(spark, sf_dir):
    """A route whose structure has no fields is left out; the others run."""
    registry = event_registry(spark, (("EV_NONE", "jsonPayload.event_type&click", "ops", "nowhere"),))
    config = event_config(on_error="skip")
    return _shown(_union(run_batch(event_messages(spark, sf_dir), registry, config, "ts")))


def pipeline_whole_message(spark, sf_dir):
    """Messages without a payload column, matched on the size of a nested array of structs."""
    events = spread(table(spark, sf_dir, "events")).withColumn("k", k_of())
    visit = F.struct(F.col("event_type").alias("sort"), payload()["details"].alias("stops"))
    messages = events.select(F.to_json(F.struct("event_id", F.col("k").alias("lane"), visit.alias("visit"))).alias("value"))
    fields = (
        FieldPlan("event_id", "event_id", "Bigint"),
        FieldPlan("lane", "lane", "Int"),
        FieldPlan("visit.stops.value[3]", "stop", "Bigint"),
    )
    plans = [
        RoutePlan("full", "V", "SELECT * FROM DataIN WHERE size(visit.stops) = 4", "yard", "full", fields),
        RoutePlan(
            "single", "V", "SELECT * FROM DataIN WHERE visit.stops.name[1] IS NULL AND lane BETWEEN 20 AND 59",
            "yard", "single", fields,
        ),
    ]
    config = event_config(message_schema=None, payload_column=None)
    rows = _union(run_batch(messages, plans, config))
    return rows.select("route", "event_id", "lane", F.coalesce("stop", F.lit(-1)).alias("stop"))


def _read_targets(spark: SparkSession, sink: FileSink, plans: tuple[RoutePlan, ...]) -> DataFrame:
    seen = {plan.target: plan for plan in plans}.values()
    frames = {plan.target: sink.read(spark, plan) for plan in seen}
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [df.withColumn("target", F.lit(target)) for target, df in frames.items()],
    )


def sink_append(spark, sf_dir):
    """Every route written, then read back by target; the day key prunes folders."""
    sink = FileSink(scratch_path(spark, "tables"))
    plans = compile_routes(event_registry(spark), event_config().identifier)
    write_batch(event_messages(spark, sf_dir), plans, event_config(), sink, "ts")
    df = _read_targets(spark, sink, plans).withColumn("route", F.col("target"))
    return _shown(df).drop("target")


def sink_table(spark, sf_dir):
    """Every route written to a catalog table, each target in a database of this run."""
    name = f"workload_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'warehouse')}'")
    plans = [replace(p, db=name) for p in compile_routes(event_registry(spark), event_config().identifier)]
    sink = TableSink()
    write_batch(event_messages(spark, sf_dir), plans, event_config(), sink, "ts")
    return _shown(_union({p.table: spark.table(sink.name(p)).drop("route") for p in plans}))


def sink_connector(spark, sf_dir):
    """Every route appended through a data source that is told its target by an option."""
    root = scratch_path(spark, "store")
    sink = ConnectorSink("parquet", "path", root + "/{db}__{table}")
    plans = compile_routes(event_registry(spark), event_config().identifier)
    write_batch(event_messages(spark, sf_dir), plans, event_config(), sink, "ts")
    return _shown(_union({p.table: spark.read.parquet(f"{root}/{p.db}__{p.table}") for p in plans}))


def _drifting(spark, sf_dir) -> list[DataFrame]:
    """Three batches of messages: a field is a number, absent, and text."""
    events = spread(table(spark, sf_dir, "events")).withColumn("k", k_of())
    err = [F.col("k"), None, F.concat(F.lit("e"), F.col("k").cast("string"))]
    return [
        events.where(F.col("k") % 3 == n).select(
            F.to_json(F.struct("event_id", *([] if value is None else [value.alias("err")]))).alias("value")
        )
        for n, value in enumerate(err)
    ]


def sink_report_failure(spark, sf_dir):
    """A route that cannot run is reported as failed, with no rows; the others are written."""
    bad = ("EV_BASE", "jsonPayload.no_such_field.x = 'y'", "ops", "broken")
    sink, config = FileSink(scratch_path(spark, "tables")), event_config(on_error="skip")
    reports = write_batch(event_messages(spark, sf_dir), event_registry(spark, (bad,)), config, sink, "ts")
    return spark.createDataFrame([(r.route, r.rows, r.ok) for r in reports], "route string, rows long, ok boolean")


def sink_type_drift(spark, sf_dir):
    """A field without a declared type, found with other types in other batches."""
    name = f"workload_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'warehouse')}'")
    fields = (FieldPlan("event_id", "event_id", "Bigint"), FieldPlan("err", "err"))
    plan = RoutePlan("all", "D", "event_id IS NOT NULL", name, "drift", fields)
    config, files, tables = event_config(message_schema=None, payload_column=None), FileSink(scratch_path(spark, "files")), TableSink()
    for messages in _drifting(spark, sf_dir):
        for sink in (files, tables):
            write_batch(messages, [plan], config, sink)
    rows = _union({"files": files.read(spark, plan).drop("route"), "tables": spark.table(tables.name(plan)).drop("route")})
    return rows.select("route", "event_id", F.coalesce("err", F.lit("-")).alias("err"))


def sink_omit_read(spark, sf_dir):
    """Columns that only some batches have are there when a target is read."""
    fields = (FieldPlan("event_id", "event_id", "Bigint"), FieldPlan("err", "err", "String"))
    plan = RoutePlan("all", "D", "event_id IS NOT NULL", "ops", "omit", fields)
    config, sink = event_config(message_schema=None, payload_column=None, missing="omit"), FileSink(scratch_path(spark, "files"))
    for messages in _drifting(spark, sf_dir):
        write_batch(messages, [plan], config, sink)
    return sink.read(spark, plan).select("event_id", F.coalesce("err", F.lit("-")).alias("err"))


def sink_report(spark, sf_dir):
    """Rows and outcome of every route as the writer reports them."""
    sink = FileSink(scratch_path(spark, "tables"))
    reports = write_batch(event_messages(spark, sf_dir), event_registry(spark), event_config(), sink, "ts")
    return spark.createDataFrame([(r.route, r.rows, r.ok) for r in reports], "route string, rows long, ok boolean")


# -- streams -------------------------------------------------------------------


class FailsOnce:
    """Writes a batch, then breaks the first time, as if the driver had died
    between the write and the commit."""

    def __init__(self, inner: FileSink) -> None:
        self.inner, self.failed = inner, False

    def write(
        self, rows: DataFrame, plan: RoutePlan, batch_id: int | str | None, replay: bool = False
    ) -> None:
        self.inner.write(rows, plan, batch_id, replay)
        if not self.failed:
            self.failed = True
            raise OSError("lost after the write")


def _stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-in")
    event_messages(spark, sf_dir).select("value").repartition(6).write.text(path)
    return text_messages(spark, path, stream=True, max_files_per_trigger=2)


def _stream_rows(spark: SparkSession, sink: FileSink, plans: tuple[RoutePlan, ...]) -> DataFrame:
    df = _read_targets(spark, sink, plans)
    return df.select("target", "event_id", "user_id", stamp("fecha_hora_operacion").alias("operation"))


def _run(spark, sf_dir, sink_of: Callable[[FileSink], Sink], extra_routes=(), tries=1, **changes):
    sink = FileSink(scratch_path(spark, "stream-out"))
    plans = compile_routes(event_registry(spark, extra_routes), event_config().identifier)
    checkpoint = scratch_path(spark, "stream-state")
    stream, target = _stream_source(spark, sf_dir), sink_of(sink)
    for attempt in range(tries):
        query = run_stream(stream, plans, event_config(**changes), target, checkpoint, available_now=True)
        try:
            query.awaitTermination()
        except Exception:
            if attempt + 1 == tries:
                raise
    return _stream_rows(spark, sink, plans[: len(ROUTES)])


def stream_route(spark, sf_dir):
    return _run(spark, sf_dir, lambda sink: sink)


def stream_inferred(spark, sf_dir):
    return _run(spark, sf_dir, lambda sink: sink, message_schema=None)


def stream_trigger(spark, sf_dir):
    """A stream that looks for messages every 200 milliseconds, until all are written."""
    sink = FileSink(scratch_path(spark, "stream-out"))
    plans = compile_routes(event_registry(spark), event_config().identifier)
    query = run_stream(
        _stream_source(spark, sf_dir), plans, event_config(), sink, scratch_path(spark, "stream-state"), trigger_ms=200
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return _stream_rows(spark, sink, plans)


def stream_replay(spark, sf_dir):
    """The first batch breaks after writing and comes again; no row is there twice."""
    return _run(spark, sf_dir, FailsOnce, tries=2)


def stream_recovered(spark, sf_dir):
    """A stream goes on without a route that a target refused; its batches are run again later."""

    class Refuses:
        """Refuses one route of every batch until it is mended."""

        def __init__(self, inner: FileSink) -> None:
            self.inner, self.mended = inner, False

        def write(self, rows, plan, batch_id, replay=False):
            if plan.table == "problems" and not self.mended:
                raise OSError("target refuses")
            self.inner.write(rows, plan, batch_id, replay)

    sink = Refuses(FileSink(scratch_path(spark, "stream-out")))
    plans = compile_routes(event_registry(spark), event_config().identifier)
    checkpoint, config = scratch_path(spark, "stream-state"), event_config(on_error="skip")
    run_stream(_stream_source(spark, sf_dir), plans, config, sink, checkpoint, available_now=True).awaitTermination()
    sink.mended = True
    run_skipped(spark, checkpoint, lambda batch: file_batch(spark, batch), plans, config, sink)
    if skipped_batches(spark, checkpoint):
        raise RuntimeError("batches are still waiting")
    return _stream_rows(spark, sink.inner, plans)


def _dealt(messages: DataFrame, parts: int) -> DataFrame:
    """Messages with a number ``part`` by the hash of their text, written once in a folder per part.

    A filter on ``part`` then reads that folder only. On the frame itself it would make every
    message anew for each part, and before ``spread``, in as few tasks as the table has splits.
    """
    path = scratch_path(messages.sparkSession, "dealt")
    dealt = messages.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    dealt.write.partitionBy("part").parquet(path)
    return messages.sparkSession.read.schema(dealt.schema).parquet(path)


def sink_compacted(spark, sf_dir):
    """Many small batches, their days compacted, some written again afterwards; rows stay the same."""
    sink, plans = FileSink(scratch_path(spark, "tables")), compile_routes(event_registry(spark), event_config().identifier)
    messages = _dealt(event_messages(spark, sf_dir), 4)
    for n in range(4):
        write_batch(messages.where(F.col("part") == n), plans, event_config(), sink, "ts", batch_id=f"s_{n}")
    for plan in {p.target: p for p in plans}.values():
        sink.compact(spark, plan, before=99999999)
    write_batch(messages.where("part = 1"), plans, event_config(), sink, "ts", batch_id="s_1", replay=True)
    for plan in {p.target: p for p in plans}.values():
        sink.compact(spark, plan, before=99999999)
        sink.clean(spark, plan, older_than_hours=0)
    df = _read_targets(spark, sink, plans).withColumn("route", F.col("target"))
    return _shown(df).drop("target")


def parse_corrupt(spark, sf_dir):
    """Every message that cannot be read, with its text and the reason."""
    events = spread(table(spark, sf_dir, "events")).withColumn("k", k_of())
    kind = F.col("event_id") % 8
    text = F.format_string('{"jsonPayload": {"event_id": %d, "user_id": 7}}', "event_id")
    broken = (
        F.when(kind == 0, F.concat(F.substring(text, 1, 30), F.lit("\\")))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.format_string('"only text %d"', "event_id"))
        .when(kind == 4, F.format_string('{"jsonPayload": {"event_id": %d, "user_id": "u%d"}}', "event_id", "k"))
        .when(kind == 5, F.format_string("[%d]", "event_id"))
        .otherwise(text)
    )
    messages = events.select(broken.alias("value"), F.col("ts"))
    config = event_config(corrupt_target="ops.unread", time_zone=None, root_arrays=False)
    unread = run_batch(messages, event_registry(spark), config, "ts").corrupt()
    return unread.select(F.coalesce("value", F.lit("-")).alias("value"), "reason", "periodo")


def kafka_records(spark, sf_dir):
    """Records as a broker's source gives them: bytes, a key, headers, a place, and values that are null."""
    events = spread(table(spark, sf_dir, "events"))
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))
    records = events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 7 == 0, F.encode(F.lit(""), "UTF-8"))
        .otherwise(F.encode(F.concat(F.lit("é:"), "props"), "UTF-8")).alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(header("sort", F.lit("old")), header("sort", F.col("event_type"))).alias("headers"),
    )
    out = record_messages(records, keep=("key", "partition", "offset", "timestamp", "headers"))
    return out.select(
        "value", "key", "partition", "offset", stamp("timestamp", MICROS).alias("at"), F.col("headers")["sort"].alias("sort")
    )


def stream_bad_route(spark, sf_dir):
    """A route that cannot run is reported and skipped; the others are written."""
    bad = ("EV_BASE", "SELECT * FROM DataIN WHERE jsonPayload.no_such_field.x = 'y'", "ops", "broken")
    return _run(spark, sf_dir, lambda sink: sink, (bad,), on_error="skip")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "strip_prefix": strip_prefix_query,
    "parse_declared": parse_declared,
    "parse_inferred": parse_inferred,
    "root_arrays": root_arrays,
    "payload_gate": payload_gate_query,
    "batch_text_source": batch_text_source,
    "binary_source": binary_source,
    "project_flat": project_flat,
    "project_missing": project_missing,
    "project_missing_null": project_missing_null,
    "project_case": project_case,
    "project_array_field": project_array_field,
    "project_array_index": project_array_index,
    "cast_scalar": cast_scalar,
    "cast_passthrough": cast_passthrough,
    "cast_timestamp": cast_timestamp,
    "cast_timestamp_slash": cast_timestamp_slash,
    "route_eq": route_eq,
    "route_null_and_index": route_null_and_index,
    "route_legacy_pair": route_legacy_pair,
    "route_select": route_select,
    "route_lenient": route_lenient,
    "route_fanout": route_fanout,
    "route_counts": route_counts,
    "route_unmatched": route_unmatched,
    "registry_plan": registry_plan,
    "registry_orphans": registry_orphans,
    "registry_csv": registry_csv,
    "registry_table": registry_table,
    "registry_store": registry_store,
    "enrich_period": enrich_period,
    "enrich_period_event": enrich_period_event,
    "enrich_tz_shift": enrich_tz_shift,
    "enrich_tz_dst": enrich_tz_dst,
    "normalise_iso_text": normalise_iso_text_query,
    "split_wide_strided": split_wide_strided,
    "split_wide_contiguous": split_wide_contiguous,
    "row_index": row_index_query,
    "row_index_arrival": row_index_arrival,
    "latest_by_key": latest_by_key_query,
    "pipeline_batch": pipeline_batch,
    "pipeline_frames": pipeline_frames,
    "pipeline_inferred": pipeline_inferred,
    "pipeline_many_routes": pipeline_many_routes,
    "parse_corrupt": parse_corrupt,
    "kafka_records": kafka_records,
    "sink_compacted": sink_compacted,
    "stream_recovered": stream_recovered,
    "pipeline_split": pipeline_split,
    "parse_repeated_keys": parse_repeated_keys,
    "split_wide_default": split_wide_default,
    "pipeline_whole_message": pipeline_whole_message,
    "sink_append": sink_append,
    "sink_table": sink_table,
    "sink_connector": sink_connector,
    "sink_report": sink_report,
    "sink_report_failure": sink_report_failure,
    "sink_type_drift": sink_type_drift,
    "sink_omit_read": sink_omit_read,
    "registry_skip_orphan": registry_skip_orphan,
    "stream_trigger": stream_trigger,
    "stream_route": stream_route,
    "stream_inferred": stream_inferred,
    "stream_replay": stream_replay,
    "stream_bad_route": stream_bad_route,
}
