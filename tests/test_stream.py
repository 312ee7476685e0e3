import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import ConnectorSink, FieldPlan, FileSink, PipelineConfig, RoutePlan, TableSink, run_stream, write_batch
from millrace.sources.messages import kafka_options, spread, text_messages, text_values
from millrace.sources.storage import shared_folder

ROUTES = (
    RoutePlan("001_a", "S", "p.kind&a", "db", "t", (FieldPlan("p.id", "id", "Int"), FieldPlan("p.kind", "kind", "String"))),
    RoutePlan("002_b", "S", "p.id >= 50", "db", "t", (FieldPlan("p.id", "id", "Int"), FieldPlan("p.kind", "kind", "String"))),
)
CONFIG = PipelineConfig("x", "p STRUCT<id: INT, kind: STRING>", "p")


@pytest.fixture()
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    df = spark.range(100).select(
        F.format_string('m:%d\t{"p":{"id":%d,"kind":"%s"}}', "id", "id", F.when(F.col("id") < 60, "a").otherwise("b")))
    df.repartition(4).write.text(path)
    return text_messages(spark, path, stream=True, max_files_per_trigger=1)


def number(batch_id):
    return int(str(batch_id).rsplit("_", 1)[-1])


class Breaks:
    """Fails on one batch, once, before or after the write."""

    def __init__(self, inner, batch, after):
        self.inner, self.batch, self.after, self.left = inner, batch, after, 1

    def write(self, rows, plan, batch_id, replay=False):
        breaks = number(batch_id) == self.batch and plan.route_id == "002_b" and self.left
        if not breaks or self.after:
            self.inner.write(rows, plan, batch_id, replay)
        if breaks:
            self.left = 0
            raise OSError("broken")


def finish(query):
    try:
        query.awaitTermination()
        return True
    except Exception:
        return False


def expected():
    return sorted([("001_a", i) for i in range(60)] + [("002_b", i) for i in range(50, 100)])


def stored(df):
    return sorted((r["route"], r["id"]) for r in df.select("route", "id").collect())


def test_stream_writes_every_route(spark, source, tmp_path):
    reports = []
    sink = FileSink(str(tmp_path / "out"))
    assert finish(run_stream(source, ROUTES, CONFIG, sink, str(tmp_path / "cp"), available_now=True,
                             on_report=reports.extend, name="routes"))
    df = sink.read(spark, ROUTES[0])
    assert stored(df) == expected()
    assert {number(r.batch_id) for r in reports} == {0, 1, 2, 3}
    assert sum(r.rows for r in reports) == 110 and all(r.ok for r in reports)
    assert df.select("batch_id", "fecha_hora_kudu").distinct().count() == 4


@pytest.mark.parametrize("after", [True, False])
@pytest.mark.parametrize("make", ["files", "tables"])
def test_replay_leaves_no_copies(spark, source, tmp_path, make, after):
    db = f"db_{make}_{after}".lower()
    routes = [RoutePlan(r.route_id, r.structure, r.predicate, db, r.table, r.fields) for r in ROUTES]
    inner = FileSink(str(tmp_path / "out")) if make == "files" else TableSink()
    sink, state = Breaks(inner, 2, after), str(tmp_path / "cp")
    assert not finish(run_stream(source, routes, CONFIG, sink, state, available_now=True))
    assert finish(run_stream(source, routes, CONFIG, sink, state, available_now=True))
    df = inner.read(spark, routes[0]) if make == "files" else spark.table(inner.name(routes[0]))
    assert stored(df) == expected()


def test_replay_keeps_its_ingest_time(spark, source, tmp_path):
    seen = []

    class Notes:
        def write(self, rows, plan, batch_id, replay=False):
            seen.append((batch_id, rows.select("fecha_hora_kudu").first()[0]))
            if len(seen) == 1:
                raise OSError("broken")

    one, state = ROUTES[:1], str(tmp_path / "cp")
    assert not finish(run_stream(source, one, CONFIG, Notes(), state, available_now=True))
    assert finish(run_stream(source, one, CONFIG, Notes(), state, available_now=True))
    assert seen[0] == seen[1] and len(seen) == 5


@pytest.mark.parametrize("make", ["files", "tables"])
def test_replay_with_other_days_or_no_rows(spark, tmp_path, make):
    plan = RoutePlan("001_a", "S", "p.kind&a", f"days_{make}", "t", ROUTES[0].fields)
    sink = FileSink(str(tmp_path)) if make == "files" else TableSink()
    read = lambda: sink.read(spark, plan) if make == "files" else spark.table(sink.name(plan))

    def write(batch_id, day, kind="a"):
        df = spark.createDataFrame([(f'{{"p":{{"id":{day},"kind":"{kind}"}}}}', datetime(2020, 1, day))], "value string, at timestamp")
        write_batch(df, [plan], CONFIG, sink, "at", batch_id, replay=True)

    write(0, 1)
    write(1, 1)
    write(1, 2)
    assert sorted((int(r["batch_id"]), r["periodo"]) for r in read().collect()) == [(0, 20200101), (1, 20200102)]
    write(1, 3, kind="z")
    assert sorted((int(r["batch_id"]), r["periodo"]) for r in read().collect()) == [(0, 20200101)]


def test_a_stream_begun_anew_adds_to_the_table(spark, source, tmp_path):
    """A new checkpoint counts batches from zero again; a second stream does too."""
    sink = FileSink(str(tmp_path / "out"))
    for state in ("one", "two"):
        assert finish(run_stream(source, ROUTES, CONFIG, sink, str(tmp_path / state), available_now=True))
    assert stored(sink.read(spark, ROUTES[0])) == sorted(expected() * 2)


def test_skip_goes_on(spark, source, tmp_path):
    bad = RoutePlan("003_x", "S", "p.no.such = 1", "db", "x", ROUTES[0].fields)
    config = PipelineConfig("x", CONFIG.message_schema, "p", on_error="skip")
    reports, sink = [], FileSink(str(tmp_path / "out"))
    assert finish(run_stream(source, [bad, *ROUTES], config, sink, str(tmp_path / "cp"), available_now=True,
                             on_report=reports.extend))
    assert stored(sink.read(spark, ROUTES[0])) == expected()
    failed = [r for r in reports if not r.ok]
    assert {r.route for r in failed} == {"003_x"} and len(failed) == 4 and "no" in failed[0].error


def test_skip_survives_a_batch_that_cannot_be_read(spark, tmp_path):
    """The second batch has a schema no route can be built on; the third is fine."""
    path, reports, sink = str(tmp_path / "in"), [], FileSink(str(tmp_path / "out"))
    os.mkdir(path)
    config = PipelineConfig("x", "p STRUCT<id: INT, kind: STRING>", "p", on_error="skip")
    for n, text in enumerate(['{"p":{"id":1,"kind":"a"}}', "BOOM", '{"p":{"id":2,"kind":"a"}}']):
        with open(f"{path}/{n}.txt", "w") as out:
            out.write(text + "\n")
        os.utime(f"{path}/{n}.txt", (n, n))
    stream = text_messages(spark, path, stream=True, max_files_per_trigger=1)
    explode = F.when(F.col("value") == "BOOM", F.raise_error(F.lit("boom"))).otherwise(F.col("value"))
    stream = stream.select(explode.cast("string").alias("value"))
    assert finish(run_stream(stream, ROUTES[:1], config, sink, str(tmp_path / "cp"), available_now=True,
                             on_report=reports.extend))
    assert [(number(r.batch_id), r.route, r.ok) for r in reports] == [(0, "001_a", True), (1, "001_a", False), (2, "001_a", True)]
    assert sorted(r["id"] for r in sink.read(spark, ROUTES[0]).collect()) == [1, 2]


def test_a_replay_clears_only_its_own_rows(spark, tmp_path):
    """Other batches and other routes of the same day stay."""
    sink = FileSink(str(tmp_path))
    df = spark.createDataFrame([('{"p":{"id":60,"kind":"a"}}',)], "value string")
    write_batch(df, ROUTES, CONFIG, sink, batch_id=0)
    write_batch(df, ROUTES, CONFIG, sink, batch_id=1, replay=True)
    write_batch(df, ROUTES[:1], CONFIG, sink, batch_id=1, replay=True)
    rows = sink.read(spark, ROUTES[0]).select("batch_id", "route").collect()
    assert sorted(map(tuple, rows)) == [("0", "001_a"), ("0", "002_b"), ("1", "001_a"), ("1", "002_b")]


def test_fail_is_the_default(spark, source, tmp_path):
    bad = RoutePlan("003_x", "S", "p.no.such = 1", "db", "x", ROUTES[0].fields)
    sink = FileSink(str(tmp_path / "out"))
    assert not finish(run_stream(source, [bad, *ROUTES], CONFIG, sink, str(tmp_path / "cp"), available_now=True))
    assert not os.path.exists(tmp_path / "cp" / "commits" / "0")


def test_trigger_interval(spark, source, tmp_path):
    query = run_stream(source, ROUTES, CONFIG, FileSink(str(tmp_path / "o")), str(tmp_path / "cp"), trigger_ms=200)
    query.processAllAvailable()
    query.stop()
    assert stored(FileSink(str(tmp_path / "o")).read(spark, ROUTES[0])) == expected()


def test_table_sink_appends_in_batches(spark):
    df = spark.createDataFrame([('{"p":{"id":1,"kind":"a"}}',)], "value string")
    routes = [RoutePlan("001_a", "S", "p.kind&a", "8_batches", "t", ROUTES[0].fields)]
    for _ in range(2):
        write_batch(df, routes, CONFIG, TableSink())
    assert spark.table("`8_batches`.t").count() == 2


def test_batches_and_streams_share_files(spark, source, tmp_path):
    sink = FileSink(str(tmp_path / "out"))
    assert finish(run_stream(source, ROUTES, CONFIG, sink, str(tmp_path / "cp"), available_now=True))
    df = spark.createDataFrame([('{"p":{"id":500,"kind":"b"}}',)], "value string")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda _: write_batch(df, ROUTES, CONFIG, sink), range(4)))
    assert stored(sink.read(spark, ROUTES[0])) == sorted(expected() + [("002_b", 500)] * 4)


def test_connector_sink(spark, tmp_path):
    df = spark.createDataFrame([('{"p":{"id":1,"kind":"a"}}',)], "value string")
    sink = ConnectorSink("json", "path", str(tmp_path) + "/{db}__{table}")
    for _ in range(2):
        write_batch(df, ROUTES[:1], CONFIG, sink)
    assert spark.read.json(str(tmp_path / "db__t")).count() == 2


def test_many_thin_partitions_become_one_file(spark, tmp_path):
    df = spark.range(2000, numPartitions=40).select(
        F.format_string('{"p":{"id":%d,"kind":"a"}}', "id").alias("value"))
    sink = FileSink(str(tmp_path))
    write_batch(df, ROUTES[:1], CONFIG, sink)
    assert sink.read(spark, ROUTES[0]).count() == 2000
    assert len(sink.read(spark, ROUTES[0]).inputFiles()) == 1


def test_rebalance_by_day(spark, tmp_path):
    df = spark.range(3000, numPartitions=12).select(
        F.format_string('{"p":{"id":%d,"kind":"a"}}', "id").alias("value"),
        F.timestamp_seconds(F.col("id") * 3600).alias("at"))
    sink = FileSink(str(tmp_path))
    write_batch(df, ROUTES[:1], CONFIG, sink, "at")
    days = sink.read(spark, ROUTES[0])
    assert days.count() == 3000
    assert len(days.inputFiles()) == days.select("periodo").distinct().count() == 125


def test_kafka_options():
    options = kafka_options("h:1,h:2", "topic", "group", "SASL_PLAINTEXT", "GSSAPI", max_offsets_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "h:1,h:2", "subscribe": "topic", "startingOffsets": "latest",
        "kafka.security.protocol": "SASL_PLAINTEXT", "kafka.group.id": "group", "kafka.sasl.mechanism": "GSSAPI",
        "kafka.sasl.kerberos.service.name": "kafka", "maxOffsetsPerTrigger": "5"}
    assert "kafka.group.id" not in kafka_options("h:1", "topic")


def test_text_values(spark):
    df = spark.createDataFrame([(bytearray(b"{}"),)], "body binary")
    assert text_values(df, "body").collect() == [("{}",)]


def test_spread(spark):
    assert spread(spark.range(10, numPartitions=2), 6).rdd.getNumPartitions() == 6
    assert spread(spark.range(10, numPartitions=9), 6).rdd.getNumPartitions() == 6


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_clock_column_of_the_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(48).select(
        F.format_string('{"p":{"id":%d,"kind":"a"}}', "id").alias("value"),
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
    ).write.parquet(path)
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(path)
    sink = FileSink(str(tmp_path / "out"))
    assert finish(run_stream(stream, ROUTES[:1], CONFIG, sink, str(tmp_path / "cp"), available_now=True, clock="timestamp"))
    assert sorted(r["periodo"] for r in sink.read(spark, ROUTES[0]).select("periodo").distinct().collect()) == [
        19700101, 19700102]


def test_omitted_columns_read_back_merged(spark, tmp_path):
    config = PipelineConfig("x", None, "p", missing="omit")
    sink = FileSink(str(tmp_path))
    for batch, text in enumerate(['{"p":{"id":1,"kind":"a"}}', '{"p":{"kind":"a"}}']):
        write_batch(spark.createDataFrame([(text,)], "value string"), ROUTES[:1], config, sink, batch_id=batch)
    rows = sink.read(spark, ROUTES[0], merge_schema=True).select("id", "kind").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "a"), (None, "a")]
