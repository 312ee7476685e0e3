"""One pass for all routes, indexed predicates, settings left alone, commit records, recovery."""

import json
import os
import re
import threading
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace import FieldPlan, FileSink, PipelineConfig, RoutePlan, run_batch, run_skipped, run_stream, write_batch
from millrace.functions.predicates import equality
from millrace.operators.envelope import corrupt_messages, infer_message_schema
from millrace.operators.route import RouteIndex, route_filter, tag_routes
from millrace.plans.pipeline import route_messages
from millrace.sources.messages import record_messages, text_messages
from millrace.sources.shared_files import SharedFiles
from millrace.streaming.recovery import SkippedBatch, file_batch, kafka_options_of, skipped_batches
from workload import queries
from workload.queries import QUERIES

FIELDS = (FieldPlan("p.id", "id", "Int"), FieldPlan("p.kind", "kind", "String"))
DDL = "p STRUCT<id: INT, kind: STRING, deep: STRUCT<tag: STRING>>"
CONFIG = PipelineConfig("x", DDL, "p")


def plan(route, predicate, table="t", fields=FIELDS):
    return RoutePlan(route, "S", predicate, "db", table, fields)


def messages(spark, n=100, kinds=10):
    return spark.range(n).select(
        F.format_string('{"p":{"id":%d,"kind":"k%d","deep":{"tag":"t%d"}}}', "id", F.col("id") % kinds, F.col("id") % 3).alias("value")
    )


def count_in(df, pattern):
    return len(re.findall(pattern, df._jdf.queryExecution().optimizedPlan().toString()))


# -- one pass --------------------------------------------------------------------


@pytest.mark.parametrize("name", ["pipeline_batch", "pipeline_many_routes"])
def test_all_routes_share_one_scan_and_one_parse(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert count_in(df, r"Relation \[.*parquet") == 1
    assert count_in(df, r"from_json\(StructField\(jsonPayload") == 1


def test_a_full_select_reads_held_messages(spark, sf_dir):
    plan_of = QUERIES["route_select"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above = [line for line in plan_of.splitlines() if "Scan" in line or "from_json" in line or "Filter" in line]
    assert sum("InMemoryTableScan" in line for line in above) == 2  # named twice, parsed once
    assert not any("from_json" in line for line in above if "Filter" in line)


def test_a_full_select_parses_once_each_time_it_names_the_messages(spark):
    df = run_batch(messages(spark), [plan("d", "SELECT p FROM DataIN WHERE p.id > 3 AND p.kind = 'k1' AND p.deep.tag IS NOT NULL")], CONFIG)["d"]
    assert count_in(df, r"from_json\(StructField\(p") == 1


def test_together_equals_the_frames(spark):
    other = (FieldPlan("p.id", "id", "String"), FieldPlan("p.deep.tag", "tag"))
    routes = [
        plan("a", "p.kind&k1"),
        plan("b", "SELECT * FROM DataIN WHERE p.kind = 'k1' AND p.id > 50", fields=other),
        plan("c", "p.kind&k1&p.deep.tag&t1", fields=other),
        plan("d", "SELECT p FROM DataIN WHERE p.id = (SELECT max(p.id) FROM DataIN)"),
        plan("none", "p.kind&zz"),
    ]
    frames = run_batch(messages(spark), routes, CONFIG, None)
    union = frames.together()
    assert union.schema["id"].dataType.simpleString() == "string"  # INT in one structure, text in the other
    found = {r: set() for r in frames}
    for row in union.collect():
        found[row["route"]].add((row["id"], row["kind"], row["tag"]))
    for name, df in frames.items():
        columns = [F.col(c).cast("string") if c in df.columns else F.lit(None) for c in ("id", "kind", "tag")]
        assert found[name] == {tuple(r) for r in df.select(*columns).collect()}
    assert len(found["a"]) == 10 and len(found["d"]) == 1 and not found["none"]


def test_a_held_batch_is_parsed_by_the_first_frame_only(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    df = messages(spark, 40).select(counted("value").alias("value"))
    frames = run_batch(df, [plan(f"r{n}", f"p.kind&k{n}") for n in range(5)], CONFIG, hold=True)
    assert sum(frame.count() for frame in frames.values()) == 20
    assert seen.value == 40
    frames.release()


# -- index -----------------------------------------------------------------------


def test_equality():
    assert equality("p.kind = 'a b'") == ("p.kind", "a b")
    assert equality("DataIN.p.kind='x'") == ("p.kind", "x")
    assert equality(" get(`a`, 1) = 'x'") is None and equality("a = 'x' AND b = 'y'") is None
    assert equality("a = 'it''s'") is None and equality(r"a = 'b\n'") is None and equality("a = b") is None


def test_index_tests_each_condition_once(spark):
    frame = spark.createDataFrame([], "p STRUCT<id: INT, kind: STRING>")
    routes = {f"r{n}": f"SELECT * FROM DataIN WHERE p.id > {n % 3}" for n in range(30)}
    routes |= {f"s{n}": f"p.kind = 'k{n}'" for n in range(30)} | {"i": "p.id = '5'", "gone": "p.no&1", "both": "p.kind&a&p.kind&b"}
    index = RouteIndex.of(routes, frame.schema)
    assert {text: len(n) for text, n in index.conditions.items()} == {"p.id > 0": 10, "p.id > 1": 10, "p.id > 2": 10, "p.id = '5'": 1}
    assert len(index.equal[("p.kind",)]) == 30


def test_tags_equal_single_filters(any_ansi):
    rows = ['{"id":1,"t":"a","u":"x"}', '{"id":2,"t":"b"}', '{"id":null,"t":"12","u":"y"}', '{"t":"v13"}', "bad"]
    df = any_ansi.createDataFrame([(r,) for r in rows], "v string").select(F.from_json("v", "id INT, t STRING, u STRING").alias("m"))
    df = df.select("m.*", "m")
    routes = {f"v{n}": f"t&v{n}" for n in range(20)} | {
        "a": "t = 'a'", "a2": "t&a", "ax": "t&a&u&x", "xa": "u&x&t&a", "n": "t > 11", "id": "id&2", "all": "SELECT * FROM DataIN", "null": "t IS NULL"}
    tagged = tag_routes(df.drop("m"), routes)
    got = {r["t"]: r["routes"] for r in tagged.collect()}
    for name, text in routes.items():
        assert {t for t, found in got.items() if name in found} == {r["t"] for r in route_filter(df.drop("m"), text).collect()}, name
    assert got["a"] == ["a", "a2", "ax", "xa", "all"]


def test_many_equality_routes_plan_fast(spark):
    df = messages(spark, 20_000, 1500)
    routes = [
        plan(f"r{n}", f"p.kind&k{n}" if n % 2 else f"SELECT * FROM DataIN WHERE p.kind = 'k{n}'", f"t{n}") for n in range(1500)
    ]
    times = []
    for _ in range(2):
        began = time.time()
        counts = route_messages(df, routes, CONFIG).counts()
        times.append(time.time() - began)
    assert counts["r7"] == 14 and counts["total"] == 20_000 and counts["unmatched"] == 0
    assert min(times) < 3


# -- settings --------------------------------------------------------------------


def test_no_setting_of_the_session_changes(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.ansi.enabled", "spark.sql.variant.allowDuplicateKeys")}
    seen, stop = set(), threading.Event()

    def watch():
        while not stop.is_set():
            seen.add(tuple(spark.conf.get(k, None) for k in before))
            try:
                spark.range(1).select(F.lit("x").cast("int")).collect()
                seen.add("a cast did not raise")
            except Exception:
                pass

    def work(n):
        df = spark.createDataFrame([('{"z": 1, "z": 2, "only": "x"}',), ('{"z": "y"}',)], "value string")
        for _ in range(4):
            assert "only" in infer_message_schema(df).names
            assert route_filter(spark.createDataFrame([("12",), ("x",)], "t string"), "t > 11").count() == 1

    watcher = threading.Thread(target=watch)
    watcher.start()
    workers = [threading.Thread(target=work, args=(n,)) for n in range(4)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    stop.set()
    watcher.join()
    assert seen == {tuple(before.values())}


def test_lenient_conditions_keep_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        df = spark.createDataFrame([("2020-01-01 00:30:00",)], "t string")
        assert route_filter(df, "to_utc_timestamp(t, 'America/Bogota') > t").count() == 1
        assert route_filter(df, "CAST(t AS TIMESTAMP) = TIMESTAMP '2020-01-01 05:30:00Z'").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# -- counts ----------------------------------------------------------------------


@pytest.mark.parametrize("count", ["observe", "first"])
def test_counts_of_routes(spark, tmp_path, count):
    config = PipelineConfig("x", DDL, "p", count=count)
    routes = [plan("a", "p.kind&k1"), plan("none", "p.kind&zz", "u"), plan("sql", "SELECT p FROM DataIN WHERE p.id < 3", "v")]
    reports = write_batch(messages(spark), routes, config, FileSink(str(tmp_path)))
    assert [(r.route, r.rows, r.ok) for r in reports] == [("a", 10, True), ("none", 0, True), ("sql", 3, True)]
    assert not (tmp_path / "db" / "u").exists()


# -- commit records --------------------------------------------------------------


def ids(sink, spark, at):
    return sorted(r["id"] for r in sink.read(spark, at).select("id").collect())


def batch(spark, first, n, day):
    df = spark.range(first, first + n).select(F.format_string('{"p":{"id":%d,"kind":"a"}}', "id").alias("value"))
    return df.withColumn("at", F.to_timestamp(F.lit(f"2020-01-{day:02d}")))


def test_small_batches_leave_a_folder_per_day(spark, tmp_path):
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    for n in range(24):
        write_batch(batch(spark, n, 1, 1 + n % 2), [at], CONFIG, sink, "at", batch_id=f"q_{n}")
    folders = {name for name in os.listdir(tmp_path / "db" / "t") if not name.startswith("_")}
    assert folders == {"periodo=20200101", "periodo=20200102"}
    assert ids(sink, spark, at) == list(range(24))
    assert not list((tmp_path / "_staging").iterdir())


def test_rows_stay_the_same_through_compaction(spark, tmp_path):
    sink, at, seen, stop = FileSink(str(tmp_path)), plan("a", "p.kind&a"), [], threading.Event()
    for n in range(12):
        write_batch(batch(spark, 10 * n, 10, 1 + n % 3), [at], CONFIG, sink, "at", batch_id=f"q_{n}")

    def read():
        while not stop.is_set():
            seen.append(ids(sink, spark, at)[:120])

    reader = threading.Thread(target=read)
    reader.start()
    assert sink.compact(spark, at, before=20200103) == 8
    write_batch(batch(spark, 120, 10, 3), [at], CONFIG, sink, "at", batch_id="q_12")
    stop.set()
    reader.join()
    assert seen and all(found == list(range(120)) for found in seen)
    assert ids(sink, spark, at) == list(range(130))
    # the days that are closed have a file each; the open one keeps its own
    assert len(sink.read(spark, at).inputFiles()) == 2 + 5
    assert sink.compact(spark, at, before=20200103) == 0
    assert sink.clean(spark, at, older_than_hours=1) == 0
    assert sink.clean(spark, at, older_than_hours=0) == 8
    assert ids(sink, spark, at) == list(range(130))


def test_a_batch_written_again_after_compaction(spark, tmp_path):
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    for n in range(4):
        write_batch(batch(spark, 10 * n, 10, 1), [at], CONFIG, sink, "at", batch_id=f"q_{n}")
    # the newest batch may come again and is left alone
    assert sink.compact(spark, at, before=20200102) == 3
    write_batch(batch(spark, 100, 5, 2), [at], CONFIG, sink, "at", batch_id="q_1", replay=True)
    want = [*range(10), *range(20, 40), *range(100, 105)]
    assert ids(sink, spark, at) == want
    write_batch(batch(spark, 0, 0, 1), [at], CONFIG, sink, "at", batch_id="q_0", replay=True)
    want = want[10:]
    assert ids(sink, spark, at) == want
    write_batch(batch(spark, 900, 1, 1), [at], CONFIG, sink, "at", batch_id="q_9")
    assert sink.compact(spark, at, before=20200105) == 2  # what is compacted already, and q_3
    assert ids(sink, spark, at) == [*want, 900]
    sink.clean(spark, at, older_than_hours=0)
    assert ids(sink, spark, at) == [*want, 900]


def test_of_two_compactions_one_wins(spark, tmp_path, monkeypatch):
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    for n in range(4):
        write_batch(batch(spark, 10 * n, 10, 1), [at], CONFIG, sink, "at")
    records = sink._records(spark, at)
    assert sink.compact(spark, at, before=20200102) == 4
    monkeypatch.setattr(FileSink, "_records", lambda *a: records)
    with pytest.raises(Exception, match="compaction-000001"):
        sink.compact(spark, at, before=20200102)
    monkeypatch.undo()
    assert ids(sink, spark, at) == list(range(40))


def test_a_failed_write_is_never_read(spark, tmp_path, monkeypatch):
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    write_batch(batch(spark, 0, 3, 1), [at], CONFIG, sink, "at", batch_id="q_0")
    with monkeypatch.context() as patch:
        patch.setattr(FileSink, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            write_batch(batch(spark, 10, 3, 1), [at], CONFIG, sink, "at", batch_id="q_1")
    assert ids(sink, spark, at) == [0, 1, 2]
    write_batch(batch(spark, 10, 3, 1), [at], CONFIG, sink, "at", batch_id="q_1", replay=True)
    assert ids(sink, spark, at) == [0, 1, 2, 10, 11, 12]
    assert sink.clean(spark, at, older_than_hours=0) == 1


def test_many_records_and_columns_of_other_types(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("millrace.streaming.sinks.MANY_RECORDS", 2)
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    for n in range(4):
        write_batch(batch(spark, n, 1, 1), [at], CONFIG, sink, "at")
    assert ids(sink, spark, at) == [0, 1, 2, 3]
    write_batch(batch(spark, 9, 1, 1), [plan("a", "p.kind&a", fields=(FieldPlan("p.id", "id", "String"),))], CONFIG, sink, "at")
    with pytest.raises(ValueError, match="column id"):
        sink.read(spark, at)
    with pytest.raises(ValueError, match="nothing has been committed"):
        sink.read(spark, plan("z", "p.kind&a", "nowhere"))


def test_small_files_are_put_in_place_whole(spark, tmp_path):
    files = SharedFiles(spark, str(tmp_path))
    files.write(f"{tmp_path}/a.json", "één\n")
    files.write(f"{tmp_path}/a.json", "two")
    assert files.read(f"{tmp_path}/a.json") == "two" and [name for name, _, _ in files.list(str(tmp_path))] == ["a.json"]
    with pytest.raises(Exception, match="a.json"):
        files.write(f"{tmp_path}/a.json", "three", replace=False)
    assert files.read(f"{tmp_path}/a.json") == "two"
    assert files.list(str(tmp_path / "none")) == []


# -- recovery --------------------------------------------------------------------


def test_skipped_routes_run_again(spark, tmp_path):
    path, state = str(tmp_path / "in"), str(tmp_path / "cp")
    messages(spark, 60).repartition(3).write.text(path)
    inner, refuse = FileSink(str(tmp_path / "out")), {"on": True}

    class Refuses:
        def write(self, rows, at, batch_id, replay=False):
            if refuse["on"] and at.route_id == "b" and not batch_id.endswith("_0"):
                raise OSError("refused")
            inner.write(rows, at, batch_id, replay)

    routes = [plan("a", "p.id < 30"), plan("b", "p.id >= 20", "u")]
    config = PipelineConfig("x", DDL, "p", on_error="skip")
    stream = text_messages(spark, path, stream=True, max_files_per_trigger=1)
    run_stream(stream, routes, config, Refuses(), state, available_now=True).awaitTermination()
    waiting = skipped_batches(spark, state)
    assert [b.number for b in waiting] == [1, 2] and all(set(b.failed) == {"b"} for b in waiting)
    times = {r[0] for r in inner.read(spark, routes[0]).select("fecha_hora_kudu").distinct().collect()}
    # still refused: the records stay
    run_skipped(spark, state, lambda b: file_batch(spark, b), routes, config, Refuses())
    assert len(skipped_batches(spark, state)) == 2
    refuse["on"] = False
    reports = run_skipped(spark, state, lambda b: file_batch(spark, b), routes, config, Refuses())
    assert {r.route for r in reports} == {"b"} and all(r.ok for r in reports)
    assert skipped_batches(spark, state) == []
    assert run_skipped(spark, state, lambda b: file_batch(spark, b), routes, config, Refuses()) == []
    assert ids(inner, spark, routes[0]) == list(range(30)) and ids(inner, spark, routes[1]) == list(range(20, 60))
    again = {r[0] for r in inner.read(spark, routes[1]).select("fecha_hora_kudu").distinct().collect()}
    assert again <= times | again and len(again) == 3 and len(again & times) >= 1


def test_offsets_of_a_skipped_kafka_batch(spark, tmp_path):
    at = lambda n: SkippedBatch(n, f"q_{n}", 0, {}, (None,) if not n else ('{"t":{"0":5}}',), ('{"t":{"0":9}}',), str(tmp_path))
    options = {"subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "5"}
    assert kafka_options_of(spark, at(1), options) == {
        "subscribe": "t", "startingOffsets": '{"t":{"0":5}}', "endingOffsets": '{"t":{"0":9}}'}
    os.makedirs(tmp_path / "sources" / "0")
    (tmp_path / "sources" / "0" / "0").write_text('v1\n{"t":{"0":2}}')
    assert kafka_options_of(spark, at(0), options)["startingOffsets"] == '{"t":{"0":2}}'


# -- corrupt messages ------------------------------------------------------------


CORRUPT = {
    None: "no text", "  ": "blank", "5": "not an object", '"x"': "not an object", "[1]": "not an object",
    '{"p":{"id":1': "malformed", "{broken}": "malformed", '{"p":{"id":"x","kind":"a"}}': "a field of another type",
}
FINE = ['{"p":{"id":1,"kind":"a"}}', "{'p':{'id':2}}", "{}", '{"q":1}', ' {"p":null}']


@pytest.mark.parametrize("ddl", [DDL, None], ids=["declared", "inferred"])
def test_corrupt_messages_are_written_and_reported(spark, tmp_path, ddl):
    config = PipelineConfig("x", ddl, "p", corrupt_target="errors.unread", root_arrays=False)
    df = spark.createDataFrame([(t,) for t in [*CORRUPT, *FINE]], "value string")
    sink, at = FileSink(str(tmp_path)), plan("a", "p.kind&a")
    reports = {r.route: r for r in write_batch(df, [at], config, sink)}
    want = CORRUPT if ddl else {t: why for t, why in CORRUPT.items() if "another" not in why}
    stored = sink.read(spark, RoutePlan("_corrupt", "", "", "errors", "unread", ())).collect()
    assert {r["value"]: r["reason"] for r in stored} == want and len(stored) == len(want) == reports["_corrupt"].rows
    assert reports["a"].rows >= 1 and stored[0]["periodo"] > 20200101


def test_a_batch_of_nothing_but_corrupt_messages(spark, tmp_path):
    config = PipelineConfig("x", None, "p", corrupt_target="errors.unread")
    df = spark.createDataFrame([("{broken",), ("7",)], "value string")
    (report,) = write_batch(df, [plan("a", "p.kind&a")], config, FileSink(str(tmp_path)))
    assert (report.route, report.rows, report.ok) == ("_corrupt", 2, True)
    assert run_batch(df, [plan("a", "p.kind&a")], config).corrupt().count() == 2


def test_corrupt_messages_with_other_columns(spark):
    df = spark.createDataFrame([("{x", 1), ('{"a":1}', 2)], "value string, n int")
    assert corrupt_messages(df, "a INT", keep=("n",)).collect() == [("{x", "malformed", 1)]


def test_config_names_a_target():
    with pytest.raises(ValueError, match="corrupt_target"):
        PipelineConfig("x", corrupt_target="unread")
    with pytest.raises(ValueError, match="count"):
        PipelineConfig("x", count="never")


# -- untyped columns -------------------------------------------------------------


def test_an_untyped_value_is_stored_alike_in_every_batch(spark, tmp_path):
    fields = (FieldPlan("p.id", "id", "Int"), FieldPlan("p.v", "v"), FieldPlan("p.list.x", "xs"), FieldPlan("p.deep", "deep"), FieldPlan("p.w", "w"))
    at, config, sink = plan("a", "p.id > 0 AND p.w > 1", fields=fields), PipelineConfig("x", None, "p"), FileSink(str(tmp_path))
    texts = ['{"p":{"id":1,"v":1.10,"list":[{"x":2.50}],"deep":{"a":1},"w":2}}', '{"p":{"id":2,"v":"x","w":3}}', '{"p":{"id":3,"v":1e2,"list":[{"x":"y"}],"w":4}}']
    batches = [texts[:1], texts[1:], texts]
    for batch_texts in batches:
        write_batch(spark.createDataFrame([(t,) for t in batch_texts], "value string"), [at], config, sink)
    rows = sink.read(spark, at).collect()
    found = {i: {(r["v"], r["xs"], r["w"]) for r in rows if r["id"] == i} for i in (1, 2, 3)}
    assert found == {1: {("1.1", '["2.5"]', "2")}, 2: {("x", None, "3")}, 3: {("100.0", '["y"]', "4")}}
    assert {r["deep"] for r in rows if r["id"] == 1} == {'{"a":1}'}


# -- broker records --------------------------------------------------------------

RECORD = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int, "
    "headers array<struct<key: string, value: binary>>"
)


def test_records_as_a_broker_gives_them(spark):
    rows = [
        (b"k1", '{"a":"é"}'.encode(), "t", 0, 1, None, 0, [("h", b"1"), ("h", b"2"), ("g", None)]),
        (None, b"", "t", 0, 2, None, 0, []),
        (b"k1", None, "t", 1, 3, None, 0, None),
        (b"\xff", b"\xff{", "t", 1, 4, None, 0, None),
    ]
    df = spark.createDataFrame(rows, RECORD)
    got = record_messages(df, keep=("key", "offset", "headers")).collect()
    assert [tuple(r)[:3] for r in got] == [('{"a":"é"}', "k1", 1), ("", None, 2), ("�{", "�", 4)]
    assert [r["headers"] for r in got] == [{"h": "2", "g": None}, {}, None]
    kept = record_messages(df, tombstones="keep").collect()
    assert [r["value"] for r in kept] == ['{"a":"é"}', "", None, "�{"] and kept[0].asDict().keys() == {"value"}
    with pytest.raises(ValueError):
        record_messages(df, tombstones="what")


def test_records_run_through_the_pipeline(spark):
    df = spark.createDataFrame(
        [(None, f'm:1\t{{"p":{{"id":{n},"kind":"a"}}}}'.encode() if n % 2 else None, "t", 0, n, None, 0, None) for n in range(6)], RECORD
    )
    frames = run_batch(record_messages(df, keep=("timestamp",)), [plan("a", "p.kind&a")], CONFIG)
    assert sorted(r["id"] for r in frames["a"].collect()) == [1, 3, 5]


def test_record_json_is_one_line(spark, tmp_path):
    sink, at = FileSink(str(tmp_path)), plan("a b/c", "p.kind&a")
    write_batch(batch(spark, 0, 1, 1), [at], CONFIG, sink, "at", batch_id="x/y~1")
    (name,) = [n for n in os.listdir(tmp_path / "db" / "t" / "_manifest") if not n.startswith(".")]
    text = (tmp_path / "db" / "t" / "_manifest" / name).read_text()
    assert "\n" not in text and json.loads(text)["batch_id"] == "x/y~1"


def counted(spark, df):
    """The frame, and an accumulator of how often a message was made."""
    made = spark.sparkContext.accumulator(0)

    def passed(value):
        made.add(1)
        return value

    return df.withColumn("value", F.udf(passed, "string")("value")), made


def test_messages_of_many_batches_are_made_once(spark, tmp_path, monkeypatch):
    kinds = F.element_at(F.array(*map(F.lit, ["purchase", "error", "view"])), (F.col("id") % 3 + 1).cast("int"))
    events = spark.range(300).select(
        F.when(F.col("id") != 7, F.col("id")).alias("event_id"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 9).alias("user_id"), kinds.alias("event_type"), (F.col("id") * 0.5).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 5).alias("props"))
    events.unionByName(events.where("id % 10 = 3")).coalesce(2).write.parquet(str(tmp_path / "events.parquet"))
    every = queries.event_messages(spark, str(tmp_path))
    want = sorted(map(tuple, QUERIES["pipeline_batch"](spark, str(tmp_path)).drop("route").collect()))
    messages, made = counted(spark, every)
    monkeypatch.setattr(queries, "event_messages", lambda *a: messages)
    got = QUERIES["sink_compacted"](spark, str(tmp_path))
    assert sorted(map(tuple, got.drop("route").collect())) == want
    assert made.value == 330


@pytest.mark.parametrize("threads, before", [(4, 40), (1, 0)])
def test_a_batch_is_parsed_before_targets_are_written_together(spark, tmp_path, threads, before):
    messages, made = counted(spark, batch(spark, 0, 40, 1))
    files, seen = FileSink(str(tmp_path)), []

    class Watches:
        def write(self, rows, at, batch_id, replay=False):
            seen.append(made.value)
            files.write(rows, at, batch_id, replay)

    routes = [plan("a", "p.kind&a", "t"), plan("b", "p.id >= 30", "u")]
    config = replace(CONFIG, route_threads=threads)
    assert [r.rows for r in write_batch(messages, routes, config, Watches(), "at")] == [40, 10]
    assert min(seen) == before and made.value == 40


def test_a_batch_that_cannot_be_read_is_reported_by_every_route(spark, tmp_path):
    broken = batch(spark, 0, 4, 1).withColumn("value", F.raise_error(F.lit("unreadable")).cast("string"))
    routes = [plan("a", "p.kind&a", "t"), plan("b", "p.id >= 30", "u")]
    reports = write_batch(broken, routes, replace(CONFIG, on_error="skip"), FileSink(str(tmp_path)), "at")
    assert [(r.route, r.ok) for r in reports] == [("a", False), ("b", False)]
