from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.predicates import condition_text, pair_form, predicate_paths, safe_positions, select_text
from millrace.operators.route import (
    any_match, count_matches, fan_out, is_filter, match_routes, route_filter, tag_routes, unmatched,
)


def test_safe_positions():
    assert safe_positions("a.b[3] IS NULL") == "get(`a`.`b`, 3) IS NULL"
    assert safe_positions("a[0].b[1] = 'x[2]'") == "get(get(`a`, 0).`b`, 1) = 'x[2]'"
    assert safe_positions("a = 'it''s b[1]' AND c[2] = \"d[0]\"") == "a = 'it''s b[1]' AND get(`c`, 2) = \"d[0]\""
    assert safe_positions("m['k'] = 1 AND a[i] = 2") == "m['k'] = 1 AND a[i] = 2"
    assert safe_positions("x.name[12] = 1") == "get(`x`.`name`, 12) = 1"


@given(st.text(alphabet="ab.'\"\\`&=() 0", max_size=30))
def test_text_without_positions_is_left_alone(text):
    assert safe_positions(text) == text


@given(st.text(alphabet="ab.[]0 ", max_size=20))
def test_quoted_text_is_left_alone(text):
    assert safe_positions(f"x = '{text}'") == f"x = '{text}'"


def test_forms():
    assert pair_form("p.gate&north side") == [("p.gate", "north side")]
    assert pair_form("a&1&b.c&2") == [("a", "1"), ("b.c", "2")]
    assert pair_form("flags & 4 = 4") is None
    with pytest.raises(ValueError, match="odd number"):
        pair_form("p.gate&north&south")
    assert pair_form("SELECT * FROM DataIN WHERE a&b = 1") is None
    assert condition_text("select * from datain  WHERE x = 1;") == "x = 1"
    assert condition_text("SELECT * FROM DataIN") == "true"
    assert condition_text("x IS NULL") == "x IS NULL"
    assert condition_text("SELECT a FROM DataIN WHERE x = 1") is None
    assert condition_text("SELECT * FROM DataIN WHERE x = 1 LIMIT 3") is None
    assert condition_text("SELECT * FROM DataIN WHERE x = 'LIMIT 3'") == "x = 'LIMIT 3'"
    assert not is_filter("SELECT a FROM DataIN") and is_filter("a&b")


def test_select_text():
    text = "select datain.a[1], '{DataIN}' from DataIN, `DataIN` d where DataINx = 1"
    assert select_text(text) == (
        "select get({DataIN}.`a`, 1), '{{DataIN}}' from {DataIN}, {DataIN} d where DataINx = 1"
    )


def test_predicate_paths():
    text = "SELECT * FROM DataIN WHERE a.b = 'c.d' AND lower(x.y[3]) IS NOT NULL OR upper(z) = \"q\""
    assert predicate_paths(text) == ["a.b", "x.y[3]", "z"]
    assert predicate_paths("p.q&v&r&w") == ["p.q", "r"]
    assert predicate_paths("datain.a.b = 1 AND `DataIN`.c IS NULL AND end = 2", keywords=True)[:2] == ["a.b", "AND"]
    assert "end" in predicate_paths("end = 2", keywords=True) and "end" not in predicate_paths("end = 2")


@pytest.fixture()
def messages(spark):
    rows = ['{"id":1,"t":"a","d":[{"n":"x"}]}', '{"id":2,"t":"b","d":[{"n":"x"},{"n":"y"}]}',
            '{"id":3,"t":null,"d":[]}', '{"id":4,"t":"12"}', "bad"]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    return df.select(F.from_json("v", "id INT, t STRING, d ARRAY<STRUCT<n: STRING>>").alias("m")).select("m.*")


def ids(df):
    return sorted((r["id"] for r in df.collect()), key=lambda i: (i is None, i))


@pytest.mark.parametrize(
    "text, want",
    [
        ("SELECT * FROM DataIN WHERE t = 'a'", [1]),
        ("SELECT * FROM DataIN WHERE d.n[1] = 'y'", [2]),
        ("SELECT * FROM DataIN WHERE d.n[1] IS NULL", [1, 3, 4, None]),
        ("SELECT * FROM DataIN", [1, 2, 3, 4, None]),
        ("SELECT * FROM DataIN WHERE DataIN.d.n[1] = 'y' AND datain.id = 2", [2]),
        ("SELECT * FROM DataIN x WHERE x.d.n[1] = 'y'", [2]),
        ("SELECT * FROM DataIN WHERE exists(d, e -> e.n = 'y') AND t LIKE 'b%'", [2]),
        ("t&b", [2]),
        ("t&b&id&2", [2]),
        ("t&b&id&3", []),
        ("nope.x&b", []),
        ("d.n[0]&x", [1, 2]),
        ("t = 12", [4]),
        ("SELECT * FROM DataIN ORDER BY id DESC NULLS LAST", [1, 2, 3, 4, None]),
        ("SELECT id FROM DataIN WHERE d.n[7] IS NULL AND id > 2", [3, 4]),
        ("SELECT id FROM DataIN WHERE datain.t = 'a' OR DataIN.d.n[1] = 'y' OR t = '{}'", [1, 2]),
        ("SELECT * FROM DataIN WHERE id > 1 ORDER BY id LIMIT 2", [2, 3]),
        ("SELECT * FROM DataIN WHERE id IN (SELECT max(id) FROM DataIN)", [4]),
        ("SELECT * FROM DataIN WHERE t = 'a' UNION ALL SELECT * FROM DataIN WHERE id = 2", [1, 2]),
        ("SELECT * FROM DataIN WHERE t <> ' order by limit '", [1, 2, 4]),
        ("SELECT a.id FROM DataIN a JOIN DataIN b ON a.id = b.id + 1 WHERE b.t = 'a'", [2]),
    ],
)
def test_route_filter(any_ansi, messages, text, want):
    assert ids(route_filter(messages, text)) == want


def test_ansi_setting_is_left_alone(any_ansi, messages):
    before = any_ansi.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(Exception):
        route_filter(messages, "no_such = 1")
    assert any_ansi.conf.get("spark.sql.ansi.enabled") == before


def test_no_view_is_left_behind(spark, messages):
    route_filter(messages, "SELECT id FROM DataIN").count()
    assert not [t.name for t in spark.catalog.listTables() if "datain" in t.name.lower() or "pyspark" in t.name]


def test_ansi_setting_survives_threads(any_ansi, messages):
    before = any_ansi.conf.get("spark.sql.ansi.enabled")
    with ThreadPoolExecutor(8) as pool:
        counts = list(pool.map(lambda _: route_filter(messages, "t = 12").count(), range(16)))
    assert counts == [1] * 16
    assert any_ansi.conf.get("spark.sql.ansi.enabled") == before


def test_fan_out_is_not_exclusive(any_ansi, messages):
    routes = {"r1": "t = 'a'", "r2": "d.n[0]&x", "r3": "id > 100"}
    tagged = {r["id"]: r["routes"] for r in tag_routes(messages, routes).collect()}
    assert tagged == {1: ["r1", "r2"], 2: ["r2"], 3: [], 4: [], None: []}
    assert sorted((r["id"], r["route"]) for r in fan_out(messages, routes).collect()) == [
        (1, "r1"), (1, "r2"), (2, "r2")]
    assert ids(unmatched(messages, routes)) == [3, 4, None]
    counts = {r["route"]: r["rows"] for r in count_matches(match_routes(messages, routes), list(routes)).collect()}
    assert counts.pop("partitions") >= 1
    assert counts == {"r1": 1, "r2": 2, "r3": 0, "total": 5, "unmatched": 3}


def test_no_routes(messages):
    assert unmatched(messages, {}).count() == 5
    assert match_routes(messages, {}).filter(any_match([])).count() == 0
    counts = {r["route"]: r["rows"] for r in count_matches(match_routes(messages, {}), []).collect()}
    assert counts["unmatched"] == 5


def test_stored_columns_are_tested_in_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = route_filter(events, "event_type&error")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan


def test_counting_and_routing_parse_once(messages):
    tagged = match_routes(messages, {"r1": "t = 'a'", "r2": "id > 1"})
    counted = count_matches(tagged, ["r1", "r2"])
    for df in (counted, fan_out(messages, {"r1": "t = 'a'", "r2": "id > 1"}), tagged):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
