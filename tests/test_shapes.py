"""Two message shapes of a freight yard from end to end."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import PipelineConfig, registry_from_csv, run_batch

ROUTES = """identifier;structure;predicate;db;table;status
yard;arrival;SELECT * FROM DataIN WHERE size(load.pallets) >= 2;yard;arrivals;Activo
yard;late;SELECT * FROM DataIN WHERE load.pallets.weight[1] > 100 OR truck IS NULL;yard;checks;Activo
sensors;raw;jsonPayload.room&cold store;plant;readings;Activo
sensors;notes;jsonPayload.room&cold store&jsonPayload.level&high;plant;notes;Activo
sensors;raw;jsonPayload.room&dry store;plant;readings;Activo
"""
FIELDS = """truck;truck;String;arrival
load.seal.number;seal;Bigint;arrival
load.pallets.goods.code[0];first_code;String;arrival
load.pallets.goods.code[9];tenth_code;String;arrival
came;came;Timestamp_2;arrival
load.pallets.weight[1];second_weight;Double;late
load.pallets.goods.code[2];third_code;String;late
jsonPayload.room;room;String;raw
jsonPayload.probe.fan-speed;fan-speed;Integer;raw
jsonPayload.probe.taken;fecha_hora_operacion;Timestamp;raw
jsonPayload.probe.fault;fault;;raw
jsonPayload.note;note;String;notes
"""


def arrival(truck, weights, came="2021/03/04 05:06:07"):
    pallets = [{"weight": w, "goods": {"code": f"c{i}"}} for i, w in enumerate(weights)]
    return json.dumps({"truck": truck, "came": came, "load": {"seal": {"number": 12}, "pallets": pallets}})


def reading(room, level="low", **probe):
    body = {"jsonPayload": {"room": room, "level": level, "probe": {"fan-speed": 30, **probe}, "note": "ñ, <ok/>"}}
    return "Line7:\tx" + json.dumps(body, ensure_ascii=False)


@pytest.fixture()
def registry(spark, tmp_path):
    (tmp_path / "routes.csv").write_text(ROUTES)
    (tmp_path / "fields.csv").write_text(FIELDS)
    return registry_from_csv(spark, str(tmp_path / "routes.csv"), str(tmp_path / "fields.csv"))


def messages(spark, texts):
    clock = F.lit(datetime(2021, 3, 5, 2, 0))
    return spark.createDataFrame([(t,) for t in texts], "value string").withColumn("at", clock)


def test_whole_messages(any_ansi, registry):
    texts = [
        arrival("t1", [5.5]),
        arrival("t2", [5.5, 120.25, 7]),
        arrival("t3", [5.5, 80], came="never"),
        arrival(None, []),
    ]
    config = PipelineConfig("yard", payload_column=None, time_zone="America/Bogota")
    frames = run_batch(messages(any_ansi, texts), registry, config, "at")
    shown = {
        route: sorted((tuple(r) for r in df.drop("fecha_hora_kudu", "periodo").collect()), key=str)
        for route, df in frames.items()
    }
    assert shown == {
        "yard_001_arrivals": [
            ("t2", 12, "c0", None, datetime(2021, 3, 4, 5, 6, 7)),
            ("t3", 12, "c0", None, None),
        ],
        "yard_002_checks": [(120.25, "c2"), (None, None)],
    }


def test_wrapped_messages(any_ansi, registry):
    texts = [
        reading("cold store", "high", taken="2021-03-04T05:06:07.000-05:00", fault=7),
        reading("dry store", taken="no date"),
        reading("roof"),
        '{"heartbeat": 1}',
        "Line7: x{}",
    ]
    config = PipelineConfig("sensors", time_zone="America/Bogota")
    frames = run_batch(messages(any_ansi, texts), registry, config, "at")
    first = frames["sensors_001_readings"]
    assert first.columns == ["room", "fan-speed", "fecha_hora_operacion", "fault", "fecha_hora_kudu", "periodo"]
    assert [tuple(r) for r in first.collect()] == [
        ("cold store", 30, datetime(2021, 3, 4, 5, 6, 7), 7, datetime(2021, 3, 4, 21, 0), 20210305)
    ]
    assert [r["note"] for r in frames["sensors_002_notes"].collect()] == ["ñ, <ok/>"]
    third = frames["sensors_003_readings"].collect()
    assert [(r["room"], r["fecha_hora_operacion"], r["fault"]) for r in third] == [("dry store", None, None)]
