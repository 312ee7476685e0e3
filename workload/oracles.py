"""SQL for the same results, straight from the tables. None of it parses a message."""

from __future__ import annotations

_E = """WITH e AS (
  SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events
)
"""
_BASE = "event_id, user_id, event_type, value, k"
_SLASH = "strftime(ts, '%Y/%m/%d %H:%M:%S')"
_DETAILS = "(1 + k % 4)"
# Routes of the event registry as plain conditions, by table.
_PURCHASES = "event_type = 'purchase'"
_PROBLEMS = "event_type = 'error'"
_SHORT = "k % 4 < 2 AND value >= 20"


def _shown(purchases: str, problems: str, short: str) -> str:
    base = """SELECT '{label}' AS route, event_id, CAST(user_id AS INTEGER) AS user_id,
      CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS periodo,
      CAST({whole} AS INTEGER) AS whole_value, {event_type} AS event_type,
      {second} AS second_step, {last} AS fourth_step,
      strftime(date_trunc('second', ts) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS operation,
      strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ingest
    FROM e WHERE {where}"""
    flat = dict(whole="trunc(value)", event_type="event_type", second="'-'", last="'-'")
    steps = dict(
        whole="-1",
        event_type="'-'",
        second="CASE WHEN k % 4 >= 1 THEN CAST(user_id AS VARCHAR) ELSE '-' END",
        last="CASE WHEN k % 4 >= 3 THEN 'FOURTH' ELSE '-' END",
    )
    return _E + " UNION ALL ".join(
        [
            base.format(label=purchases, where=_PURCHASES, **flat),
            base.format(label=problems, where=_PROBLEMS, **flat),
            base.format(label=short, where=_SHORT, **steps),
        ]
    )


_PIPELINE = _shown("events_app_001_purchases", "events_app_002_problems", "events_app_003_short_visits")

_STREAM = _E + " UNION ALL ".join(
    f"""SELECT '{target}' AS target, event_id, CAST(user_id AS INTEGER) AS user_id,
      strftime(date_trunc('second', ts) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS operation
    FROM e WHERE {where}"""
    for target, where in (
        ("sales.purchases", _PURCHASES),
        ("ops.problems", _PROBLEMS),
        ("ops.short_visits", _SHORT),
    )
)

_REPORT = f"""{_E} SELECT 'events_app_001_purchases' AS route, count(*) AS rows, true AS ok FROM e WHERE {_PURCHASES}
  UNION ALL SELECT 'events_app_002_problems', count(*), true FROM e WHERE {_PROBLEMS}
  UNION ALL SELECT 'events_app_003_short_visits', count(*), true FROM e WHERE {_SHORT}"""

_DRIFT = _E + """SELECT event_id, CASE k % 3 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN '-' ELSE 'e' || k END AS err FROM e"""

_REGISTRY = """WITH r AS (
  SELECT DISTINCT 'orders_' || o_orderstatus AS identifier,
    'S' || substr(o_orderpriority, 1, 1) AS structure,
    'SELECT * FROM DataIN WHERE priority = ''' || o_orderpriority || '''' AS predicate,
    'db_' || lower(o_orderstatus) AS db,
    'prio_' || substr(o_orderpriority, 1, 1) AS "table",
    CASE WHEN o_orderstatus = 'P' THEN 'Inactivo' ELSE 'Activo' END AS status,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ord
  FROM orders
), f AS (
  SELECT DISTINCT 'lines.value[' || (l_linenumber - 1) || ']' AS path,
    'line_' || l_linenumber AS name,
    CASE WHEN l_linenumber % 2 = 0 THEN 'Int' ELSE '' END AS type,
    'S' || (1 + (l_linenumber - 1) % 4) AS structure,
    CAST(l_linenumber AS INTEGER) AS field_ord
  FROM lineitem
)
"""


def _plan_rows(identifier: str, order: str = ", ord, field_ord") -> str:
    return (
        _REGISTRY
        + f"""SELECT identifier, structure, predicate, db, "table", status, path, name, type{order}
        FROM r JOIN f USING (structure) WHERE identifier = '{identifier}'"""
    )


_STEP_VALUES = ("CAST(k AS VARCHAR)", "CAST(user_id AS VARCHAR)", "event_type", "CAST(event_id AS VARCHAR)")


def _entry(i: int, value: str) -> str:
    return f"CASE WHEN k % 4 >= {i} THEN {value} ELSE '-' END"


ORACLES: dict[str, str] = {
    "strip_prefix": """SELECT event_id, event_type <> 'error' AS starts_with_brace,
        CASE WHEN event_type = 'error' THEN 'ev 1:' ELSE '' END AS kept_prefix FROM events""",
    "parse_declared": f"{_E} SELECT {_BASE} FROM e",
    "parse_inferred": f"""{_E} SELECT event_id, user_id, event_type, value, CAST(k AS BIGINT) AS k,
        CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR)
             WHEN event_type = 'error' THEN '{{"k":' || k || '}}' ELSE event_type END AS mixed FROM e""",
    "root_arrays": f"{_E} SELECT {_BASE} FROM e UNION ALL SELECT {_BASE} FROM e",
    "payload_gate": """SELECT CASE WHEN event_type IN ('click', 'view') THEN 'no payload' ELSE event_type END
          AS event_type, count(*) AS messages,
          count(CASE WHEN event_type NOT IN ('click', 'view') THEN 1 END) AS payloads
        FROM events GROUP BY 1""",
    "batch_text_source": f"{_E} SELECT {_BASE} FROM e",
    "binary_source": f"{_E} SELECT {_BASE} FROM e",
    "project_flat": f"{_E} SELECT {_BASE}, {_SLASH} AS ts_text FROM e",
    "project_missing": f"{_E} SELECT event_id, k FROM e",
    "project_missing_null": f"{_E} SELECT event_id, k, true AS note_is_null, 'string' AS note_type FROM e",
    "project_case": f'{_E} SELECT event_id, k AS "user-k" FROM e',
    "project_array_field": f"""{_E} SELECT event_id,
          array_to_string(list_slice(['K', 'USER', 'TYPE', 'FOURTH'], 1, {_DETAILS}), ',') AS names,
          array_to_string(list_slice([{', '.join(_STEP_VALUES)}], 1, {_DETAILS}), ',') AS texts,
          CAST({_DETAILS} AS INTEGER) AS entries FROM e""",
    "project_array_index": f"""{_E} SELECT event_id,
          {', '.join(f'{_entry(i, v)} AS value_{i}' for i, v in enumerate(_STEP_VALUES))},
          '-' AS value_12, {_entry(1, "'USER'")} AS name_1 FROM e""",
    "cast_scalar": f"""{_E} SELECT event_id, CAST(event_id AS VARCHAR) AS id_text,
          CAST(trunc(value) AS INTEGER) AS whole, CAST(trunc(value) AS BIGINT) AS whole_long,
          value AS number, CAST(trunc(value) AS INTEGER) AS cut, CAST(k AS DOUBLE) AS k,
          true AS bad_int, true AS bad_long, true AS bad_double FROM e""",
    "cast_passthrough": """SELECT event_id, CAST(value AS VARCHAR) AS value_text, event_type,
          strftime(ts, '%Y-%m-%dT%H:%M:%S.%g-05:00') AS iso_text, CAST(trunc(value) AS INTEGER) AS whole,
          strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "cast_timestamp": """SELECT event_id, epoch_us(ts + INTERVAL 5 HOUR) // 1000 AS iso_millis,
          user_id AS epoch_seconds, true AS slash_is_null FROM events""",
    "cast_timestamp_slash": """SELECT event_id, CASE WHEN event_type = 'error' THEN '-'
          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS given FROM events""",
    "route_eq": f"{_E} SELECT {_BASE} FROM e WHERE event_type = 'error'",
    "route_null_and_index": f"{_E} SELECT {_BASE} FROM e WHERE k % 4 < 3",
    "route_legacy_pair": f"{_E} SELECT {_BASE} FROM e WHERE event_type = 'view' AND k = 7",
    "route_select": f"""{_E} SELECT {_BASE} FROM e WHERE value > 50
          AND event_type IN (SELECT event_type FROM events WHERE value > 400)""",
    "route_lenient": f"{_E} SELECT {_BASE} FROM e WHERE value >= 100",
    "route_fanout": _E
    + " UNION ALL ".join(
        f"SELECT event_id, user_id, '{name}' AS route FROM e WHERE {where}"
        for name, where in (("purchases", _PURCHASES), ("problems", _PROBLEMS), ("short_visits", _SHORT))
    ),
    "route_counts": f"""{_E} SELECT 'purchases' AS route, count(*) AS rows FROM e WHERE {_PURCHASES}
        UNION ALL SELECT 'problems', count(*) FROM e WHERE {_PROBLEMS}
        UNION ALL SELECT 'short_visits', count(*) FROM e WHERE {_SHORT}
        UNION ALL SELECT 'total', count(*) FROM e
        UNION ALL SELECT 'unmatched', count(*) FROM e
          WHERE NOT ({_PURCHASES} OR {_PROBLEMS} OR ({_SHORT}))""",
    "route_unmatched": f"""{_E} SELECT {_BASE} FROM e
        WHERE NOT ({_PURCHASES} OR {_PROBLEMS} OR ({_SHORT}))""",
    "registry_plan": _plan_rows("orders_F"),
    "registry_orphans": _REGISTRY
    + 'SELECT identifier, structure, db, "table" FROM r WHERE structure NOT IN (SELECT structure FROM f)',
    "registry_csv": _plan_rows("orders_O", ""),
    "registry_table": _plan_rows("orders_P"),
    "registry_store": _plan_rows("orders_F"),
    "enrich_period": """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS periodo,
          strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ingest FROM events""",
    "enrich_period_event": """SELECT event_id,
          CAST(strftime(ts - INTERVAL 36 HOUR, '%Y%m%d') AS INTEGER) AS periodo FROM events""",
    "enrich_tz_shift": """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS periodo,
          strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ingest,
          strftime(ts - INTERVAL 41 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS operation FROM events""",
    "enrich_tz_dst": """SELECT event_id, CAST(month AS INTEGER) AS month, CAST(strftime(clock, '%Y%m%d') AS INTEGER) AS periodo,
          strftime(clock AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S.%f') AS ingest
        FROM (SELECT event_id, month, ts::TIMESTAMP + to_months(month::INTEGER) AS clock FROM events, range(12) AS m(month))""",
    "normalise_iso_text": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "text",
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS read_back FROM events""",
    "split_wide_strided": """SELECT doc_id, substr(text, 1, 5000) AS c0, substr(text, 5001, 5000) AS c1,
          substr(text, 10002, 5000) AS c2, substr(text, 15003, 5000) AS c3,
          substr(text, 20003) AS rest FROM documents""",
    "split_wide_contiguous": """SELECT doc_id, substr(text, 1, 5000) AS c0, substr(text, 5001, 5000) AS c1,
          substr(text, 10001, 5000) AS c2, substr(text, 15001, 5000) AS c3,
          substr(text, 20001) AS rest FROM documents""",
    "row_index": """SELECT event_id, user_id,
          row_number() OVER (ORDER BY user_id, event_id) - 1 AS "index" FROM events""",
    "row_index_arrival": """SELECT CAST(0 AS BIGINT) AS "first", count(*) - 1 AS "last", count(*) AS "rows",
          CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS total FROM events""",
    "latest_by_key": """SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
              FROM events) WHERE place = 1""",
    "pipeline_batch": _PIPELINE,
    "pipeline_frames": _PIPELINE,
    "pipeline_inferred": _PIPELINE,
    "pipeline_many_routes": f"""{_E} SELECT 'user_' || user_id AS route, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM e GROUP BY user_id
        UNION ALL SELECT 'k_' || k, count(*), sum(event_id)::BIGINT FROM e GROUP BY k""",
    "parse_corrupt": """SELECT coalesce(value, '-') AS value, reason, periodo FROM (
          SELECT CASE event_id % 8
              WHEN 0 THEN substr(t, 1, 30) || chr(92) WHEN 2 THEN '  ' WHEN 3 THEN '"only text ' || event_id || '"'
              WHEN 4 THEN '{"jsonPayload": {"event_id": ' || event_id || ', "user_id": "u' || k || '"}}' WHEN 5 THEN '[' || event_id || ']' END AS value,
            CASE event_id % 8 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no text' WHEN 2 THEN 'blank' WHEN 3 THEN 'not an object'
              WHEN 4 THEN 'a field of another type' ELSE 'not an object' END AS reason,
            CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS periodo
          FROM (SELECT event_id, ts, json_extract_string(props, '$.k') AS k,
                       '{"jsonPayload": {"event_id": ' || event_id || ', "user_id": 7}}' AS t FROM events WHERE event_id % 8 < 6))""",
    "kafka_records": """SELECT CASE WHEN event_id % 7 = 0 THEN '' ELSE 'é:' || props END AS value, CAST(user_id AS VARCHAR) AS key,
          CAST(event_id % 3 AS INTEGER) AS partition, event_id AS "offset", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, event_type AS sort
        FROM events WHERE event_id % 5 <> 0""",
    "sink_compacted": _shown("sales.purchases", "ops.problems", "ops.short_visits"),
    "stream_recovered": _STREAM,
    "pipeline_split": """SELECT lang AS route, doc_id, lang, substr(text, 1, 5000) AS c0,
          substr(text, 5001, 5000) AS c1, substr(text, 10001, 5000) AS c2, substr(text, 15001, 5000) AS c3,
          substr(text, 20001) AS rest FROM documents WHERE lang IN ('en', 'de')""",
    "parse_repeated_keys": f"""{_E} SELECT event_id, CASE WHEN k % 3 = 0 THEN 'e' || k ELSE '-' END AS err FROM e""",
    "split_wide_default": "SELECT doc_id, true AS same FROM documents",
    "pipeline_whole_message": f"""{_E} SELECT CASE WHEN k % 4 = 3 THEN 'full' ELSE 'single' END AS route,
          event_id, CAST(k AS INTEGER) AS lane, CASE WHEN k % 4 = 3 THEN event_id ELSE -1 END AS stop
        FROM e WHERE k % 4 = 3 OR (k % 4 = 0 AND k BETWEEN 20 AND 59)""",
    "sink_table": _shown("purchases", "problems", "short_visits"),
    "sink_connector": _shown("purchases", "problems", "short_visits"),
    "sink_append": _shown("sales.purchases", "ops.problems", "ops.short_visits"),
    "sink_report": _REPORT,
    "sink_report_failure": _REPORT + " UNION ALL SELECT 'events_app_004_broken', 0, false",
    "sink_type_drift": " UNION ALL ".join(f"SELECT '{sink}' AS route, * FROM ({_DRIFT})" for sink in ("files", "tables")),
    "sink_omit_read": _DRIFT,
    "registry_skip_orphan": _PIPELINE,
    "stream_trigger": _STREAM,
    "stream_route": _STREAM,
    "stream_inferred": _STREAM,
    "stream_replay": _STREAM,
    "stream_bad_route": _STREAM,
}
