"""DuckDB twins of the registered queries (tables are pre-registered views).

Each statement recomputes the expected result independently, with the same
derivation rules as :mod:`tidewater.plans.fixtures`.  Column names and types
match the Spark result.
"""

from __future__ import annotations

from tidewater.constants import PY_SPACE_CLASS

# Python str.strip() whitespace; the class is valid RE2 (DuckDB) as well as Java syntax.
_WS = PY_SPACE_CLASS

_SPARSE = r"""
sparse AS (
  SELECT event_id, event_type, ts,
    CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS host,
    CASE WHEN event_id % 5 = 0 THEN ' ' ELSE '0' END AS pad,
    CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN NULL ELSE '$a$;$b$' END AS mv_user,
    CASE WHEN event_id % 97 = 0 THEN 'not json' WHEN event_id % 89 = 0 THEN ''
         ELSE chr(9) || ' ' || props || chr(10) END AS raw,
    ['a', '', NULL, event_type] AS tags,
    '' AS n_mv_x,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS n_note,
    'r' AS n_raw
  FROM events
),
attrs AS (
  SELECT event_id, e.k AS k, e.v AS v FROM (
    SELECT event_id, unnest([{'k': 'host', 'v': host}, {'k': 'pad', 'v': pad},
                             {'k': '__mv_user', 'v': mv_user}, {'k': '_raw', 'v': raw}]) AS e
    FROM sparse)
)"""


def _flat_sql(attr_keep: str, tags_expr: str, nested: list[tuple[str, str]]) -> str:
    """Flattened (event_id, path, value) rows of a cleaned map-form event."""
    nested_sql = "\n".join(
        f"  UNION ALL SELECT event_id, 'nested.{name}', {expr} FROM sparse" for name, expr in nested
    )
    return f"""
WITH {_SPARSE},
t AS (SELECT event_id, {tags_expr} AS tags FROM sparse)
SELECT event_id, 'event_id' AS path, CAST(event_id AS VARCHAR) AS value FROM sparse
  UNION ALL SELECT event_id, 'event_type', event_type FROM sparse
  UNION ALL SELECT event_id, 'attrs.' || k, v FROM attrs WHERE {attr_keep}
  UNION ALL SELECT event_id, 'tags#', CAST(len(tags) AS VARCHAR) FROM t
  UNION ALL SELECT event_id, 'tags[' || CAST(i - 1 AS VARCHAR) || ']', tags[i]
    FROM (SELECT event_id, tags, generate_subscripts(tags, 1) AS i FROM t)
{nested_sql}
"""


_KEEP_TAGS = "tags"
_DROP_EMPTY_TAGS = "list_filter(tags, lambda x: x IS NOT NULL AND x <> '')"
_EMPTY = "({v} IS NULL OR {v} = '')"

_CLEANED = f"""
WITH {_SPARSE}
SELECT /*more*/ event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
  NULLIF(host, '') AS host,
  pad,
  CAST(len({_DROP_EMPTY_TAGS}) AS INTEGER) AS tag_count,
  array_to_string({_DROP_EMPTY_TAGS}, '|') AS tags,
  NULLIF(n_note, '') AS note
FROM sparse
"""

_CLEANED_VIEW = _CLEANED


def _batched_view(tail: str, more: str) -> str:
    """The cleaned events with the batch of each: its JSON text's bytes (``tail``: fields after the nested one) summed in order."""
    json = (
        "'{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"ts\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '\"'"
        " || CASE WHEN host <> '' THEN ',\"host\":\"' || host || '\"' ELSE '' END || ',\"pad\":\"' || pad || '\",\"tags\":[\"a\",\"' || event_type || '\"]'"
        f" || ',\"nested\":{{' || CASE WHEN n_note <> '' THEN '\"note\":\"' || n_note || '\"' ELSE '' END || '}}{tail}}}'"
    )
    sized = f"(SELECT event_id AS id, event_type AS kind, ts AS moment, strlen({json}) AS nb FROM sparse)"
    batch = "SELECT id, CAST(floor((sum(nb) OVER (PARTITION BY kind ORDER BY moment, id ROWS UNBOUNDED PRECEDING) - nb) / 16384) AS BIGINT) AS batch_id"
    return _CLEANED.replace("/*more*/", f"batch_id, {more}") + f" JOIN ({batch} FROM {sized}) ON id = event_id"


_RAW_TEXT = r"""
raw_text AS (
  SELECT doc_id, replace(CASE WHEN doc_id % 3 = 0 THEN replace(text, '.', '.' || chr(13))
                              WHEN doc_id % 5 = 0 THEN replace(text, chr(10), chr(13) || chr(10)) ELSE text END,
                         chr(10), chr(10) || chr(10) || chr(10)) || chr(10) || ' ' || chr(9) || chr(10) AS raw
  FROM documents
)"""

_QUOTED_LINES = r"""
quoted_lines AS (
  SELECT page_id, CAST(line_no - 1 AS INTEGER) AS line_no,
    CASE WHEN page_id % 4 = 0 THEN ' ' || line
         WHEN page_id % 5 = 0 THEN 'a,"b"' || chr(13) || line
         ELSE line END AS line
  FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS line,
               generate_subscripts(string_split(html, chr(10)), 1) AS line_no FROM pages)
)"""

_EVENT_JSON_ROWS = """
  CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS code,
  event_id, event_type, user_id
"""

_PARSED = f"""
WITH {_SPARSE},
s AS (SELECT event_id, raw, regexp_replace(raw, '^{_WS}+|{_WS}+$', '', 'g') AS j FROM sparse),
p AS (SELECT event_id, raw,
        CASE WHEN j <> '' AND json_valid(j) THEN json_type(j) = 'OBJECT' ELSE false END AS ok, j FROM s)
"""

ORACLE: dict[str, str] = {
    "search_head": """
SELECT event_id, ts, user_id, event_type, value, props FROM events
WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 50
""",
    "explode_results": """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, event_id, props AS _raw FROM events
""",
    "read_raw_lines": f"""
WITH {_RAW_TEXT}
SELECT unnest(string_split(raw, chr(10))) AS line FROM raw_text
""",
    "stage_csv": f"""
WITH {_QUOTED_LINES}
SELECT line FROM quoted_lines WHERE NOT regexp_full_match(line, '{_WS}*')
""",
    "stage_json": _batched_view("", ""),
    "parse_raw": _PARSED + """
SELECT event_id, CASE WHEN ok THEN CAST(json_extract(j, '$.k') AS INTEGER) END AS k, NOT ok AS bad FROM p
""",
    "route_failures": _PARSED + """
SELECT event_id, CASE WHEN ok THEN 'good' ELSE 'dead' END AS route,
       CASE WHEN ok THEN CAST(json_extract(j, '$.k') AS INTEGER) END AS k,
       CASE WHEN ok THEN NULL ELSE raw END AS raw
FROM p
""",
    "infer_rows": f"SELECT {_EVENT_JSON_ROWS} FROM events",
    "apply_mapping_json": """
SELECT event_id AS id, event_type AS kind, user_id AS user_key,
  CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS code
FROM events
""",
    "apply_mapping_csv": """
SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, l_quantity AS quantity,
  l_returnflag || ',' || l_linestatus AS flags, strftime(l_shipdate, '%Y-%m-%d') AS shipdate
FROM lineitem
""",
    "encode_json": _CLEANED_VIEW,
    "encode_csv_line": f"""
WITH {_QUOTED_LINES}
SELECT page_id, line_no,
  CASE WHEN contains(line, '"') OR contains(line, ',') OR contains(line, chr(13)) OR contains(line, chr(10))
         THEN '"' || replace(line, '"', '""') || '"'
       WHEN line = '' THEN '""'
       ELSE line END AS field
FROM quoted_lines
""",
    "tag_run": "SELECT event_id, 'run-0001' AS run_id FROM events",
    "drop_mv_fields": _flat_sql(
        "NOT starts_with(k, '__mv_')", _KEEP_TAGS, [("note", "n_note"), ("_raw", "n_raw")]
    ),
    "drop_empty_fields": _flat_sql(
        "NOT " + _EMPTY.format(v="v"),
        _DROP_EMPTY_TAGS,
        [("__mv_x", "NULLIF(n_mv_x, '')"), ("note", "NULLIF(n_note, '')"), ("_raw", "NULLIF(n_raw, '')")],
    ),
    "drop_empty_mv_fields": _flat_sql(
        "NOT (starts_with(k, '__mv_') AND " + _EMPTY.format(v="v") + ")",
        _DROP_EMPTY_TAGS,
        [("__mv_x", "NULLIF(n_mv_x, '')"), ("note", "n_note"), ("_raw", "n_raw")],
    ),
    "drop_raw_field": _flat_sql("k <> '_raw'", _KEEP_TAGS, [("__mv_x", "n_mv_x"), ("note", "n_note")]),
    "clean_events": _flat_sql(
        "NOT starts_with(k, '__mv_') AND k <> '_raw' AND NOT " + _EMPTY.format(v="v"),
        _DROP_EMPTY_TAGS,
        [("note", "NULLIF(n_note, '')")],
    ),
    "clean_events_struct": f"""
WITH {_SPARSE},
t AS (SELECT event_id, {_DROP_EMPTY_TAGS} AS tags FROM sparse)
SELECT event_id, 'event_id' AS path, CAST(event_id AS VARCHAR) AS value FROM sparse
  UNION ALL SELECT event_id, 'event_type', event_type FROM sparse
  UNION ALL SELECT event_id, 'host', NULLIF(host, '') FROM sparse
  UNION ALL SELECT event_id, 'pad', pad FROM sparse
  UNION ALL SELECT event_id, 'tags#', CAST(len(tags) AS VARCHAR) FROM t
  UNION ALL SELECT event_id, 'tags[' || CAST(i - 1 AS VARCHAR) || ']', tags[i]
    FROM (SELECT event_id, tags, generate_subscripts(tags, 1) AS i FROM t)
  UNION ALL SELECT event_id, 'nested.note', NULLIF(n_note, '') FROM sparse
""",
    "drop_blank_lines": f"""
WITH {_RAW_TEXT},
l AS (SELECT doc_id, unnest(string_split(raw, chr(10))) AS line,
             generate_subscripts(string_split(raw, chr(10)), 1) AS pos FROM raw_text)
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS line_no, line FROM l
WHERE NOT regexp_full_match(line, '{_WS}*')
""",
    "assign_byte_batch": """
WITH b AS (
  SELECT source, doc_id, strlen(text) AS nb,
    CAST(floor((sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - strlen(text)) / 262144) AS BIGINT) AS batch_id
  FROM documents)
SELECT source, batch_id, count(*) AS n_docs, CAST(sum(nb) AS BIGINT) AS n_bytes,
       min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM b GROUP BY source, batch_id
""",
    "assign_count_batch": """
WITH b AS (
  SELECT o_orderpriority, o_orderkey,
    CAST(floor((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) / 1000) AS BIGINT) AS batch_id
  FROM orders)
SELECT o_orderpriority, batch_id, count(*) AS n_orders, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM b GROUP BY o_orderpriority, batch_id
""",
    "assign_count_batch_lineitem": """
WITH b AS (
  SELECT l_linestatus, l_orderkey, l_shipdate,
    CAST(floor((row_number() OVER (PARTITION BY l_linestatus
                 ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1) / 1000) AS BIGINT) AS batch_id
  FROM lineitem)
SELECT l_linestatus, batch_id, count(*) AS n_lines,
       strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship,
       CAST(sum(l_orderkey) AS BIGINT) AS orderkey_sum
FROM b GROUP BY l_linestatus, batch_id
""",
    "assign_time_batch": """
SELECT event_id, 'ingest-' || strftime(date_trunc('second', ts), '%Y%m%d-%H%M%S') AS batch_name FROM events
""",
    "search_funnel": """
SELECT count(*) AS scan_count,
       count(*) FILTER (WHERE event_type = 'error') AS event_count,
       CAST(least(count(*) FILTER (WHERE event_type = 'error'), 50) AS BIGINT) AS result_count
FROM events
""",
    "delivery_summary": """
SELECT 'run-' || CAST(user_id % 5 AS VARCHAR) AS run_id,
  CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS sent,
  CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS elapsed_seconds,
  CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS DOUBLE) / 60.0 AS elapsed_minutes
FROM events GROUP BY 1
""",
    "retain": """
SELECT event_id, user_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY
""",
    "retain_lineitem": """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2001-11-04 00:00:00' - INTERVAL 365 DAY
""",
    "alert_windows": """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n_matches
FROM events WHERE event_type = 'error'
GROUP BY date_trunc('hour', ts) HAVING count(*) >= 3
""",
    "alert_events": """
SELECT e.event_id, e.user_id FROM events e
WHERE e.event_type = 'error' AND date_trunc('hour', e.ts) IN (
  SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error'
  GROUP BY 1 HAVING count(*) >= 3)
""",
    "append_table": """
SELECT event_id, event_type, 'run-0001' AS run_id FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, event_type, 'run-0001' AS run_id FROM events
""",
    "deliver_direct": "SELECT event_id, event_type, 'run-0001' AS run_id FROM events",
    "load_staged": _batched_view("", ""),
    "alert_delivered_rows": _batched_view(',"run_id":"run-0001"', "CASE WHEN event_id % 2 = 0 THEN 'run-0001' ELSE 'run-0002' END AS run_id,").replace(
        "PARTITION BY kind ORDER BY", "PARTITION BY kind, id % 2 ORDER BY"
    ),
    "load_mapped": """
SELECT 'good' AS route, event_id AS id, event_type AS kind, CASE WHEN event_id % 83 = 0 THEN -1 ELSE user_id END AS user,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_id % 79 = 0 END AS is_nan, CAST(NULL AS VARCHAR) AS record
FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
UNION ALL
SELECT 'dead', NULL, NULL, NULL, NULL, CASE WHEN event_id % 97 = 0 THEN 'not json ' || event_id ELSE '[' || event_id || ']' END
FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
UNION ALL SELECT 'lost', NULL, NULL, NULL, NULL, NULL
""",
    "load_mapped_csv": "SELECT text AS line, CAST(NULL AS VARCHAR) AS more FROM documents",
    "unchanged_files": """
SELECT name, length FROM (
  SELECT o_orderkey AS k, 'buffer-' || o_orderkey AS name, CAST(floor(o_totalprice * 40) AS BIGINT) AS length,
         CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1998-08-02 00:00:00' ELSE CAST(o_orderdate AS TIMESTAMP) END + to_seconds(o_orderkey % 41 - 30) AS changed
  FROM orders)
WHERE changed < TIMESTAMP '1998-08-02 00:00:00' AND (length > 5 * 1024 * 1024 OR (k % 5 <> 0 AND k % 4 <> 0))
""",
    "clean_json_events": """
SELECT event_id, event_id % 101 = 0 AS bad,
  CASE WHEN event_id % 101 <> 0 THEN
    '{"deep":{"l' || event_id % 7 || '":{"v' || event_id % 11 || '":["a",[{}],' || event_id % 2 || '],"z":{}}},"id":' || event_id || ',"k' || event_id % 13 || '":"' || event_type || '"}'
  END AS event
FROM events
""",
    "assign_greedy_batch": """
WITH RECURSIVE rows AS (
  SELECT source, doc_id, strlen(text) AS bytes, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
walk AS (
  SELECT source, doc_id, bytes, r, CAST(0 AS BIGINT) AS batch_id, CAST(bytes AS BIGINT) AS held FROM rows WHERE r = 1
  UNION ALL
  SELECT n.source, n.doc_id, n.bytes, n.r, w.batch_id + CASE WHEN w.held > 65536 THEN 1 ELSE 0 END,
         CASE WHEN w.held > 65536 THEN n.bytes ELSE w.held + n.bytes END
  FROM walk w JOIN rows n ON n.source = w.source AND n.r = w.r + 1)
SELECT source, batch_id, count(*) AS n_docs, CAST(sum(bytes) AS BIGINT) AS n_bytes, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM walk GROUP BY source, batch_id
""",
    "search_progress": """
SELECT 'run-0001' AS run_id, CAST(100 AS DOUBLE) AS percent_done, count(*) AS scan_count, count(*) FILTER (WHERE event_type = 'error') AS event_count,
       least(count(*) FILTER (WHERE event_type = 'error'), 50) AS result_count
FROM events
""",
    "alert_failures": _PARSED + """
SELECT 'run-0001' AS run_id, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS sent, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS failed FROM p
""",
    "dead_letters": _PARSED + """
SELECT coalesce(raw, '') AS record, 'run-0001' AS run_id FROM p WHERE NOT ok
""",
    "alert_program": f"""
WITH {_SPARSE}
SELECT event_id AS id, NULLIF(host, '') AS host, NULLIF(n_note, '') AS note, 'run-0001' AS run FROM sparse
WHERE event_type = 'error' AND date_trunc('hour', ts) IN (
  SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 3)
""",
    "eligible_files": """
WITH listing AS (
  SELECT 'buffer-' || o_orderkey AS name, CAST(floor(o_totalprice * 40) AS BIGINT) AS length,
         CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '1998-08-02 00:00:00' ELSE o_orderdate END
           + to_seconds(o_orderkey % 41 - 30) AS changed FROM orders)
SELECT name, length, changed < TIMESTAMP '1998-08-02 00:00:00'
       AND (length > 5242880 OR changed <= TIMESTAMP '1998-08-02 00:00:00' - INTERVAL 10 SECOND) AS eligible FROM listing
""",
    "search_head_large": """
SELECT l_orderkey, l_linenumber, copy FROM (
  SELECT *, CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS copy FROM lineitem WHERE l_quantity >= 2)
ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, copy DESC LIMIT 150000
""",
    "alert_delivery": """
SELECT 'run-0001' AS run_id, count(*) AS sent, CAST(0 AS BIGINT) AS failed FROM events
""",
    "alert_delivery_stream": """
SELECT 'run-0001' AS run_id, count(*) AS sent, CAST(0 AS BIGINT) AS failed FROM events
""",
    "alert_direct": """
SELECT 'run-0001' AS run_id, count(*) AS sent, CAST(0 AS BIGINT) AS failed FROM events
""",
    "forwarder": f"""
WITH {_RAW_TEXT},
l AS (SELECT unnest(string_split(raw, chr(10))) AS line FROM raw_text)
SELECT line FROM l WHERE NOT regexp_full_match(line, '{_WS}*')
""",
    "stream_intake": f"""
WITH {_RAW_TEXT},
l AS (SELECT unnest(string_split(raw, chr(10))) AS line FROM raw_text)
SELECT line FROM l WHERE NOT regexp_full_match(line, '{_WS}*')
""",
    "backfill": """
WITH head AS (SELECT event_id FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 50)
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS code, event_id, event_type, user_id
FROM events WHERE event_id IN (SELECT event_id FROM head)
""",
}
ORACLE["alert_windows_stream"] = ORACLE["alert_windows"]
ORACLE["alert_stream_program"] = ORACLE["alert_program"]
