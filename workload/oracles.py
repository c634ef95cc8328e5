"""The registered queries in DuckDB's SQL, written independently of the library."""

from __future__ import annotations

from workload.tables import DAY, JAN_1, JAN_2, JAN_15, JAN_31, MAX_LOGS, TERMS

EVENTS = f"""
ev AS (
  SELECT lpad(CAST(event_id AS VARCHAR), 20, '0') AS log_id,
         epoch_us(ts) // 1000000 AS time,
         event_type AS topic,
         CAST(user_id AS VARCHAR) AS source,
         CAST(CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 4 AS INTEGER) AS shard,
         CAST(value AS VARCHAR) AS value,
         regexp_extract(props, '"k": *([-0-9.]+)', 1) AS k
  FROM events
)"""

DOCUMENTS = f"""
docs AS (
  SELECT lpad(CAST(doc_id AS VARCHAR), 20, '0') AS log_id,
         {JAN_1} + 60 * doc_id AS time,
         lang AS topic, source, text,
         CAST(CAST(('0x' || substr(md5(source), 1, 8)) AS BIGINT) % 4 AS INTEGER) AS shard
  FROM documents
)"""


def _digits(n: str) -> str:
    steps = " ".join(f"WHEN {n} < {1 << (7 * d)} THEN {d}" for d in range(1, 6))
    return f"(CASE {steps} ELSE 6 END)"


def _framed(n: str) -> str:
    return f"(1 + {_digits(n)} + {n})"


def _text(column: str) -> str:
    return _framed(f"strlen({column})")


# Groups of at most two logs per shard, topic, source and day, in order of time and hash of the id; a
# group arrives with its newest log.
GROUPS = EVENTS + f""",
sized AS (
  SELECT *, 1 + {_digits('time')}
            + {_framed(f"({_framed('5')} + {_text('value')})")}
            + {_framed(f"({_framed('1')} + {_text('k')})")} AS log_size,
         time // {DAY} AS day,
         row_number() OVER (PARTITION BY shard, topic, source, time // {DAY} ORDER BY time, md5(log_id), log_id) AS rn
  FROM ev
),
grouped AS (
  SELECT shard, topic, source, day, (rn - 1) // {MAX_LOGS} AS chunk,
         lpad(CAST(max(time) AS VARCHAR), 10, '0') || '-' || md5(concat_ws('/', CAST(shard AS VARCHAR), md5(topic),
             md5(source), '-', CAST(day * {DAY} AS VARCHAR), md5(arg_min(log_id, rn)))) AS cursor,
         min(time) AS min_time, max(time) AS max_time, count(*) AS n_logs,
         CAST(sum({_framed('log_size')}) + {_text('any_value(topic)')} + {_text('any_value(source)')} AS BIGINT) AS raw_size,
         string_agg(CAST(time AS VARCHAR) || '/' || value || '/' || k, ',' ORDER BY rn) AS logs,
         CAST(make_date(CAST(day AS INTEGER)) AS VARCHAR) AS date
  FROM sized GROUP BY shard, topic, source, day, (rn - 1) // {MAX_LOGS}
)"""

PULLED = GROUPS + f""",
pulled AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY shard ORDER BY cursor) AS INTEGER) AS place
    FROM grouped WHERE cursor >= '{JAN_15:010d}-'
  ) WHERE place <= 10
)"""


def _arrived(time: int) -> str:
    """First cursor of a shard at or after a time, or the time's smallest."""
    return f"coalesce(min(cursor) FILTER (cursor >= '{time:010d}-'), '{time:010d}-')"


LINES = """
lines AS (
  SELECT '/var/log/' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.LOG' AS file_path,
         unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents
)"""

RECORDS = LINES + """,
marked AS (
  SELECT *, CAST(sum(CASE WHEN regexp_full_match(line, '[A-Z].*') THEN 1 ELSE 0 END)
              OVER (PARTITION BY file_path ORDER BY n) AS BIGINT) AS record
  FROM lines
)"""

URLS = r"""
urls AS (
  SELECT page_id, regexp_full_match(url, '(https?)://([^/]+)/([a-z]+)/([0-9]+)\?page=([0-9]+).*') AS ok,
         regexp_extract(url, '^(https?)://([^/]+)/([a-z]+)/([0-9]+)\?page=([0-9]+)',
                        ['scheme', 'host', 'lang', 'number', 'page']) AS f
  FROM pages
)"""

_HAS_THE = "list_contains(regexp_split_to_array(lower(text), '[,: ]'), 'the')"
_NUMBER_K = r"CASE WHEN regexp_full_match(k, '\s*[+-]?[0-9]+\s*') THEN TRY_CAST(k AS BIGINT) END"

_PER_PARTITION = f"""WITH {GROUPS}
SELECT shard, date, count(*) AS n_groups, CAST(sum(n_logs) AS BIGINT) AS n_logs, CAST(sum(raw_size) AS BIGINT) AS bytes
FROM grouped GROUP BY shard, date"""

_TERM = f"WITH {DOCUMENTS} SELECT log_id, time, topic, source FROM docs WHERE {_HAS_THE}"

_COLLECTED = f"""
WITH taken AS (
  SELECT kind AS logstore, doc_id, lang, source, text FROM documents
  CROSS JOIN (VALUES ('texts'), ('spanish')) AS kinds(kind) WHERE kind = 'texts' OR source <> 'src1'
)
SELECT logstore, CAST(doc_id AS VARCHAR) AS doc, {JAN_1} + 60 * doc_id AS time, lang AS topic, source,
       md5(text) AS message, NULL AS reject_reason
FROM taken WHERE source <> 'src3' AND (lang = 'es') = (logstore = 'spanish')
UNION ALL
SELECT logstore, NULL, NULL, NULL, source, md5('[no time] doc=' || doc_id || ' lang=' || lang || chr(10) || text),
       'time does not parse'
FROM taken WHERE source = 'src3'"""

_MEMBERS = r"""
members AS (
  SELECT n_name AS group_name,
         concat_ws('.', '10', s_suppkey // 65536, (s_suppkey // 256) % 256, s_suppkey % 256) AS ip,
         s_name AS unique_id, 'nation-' || CAST(s_nationkey AS VARCHAR) AS userdefined_id
  FROM nation JOIN supplier ON n_nationkey = s_nationkey
)"""

# The state of a pair after each second in which it changed.
_CHANGES = f"""
seconds AS (
  SELECT (CASE WHEN o_orderkey % 2 = 0 THEN 'all-' ELSE 'errors-' END) || r_name AS config_name, n_name AS group_name,
         {JAN_1} + o_orderkey * 7919 % (30 * {DAY}) AS time, arg_max(o_orderstatus, o_orderkey) <> 'F' AS "on"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
)"""

_FLAT = f"""WITH {GROUPS}
SELECT g.cursor || '-' || lpad(CAST((rn - 1) % {MAX_LOGS} AS VARCHAR), 8, '0') AS log_id,
       s.time, s.topic, s.source, s.shard, s.value, s.k
FROM sized s JOIN grouped g
  ON s.shard = g.shard AND s.topic = g.topic AND s.source = g.source AND s.day = g.day
     AND (s.rn - 1) // {MAX_LOGS} = g.chunk"""

_ENTITIES = """
WITH feed AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders
),
alive AS (
  SELECT * FROM feed f WHERE rn > coalesce(
    (SELECT max(rn) FROM feed d WHERE d.o_custkey = f.o_custkey AND d.o_orderstatus = 'F'), 0)
)
SELECT o_custkey AS name,
       epoch_us(arg_min(o_orderdate, rn)) // 1000000 AS create_time,
       epoch_us(arg_max(o_orderdate, rn)) // 1000000 AS modify_time,
       arg_max(o_totalprice, rn) AS o_totalprice, arg_max(o_orderpriority, rn) AS o_orderpriority
FROM alive GROUP BY o_custkey"""

ORACLES: dict[str, str] = {
    "pack_log_groups": f"""WITH {GROUPS}
SELECT cursor, shard, topic, source, date, min_time, max_time, n_logs, raw_size, logs FROM grouped""",
    "flatten_log_groups": _FLAT,
    "flatten_contents": f"""WITH {EVENTS}
SELECT log_id, 0 AS position, 'value' AS key, value FROM ev
UNION ALL SELECT log_id, 1 AS position, 'k' AS key, k AS value FROM ev""",
    "assign_shard": f"WITH {EVENTS} SELECT log_id, source, shard FROM ev",
    "put_logs": _PER_PARTITION,
    "put_logs_stream": _PER_PARTITION,
    "expire_logs": f"SELECT log_id, time, topic FROM ({_FLAT}) WHERE time >= {JAN_31} - 7 * 86400",
    "meter_volume": f"""WITH {GROUPS}
SELECT topic, source, count(*) AS n_groups, CAST(sum(n_logs) AS BIGINT) AS n_logs, CAST(sum(raw_size) AS BIGINT) AS bytes
FROM grouped GROUP BY topic, source""",
    "list_shards": f"""WITH {GROUPS}
SELECT shard, count(*) AS n_groups, min(cursor) AS first_cursor, max(cursor) AS last_cursor
FROM grouped GROUP BY shard
UNION ALL SELECT 4, 0, NULL, NULL""",
    "resolve_cursor": f"""WITH {GROUPS}
SELECT shard, 'begin' AS position, min(cursor) AS cursor FROM grouped GROUP BY shard
UNION ALL SELECT shard, 'end', max(cursor) || '~' FROM grouped GROUP BY shard
UNION ALL SELECT shard, '{JAN_15}', {_arrived(JAN_15)} FROM grouped GROUP BY shard
UNION ALL SELECT shard, '{JAN_31}', {_arrived(JAN_31)} FROM grouped GROUP BY shard
UNION ALL SELECT 4, * FROM (VALUES ('begin', ''), ('end', ''), ('{JAN_15}', '{JAN_15:010d}-'), ('{JAN_31}', '{JAN_31:010d}-'))""",
    "pull_logs": f"WITH {PULLED} SELECT shard, place, cursor, topic, source, n_logs FROM pulled",
    "next_cursors": f"""WITH {PULLED}
SELECT shard AS range, shard, count(*) AS n_groups, max(cursor) || '~' AS next_cursor FROM pulled GROUP BY shard""",
    "follow_shards": f"WITH {EVENTS} SELECT time, topic, source, shard, value, k FROM ev",
    "tail_logs": f"""WITH {EVENTS}
SELECT topic, count(*) AS n_logs, min(time) AS first_time, max(time) AS last_time
FROM ev WHERE time >= {JAN_15} GROUP BY topic""",
    "scan_logs": f"""SELECT log_id, time, topic, source, value, k FROM ({_FLAT})
WHERE time >= {JAN_2} AND time < {JAN_2 + DAY} AND topic = 'error'""",
    "scan_groups": f"""{_FLAT}
WHERE s.time >= {JAN_2 + 1000} AND s.time < {JAN_2 + DAY // 2} AND s.topic = 'error'""",
    "term_match": _TERM,
    "key_term_match": f"""WITH {DOCUMENTS}
SELECT log_id, time FROM docs
WHERE topic = 'en' AND list_contains(regexp_split_to_array(lower(text), '[,: ]'), 'and')""",
    "key_compare": f"""WITH {EVENTS}
SELECT log_id, time, value, k FROM ev WHERE {_NUMBER_K} > 50 AND TRY_CAST(value AS DOUBLE) >= 100""",
    "get_logs": f"""SELECT log_id, time, topic, source, value, k FROM ({_FLAT})
WHERE time >= {JAN_2 + 40_000} AND time < {JAN_15 + 30_000} AND {_NUMBER_K} > 10
ORDER BY time DESC, log_id DESC LIMIT 100 OFFSET 100""",
    "get_logs_by_rank": f"""SELECT log_id, time, topic, source, value, k FROM ({_FLAT})
WHERE time >= {JAN_2 + 40_000} AND time < {JAN_15 + 30_000} AND {_NUMBER_K} > 10
ORDER BY time DESC, log_id DESC LIMIT 100 OFFSET 50""",
    "get_histograms": f"""WITH {EVENTS},
buckets AS (SELECT unnest(range({JAN_2}, {JAN_2 + DAY - 100}, 3600)) AS lo)
SELECT lo AS "from", least(lo + 3600, {JAN_2 + DAY - 100}) AS "to", count(log_id) AS count, 'Complete' AS progress
FROM buckets LEFT JOIN ev
  ON time >= lo AND time < least(lo + 3600, {JAN_2 + DAY - 100}) AND topic = 'error' AND TRY_CAST(value AS DOUBLE) > 50
GROUP BY lo""",
    "histogram_total": f"""WITH {EVENTS}
SELECT count(*) AS count, 'Complete' AS progress FROM ev
WHERE time >= {JAN_2 + 40_000} AND time < {JAN_15 + 30_000} AND {_NUMBER_K} <= 50""",
    "rollup_histograms": f"""WITH {EVENTS},
buckets AS (SELECT unnest(range({JAN_2 + 40_007}, {JAN_15 + 30_013}, {DAY})) AS lo)
SELECT lo AS "from", least(lo + {DAY}, {JAN_15 + 30_013}) AS "to", count(log_id) AS count, 'Complete' AS progress
FROM buckets LEFT JOIN ev ON time >= lo AND time < least(lo + {DAY}, {JAN_15 + 30_013})
GROUP BY lo""",
    "live_histograms": f"""WITH {EVENTS}
SELECT time // 3600 * 3600 AS "from", time // 3600 * 3600 + 3600 AS "to", count(*) AS count,
       CASE WHEN time // 3600 * 3600 + 3600 <= (SELECT max(time) FROM ev) - 600 THEN 'Complete' ELSE 'Incomplete' END AS progress
FROM ev GROUP BY time // 3600""",
    "build_line_index": f"""WITH {DOCUMENTS}
SELECT DISTINCT unnest(list_filter(regexp_split_to_array(lower(text), '[,: ]'), lambda x: x <> '')) AS token,
       CAST(make_date(CAST(time // 86400 AS INTEGER)) AS VARCHAR) AS date, shard, log_id
FROM docs""",
    "build_key_index": f"""WITH {EVENTS}
SELECT log_id, time, {_NUMBER_K} AS k, TRY_CAST(value AS DOUBLE) AS value FROM ev""",
    "lookup_term": f"""WITH {DOCUMENTS}
SELECT time, topic, source FROM docs WHERE time >= {JAN_1 + 3600} AND time < {JAN_31} AND {_HAS_THE}""",
    "lookup_terms": f"""WITH {DOCUMENTS},
split AS (SELECT *, regexp_split_to_array(lower(text), '[,: ]') AS words FROM docs)
SELECT time, topic, source, md5(text) AS text FROM split
WHERE time >= {JAN_1 + 3600} AND time < {JAN_31} AND NOT list_contains(words, '{TERMS[2].lower()}')
  AND (list_contains(words, '{TERMS[0].lower()}') OR list_contains(words, '{TERMS[1].lower()}'))""",
    "split_shards": f"WITH {EVENTS} SELECT time, topic, source, value, k FROM ev",
    "lookup_keys": f"""WITH {EVENTS}
SELECT time, topic, source, value, k FROM ev WHERE time >= {JAN_1 + 3600} AND time < {JAN_31}
  AND ((TRY_CAST(value AS DOUBLE) > 200 AND NOT {_NUMBER_K} >= 90) OR ({_NUMBER_K} < 5 AND TRY_CAST(value AS DOUBLE) <= 1))""",
    "follow_log_files": """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_id, event_type, value, 'end' AS mark FROM events""",
    "follow_records": """
SELECT event_id, event_type, value, 'end' AS mark, CAST(0 AS BIGINT) AS part, CAST(2 AS BIGINT) AS n_lines FROM events""",
    "read_log_files": """
SELECT source, lang, CAST(sum(1 + len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
       CAST(sum(length(replace(text, chr(10), ''))
           + length('[] doc= lang=' || CAST(doc_id AS VARCHAR) || lang)
           + CASE WHEN source = 'src3' THEN length('no time') ELSE 19 END) AS BIGINT) AS n_chars
FROM documents GROUP BY source, lang""",
    "assemble_records": f"""WITH {RECORDS}
SELECT file_path, record, 0 AS part, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY n) AS body
FROM marked GROUP BY file_path, record""",
    "assemble_bounded_records": f"""WITH {RECORDS},
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY file_path, record ORDER BY n) - 1) // 2 AS part,
         count(*) OVER (PARTITION BY file_path, record) > 2 AS oversize
  FROM marked
)
SELECT file_path, record, part, count(*) AS n_lines, string_agg(line, chr(10) ORDER BY n) AS body, any_value(oversize) AS oversize
FROM placed GROUP BY file_path, record, part""",
    "extract_fields": f"""WITH {URLS}
SELECT page_id, CASE WHEN ok THEN f.scheme END AS scheme, CASE WHEN ok THEN f.host END AS host,
       CASE WHEN ok THEN f.lang END AS lang, CASE WHEN ok THEN f.number END AS number,
       CASE WHEN ok THEN f.page END AS page,
       CASE WHEN NOT ok THEN 'extraction regex does not match' END AS reject_reason
FROM urls""",
    "filter_records": rf"""WITH {URLS}
SELECT page_id, f.host AS host, f.lang AS lang FROM urls
WHERE ok AND regexp_full_match(f.host, '.*\.example\.(com|org)') AND regexp_full_match(f.lang, 'en|fr')""",
    "parse_log_time": """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW'
                        THEN epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 END AS time
FROM orders""",
    "derive_topic": """
SELECT doc_id, source AS by_path, '' AS by_none,
       '/var/log/' || source || '/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.LOG' AS by_default,
       'group-' || lang AS by_group
FROM documents""",
    "route_records": """
WITH records AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS machine_id, event_type,
         '/var/log/' || event_type || '/' || CAST(user_id AS VARCHAR) || '.LOG' AS file_path
  FROM events
)
SELECT event_id, machine_id, file_path, kind || '-' || r_name AS config_name, r_name AS project,
       kind AS logstore, n_name AS group_name, 'topic-' || n_name AS group_topic
FROM records
JOIN customer ON machine_id = CAST(c_custkey AS VARCHAR)
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
CROSS JOIN (VALUES ('all'), ('errors')) AS kinds(kind)
WHERE kind = 'all' OR (event_type = 'error' AND regexp_full_match(machine_id, '1[0-9]'))""",
    "binding_intervals": f"""WITH {_CHANGES},
turns AS (
  SELECT *, lag("on", 1, false) OVER (PARTITION BY config_name, group_name ORDER BY time) AS was FROM seconds
)
SELECT config_name, group_name, bound_from, bound_to FROM (
  SELECT config_name, group_name, "on", time AS bound_from,
         lead(time) OVER (PARTITION BY config_name, group_name ORDER BY time) AS bound_to
  FROM turns WHERE "on" <> was
) WHERE "on\"""",
    "route_records_in_time": f"""WITH {_CHANGES},
wanted AS (
  SELECT event_id, epoch_us(ts) // 1000000 AS time, CAST(user_id AS VARCHAR) AS machine_id, event_type,
         '/var/log/' || event_type || '/' || CAST(user_id AS VARCHAR) || '.LOG' AS file_path,
         kind || '-' || r_name AS config_name, r_name AS project, kind AS logstore, n_name AS group_name
  FROM events
  JOIN customer ON user_id = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES ('all'), ('errors')) AS kinds(kind)
)
SELECT event_id, machine_id, file_path, w.config_name, project, logstore, w.group_name, 'topic-' || w.group_name AS group_topic
FROM wanted w ASOF JOIN seconds s
  ON w.config_name = s.config_name AND w.group_name = s.group_name AND w.time >= s.time
WHERE s."on" AND (logstore = 'all' OR (event_type = 'error' AND regexp_full_match(machine_id, '1[0-9]')))""",
    "collect_logs": _COLLECTED,
    "collect_logs_stream": _COLLECTED,
    "expand_machine_groups": f"WITH {_MEMBERS} SELECT group_name, ip, unique_id, userdefined_id FROM members",
    "machine_totals": f"WITH {_MEMBERS} SELECT group_name, count(*) AS total FROM members GROUP BY group_name",
    "applied_configs": """
SELECT DISTINCT 'customer-' || CAST(o_custkey AS VARCHAR) AS group_name, o_orderpriority AS config_name FROM orders""",
    "applied_machine_groups": """
SELECT DISTINCT l_returnflag || l_linestatus AS config_name, 'supplier-' || CAST(l_suppkey AS VARCHAR) AS group_name
FROM lineitem""",
    "current_bindings": """
SELECT config_name, group_name FROM (
  SELECT o_orderpriority AS config_name, o_custkey AS group_name, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders
) WHERE rn = 1 AND o_orderstatus <> 'F'""",
    "entity_snapshot": _ENTITIES,
    "follow_entities": _ENTITIES,
    "missing_targets": """
SELECT doc_id, count(*) AS n_refs FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id) GROUP BY doc_id""",
}
