"""SQL twins of the registered queries, for DuckDB over the given tables.

They derive the same lines from the tables and apply the rules in SQL's own way.
"""

from __future__ import annotations

from partwise.plans.derived import MAX_FRIENDS

_EVENTS = """
SELECT event_id AS line_no,
       concat_ws(' | ', strftime(ts, '%Y-%m-%d'), '10.0.0.' || user_id, '/' || event_type,
                 CAST(CASE WHEN event_type = 'error' THEN 400 + CAST(floor(value) AS BIGINT) ELSE 200 END AS VARCHAR),
                 CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS value
FROM events
"""

_LOG = f"""
events_text AS ({_EVENTS}),
parts_text AS (
  SELECT concat_ws(' | ', '2024-01-15', p_brand, '/x') ||
         CASE WHEN p_type = 'STANDARD' THEN ' | n/a | 5'
              WHEN p_type = 'ECONOMY' THEN ' |  |'
              WHEN p_type = 'MEDIUM' THEN ' || '
              WHEN p_type = 'PROMO' THEN ' | 0404 | 1'
              WHEN p_type = 'LARGE' THEN ' | ' || chr(9) || '+500' || chr(9) || ' | 1'
              WHEN p_retailprice < 1000 THEN ' | -404 | 1'
              ELSE ' | 99999999999 | 1' END AS value
  FROM part),
log AS (
  SELECT value FROM events_text
  UNION ALL SELECT value FROM parts_text
  UNION ALL SELECT concat_ws(' | ', '2024-01-15', c_name, '/x') FROM customer
  UNION ALL SELECT '  # ' || s_name FROM supplier
  UNION ALL SELECT '  ' || chr(9) FROM nation),
trimmed AS (SELECT value, trim(value, ' ' || chr(9)) AS line FROM log),
split AS (SELECT line, string_split(rtrim(line, '|'), '|') AS f FROM trimmed),
named AS (
  SELECT line, len(f) AS width,
         trim(f[1], ' ' || chr(9)) AS date, trim(f[2], ' ' || chr(9)) AS ip, trim(f[3], ' ' || chr(9)) AS url,
         trim(f[4], ' ' || chr(9)) AS status, trim(f[5], ' ' || chr(9)) AS size
  FROM split),
coded AS (
  SELECT *, CASE WHEN regexp_full_match(status, '[+-]?[0-9]+') THEN TRY_CAST(status AS INTEGER) END AS code
  FROM named),
parsed AS (
  SELECT *, CASE WHEN line = '' OR starts_with(line, '#') THEN 'skipped'
                 WHEN width < 4 THEN 'malformed'
                 WHEN code IS NULL THEN 'invalid_code'
                 WHEN code < 400 THEN 'ok'
                 ELSE 'error' END AS outcome
  FROM coded),
raw_status AS (
  SELECT trim(string_split(rtrim(value, '|'), '|')[4], ' ' || chr(9)) AS status
  FROM log WHERE len(string_split(rtrim(value, '|'), '|')) >= 4)
"""

_STATUS = f"WITH {_LOG} SELECT status, count(*) AS n FROM raw_status GROUP BY status"


def _lists(friend: str) -> str:
    return f"""SELECT CAST(l_orderkey AS VARCHAR) AS user,
       string_agg(CAST({friend} AS VARCHAR), ',' ORDER BY CAST({friend} AS VARCHAR)) AS friends
FROM lineitem GROUP BY l_orderkey"""


def _graph(friend: str) -> str:
    return f"""
entry AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS u, CAST({friend} AS VARCHAR) AS f, count(*) AS times
  FROM lineitem GROUP BY 1, 2),
pair AS (
  SELECT a.u, a.f AS f1, b.f AS f2 FROM entry a JOIN entry b ON a.u = b.u AND a.f < b.f
  UNION ALL SELECT u, f, f FROM entry WHERE times > 1)
"""


_PARTS = "SELECT l_orderkey AS u, CAST(l_partkey AS VARCHAR) AS f FROM lineitem"
_KINDS = f"""{_PARTS}
  UNION ALL SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _intersection(friends: str) -> str:
    return f"""
entry AS (SELECT u, f, count(*) AS times FROM ({friends}) GROUP BY 1, 2),
same AS (SELECT u, string_agg(f || ':' || times, ',' ORDER BY f) AS list FROM entry GROUP BY u),
one AS (SELECT min(u) AS u FROM same GROUP BY list),
kept AS (SELECT entry.* FROM entry SEMI JOIN one USING (u)),
pair AS (
  SELECT a.u, a.f AS f1, b.f AS f2 FROM kept a JOIN kept b ON a.u = b.u AND a.f < b.f
  UNION ALL SELECT u, f, f FROM kept WHERE times > 1),
lists AS (SELECT f1, f2, count(*) AS n FROM pair GROUP BY 1, 2),
met AS (
  SELECT p.f1, p.f2, e.f AS name, count(*) AS met
  FROM pair p JOIN kept e ON e.u = p.u AND e.f NOT IN (p.f1, p.f2) GROUP BY 1, 2, 3),
found AS (
  SELECT m.f1, m.f2, '[' || string_agg(m.name, ', ' ORDER BY m.name) || ']' AS members
  FROM met m JOIN lists l ON l.f1 = m.f1 AND l.f2 = m.f2 AND l.n = m.met GROUP BY 1, 2)
"""


# Lists without the ones that the guard leaves out; repeats count.
_GUARDED = f"SELECT u, f FROM ({_PARTS}) WHERE u IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) <= {MAX_FRIENDS})"
_COMMON_ROWS = f"WITH {_graph('l_suppkey')} SELECT f1, f2, u AS member FROM pair"
_INTERSECTION = f"WITH {_intersection(_PARTS)} SELECT f1, f2, members FROM found"


def _outcomes(friends: str) -> str:
    return f"""WITH {_intersection(friends)}
SELECT 'skipped' AS outcome, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM region) AS n
UNION ALL SELECT 'malformed', count(*) FROM nation
UNION ALL SELECT 'processed', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'pairs_with_members', count(*) FROM found"""


_OUTCOMES_GUARDED = f"""WITH {_intersection(_GUARDED)},
size AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT 'skipped' AS outcome, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM region) AS n
UNION ALL SELECT 'malformed', count(*) FROM nation
UNION ALL SELECT 'celebrity', count(*) FROM size WHERE n > {MAX_FRIENDS}
UNION ALL SELECT 'processed', count(*) FROM size WHERE n <= {MAX_FRIENDS}
UNION ALL SELECT 'pairs_with_members', count(*) FROM found"""


def _members(condition: str) -> str:
    return f"""WITH {_graph('l_suppkey')}
SELECT f1, f2, '[' || string_agg(u, ', ' ORDER BY u) || ']' AS members
FROM pair WHERE {condition} GROUP BY f1, f2"""


_TRIPS = """
trips AS (
  SELECT o_orderkey AS trip_id,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS "VendorID",
         CASE WHEN o_orderkey % 97 <> 0 THEN strftime(o_orderdate, '%m/%d/%Y %I:%M:%S %p')
              ELSE 'unknown' END AS tpep_pickup_datetime
  FROM orders),
dated AS (SELECT *, try_strptime(tpep_pickup_datetime, '%m/%d/%Y %I:%M:%S %p') AS picked_up FROM trips),
prepared AS (
  SELECT trip_id, "VendorID", CAST(month(picked_up) AS INTEGER) AS "Month", tpep_pickup_datetime, picked_up
  FROM dated WHERE picked_up IS NOT NULL AND "VendorID" IS NOT NULL)
"""

_TYPED = f"""WITH {_TRIPS}
SELECT trip_id, "VendorID", "Month", tpep_pickup_datetime, strftime(picked_up, '%Y-%m-%d %H:%M:%S') AS pickup
FROM prepared"""
_COUNT = f"""WITH {_TRIPS} SELECT count(*) AS n FROM prepared WHERE "VendorID" = 1 AND "Month" = 1"""
_PLACES = "nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey"

# A file per event type and remainder of the user; a line takes its bytes and a line end.
_AUDIT = f"""WITH file AS (
  SELECT event_type, CAST(sum(strlen(lines.value) + 1) AS BIGINT) AS length
  FROM ({_EVENTS}) lines JOIN events ON line_no = event_id GROUP BY event_type, user_id % 3),
audit AS (
  SELECT event_type, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes, avg(length) AS mean_bytes,
         max(length) AS max_bytes, CAST(sum(greatest(ceil(length / 20000), 1)) AS BIGINT) AS blocks,
         count(*) FILTER (length < 20000) AS small_files,
         sum(greatest(ceil(length / 20000), 1)) > greatest(ceil(sum(length) / 20000), 1) AS fragmented
  FROM file GROUP BY event_type)"""

ORACLE: dict[str, str] = {
    "http_error_count": f"""WITH {_LOG}
SELECT status, count(*) AS n FROM parsed WHERE outcome = 'error' GROUP BY status""",
    "http_status_count": _STATUS,
    "http_server_error_count": f"""WITH {_LOG}
SELECT status, count(*) AS n FROM parsed WHERE outcome = 'error' AND code >= 500 GROUP BY status""",
    "log_line_outcomes": f"WITH {_LOG} SELECT outcome, count(*) AS n FROM parsed GROUP BY outcome",
    "log_summary": f"""WITH {_LOG}
SELECT outcome, CASE WHEN outcome = 'error' THEN status END AS status, count(*) AS n FROM parsed GROUP BY 1, 2""",
    "log_fields": f"WITH {_LOG} SELECT date, ip, url, status, size, outcome FROM parsed",
    "error_lines": rf"WITH {_LOG} SELECT value FROM log WHERE regexp_matches(value, '\| 4[0-9][0-9] \|')",
    "log_head": f"""SELECT row_number() OVER (ORDER BY line_no) AS line_no, value FROM ({_EVENTS})
ORDER BY 1 LIMIT 10""",
    "log_head_by_number": f"SELECT line_no, value FROM ({_EVENTS}) ORDER BY line_no LIMIT 10",
    "overwritten_counts": f"""WITH {_LOG}
SELECT status, count(*) AS n FROM parsed WHERE outcome = 'error' GROUP BY status""",
    "tsv_roundtrip": _STATUS,
    "compact_files": f"WITH {_LOG} SELECT value FROM log",
    "compacted_size": f"""WITH {_LOG},
total AS (SELECT CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes, count(*) AS n FROM log)
SELECT 'before' AS stage, CAST(ceil(n / 250) AS BIGINT) AS files, bytes FROM total
UNION ALL SELECT 'after', CAST(ceil(bytes / 134217728) AS BIGINT), bytes FROM total""",
    "compact_folder_lines": f"WITH {_LOG} SELECT value FROM log UNION ALL SELECT value FROM log",
    "compact_folder_size": f"""WITH {_LOG}
SELECT 'folder' AS stage, 2::BIGINT AS files, CAST(2 * sum(strlen(value) + 1) AS BIGINT) AS bytes, true AS same_bytes,
  1::BIGINT AS untouched FROM log""",
    "updated_partitions": f"""WITH {_TRIPS}
SELECT "VendorID", "Month", count(*) AS n FROM prepared WHERE "VendorID" <> 1 OR "Month" <= 6 GROUP BY 1, 2""",
    "friend_lists": _lists("l_partkey"),
    "friend_lists_arrow": _lists("l_suppkey"),
    "friend_pairs": f"WITH {_graph('l_suppkey')} SELECT u AS user, f1, f2 FROM pair",
    "common_friend_rows": _COMMON_ROWS,
    "common_friends": _members("true"),
    "common_friends_spread": _members("true"),
    "common_friends_lines": f"SELECT f1 || ',' || f2 || chr(9) || members AS value FROM ({_members('true')})",
    "common_friends_streamed": f"SELECT f1 || ',' || f2 || chr(9) || members AS value FROM ({_members('true')})",
    "common_friends_clean": _members("f1 < f2"),
    "friend_list_intersection": _INTERSECTION,
    "friend_list_intersection_spread": _INTERSECTION,
    "friend_list_intersection_lines": f"""SELECT '(' || f1 || ',' || f2 || ')' || chr(9) || members AS value
FROM ({_INTERSECTION})""",
    "friend_list_intersection_shared": f"WITH {_intersection(_KINDS)} SELECT f1, f2, members FROM found",
    "friend_list_intersection_guarded": f"WITH {_intersection(_GUARDED)} SELECT f1, f2, members FROM found",
    "common_friends_guarded": _members(
        f"u IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem GROUP BY l_orderkey HAVING count(*) <= {MAX_FRIENDS})"
    ),
    "graph_outcomes_guarded": _OUTCOMES_GUARDED,
    "graph_outcomes": _outcomes(_PARTS),
    "graph_outcomes_shared": _outcomes(_KINDS),
    "trips_typed": _TYPED,
    "trips_inferred": _TYPED,
    "trips_total": f"WITH {_TRIPS} SELECT count(*) AS n FROM prepared",
    "trips_rows_read": f"WITH {_TRIPS} SELECT count(*) AS n FROM trips",
    "trips_preview": f"WITH {_TRIPS} SELECT * FROM trips ORDER BY trip_id LIMIT 5",
    "trips_preview_columns": f"""WITH {_TRIPS}, top AS (SELECT * FROM prepared ORDER BY trip_id LIMIT 5)
SELECT "VendorID", tpep_pickup_datetime, "Month" FROM top""",
    "trips_count_csv": _COUNT,
    "trips_count_flat": _COUNT,
    "trips_count_partitioned": _COUNT,
    "trips_count_sql": _COUNT,
    "trips_partition_rows": f"""WITH {_TRIPS}
SELECT "VendorID", "Month", count(*) AS n FROM prepared GROUP BY 1, 2""",
    "layout_counts": f"""WITH {_TRIPS},
found AS (SELECT count(*) AS n FROM prepared WHERE "VendorID" = 1 AND "Month" = 1)
SELECT layout, n FROM found, (VALUES ('csv'), ('flat'), ('partitioned')) v(layout)""",
    "layout_comparison": f"""WITH {_TRIPS},
found AS (SELECT count(*) AS n FROM prepared WHERE "VendorID" = 1 AND "Month" = 1)
SELECT layout, n, below_csv, below_flat
FROM found, (VALUES ('csv', false, false), ('flat', true, false), ('partitioned', true, true)) v(layout, below_csv, below_flat)""",
    "layout_bytes_read": f"""WITH {_TRIPS},
found AS (SELECT count(*) AS n, count(*) FILTER ("VendorID" = 1 AND "Month" = 1) AS chosen FROM prepared)
SELECT layout, CASE kind WHEN 'all' THEN n WHEN 'none' THEN 0 ELSE chosen END AS rows, reads_columns, below_files FROM found,
  (VALUES ('flat', 'all', true, true), ('flat_no_vendor', 'none', false, false), ('partitioned', 'chosen', false, true),
    ('partitioned_ids', 'chosen', true, true)) v(layout, kind, reads_columns, below_files)""",
    "layout_audit": f"{_AUDIT} SELECT * FROM audit",
    "layout_audit_listed": f"{_AUDIT} SELECT * FROM audit",
    "trips_inferred_types": f"""WITH {_TRIPS}
SELECT 'trip_id' AS "column", 'int' AS kind, count(*) AS n FROM trips
UNION ALL SELECT 'VendorID', 'int', count("VendorID") FROM trips
UNION ALL SELECT 'tpep_pickup_datetime', 'string', count(*) FROM trips""",
    "layout_health": f"{_AUDIT} SELECT event_type, files, blocks, small_files FROM audit WHERE fragmented",
    "layout_files": f"""WITH {_TRIPS}
SELECT CAST("VendorID" AS VARCHAR) AS "VendorID", CAST("Month" AS VARCHAR) AS "Month", count(*) AS rows
FROM prepared GROUP BY 1, 2""",
    "layout_partitions": f"""WITH {_TRIPS} SELECT DISTINCT "VendorID", "Month" FROM prepared""",
    "census_layout_count": f"SELECT count(*) AS n FROM {_PLACES} WHERE n_name = 'NATION_3'",
    "utility_layout_count": f"""SELECT count(*) AS n FROM {_PLACES} JOIN orders ON o_custkey = c_custkey
WHERE r_name = 'ASIA' AND month(o_orderdate) = 3""",
    "machine_layout_count": "SELECT count(*) AS n FROM part WHERE p_type = 'PROMO'",
    "census_partition_rows": f"SELECT r_name, n_name, count(*) AS n FROM {_PLACES} GROUP BY 1, 2",
    "utility_partition_rows": f"""SELECT r_name, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n
FROM {_PLACES} JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
    "machine_partition_rows": "SELECT p_type, count(*) AS n FROM part GROUP BY 1",
}
