"""DuckDB SQL for the registered queries, over the same tables.

Written from the tables' numbers rather than from their text form where
possible, and with windows and plain joins where the operators use other plans.
"""

from __future__ import annotations

from servicerank.schemas import DEFAULT_WEIGHTS, MATRIX_CRITERIA, REPORT_CRITERIA, SNAPSHOT_COLUMNS

# Snapshots as typed values.
_OBS = """
src AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events),
obs AS (
  SELECT user_id AS service_point_id, date_trunc('minute', ts) AS minute,
         CASE WHEN k < 97 AND k % 10 <> 3 THEN k END AS waiting,
         CASE WHEN event_type <> 'error' THEN CAST(floor(value * 60) AS BIGINT) END AS wait,
         k % 5 AS counters,
         CASE WHEN event_type = 'signup' THEN FALSE
              WHEN event_type = 'purchase' AND k < 5 THEN NULL ELSE TRUE END AS is_open
  FROM src),
fact AS (
  SELECT service_point_id, date_diff('minute', TIMESTAMP '2017-01-01', minute) + 1 AS time_id,
         waiting AS customers_currently_waiting, wait AS expected_wait_time,
         counters AS active_counters, is_open, minute
  FROM obs)"""

# Snapshots as raw text.
_TEXT_COLUMNS = {
    "id": "CAST(user_id AS VARCHAR)",
    "name": "'Point ' || user_id",
    "lat": "CAST(value AS VARCHAR)",
    "stops": "'[''' || event_type || ''', ''' || k || ''']'",
    "currently_waiting":
        "CASE WHEN k >= 97 THEN 'None' WHEN k % 10 = 3 THEN k || '.0' ELSE CAST(k AS VARCHAR) END",
    "expected_wait_time":
        "CASE WHEN event_type = 'error' THEN 'None' ELSE CAST(CAST(floor(value * 60) AS BIGINT) AS VARCHAR) END",
    "active_counters": "CAST(k % 5 AS VARCHAR)",
    "is_open": "CASE WHEN event_type = 'signup' THEN 'False' WHEN event_type = 'purchase' AND k < 5 THEN 'yes' "
               "WHEN event_type = 'view' THEN 'true' ELSE 'True' END",
    "time": "strftime(ts, '%y/%m/%d %H:%M:%S')",
}


def _raw(**replaced: str) -> str:
    columns = {**_TEXT_COLUMNS, **replaced}
    listed = ", ".join(f"{columns.get(c, chr(39) + 'None' + chr(39))} AS {c}" for c in SNAPSHOT_COLUMNS)
    return f"src AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events) SELECT {listed} FROM src"


_LAKE_ROWS = "WITH " + _raw(time="'24/03/04 10:00:00'")

_INT_TEXT = "CASE WHEN regexp_full_match({0}, '[+-]?[0-9]+') THEN CAST({0} AS BIGINT) END"
_STAGED = f"""
WITH raw AS (WITH {_raw()})
SELECT CAST(id AS BIGINT) AS service_point_id,
       date_trunc('minute', strptime(time, '%y/%m/%d %H:%M:%S')) AS time_format,
       {_INT_TEXT.format('currently_waiting')} AS customers_currently_waiting,
       {_INT_TEXT.format('expected_wait_time')} AS expected_wait_time,
       {_INT_TEXT.format('active_counters')} AS active_counters,
       CASE lower(is_open) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS is_open
FROM raw"""

_FACT_COLUMNS = "service_point_id, time_id, customers_currently_waiting, expected_wait_time, active_counters, is_open"

# Attributes of a minute, by column expression.
_DATE_PARTS = """
  CAST(dayofweek({0}) + 1 AS INTEGER) AS day_of_week, CAST(hour({0}) AS INTEGER) AS hour,
  CAST(day({0}) AS INTEGER) AS day_number_in_month, CAST(strftime({0}, '%U') AS INTEGER) AS week_number_in_year,
  CAST(month({0}) AS INTEGER) AS month_number, dayofweek({0}) NOT IN (0, 5) AS weekday_flag, FALSE AS holiday_flag"""

# Open rows with waits in seconds, missing ones imputed.
_FILLED = _OBS + """,
filled AS (
  SELECT service_point_id, CAST(date_trunc('day', minute) AS TIMESTAMP) AS cday,
         CAST(dayofweek(minute) + 1 AS INTEGER) AS day_of_week, CAST(hour(minute) AS INTEGER) AS hour, waiting,
         coalesce(wait, avg(wait) OVER (PARTITION BY waiting)) AS seconds
  FROM obs WHERE is_open)"""

_HOURLY = _FILLED + """,
hourly AS (
  SELECT service_point_id, day_of_week, hour, cday, max(waiting) AS top_load, max(seconds) AS top_wait
  FROM filled GROUP BY ALL),
typical AS (
  SELECT service_point_id, day_of_week, hour, avg(top_load) AS mean_load FROM hourly GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY service_point_id, day_of_week ORDER BY mean_load DESC NULLS LAST, hour) AS place
  FROM typical)"""

_WAITS = _HOURLY + """,
waits AS (
  SELECT service_point_id, CAST(ceil(sum(top_wait) / (60 * count(top_wait))) AS BIGINT) AS rush_wait
  FROM hourly JOIN (SELECT * FROM ranked WHERE place = 1) USING (service_point_id, day_of_week, hour)
  GROUP BY service_point_id)"""

# The rounded mean in whole numbers: halves go up whatever their binary form.
_RATINGS = """
ratings AS (
  SELECT o_custkey AS service_point_id,
         CAST((200 * sum(score * weight) + sum(weight)) // (2 * sum(weight)) AS BIGINT) / 100.0 AS rating
  FROM (SELECT o_custkey,
               CASE WHEN o_orderkey % 17 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS score,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 4 + 1 END AS weight
        FROM orders)
  GROUP BY o_custkey)"""

_POINTS = """
points AS (
  SELECT s_suppkey AS service_point_id,
         s_name || repeat(' ® Suffix', CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 1 END) AS name,
         'POINT(' || s_suppkey || ' ' || s_nationkey || ')' AS location,
         CAST(40 + s_suppkey * 7 % 60 AS INTEGER) AS open_hours,
         CAST(1 + s_suppkey * 3 % 11 AS INTEGER) AS stops
  FROM supplier)"""

_MATRIX = _WAITS + "," + _RATINGS + "," + _POINTS + """,
matrix AS (
  SELECT service_point_id, rush_wait, open_hours, stops, CAST(rating AS DOUBLE) AS rating
  FROM points JOIN waits USING (service_point_id) JOIN ratings USING (service_point_id))"""

_SCALED = _MATRIX + """,
scaled AS (
  SELECT service_point_id, least_wait / rush_wait AS a, open_hours / most_hours AS b,
         stops / most_stops AS c, rating / best_rating AS d
  FROM matrix CROSS JOIN (
    SELECT CAST(min(rush_wait) AS DOUBLE) AS least_wait, CAST(max(open_hours) AS DOUBLE) AS most_hours,
           CAST(max(stops) AS DOUBLE) AS most_stops, max(rating) AS best_rating
    FROM matrix))"""

_W = dict(zip("abcd", DEFAULT_WEIGHTS))
_REPORT = f"""
WITH {_SCALED}
SELECT service_point_id, regexp_replace(name, ' ® Suffix', '', 'g') AS name, location,
       {", ".join(f"round({x} * CAST({w} AS DOUBLE), 6) AS {n}" for (x, w), n in zip(_W.items(), REPORT_CRITERIA))},
       round({" + ".join(f"{x} * CAST({w} AS DOUBLE)" for x, w in _W.items())}, 6) AS performance_score
FROM scaled JOIN points USING (service_point_id)
ORDER BY performance_score DESC, service_point_id"""

# The fact through a join with the generated minutes rather than by arithmetic.
_BACKFILL = f"""
WITH {_OBS},
minutes AS (
  SELECT row_number() OVER (ORDER BY m) AS id, m
  FROM (SELECT unnest(range(TIMESTAMP '2017-01-01', TIMESTAMP '2036-01-06 10:40:00', INTERVAL 1 MINUTE)) AS m))
SELECT service_point_id, id AS time_id, customers_currently_waiting, expected_wait_time, active_counters, is_open
FROM fact JOIN minutes ON minutes.m = fact.minute"""

_KEY_AUDIT = f"""
WITH {_OBS},
twice AS (SELECT count(*) AS n FROM fact GROUP BY service_point_id, time_id HAVING count(*) > 1),
lost AS (SELECT count(*) AS n FROM fact
         WHERE service_point_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY service_point_id)
SELECT 'duplicate primary key' AS check_name, count(*) AS bad_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS bad_rows FROM twice
UNION ALL SELECT 'null primary key', 0, 0
UNION ALL SELECT 'orphan service_point_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM lost
UNION ALL SELECT 'orphan time_id', count(DISTINCT time_id), count(*) FROM fact WHERE time_id NOT BETWEEN 1 AND 10000000"""

_DECISION_MATRIX = f"""
WITH {_MATRIX}
SELECT service_point_id, {", ".join(f"{x} AS {n}" for x, n in zip(["rush_wait", "open_hours", "stops", "rating"], MATRIX_CRITERIA))}
FROM matrix"""

ORACLE_SQL: dict[str, str] = {
    "lake_snapshot_rows": _LAKE_ROWS,
    "batch_ingest": _LAKE_ROWS,
    "array_ingest": _LAKE_ROWS,
    "stream_ingest": _LAKE_ROWS,
    "load_summary": f"SELECT count(*) AS row_count, CAST({len(SNAPSHOT_COLUMNS)} AS BIGINT) AS column_count FROM events",
    "batch_summaries": f"""
WITH raw AS (WITH {_raw()}),
taken AS (SELECT CAST(id AS BIGINT) % 3 AS k, strptime(time, '%y/%m/%d %H:%M:%S') AS t FROM raw)
SELECT 'points-' || k AS batch, count(*) AS rows, CAST(0 AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS misplaced,
       CAST(min(t) AS VARCHAR) AS first_time, CAST(max(t) AS VARCHAR) AS last_time
FROM taken GROUP BY k""",
    "repeated_ingest": f"WITH {_raw()}",
    "packed_lake": f"""
WITH raw AS (WITH {_raw()}),
more AS (SELECT * FROM raw UNION ALL SELECT * REPLACE ('again' AS name) FROM raw WHERE CAST(id AS BIGINT) % 3 = 0)
SELECT *, strftime(strptime(time, '%y/%m/%d %H:%M:%S'), '%Y-%m-%d') AS ingest_date FROM more""",
    "staged_queue": _STAGED,
    "time_dimension": f"""
WITH span AS (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) + INTERVAL 1 DAY AS hi FROM events),
minutes AS (SELECT unnest(range(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MINUTE)) AS m FROM span)
SELECT row_number() OVER (ORDER BY m) AS time_id, m AS full_date, {_DATE_PARTS.format('m')}
FROM minutes""",
    "queue_calendar": f"""
WITH {_OBS}
SELECT service_point_id, time_id, customers_currently_waiting, minute AS full_date, {_DATE_PARTS.format('minute')}
FROM fact""",
    "queue_time_bucketed": f"""
WITH {_OBS}
SELECT service_point_id, time_id, customers_currently_waiting, minute AS full_date, {_DATE_PARTS.format('minute')}
FROM fact""",
    "queue_time_join": f"""
WITH {_OBS}
SELECT service_point_id, time_id, minute AS full_date,
       CAST(dayofweek(minute) + 1 AS INTEGER) AS day_of_week, CAST(hour(minute) AS INTEGER) AS hour,
       dayofweek(minute) NOT IN (0, 5) AS weekday_flag
FROM fact""",
    "fact_queue_backfill": _BACKFILL,
    "fact_queue_daily": f"""
WITH {_OBS}
SELECT {_FACT_COLUMNS} FROM fact
WHERE minute >= TIMESTAMP '2024-01-15' AND minute < TIMESTAMP '2024-01-16'""",
    "fact_queue_stored": f"WITH {_OBS} SELECT {_FACT_COLUMNS} FROM fact",
    "fact_queue_yesterday": f"""
WITH {_OBS}
SELECT service_point_id, customers_currently_waiting, expected_wait_time, active_counters, is_open,
       CAST(hour(minute) * 60 + minute(minute) AS INTEGER) AS minute_of_day, TRUE AS stamped_a_day_later
FROM fact""",
    "fact_queue_pruned": f"""
WITH {_OBS},
twice AS (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE is_open = FALSE)
SELECT {_FACT_COLUMNS} FROM twice WHERE minute >= TIMESTAMP '2024-01-10' AND minute < TIMESTAMP '2024-01-20'""",
    "fact_reviews": """
WITH raw AS (
  SELECT o_custkey, epoch(o_orderdate)::BIGINT + o_orderkey % 86400 AS second, o_orderkey,
         o_orderstatus || ' ' || o_orderpriority AS review,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS rating,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 4 AS INTEGER) END AS votes
  FROM orders)
SELECT row_number() OVER (
         ORDER BY second, o_custkey, review, rating NULLS FIRST, votes NULLS FIRST) AS review_id,
       o_custkey AS service_point_id,
       (second + 1 - epoch(TIMESTAMP '1995-01-01')::BIGINT) // 60 + 1 AS time_id,
       rating AS review_score, votes AS number_upvotes_review, review AS full_review
FROM raw""",
    "imputed_wait": f"""
WITH {_FILLED}
SELECT service_point_id, cday, day_of_week, hour, waiting AS customers_currently_waiting,
       round(seconds / 60.0, 6) AS expected_wait_time_imputed
FROM filled""",
    "daily_hour_max": f"""
WITH {_HOURLY}
SELECT cday, service_point_id, day_of_week, hour, top_load AS max_cust_wait FROM hourly""",
    "avg_hour_max": f"""
WITH {_HOURLY}
SELECT service_point_id, day_of_week, hour, round(mean_load, 6) AS avg_max_cust_wait FROM typical""",
    "ranked_hours": f"""
WITH {_HOURLY}
SELECT service_point_id, day_of_week, hour, CAST(place AS INTEGER) AS ranked_rush FROM ranked""",
    "rush_hours": f"WITH {_HOURLY} SELECT service_point_id, day_of_week, hour FROM ranked WHERE place = 1",
    "rush_wait_by_day": f"""
WITH {_HOURLY}
SELECT cday, service_point_id, day_of_week, hour, round(top_wait, 6) AS max_wait_time_in_rush_hour
FROM hourly SEMI JOIN (SELECT * FROM ranked WHERE place = 1) USING (service_point_id, day_of_week, hour)""",
    "rush_wait_by_steps": f"WITH {_WAITS} SELECT service_point_id, rush_wait AS avg_max_wait_time_rush_hour FROM waits",
    "rush_wait": f"WITH {_WAITS} SELECT service_point_id, rush_wait AS avg_max_wait_time_rush_hour FROM waits",
    "rush_wait_maintained": f"WITH {_WAITS} SELECT service_point_id, rush_wait AS avg_max_wait_time_rush_hour FROM waits",
    "imputed_by_point": f"""
WITH {_OBS},
keyed AS (
  SELECT (CASE WHEN service_point_id % 3 = 0 THEN 0 ELSE service_point_id END + 1) * 1000003 + active_counters AS key,
         time_id, expected_wait_time FROM fact)
SELECT key, time_id, expected_wait_time,
       round(coalesce(expected_wait_time, avg(expected_wait_time) OVER (PARTITION BY key)) / 60.0, 6) AS wait
FROM keyed""",
    "weighted_rating": f"""
WITH {_RATINGS}
SELECT service_point_id, CAST(rating AS DOUBLE) AS weighted_average_review_score FROM ratings""",
    "decision_matrix": _DECISION_MATRIX,
    "swapped_matrix": _DECISION_MATRIX,
    "decision_matrix_view": f"""
WITH {_MATRIX}
SELECT service_point_id, name,
       {", ".join(f"matrix.{x} AS {n}" for x, n in zip(["rush_wait", "open_hours", "stops", "rating"], MATRIX_CRITERIA))}
FROM matrix JOIN points USING (service_point_id)""",
    "normalized_matrix": f"""
WITH {_SCALED}
SELECT service_point_id, {", ".join(f"round({x}, 6) AS normalized_{n}" for x, n in zip("abcd", MATRIX_CRITERIA))}
FROM scaled""",
    "ranked_report": _REPORT,
    "warehouse_report": _REPORT,
    "cleaned_labels": f"""
WITH {_POINTS}
SELECT service_point_id, replace(name, ' ® Suffix', '') AS name, location,
       open_hours AS number_of_open_hours_per_week, stops AS number_of_bus_stops
FROM points""",
    "pk_duplicates": f"""
WITH {_OBS}
SELECT service_point_id, time_id, count(*) AS n_rows FROM fact GROUP BY ALL HAVING count(*) > 1""",
    "fk_orphans": """
SELECT user_id AS service_point_id, count(*) AS n_rows FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY ALL""",
    "time_fk_orphans": f"""
WITH {_OBS}
SELECT time_id, count(*) AS n_rows FROM fact WHERE minute >= TIMESTAMP '2024-01-16' GROUP BY ALL""",
    "key_audit": _KEY_AUDIT,
    "bucketed_key_audit": _KEY_AUDIT,
    "reviews_key_audit": """
WITH raw AS (
  SELECT o_custkey, o_orderkey, (epoch(o_orderdate)::BIGINT + o_orderkey % 86400 + 1) AS second FROM orders),
lost AS (SELECT count(*) AS n FROM raw WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey),
late AS (SELECT count(*) AS n FROM raw WHERE second >= epoch(TIMESTAMP '1998-01-01')::BIGINT GROUP BY second // 60)
SELECT 'duplicate primary key' AS check_name, CAST(0 AS BIGINT) AS bad_keys, CAST(0 AS BIGINT) AS bad_rows
UNION ALL SELECT 'null primary key', 0, 0
UNION ALL SELECT 'orphan service_point_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM lost
UNION ALL SELECT 'orphan time_id', count(*), CAST(coalesce(sum(n), 0) AS BIGINT) FROM late""",
    "time_key_audit": """
SELECT unnest(['duplicate primary key', 'null primary key']) AS check_name,
       CAST(0 AS BIGINT) AS bad_keys, CAST(0 AS BIGINT) AS bad_rows""",
    "rejected_times": f"""
WITH raw AS (WITH {_raw()}),
texts AS (
  SELECT CASE WHEN active_counters = '1' AND is_open = 'true' THEN replace(time, '/', '-')
              WHEN active_counters = '2' AND is_open = 'False' THEN 'None'
              WHEN active_counters = '3' THEN '10' || substr(time, 3) ELSE time END AS t
  FROM raw),
parsed AS (SELECT t, try_strptime(t, '%y/%m/%d %H:%M:%S') AS taken FROM texts)
SELECT 'malformed' AS reason, count(DISTINCT t) AS n_texts, count(*) AS n_rows FROM parsed WHERE taken IS NULL
UNION ALL
SELECT 'outside the calendar', count(DISTINCT t), count(*) FROM parsed
WHERE taken < TIMESTAMP '2017-01-01' OR taken >= TIMESTAMP '2036-01-06 10:40:00'""",
    "spelled_numbers": """
SELECT event_id, CAST(0.0001::DOUBLE + value / 1e6::DOUBLE AS VARCHAR) AS small,
       CAST(value * 1000003.5::DOUBLE AS VARCHAR) AS large, CAST(floor(value) * 1e7::DOUBLE AS VARCHAR) AS whole
FROM events""",
    "spelled_values": r"""
SELECT event_id,
       '["it''s ' || event_type || '", ''say "x"'', ''both \'' and "'', ''line\nend\tback\\slash'', None]' AS texts,
       '{''' || event_type || ''': [' || CASE WHEN user_id % 10 > 4 THEN 'True' ELSE 'False' END || ', None], "it''s": ['
         || CASE WHEN user_id % 10 = 0 THEN 'True' ELSE 'False' END || ']}' AS pairs,
       '{''kind'': ''' || event_type || ''', ''k'': ' || CASE WHEN user_id % 10 > 2 THEN CAST(user_id % 10 AS VARCHAR) ELSE 'None' END
         || ', ''more'': [{''a'': "it''s ' || event_type || '"}]}' AS record
FROM events""",
}
