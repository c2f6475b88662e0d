"""The registered queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

VALUES = ("power_output", "wind_speed", "wind_direction")
_SHORT = {"power_output": "p", "wind_speed": "s", "wind_direction": "d"}

_READINGS = """
readings AS (
  SELECT date_trunc('hour', ts)::TIMESTAMP AS "timestamp",
         (floor(user_id / 10)::INTEGER + 1)::INTEGER AS turbine_id,
         CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'nan'::DOUBLE
              WHEN event_id % 97 = 0 THEN -3.2::DOUBLE WHEN event_id % 101 = 0 THEN 150::DOUBLE
              ELSE ((event_id * 37) % 200)::DOUBLE / 10 END AS wind_speed,
         (CASE WHEN event_id % 127 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 400
               WHEN event_id % 113 = 0 THEN -15 ELSE (event_id * 53) % 360 END)::INTEGER AS wind_direction,
         CASE WHEN event_id < 60 OR event_id % 83 = 0 THEN NULL
              WHEN event_id % 79 = 0 THEN 'nan'::DOUBLE
              WHEN event_id % 89 = 0 THEN -value ELSE value END AS power_output,
         ts AS _ingested_at,
         'data_group_' || (floor(floor(user_id / 10) / 5)::INTEGER + 1)::VARCHAR || '.csv' AS _source_file,
         event_id
  FROM events)"""

_DEDUPED = """
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY turbine_id, "timestamp"
        ORDER BY _ingested_at DESC NULLS LAST, _source_file DESC NULLS LAST,
                 power_output DESC NULLS LAST, wind_speed DESC NULLS LAST,
                 wind_direction DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM readings) WHERE rn = 1)"""

_FLAGGED = """
marked AS (
  SELECT *, (power_output IS NULL OR isnan(power_output)) AS pm,
         (wind_speed IS NULL OR isnan(wind_speed)) AS sm, (wind_direction IS NULL) AS dm
  FROM deduped),
judged AS (
  SELECT *, CASE WHEN pm THEN false ELSE power_output < 0 END AS pi,
         CASE WHEN sm THEN false ELSE wind_speed < 0 OR wind_speed > 100 END AS si,
         CASE WHEN dm THEN false ELSE wind_direction < 0 OR wind_direction >= 360 END AS di
  FROM marked),
flagged AS (
  SELECT "timestamp", turbine_id,
         CASE WHEN sm OR si THEN NULL ELSE wind_speed END AS wind_speed,
         CASE WHEN dm OR di THEN NULL ELSE wind_direction END AS wind_direction,
         CASE WHEN pm OR pi THEN NULL ELSE power_output END AS power_output,
         _ingested_at, _source_file, event_id,
         pm AS power_output_was_missing, pi AS power_output_was_invalid,
         sm AS wind_speed_was_missing, si AS wind_speed_was_invalid,
         dm AS wind_direction_was_missing, di AS wind_direction_was_invalid,
         CAST("timestamp" AS DATE) AS date
  FROM judged)"""

_SILVER = """
filled AS (
  SELECT *, last_value(power_output IGNORE NULLS) OVER w AS fp,
         last_value(wind_speed IGNORE NULLS) OVER w AS fs,
         last_value(wind_direction IGNORE NULLS) OVER w AS fd
  FROM flagged
  WINDOW w AS (PARTITION BY turbine_id ORDER BY "timestamp" NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
silver AS (
  SELECT * EXCLUDE (fp, fs, fd) REPLACE (fp AS power_output, fs AS wind_speed, fd AS wind_direction),
         power_output IS NULL AND fp IS NOT NULL AS power_output_was_imputed,
         wind_speed IS NULL AND fs IS NOT NULL AS wind_speed_was_imputed,
         wind_direction IS NULL AND fd IS NOT NULL AS wind_direction_was_imputed
  FROM filled)"""

_SUMMARY = """
summary AS (
  SELECT turbine_id, date, min(power_output) AS min_power_output, max(power_output) AS max_power_output,
         avg(power_output) AS avg_power_output, count(*) AS reading_count,
         sum(power_output_was_imputed::INTEGER)::BIGINT AS imputed_count
  FROM silver GROUP BY turbine_id, date)"""

_ANOMALIES = """
stats AS (
  SELECT turbine_id, date, avg(power_output) AS mean_power_output,
         stddev_samp(power_output) AS stddev_power_output
  FROM silver WHERE NOT power_output_was_imputed GROUP BY turbine_id, date),
anomalies AS (
  SELECT s.*, t.mean_power_output, t.stddev_power_output,
         CASE WHEN t.stddev_power_output IS NULL THEN false
              WHEN s.power_output IS NULL THEN NULL
              WHEN t.stddev_power_output <= 1e-9 * abs(t.mean_power_output) THEN false
              ELSE abs(s.power_output - t.mean_power_output) > 2.0 * t.stddev_power_output
         END AS is_anomaly
  FROM silver s JOIN stats t ON s.turbine_id = t.turbine_id AND s.date = t.date
  WHERE NOT s.power_output_was_imputed)"""

_QUALITY = """
quality AS (
  SELECT turbine_id,
         count(*) FILTER (power_output_was_missing OR wind_speed_was_missing OR wind_direction_was_missing)
           AS missing_count,
         count(*) FILTER (power_output_was_invalid OR wind_speed_was_invalid OR wind_direction_was_invalid)
           AS invalid_count,
         count(*) FILTER (power_output_was_imputed) AS imputed_count, count(*) AS total_readings
  FROM silver GROUP BY turbine_id)"""

_HOURS = """
spans AS (SELECT turbine_id, min("timestamp") AS a, max("timestamp") AS b FROM readings GROUP BY turbine_id),
grid AS (
  SELECT turbine_id, unnest(generate_series(a, b, INTERVAL 1 HOUR))::TIMESTAMP AS "timestamp" FROM spans),
absent AS (
  SELECT g.turbine_id, g."timestamp" FROM grid g
  WHERE NOT EXISTS (SELECT 1 FROM readings r
                    WHERE r.turbine_id = g.turbine_id AND r."timestamp" = g."timestamp"))"""

# Even devices report every ten minutes, odd ones every hour; a step is the most frequent difference.
_GRIDS = """
times AS (
  SELECT DISTINCT turbine_id,
         CASE WHEN turbine_id % 2 = 0 THEN time_bucket(INTERVAL 10 MINUTE, _ingested_at::TIMESTAMP) ELSE "timestamp" END AS t
  FROM readings),
pairs AS (
  SELECT turbine_id, t, lead(t) OVER (PARTITION BY turbine_id ORDER BY t) AS next FROM times),
differences AS (
  SELECT turbine_id, date_diff('second', t, next) AS d, count(*) AS n FROM pairs WHERE next IS NOT NULL GROUP BY ALL),
steps AS (
  SELECT turbine_id, d AS step_seconds, n AS seen, (sum(n) OVER (PARTITION BY turbine_id))::BIGINT AS differences
  FROM differences QUALIFY row_number() OVER (PARTITION BY turbine_id ORDER BY n DESC, d) = 1),
spans AS (
  SELECT p.turbine_id, t, step_seconds, round(date_diff('second', t, next) / step_seconds)::BIGINT - 1 AS absent
  FROM pairs p JOIN steps s ON p.turbine_id = s.turbine_id
  WHERE next IS NOT NULL AND round(date_diff('second', t, next) / step_seconds) > 1)"""

_TYPED = """
junk AS (
  SELECT *, event_id % 211 = 0 AS jt, event_id % 307 = 0 AS jk,
         CASE WHEN event_id % 113 = 0 THEN '180.5' WHEN event_id % 109 = 0 THEN 'abc' END AS jd,
         event_id % 223 = 0 AS jp
  FROM readings),
typed AS (
  SELECT CASE WHEN jt THEN NULL ELSE "timestamp" END AS "timestamp",
         CASE WHEN jk THEN NULL ELSE turbine_id END AS turbine_id, wind_speed,
         CASE WHEN jd IS NOT NULL THEN NULL ELSE wind_direction END AS wind_direction,
         CASE WHEN jp THEN NULL ELSE power_output END AS power_output,
         CASE WHEN jt OR jk OR jd IS NOT NULL OR jp THEN
           '{' || concat_ws(',', CASE WHEN jt THEN '"timestamp":"bad"' END,
                            CASE WHEN jk THEN '"turbine_id":"T-7"' END,
                            CASE WHEN jd IS NOT NULL THEN '"wind_direction":"' || jd || '"' END,
                            CASE WHEN jp THEN '"power_output":"n/a"' END) || '}'
         END AS _rescued_data
  FROM junk)"""

_CLEAN = [_READINGS, _DEDUPED, _FLAGGED, _SILVER]


def _sql(parts: list[str], query: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + query


def _silver(query: str) -> str:
    return _sql(_CLEAN, query)


def _gold(query: str) -> str:
    return _sql([*_CLEAN, _SUMMARY, _ANOMALIES], query)


_FILLED = ", ".join([*VALUES, *[f"{v}_was_imputed" for v in VALUES]])
_ROUNDED_STATS = (
    "* REPLACE (round(mean_power_output, 6) AS mean_power_output, "
    "round(stddev_power_output, 6) AS stddev_power_output)"
)
_ROUNDED_SUMMARY = "SELECT * REPLACE (round(avg_power_output, 6) AS avg_power_output) FROM summary"
_FILL = f"SELECT turbine_id, \"timestamp\", {_FILLED} FROM silver"

_CAPPED = """
held AS (
  SELECT *, """ + ", ".join(
    f'last_value({v} IGNORE NULLS) OVER w AS f_{v}, '
    f'max(CASE WHEN {v} IS NOT NULL THEN "timestamp" END) OVER w AS at_{v}'
    for v in VALUES
) + """
  FROM flagged
  WINDOW w AS (PARTITION BY turbine_id ORDER BY "timestamp" NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
capped AS (
  SELECT turbine_id, "timestamp", """ + ", ".join(
    f'CASE WHEN {v} IS NULL AND "timestamp" - at_{v} <= INTERVAL 6 HOUR THEN f_{v} ELSE {v} END AS {v}, '
    f'coalesce({v} IS NULL AND "timestamp" - at_{v} <= INTERVAL 6 HOUR, false) AS {v}_was_imputed'
    for v in VALUES
) + " FROM held)"

# Files of odd groups came a second time with good times and devices; equal lines of a version are one.
_QUARANTINE = """
faulty AS (
  SELECT *, regexp_extract(_source_file, '([0-9]+)', 1)::INTEGER % 2 = 1 AS odd, event_id % 211 = 0 AS jt, event_id % 307 = 0 AS jk, event_id % 223 = 0 AS jp
  FROM readings),
versions AS (
  SELECT *, 1 AS version FROM faulty UNION ALL SELECT * REPLACE (false AS jt, false AS jk), 2 FROM faulty WHERE odd),
lines AS (
  SELECT CASE WHEN NOT jt THEN "timestamp" END AS "timestamp", CASE WHEN NOT jk THEN turbine_id END AS turbine_id, wind_speed, wind_direction,
         CASE WHEN NOT jp THEN power_output END AS power_output,
         '{' || concat_ws(',', CASE WHEN jt THEN '"timestamp":"bad"' END, CASE WHEN jk THEN '"turbine_id":"T-7"' END,
                          CASE WHEN jp THEN '"power_output":"n/a"' END) || '}' AS _rescued_data,
         _source_file, CASE WHEN jk THEN 'no device' WHEN jt THEN 'no time' ELSE 'unparsed value' END AS _reason, _ingested_at, odd, version
  FROM versions WHERE jt OR jk OR jp),
held AS (
  SELECT * EXCLUDE (_ingested_at), count(*) AS copies FROM lines GROUP BY ALL),
aged AS (
  SELECT *, TIMESTAMP '2024-01-31' + to_days(version) AS _file_modified, odd AND version = 1 AS released,
         TIMESTAMP '2024-01-31' + to_days(min(version) OVER (
           PARTITION BY _source_file, "timestamp", turbine_id, wind_speed, wind_direction, power_output, _rescued_data)) AS since
  FROM held)"""

# Cells that an hour's fill leaves empty come from a neighbour's last usable value of the three hours before.
_FALLBACK = """
spare AS (
  SELECT (turbine_id % 15 + 1)::INTEGER AS turbine_id, "timestamp" + INTERVAL 20 MINUTE AS t,
         CASE WHEN power_output >= 0 AND NOT isnan(power_output) THEN power_output END AS power_output,
         CASE WHEN wind_speed BETWEEN 0 AND 100 AND NOT isnan(wind_speed) THEN wind_speed END AS wind_speed,
         CASE WHEN wind_direction >= 0 AND wind_direction < 360 THEN wind_direction END AS wind_direction
  FROM readings WHERE event_id % 2 = 0
  QUALIFY row_number() OVER (PARTITION BY turbine_id, "timestamp"
      ORDER BY _ingested_at DESC NULLS LAST, _source_file DESC NULLS LAST, readings.power_output DESC NULLS LAST,
               readings.wind_speed DESC NULLS LAST, readings.wind_direction DESC NULLS LAST, event_id DESC NULLS LAST) = 1),
""" + ",\n".join(
    f"spare_{v} AS (SELECT turbine_id, t, {v} AS value FROM spare WHERE {v} IS NOT NULL)" for v in VALUES
) + """,
substituted AS (
  SELECT c.turbine_id, c."timestamp", """ + ", ".join(
    f'coalesce(c.{v}, CASE WHEN c."timestamp" - {_SHORT[v]}.t <= INTERVAL 3 HOUR THEN {_SHORT[v]}.value END) AS {v}, c.{v}_was_imputed, '
    f'c.{v} IS NULL AND coalesce(c."timestamp" - {_SHORT[v]}.t <= INTERVAL 3 HOUR, false) AS {v}_was_substituted'
    for v in VALUES
) + """
  FROM capped c """ + " ".join(
    f'ASOF LEFT JOIN spare_{v} {_SHORT[v]} ON c.turbine_id = {_SHORT[v]}.turbine_id AND c."timestamp" >= {_SHORT[v]}.t' for v in VALUES
) + ")"

# The late third of the readings lacks some of its times.
_TIMELESS = """
readings AS (
  SELECT * REPLACE (CASE WHEN event_id % 21 <> 0 THEN "timestamp" END AS "timestamp") FROM (
    WITH """ + _READINGS + """ SELECT * FROM readings))"""
_NUMBERED = _TYPED.replace("SELECT CASE WHEN jt", "SELECT event_id, CASE WHEN jt")


def _refreshed(query: str) -> str:
    return _sql([_TIMELESS, _DEDUPED, _FLAGGED, _SILVER, _SUMMARY, _ANOMALIES], query)


_RULES = [
    ("device_known", "turbine_id IS NOT NULL", 0.0),
    ("time_known", '"timestamp" IS NOT NULL', 0.0),
    ("power_present", "NOT power_output_was_missing", 0.05),
    ("power_possible", "NOT power_output_was_invalid", 0.01),
    ("speed_present", "NOT wind_speed_was_missing", 0.05),
    ("speed_possible", "NOT wind_speed_was_invalid", 0.01),
    ("direction_present", "NOT wind_direction_was_missing", 0.05),
    ("direction_possible", "NOT wind_direction_was_invalid", 0.01),
    ("power_filled", "power_output IS NOT NULL", 0.01),
]

ORACLE: dict[str, str] = {
    "rescued_values": _sql([_READINGS, _TYPED], "SELECT * FROM typed"),
    "landing_scan": _sql([_READINGS, _TYPED], "SELECT *, true AS has_file FROM typed"),
    "dedupe": _sql([_READINGS, _DEDUPED], "SELECT * FROM deduped"),
    "flag_missing_invalid": _sql([_READINGS, _DEDUPED, _FLAGGED], "SELECT * FROM flagged"),
    "forward_fill": _silver(_FILL),
    "forward_fill_day_carry": _silver(_FILL),
    "silver_clean": _silver("SELECT * FROM silver"),
    "remaining_nulls": _silver("\nUNION ALL ".join(
        f"SELECT '{v}' AS column_name, count(*) FILTER ({v} IS NULL) AS null_count FROM silver" for v in VALUES
    )),
    "daily_summary": _gold(_ROUNDED_SUMMARY),
    "turbine_day_stats": _gold(f"SELECT {_ROUNDED_STATS} FROM stats"),
    "anomalies": _gold(f"SELECT {_ROUNDED_STATS} FROM anomalies"),
    "anomalies_window": _gold(f"SELECT {_ROUNDED_STATS} FROM anomalies"),
    "incremental_refresh": _gold(_ROUNDED_SUMMARY),
    "turbine_list": _sql([_READINGS], "SELECT DISTINCT turbine_id FROM readings ORDER BY turbine_id"),
    "turbine_daily": _gold(f"{_ROUNDED_SUMMARY} ORDER BY turbine_id, date"),
    "turbine_anomalies": _gold(
        'SELECT turbine_id, date, "timestamp", power_output FROM anomalies WHERE is_anomaly '
        'ORDER BY turbine_id, "timestamp"'
    ),
    "turbine_kpis": _gold("""
SELECT d.turbine_id, d.days_of_data, d.total_imputed, coalesce(a.anomaly_count, 0) AS anomaly_count,
       round(d.mean_daily_power, 6) AS mean_daily_power
FROM (SELECT turbine_id, count(*) AS days_of_data, coalesce(sum(imputed_count), 0)::BIGINT AS total_imputed,
             avg(avg_power_output) AS mean_daily_power FROM summary GROUP BY turbine_id) d
LEFT JOIN (SELECT turbine_id, count(*) AS anomaly_count FROM anomalies WHERE is_anomaly
           GROUP BY turbine_id) a ON a.turbine_id = d.turbine_id"""),
    "fleet_quality": _sql([*_CLEAN, _QUALITY], "SELECT * FROM quality"),
    "anomaly_counts": _gold(
        "SELECT turbine_id, count(*) AS anomaly_count FROM anomalies WHERE is_anomaly GROUP BY turbine_id"
    ),
    "flakiest_top5": _sql([*_CLEAN, _QUALITY], """
SELECT turbine_id, round((missing_count + invalid_count) / total_readings, 6) AS issue_rate,
       missing_count, invalid_count, total_readings
FROM quality ORDER BY (missing_count + invalid_count) / total_readings DESC, turbine_id LIMIT 5"""),
    "invalid_direction_rows": _silver("SELECT * FROM silver WHERE wind_direction_was_invalid"),
    "anomalous_rows": _gold(f"SELECT {_ROUNDED_STATS} FROM anomalies WHERE is_anomaly"),
    "imputed_days": _gold(f"{_ROUNDED_SUMMARY} WHERE imputed_count > 0"),
    "chart_feed": _gold("""
SELECT s.turbine_id, s.date, s.min_power_output, s.max_power_output,
       round(s.avg_power_output, 6) AS avg_power_output,
       a."timestamp" AS anomaly_time, a.power_output AS anomaly_power
FROM summary s LEFT JOIN (SELECT * FROM anomalies WHERE is_anomaly) a
  ON a.turbine_id = s.turbine_id AND a.date = s.date"""),
    "absent_hours": _sql([_READINGS, _HOURS], "SELECT * FROM absent"),
    "with_absent_hours": _sql([_READINGS, _DEDUPED, _HOURS], """
SELECT turbine_id, "timestamp", power_output, false AS _was_absent FROM deduped
UNION ALL SELECT turbine_id, "timestamp", NULL, true FROM absent"""),
    "capped_fill": _sql([_READINGS, _DEDUPED, _FLAGGED, _CAPPED], "SELECT * FROM capped"),
    "capacity_bound": _sql([_READINGS, _DEDUPED], """
SELECT turbine_id, "timestamp",
       CASE WHEN m OR i THEN NULL ELSE power_output END AS power_output,
       m AS power_output_was_missing, i AS power_output_was_invalid
FROM (SELECT *, CASE WHEN m THEN false ELSE power_output < 0 OR coalesce(power_output > rated, false) END AS i
      FROM (SELECT d.*, abs(s.s_acctbal) / 50 AS rated,
                   d.power_output IS NULL OR isnan(d.power_output) AS m
            FROM deduped d LEFT JOIN supplier s ON s.s_suppkey + 1 = d.turbine_id))"""),
    "quarantine": _sql([_READINGS, _TYPED], """
SELECT * FROM (
  SELECT *, CASE WHEN turbine_id IS NULL THEN 'no device' WHEN "timestamp" IS NULL THEN 'no time'
                 WHEN _rescued_data IS NOT NULL THEN 'unparsed value' END AS _reason FROM typed)
WHERE _reason IS NOT NULL"""),
    "quality_rules": _silver("\nUNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) AS checked_rows, count(*) FILTER (NOT coalesce({p}, false)) AS failed_rows, "
        f"{a}::DOUBLE AS allowed_share, "
        f"count(*) FILTER (NOT coalesce({p}, false)) <= {a} * count(*) AS passed FROM silver"
        for n, p, a in _RULES
    )),
}

ORACLE |= {
    "ledger_ingest": _sql([_READINGS, _NUMBERED], """
SELECT * EXCLUDE (event_id), true AS has_file FROM typed
UNION ALL SELECT * EXCLUDE (event_id), true FROM typed WHERE event_id % 3 = 0
UNION ALL SELECT * EXCLUDE (event_id), true FROM typed WHERE event_id % 5 = 0
UNION ALL SELECT * EXCLUDE (event_id) REPLACE (
    NULL::DOUBLE AS wind_speed, NULL::INTEGER AS wind_direction,
    '{' || concat_ws(',', CASE WHEN event_id % 211 = 0 THEN '"timestamp":"bad"' END,
                     CASE WHEN event_id % 307 = 0 THEN '"turbine_id":"T-7"' END,
                     CASE WHEN event_id % 223 = 0 THEN '"power_output":"n/a"' END, '"gear_temp":"80"') || '}' AS _rescued_data),
  true FROM typed WHERE event_id % 7 = 0"""),
    "landing_files": _sql([_READINGS, _NUMBERED], """
SELECT "timestamp", turbine_id, power_output, 'delivery_' || (event_id % 3)::VARCHAR AS delivery, true AS has_size, true AS taken_after_written
FROM typed"""),
    "stream_feed": _sql([_READINGS, _NUMBERED], """
SELECT * EXCLUDE (event_id), true AS has_file FROM typed
UNION ALL SELECT * EXCLUDE (event_id), true FROM typed WHERE event_id % 3 = 0
UNION ALL SELECT * EXCLUDE (event_id) REPLACE (coalesce(left(_rescued_data, -1) || ',', '{') || '"gear_temp":"80"}' AS _rescued_data), true
  FROM typed WHERE event_id % 7 = 0"""),
    "bronze_compacted": _sql([_READINGS], "SELECT * EXCLUDE (event_id), 1::BIGINT AS batches FROM readings"),
    "layer_routing": _silver("""
SELECT l || e.env || '/turbine_data/' || t AS place, turbine_id, date, count(*) FILTER (l = 'silver') + (l = 'gold')::INTEGER AS "rows"
FROM silver, (VALUES ('', 1), ('_dev', 2)) e(env, every),
     (VALUES ('silver', 'silver_turbine_readings'), ('gold', 'daily_turbine_summary')) x(l, t)
WHERE turbine_id % every = 0 GROUP BY l, e.env, t, turbine_id, date"""),
    "device_steps": _sql([_READINGS, _GRIDS], "SELECT * FROM steps"),
    "absent_spans": _sql([_READINGS, _GRIDS], """
SELECT turbine_id, t + to_seconds(step_seconds) AS first_absent, t + to_seconds(absent * step_seconds) AS last_absent, step_seconds, absent
FROM spans"""),
    "absent_readings": _sql([_READINGS, _GRIDS], """
SELECT turbine_id, t + to_seconds(k * step_seconds) AS "timestamp"
FROM (SELECT *, unnest(range(1, absent + 1)) AS k FROM spans)"""),
    "quarantine_open": _sql([_READINGS, _QUARANTINE], """
SELECT "timestamp", turbine_id, power_output, _rescued_data, _source_file, _reason, copies, _file_modified, since FROM aged WHERE NOT released"""),
    "quarantine_by_file": _sql([_READINGS, _QUARANTINE], """
SELECT _source_file, _reason, coalesce(sum(copies) FILTER (NOT released), 0)::BIGINT AS open_lines,
       coalesce(sum(copies) FILTER (released), 0)::BIGINT AS released_lines, min(since) FILTER (NOT released) AS oldest
FROM aged GROUP BY ALL"""),
    "fallback_fill": _sql(
        [_READINGS, _DEDUPED, _FLAGGED, _CAPPED.replace("INTERVAL 6 HOUR", "INTERVAL 1 HOUR"), _FALLBACK], "SELECT * FROM substituted"
    ),
    "contract": _silver("""
SELECT rule, kind, checked::BIGINT AS checked, coalesce(failed, 0)::BIGINT AS failed, allowed_share::DOUBLE AS allowed_share,
       coalesce(failed, 0) <= allowed_share * checked AS passed FROM (
  SELECT 'power_known' AS rule, 'row' AS kind, count(*) AS checked, count(*) FILTER (power_output IS NULL) AS failed, 0.0 AS allowed_share FROM silver
  UNION ALL SELECT 'speed_possible', 'row', count(*), count(*) FILTER (wind_speed_was_invalid), 0.05 FROM silver
  UNION ALL SELECT 'one_row_a_reading', 'unique', count(*), count(*) - count(DISTINCT (turbine_id, "timestamp")), 0.0
    FROM silver WHERE turbine_id IS NOT NULL AND "timestamp" IS NOT NULL
  UNION ALL SELECT 'one_row_a_day', 'unique', count(*), count(*) - count(DISTINCT (turbine_id, date)), 0.0
    FROM silver WHERE turbine_id IS NOT NULL AND date IS NOT NULL
  UNION ALL SELECT 'rated', 'reference', count(*), count(*) FILTER (turbine_id NOT IN (SELECT s_suppkey + 1 FROM supplier)), 0.0 FROM silver
  UNION ALL SELECT 'mostly_rated', 'reference', count(*), count(*) FILTER (turbine_id NOT IN (SELECT s_suppkey + 1 FROM supplier)), 0.9 FROM silver
  UNION ALL SELECT 'seen_within_the_hour', 'fresh', count(*), count(*) FILTER (last < (SELECT max("timestamp") FROM silver) - INTERVAL 1 HOUR), 0.0
    FROM (SELECT max("timestamp") AS last FROM silver GROUP BY turbine_id)
  UNION ALL SELECT 'seen_in_this_century', 'fresh', count(*), count(*) FILTER (last < TIMESTAMP '2000-01-01'), 0.0
    FROM (SELECT max("timestamp") AS last FROM silver GROUP BY turbine_id)
  UNION ALL SELECT 'seldom_filled', 'share', count(*), count(*) FILTER (bad > 0.02::DOUBLE * n), 0.0
    FROM (SELECT count(*) AS n, count(*) FILTER (power_output_was_imputed) AS bad FROM silver GROUP BY turbine_id)
  UNION ALL SELECT 'not_all_filled', 'share', count(*), count(*) FILTER (bad > 0.5::DOUBLE * n), 0.2
    FROM (SELECT count(*) AS n, count(*) FILTER (power_output_was_imputed) AS bad FROM silver GROUP BY turbine_id, date)
  UNION ALL SELECT 'any_rows', 'volume', 1, (count(*) < 1)::INTEGER, 0.0 FROM silver
  UNION ALL SELECT 'very_many_rows', 'volume', 1, (count(*) < 1000000000000)::INTEGER, 0.0 FROM silver)"""),
    "contract_breaches": _silver("""
SELECT turbine_id, "timestamp", concat_ws(',', CASE WHEN power_output IS NULL THEN 'power_known' END,
    CASE WHEN wind_speed_was_invalid THEN 'speed_possible' END,
    CASE WHEN count(*) OVER (PARTITION BY turbine_id, "timestamp") > 1 THEN 'one_row_a_reading' END,
    CASE WHEN count(*) OVER (PARTITION BY turbine_id, date) > 1 THEN 'one_row_a_day' END,
    CASE WHEN turbine_id NOT IN (SELECT s_suppkey + 1 FROM supplier) THEN 'rated,mostly_rated' END) AS broken
FROM silver QUALIFY broken <> ''"""),
    "silver_clean_default": ORACLE["silver_clean"],
    "forward_fill_busy_days": ORACLE["forward_fill"],
    "silver_full_build": _silver("SELECT * EXCLUDE (event_id) FROM silver"),
    "summary_after_refresh": _refreshed(_ROUNDED_SUMMARY),
    "anomalies_after_refresh": _refreshed(
        f"SELECT {_ROUNDED_STATS} FROM (SELECT * EXCLUDE (event_id) FROM anomalies)"
    ),
    "kpis_from_tables": ORACLE["turbine_kpis"],
    "chart_feed_from_tables": ORACLE["chart_feed"],
    "one_turbine_daily": _gold(f"{_ROUNDED_SUMMARY} WHERE turbine_id = 3 ORDER BY date"),
    "one_turbine_kpis": _gold("""
SELECT k.turbine_id::INTEGER AS turbine_id, count(s.date) AS days_of_data, coalesce(sum(s.imputed_count), 0)::BIGINT AS total_imputed,
       (SELECT count(*) FROM anomalies a WHERE a.is_anomaly AND a.turbine_id = k.turbine_id) AS anomaly_count,
       round(avg(s.avg_power_output), 6) AS mean_daily_power
FROM (VALUES (3), (999)) k(turbine_id) LEFT JOIN summary s ON s.turbine_id = k.turbine_id GROUP BY k.turbine_id"""),
    "one_turbine_anomalies": _gold(
        'SELECT turbine_id, date, "timestamp", power_output FROM anomalies WHERE is_anomaly AND turbine_id = 3 '
        'ORDER BY "timestamp"'
    ),
    "one_turbine_invalid_direction": _silver("SELECT * FROM silver WHERE wind_direction_was_invalid AND turbine_id = 3"),
}
