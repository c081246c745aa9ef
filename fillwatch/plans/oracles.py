"""The same queries in SQL, for checking results with another engine."""

from __future__ import annotations

from fillwatch.operators import features

TABLES = {
    "bins": """
SELECT CAST(c_custkey AS VARCHAR) AS bin_id,
  42.66 + (c_custkey % 101 - 50) / 1000.0 AS location_lat,
  21.17 + (c_custkey % 97 - 48) / 1000.0 AS location_lng,
  CASE c_custkey % 4 WHEN 0 THEN 'street' WHEN 1 THEN 'residential' WHEN 2 THEN 'commercial' ELSE 'overflow' END AS type,
  CAST(CASE CAST(floor(c_custkey / 4) AS BIGINT) % 4 WHEN 0 THEN 60 WHEN 1 THEN 120 WHEN 2 THEN 240 ELSE 500 END AS DOUBLE) AS capacity,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE least(c_acctbal / 100, 100.0) END AS current_fill_level,
  CASE c_nationkey % 5 WHEN 0 THEN 'offline' WHEN 1 THEN 'inactive' ELSE 'active' END AS status,
  TIMESTAMP '2024-01-31 00:00:00' - to_days(CAST(c_custkey % 180 AS INT)) AS last_maintenance_date,
  TIMESTAMP '2022-01-31 00:00:00' + to_days(CAST(c_custkey % 700 AS INT)) AS installation_date
FROM customer""",
    "sensor_data": """
SELECT CAST(event_id AS VARCHAR) AS sensor_id, CAST(user_id AS VARCHAR) AS bin_id, ts AS "timestamp",
  least(value, 100.0) AS fill_level, CAST(props::JSON->>'k' AS DOUBLE) AS temperature,
  round(least(value, 100.0) / 100 * CASE CAST(floor(user_id / 4) AS BIGINT) % 4 WHEN 0 THEN 60 WHEN 1 THEN 120 WHEN 2 THEN 240 ELSE 500 END, 2) AS weight,
  CAST(25 + event_id % 61 AS DOUBLE) AS humidity,
  CASE WHEN least(value, 100.0) >= 90 OR CAST(props::JSON->>'k' AS DOUBLE) >= 60 THEN 'alert' ELSE 'normal' END AS status
FROM events""",
    "citizen_reports": """
SELECT CAST(o_orderkey AS VARCHAR) AS report_id, CAST(o_custkey AS VARCHAR) AS bin_id,
  o_orderdate + to_days(8400) AS report_timestamp,
  CASE o_orderkey % 3 WHEN 0 THEN 'overflow' WHEN 1 THEN 'damage' ELSE 'odor' END AS report_type,
  'Issue reported for bin ' || o_custkey AS description,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS resolved,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(8400) + to_hours(CAST(1 + o_orderkey % 72 AS INT)) END AS resolved_timestamp
FROM orders""",
    "maintenance_events": """
SELECT l_orderkey || '-' || l_linenumber AS event_id, CAST(l_partkey % 150 AS VARCHAR) AS bin_id,
  CASE l_returnflag WHEN 'R' THEN 'repaired' ELSE 'emptied' END AS maintenance_type,
  l_shipdate + to_days(8400) AS event_timestamp, 'tech-' || (100 + l_linenumber) AS performed_by,
  l_quantity AS duration, l_extendedprice / 1000 AS cost
FROM lineitem""",
    "alarms": """
SELECT 'a' || event_id AS alarm_id, CAST(user_id AS VARCHAR) AS bin_id,
  CASE event_id % 3 WHEN 0 THEN 'overflow' WHEN 1 THEN 'temperature' ELSE 'co2_high' END AS alarm_type,
  ts AS triggered_at, CASE WHEN event_id % 2 = 0 THEN ts + to_hours(CAST(1 + event_id % 48 AS INT)) END AS resolved_at,
  CASE CAST(floor(event_id / 3) AS BIGINT) % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS severity,
  CASE WHEN event_id % 2 = 0 THEN 'resolved' ELSE 'active' END AS status
FROM events WHERE event_type = 'error'""",
    "route_history": """
SELECT CAST(l_orderkey AS VARCHAR) AS route_id, CAST(l_partkey AS VARCHAR) AS bin_id,
  l_shipdate + to_days(8400) AS service_date,
  CASE l_linenumber % 4 WHEN 0 THEN 'missed' WHEN 1 THEN 'collected' WHEN 2 THEN 'delayed' ELSE 'skipped' END AS collection_status
FROM lineitem""",
    "gaps": """
SELECT * REPLACE (CASE WHEN CAST(sensor_id AS BIGINT) % 3 <> 0 THEN fill_level END AS fill_level,
                  CASE WHEN CAST(sensor_id AS BIGINT) % 5 <> 0 THEN temperature END AS temperature)
FROM sensor_data""",
    "derived": """
SELECT sha256(sensor_id || '|' || CASE WHEN fill_level >= 90 THEN 'overflow' ELSE 'temperature' END) AS alarm_id, bin_id,
  CASE WHEN fill_level >= 90 THEN 'overflow' ELSE 'temperature' END AS alarm_type,
  "timestamp" AS triggered_at, CAST(NULL AS TIMESTAMP) AS resolved_at,
  CASE WHEN fill_level >= 95 OR temperature >= 70 THEN 'critical' ELSE 'high' END AS severity,
  'active' AS status
FROM sensor_data WHERE fill_level >= 90 OR temperature >= 60""",
    "rollup": """
SELECT 'day-' || CAST("date" AS VARCHAR) AS id, "date",
  CAST((SELECT count(*) FROM bins) AS INTEGER) AS total_bins,
  avg(fill) AS avg_fill_level, CAST(count(reports) AS INTEGER) AS total_reports,
  CAST(count(resolved) AS INTEGER) AS resolved_reports, CAST(count(maintenance) AS INTEGER) AS maintenance_events_count,
  avg(minutes) AS avg_response_time, CAST(count(alarms) AS INTEGER) AS alarms_count,
  CAST(count(routes) AS INTEGER) AS routes_completed
FROM (
  SELECT CAST("timestamp" AS DATE) AS "date", fill_level AS fill, NULL AS reports, NULL AS resolved, NULL AS minutes,
    NULL AS maintenance, NULL AS alarms, NULL AS routes FROM sensor_data
  UNION ALL
  SELECT CAST(report_timestamp AS DATE), NULL, 1, CASE WHEN resolved THEN 1 END,
    CASE WHEN resolved THEN date_diff('second', report_timestamp, resolved_timestamp) / 60.0 END, NULL, NULL, NULL FROM citizen_reports
  UNION ALL
  SELECT CAST(event_timestamp AS DATE), NULL, NULL, NULL, NULL, 1, NULL, NULL FROM maintenance_events
  UNION ALL
  SELECT CAST(triggered_at AS DATE), NULL, NULL, NULL, NULL, NULL, 1, NULL FROM alarms
  UNION ALL
  SELECT day, NULL, NULL, NULL, NULL, NULL, NULL, 1 FROM (
    SELECT route_id, CAST(service_date AS DATE) AS day FROM route_history
    GROUP BY ALL HAVING bool_and(collection_status = 'collected'))
) GROUP BY "date\"""",
    "known": """
SELECT * REPLACE (coalesce(fill_level, 0.0) AS fill_level, coalesce(temperature, 20.0) AS temperature),
  epoch_us("timestamp") AS us FROM {source}""",
    "aged": """
SELECT bin_id, fill_level AS y, (us - epoch_us(TIMESTAMP '2024-01-31 00:00:00')) / 3600000000.0 AS x FROM known""",
    "rates": """
SELECT bin_id,
  greatest(-1.0, least(5.0, coalesce(CASE WHEN n1 >= 3 THEN s1 ELSE s48 END, 0.0))) AS fill_rate_1h,
  greatest(-1.0, least(5.0, coalesce(CASE WHEN n6 >= 3 THEN s6 ELSE s48 END, 0.0))) AS fill_rate_6h,
  greatest(-1.0, least(5.0, coalesce(CASE WHEN n24 >= 3 THEN s24 ELSE s48 END, 0.0))) AS fill_rate_24h,
  greatest(-1.0, least(5.0, coalesce(CASE WHEN n12 >= 3 THEN s12 ELSE s48 END, 0.0))) AS fill_rate_12h,
  coalesce(week, 0.0) AS avg_fill_last_week
FROM (SELECT bin_id, avg(y) FILTER (x >= -168) AS week, {slopes} FROM aged GROUP BY bin_id)""".replace(
        "{slopes}",
        ", ".join(
            f"count(*) FILTER (x >= -{h}) AS n{h}, CASE WHEN count(*) FILTER (x >= -{h}) >= 2 AND"
            f" min(x) FILTER (x >= -{h}) < max(x) FILTER (x >= -{h})"
            f" THEN regr_slope(y, x) FILTER (x >= -{h}) END AS s{h}"
            for h in (1, 6, 12, 24, 48)
        ),
    ),
    "tail": """
SELECT bin_id, arg_max(fill_level, -recency) AS current_fill_level, arg_max(temperature, -recency) AS temperature,
  arg_max(humidity, -recency) AS humidity, arg_max(weight, -recency) AS weight,
  max("timestamp") AS last_reading_at,
  CASE WHEN count(*) < 5 THEN 0.0 ELSE regr_slope(temperature, -recency) END AS temperature_trend
FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY "timestamp" DESC, sensor_id DESC) AS recency FROM known)
WHERE recency <= 10 GROUP BY bin_id""",
    "since_maintenance": """
SELECT b.bin_id, CAST(coalesce(date_diff('day', coalesce(m.day, CAST(b.last_maintenance_date AS DATE)), DATE '2024-01-31'), -1) AS INTEGER) AS days_since_maintenance
FROM (SELECT * FROM bins) b LEFT JOIN (
  SELECT bin_id, max(CAST(event_timestamp AS DATE)) AS day FROM maintenance_events
  WHERE event_timestamp <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY bin_id) m USING (bin_id)""",
    "features": """
SELECT t.bin_id, current_fill_level, temperature, humidity, weight, CAST(0 AS INTEGER) AS hour_of_day, CAST(2 AS INTEGER) AS day_of_week,
  fill_rate_1h, fill_rate_6h, fill_rate_24h, coalesce(s.days_since_maintenance, -1) AS days_since_maintenance,
  avg_fill_last_week, temperature_trend, CAST(0 AS INTEGER) AS is_weekend, CAST(0 AS INTEGER) AS season, fill_rate_12h
FROM tail t JOIN rates USING (bin_id) LEFT JOIN since_maintenance s USING (bin_id)""",
    "horizons": """
SELECT f.*, h.horizon FROM features f, (VALUES (1), (6), (12), (24)) h(horizon)""",
}

NEEDS = {
    "gaps": ("sensor_data",),
    "derived": ("sensor_data",),
    "rollup": ("bins", "sensor_data", "citizen_reports", "maintenance_events", "alarms", "route_history"),
    "known": ("sensor_data",),
    "aged": ("known",),
    "rates": ("aged",),
    "tail": ("known",),
    "since_maintenance": ("bins", "maintenance_events"),
    "features": ("tail", "rates", "since_maintenance"),
    "horizons": ("features",),
}


def using(names: str, body: str, readings: str = "sensor_data") -> str:
    """``body`` under the named tables and the tables those need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in NEEDS.get(name, ()):
            visit(needed)
        if name == "known":
            visit(readings)
        order.append(name)

    for name in names.split():
        visit(name)
    parts = []
    for name in order:
        text = TABLES[name].replace("{source}", readings)
        parts.append(f"{name} AS ({text}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


def _round(columns: str, places: int = 4) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns.split())


A = "TIMESTAMP '2024-01-31 00:00:00'"
PERFORMANCE = (
    "SELECT id, \"date\", total_bins, " + _round("avg_fill_level") + ", total_reports, resolved_reports,"
    " maintenance_events_count, " + _round("avg_response_time") + ", alarms_count, routes_completed FROM rollup"
)
FEATURES = (
    "bin_id, " + _round("current_fill_level temperature humidity weight", 6) + ", hour_of_day, day_of_week, "
    + _round("fill_rate_1h fill_rate_6h fill_rate_24h", 6) + ", days_since_maintenance, "
    + _round("avg_fill_last_week temperature_trend", 6) + ", is_weekend, season"
)

AWKWARD_TIME = """CASE event_id % 16
    WHEN 3 THEN date_trunc('second', ts) WHEN 5 THEN date_trunc('millisecond', ts)
    WHEN 6 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 7 THEN date_trunc('second', ts) ELSE ts END"""

ORACLES: dict[str, str] = {
    "sensor_parse": using("sensor_data", "SELECT * FROM sensor_data"),
    "bins_parse": using("bins", "SELECT * FROM bins"),
    "reports_parse": using("citizen_reports", "SELECT * FROM citizen_reports"),
    "maintenance_parse": using("maintenance_events", "SELECT * FROM maintenance_events"),
    "alarms_parse": using("alarms", "SELECT * FROM alarms"),
    "routes_parse": using("route_history", "SELECT * FROM route_history"),
    "performance_parse": using("rollup", PERFORMANCE),
    "parse_edge_cases": f"""
SELECT event_id, CAST(event_id AS VARCHAR) AS sensor_id,
  CASE event_id % 16 WHEN 14 THEN '{{"k":1}}' ELSE CAST(user_id AS VARCHAR) END AS bin_id,
  {AWKWARD_TIME} AS "timestamp",
  event_id % 16 = 12 AS fill_is_nan,
  CASE event_id % 16 WHEN 9 THEN NULL WHEN 12 THEN -1.0 WHEN 15 THEN 1.5 ELSE value END AS fill_level
FROM events WHERE event_id % 16 NOT IN (8, 10, 11, 13)""",
    "reject_split": """
SELECT 'sensor_data' AS topic, reason, count(*) AS messages FROM (
  SELECT CASE WHEN event_id % 16 IN (10, 13) THEN 'bad_json' WHEN event_id % 16 = 11 THEN 'null_key'
    WHEN event_id % 16 = 8 THEN 'bad_time' ELSE 'good' END AS reason FROM events) GROUP BY reason""",
    "rejected_messages": f"""
SELECT 'sensor_data' AS topic,
  CASE k WHEN 10 THEN '{{' || body WHEN 13 THEN '[{{' || body || '}}]' ELSE '{{' || body || '}}' END AS json_str,
  CASE WHEN k IN (10, 13) THEN 'bad_json' WHEN k = 11 THEN 'null_key' ELSE 'bad_time' END AS reason
FROM (SELECT event_id % 16 AS k, '"sensor_id":' || event_id || ',"bin_id":'
    || CASE event_id % 16 WHEN 11 THEN 'null' ELSE CAST(user_id AS VARCHAR) END || ',"timestamp":"'
    || CASE event_id % 16 WHEN 8 THEN 'junk' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
    || '","fill_level":' || CAST(value AS VARCHAR) AS body
  FROM events WHERE event_id % 16 IN (8, 10, 11, 13))""",
    "json_messages": using(
        "route_history",
        """SELECT route_id, bin_id, '{"service_date":"' || strftime(service_date, '%Y-%m-%dT%H:%M:%S.%fZ')
  || '","collection_status":"' || collection_status || '"}' AS json_str FROM route_history""",
    ),
    "critical_fields": using(
        "bins",
        """SELECT bin_id,
  CASE WHEN n % 5 IN (0, 1) THEN '2024-01-31 00:00:00' ELSE strftime(installation_date, '%Y-%m-%d') END AS "timestamp",
  CASE WHEN n % 3 IN (0, 1) THEN '2024-01-31' ELSE strftime(installation_date, '%Y-%m-%d') END AS installation_date,
  CASE n % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE strftime(last_maintenance_date, '%Y-%m-%d') END AS last_maintenance
FROM (SELECT *, CAST(bin_id AS BIGINT) AS n FROM bins)""",
    ),
    "bin_flatten": using(
        "bins",
        """SELECT bin_id,
  CASE WHEN n % 4 = 0 OR n % 13 <> 0 THEN location_lat END AS location_lat,
  CASE WHEN n % 4 = 0 OR n % 13 <> 0 THEN location_lng END AS location_lng,
  CASE WHEN n % 6 <> 0 THEN type ELSE 'standard' END AS type,
  CASE WHEN n % 3 = 0 OR n % 11 <> 0 THEN capacity END AS capacity,
  nullif(current_fill_level, 0) AS current_fill_level,
  CASE WHEN n % 5 <> 0 THEN status ELSE 'active' END AS status, last_maintenance_date, installation_date
FROM (SELECT *, CAST(bin_id AS BIGINT) AS n FROM bins)""",
    ),
    "reading_status": using(
        "gaps",
        """SELECT sensor_id, CASE WHEN coalesce(fill_level >= 90, false) OR coalesce(temperature >= 60, false)
  THEN 'alert' ELSE 'normal' END AS status FROM gaps""",
    ),
    "reading_weight": using(
        "sensor_data bins",
        """SELECT s.sensor_id, s.bin_id, round(s.fill_level / 100 * b.capacity, 2) AS weight
FROM sensor_data s LEFT JOIN bins b USING (bin_id)""",
    ),
    "fill_class": using(
        "gaps",
        """SELECT sensor_id, CASE WHEN fill_level < 30 THEN 'empty' WHEN fill_level < 80 THEN 'partial'
  WHEN fill_level IS NOT NULL THEN 'full' END AS fill_class FROM gaps""",
    ),
    "readings_to_wide": using(
        "sensor_data",
        """SELECT bin_id, "timestamp", max(fill_level) AS fill_level, max(temperature) AS temperature,
  max(humidity) AS humidity, max(weight) AS weight FROM sensor_data GROUP BY ALL""",
    ),
    "route_stops": """
SELECT CAST(o_orderkey AS VARCHAR) AS route_id, CAST((o_orderkey * 7 + i * 13) % 1500 AS VARCHAR) AS bin_id,
  o_orderdate + to_days(8400) AS service_date,
  CASE (o_orderkey + i) % 4 WHEN 0 THEN 'collected' WHEN 1 THEN 'delayed' WHEN 2 THEN 'missed' ELSE 'skipped' END AS collection_status
FROM (SELECT *, unnest(range(1, 4 + o_orderkey % 10)) AS i FROM orders)""",
    "null_defaults": using(
        "gaps",
        """SELECT sensor_id, coalesce(fill_level, 0.0) AS fill_level, coalesce(temperature, 20.0) AS temperature,
  coalesce(humidity, 50.0) AS humidity, coalesce(weight, 0.0) AS weight FROM gaps""",
    ),
    "sensor_alarms": using("derived", "SELECT * EXCLUDE (alarm_id) FROM derived"),
    "sensor_alarms_from_json": using("derived", "SELECT * FROM derived"),
    "sensor_alarm_ids": using("derived", "SELECT alarm_id, bin_id FROM derived"),
    "sensor_alarms_stream": using("derived", "SELECT * FROM derived"),
    "job_rows": using(
        "sensor_data derived",
        """SELECT 'sensor_data' AS "table", 'sensor_data' AS source, count(*) AS "rows" FROM sensor_data
           UNION ALL SELECT 'alarms', 'sensor_alarms', count(*) FROM derived""",
    ),
    "all_alarms": using("alarms derived", "SELECT * FROM alarms UNION ALL SELECT * FROM derived"),
    "alert_outbox": using(
        "alarms bins",
        """SELECT alarm_id, a.bin_id, 'URGENT: ' || alarm_type || ' - ' || a.bin_id AS subject,
  chr(10) || 'Alert Details:' || chr(10) || '- Bin ID: ' || a.bin_id || chr(10) || '- Alert Type: ' || alarm_type
  || chr(10) || '- Severity: ' || coalesce(severity, 'high') || chr(10)
  || '- Timestamp: ' || strftime(triggered_at, '%Y-%m-%d %H:%M:%S.%f') || chr(10)
  || '- Location: https://maps.google.com/?q=' || coalesce(CAST(location_lat AS VARCHAR), '') || ','
  || coalesce(CAST(location_lng AS VARCHAR), '') || chr(10) || chr(10) || 'Please take immediate action.' || chr(10) AS body
FROM alarms a LEFT JOIN bins b USING (bin_id)""",
    ),
    "alert_outbox_stream": using(
        "derived bins",
        """SELECT alarm_id, a.bin_id, 'URGENT: ' || alarm_type || ' - ' || a.bin_id AS subject,
  chr(10) || 'Alert Details:' || chr(10) || '- Bin ID: ' || a.bin_id || chr(10) || '- Alert Type: ' || alarm_type
  || chr(10) || '- Severity: ' || coalesce(severity, 'high') || chr(10)
  || '- Timestamp: ' || strftime(triggered_at, '%Y-%m-%d %H:%M:%S.%f') || chr(10)
  || '- Location: https://maps.google.com/?q=' || coalesce(CAST(location_lat AS VARCHAR), '') || ','
  || coalesce(CAST(location_lng AS VARCHAR), '') || chr(10) || chr(10) || 'Please take immediate action.' || chr(10) AS body
FROM derived a LEFT JOIN bins b USING (bin_id)""",
    ),
    "alarm_counts_stream": using(
        "derived",
        """SELECT CAST(triggered_at AS DATE) AS date, alarm_type, severity, count(DISTINCT alarm_id) AS alarms
FROM derived
WHERE date_trunc('day', triggered_at) + INTERVAL 1 DAY <= (SELECT max(triggered_at) - INTERVAL 2 DAY FROM derived)
GROUP BY ALL""",
    ),
    "latest_by_key": using(
        "sensor_data",
        """SELECT * FROM sensor_data
QUALIFY row_number() OVER (PARTITION BY bin_id ORDER BY "timestamp" DESC, sensor_id DESC) = 1""",
    ),
    "merge_ignore_nulls": using(
        "gaps",
        """SELECT last(sensor_id ORDER BY o) AS sensor_id, bin_id, last("timestamp" ORDER BY o) AS "timestamp",
  last(fill_level ORDER BY o) FILTER (fill_level IS NOT NULL) AS fill_level,
  last(temperature ORDER BY o) FILTER (temperature IS NOT NULL) AS temperature,
  last(weight ORDER BY o) AS weight, last(humidity ORDER BY o) AS humidity, last(status ORDER BY o) AS status
FROM (SELECT *, row_number() OVER (PARTITION BY bin_id ORDER BY "timestamp", sensor_id) AS o FROM gaps) GROUP BY bin_id""",
    ),
    "route_upsert": using(
        "route_history",
        """SELECT * FROM route_history QUALIFY row_number() OVER (
  PARTITION BY route_id, bin_id ORDER BY service_date DESC, collection_status DESC) = 1""",
    ),
    "maintenance_upsert": using(
        "maintenance_events",
        """SELECT * FROM maintenance_events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC,
  bin_id DESC, maintenance_type DESC, performed_by DESC, duration DESC, cost DESC) = 1""",
    ),
    "bins_filtered": using("bins", "SELECT * FROM bins WHERE status = 'active' AND type = 'commercial'"),
    "bins_all": using("bins", "SELECT * FROM bins"),
    "sensor_recent": using(
        "sensor_data", f'SELECT * FROM sensor_data WHERE "timestamp" >= {A} - to_hours(24)'
    ),
    "sensor_recent_for_bins": using(
        "sensor_data bins",
        f"""SELECT * FROM sensor_data WHERE "timestamp" >= {A} - to_hours(24)
  AND bin_id IN (SELECT bin_id FROM bins WHERE status = 'offline')""",
    ),
    "sensor_for_chosen_bins": using(
        "sensor_data",
        f"""SELECT * FROM sensor_data WHERE "timestamp" >= {A} - to_days(30) AND bin_id IN ('7', '11')""",
    ),
    "reports_recent": using(
        "citizen_reports", f"SELECT * FROM citizen_reports WHERE report_timestamp >= {A} - to_days(7)"
    ),
    "reports_resolved": using(
        "citizen_reports",
        f"""SELECT * FROM citizen_reports WHERE (resolved AND report_timestamp >= {A} - to_days(7))
  OR (NOT resolved AND report_timestamp >= {A} - to_days(3))""",
    ),
    "maintenance_recent": using(
        "maintenance_events", f"SELECT * FROM maintenance_events WHERE event_timestamp >= {A} - to_days(30)"
    ),
    "alarms_recent": using(
        "alarms",
        f"SELECT * FROM alarms WHERE triggered_at >= {A} - to_days(7) AND severity = 'high' AND status = 'active'",
    ),
    "routes_recent": using(
        "route_history", f"SELECT * FROM route_history WHERE service_date >= {A} - to_days(7)"
    ),
    "performance_recent": using("rollup", PERFORMANCE + " WHERE \"date\" >= DATE '2024-01-01'"),
    "bins_with_readings": using("sensor_data", "SELECT DISTINCT bin_id FROM sensor_data"),
    "reading_counts": using(
        "sensor_data",
        "SELECT bin_id, count(*) AS readings FROM sensor_data GROUP BY ROLLUP (bin_id)",
    ),
    "sensor_history_sample": using(
        "sensor_data",
        """SELECT sensor_id, bin_id, "timestamp", fill_level, temperature, humidity, weight
FROM sensor_data ORDER BY "timestamp", sensor_id LIMIT 5000""",
    ),
    "sql_parameters": using(
        "bins",
        """SELECT bin_id, type, capacity FROM bins
WHERE status = 'inactive' AND capacity >= 120.0 AND location_lat > 42.65""",
    ),
    "bin_summary": using(
        "bins",
        """SELECT count(*) AS total_bins, count(*) FILTER (status = 'active') AS active_bins,
  count(*) FILTER (status = 'offline') AS offline_bins, round(avg(current_fill_level), 2) AS avg_fill FROM bins""",
    ),
    "status_distribution": using("bins", "SELECT status, count(*) AS bins FROM bins GROUP BY status"),
    "map_points": using(
        "bins",
        """SELECT bin_id, location_lat, location_lng, status, type, current_fill_level, capacity, last_maintenance_date,
  CASE WHEN current_fill_level IS NULL THEN 20.0 ELSE greatest(20.0, least(current_fill_level * 1.5, 50.0)) END AS marker_size,
  CASE status WHEN 'active' THEN 'green' WHEN 'inactive' THEN 'red' WHEN 'offline' THEN 'gray' END AS color FROM bins""",
    ),
    "map_center": using(
        "bins", "SELECT round(avg(location_lat), 6) AS lat, round(avg(location_lng), 6) AS lon FROM bins"
    ),
    "report_resolution": using(
        "citizen_reports",
        """SELECT count(*) FILTER (resolved) AS resolved_reports, count(*) - count(*) FILTER (resolved) AS unresolved_reports
FROM citizen_reports""",
    ),
    "alarm_severity": using("alarms", "SELECT severity, count(*) AS alarms FROM alarms GROUP BY severity"),
    "fill_series": using(
        "sensor_data", 'SELECT bin_id, "timestamp", fill_level FROM sensor_data ORDER BY bin_id, "timestamp"'
    ),
    "bins_emptied_daily": using(
        "maintenance_events",
        """SELECT CAST(event_timestamp AS DATE) AS "date", count(*) AS bins_emptied FROM maintenance_events
WHERE maintenance_type = 'emptied' GROUP BY 1""",
    ),
    "daily_rollup": using("rollup", PERFORMANCE),
    "daily_rollup_kept": using("rollup", PERFORMANCE),
    "latest_reading": using(
        "tail",
        "SELECT bin_id, last_reading_at, current_fill_level, temperature, humidity, weight FROM tail",
    ),
    "calendar_features": using(
        "sensor_data",
        """SELECT sensor_id, "timestamp", CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
  CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week, CAST(isodow("timestamp") >= 6 AS INTEGER) AS is_weekend,
  CAST(floor((month("timestamp") - 1) / 3) AS INTEGER) AS season FROM sensor_data""",
    ),
    "fill_rates": using(
        "rates",
        "SELECT bin_id, " + _round("fill_rate_1h fill_rate_6h fill_rate_24h fill_rate_12h", 6) + " FROM rates",
    ),
    "avg_fill_week": using("rates", "SELECT bin_id, " + _round("avg_fill_last_week", 6) + " FROM rates"),
    "temperature_trend": using("tail", "SELECT bin_id, " + _round("temperature_trend", 6) + " FROM tail"),
    "days_since_maintenance": using("since_maintenance", "SELECT * FROM since_maintenance"),
    "feature_table": using(
        "features", f"SELECT {FEATURES}, {_round('fill_rate_12h', 6)} FROM features", readings="gaps"
    ),
    "feature_table_kept": using(
        "features", f"SELECT {FEATURES}, {_round('fill_rate_12h', 6)} FROM features", readings="gaps"
    ),
    "forecast_inputs": using(
        "horizons",
        """SELECT bin_id, round(least(100.0, current_fill_level + fill_rate_12h * horizon), 6) AS current_fill_level,
  round(temperature + temperature_trend * horizon, 6) AS temperature, round(greatest(0.0, least(humidity, 100.0)), 6) AS humidity,
  round(weight, 6) AS weight, CAST((hour_of_day + horizon) % 24 AS INTEGER) AS hour_of_day,
  CAST((day_of_week + floor((hour_of_day + horizon) / 24)) % 7 AS INTEGER) AS day_of_week,"""
        + _round("fill_rate_1h fill_rate_6h fill_rate_24h", 6)
        + ", days_since_maintenance, "
        + _round("avg_fill_last_week temperature_trend", 6)
        + ", is_weekend, season, horizon, round(current_fill_level, 6) AS base_fill_level FROM horizons",
        readings="gaps",
    ),
    "monotone_step": using(
        "horizons",
        """SELECT bin_id, horizon, predicted_fill, confidence, round(predicted_fill - confidence, 2) AS lower,
  round(predicted_fill + confidence, 2) AS upper,
  CASE WHEN predicted_fill >= 90 THEN 'critical' WHEN predicted_fill >= 75 THEN 'warning'
    WHEN predicted_fill >= 60 THEN 'semi_warning' ELSE 'normal' END AS level
FROM (SELECT bin_id, horizon, round(((CAST(bin_id AS BIGINT) * 7 + horizon * 5) % 100) / 10.0, 2) AS confidence,
  max(round(greatest(0.0, least(100.0, greatest(current_fill_level,
    ((CAST(bin_id AS BIGINT) * 31 + horizon * 17) % 1200) / 10.0 - 10))), 2)) OVER (PARTITION BY bin_id ORDER BY horizon) AS predicted_fill
  FROM horizons)""",
        readings="gaps",
    ),
    "fill_levels": using(
        "gaps",
        """SELECT sensor_id, CASE WHEN fill_level >= 90 THEN 'critical' WHEN fill_level >= 75 THEN 'warning'
  WHEN fill_level >= 60 THEN 'semi_warning' WHEN fill_level IS NOT NULL THEN 'normal' END AS level FROM gaps""",
    ),
}


def _slope(x: str, frame: str, bound: str = "true") -> str:
    over = f"FILTER ({bound}) OVER ({frame})"
    return (
        f"CASE WHEN count(*) {over} >= 2 AND min({x}) {over} < max({x}) {over}"
        f" THEN regr_slope(fill_level, {x}) {over} END"
    )


def _examples(mode: str) -> str:
    """Every reading with its prefix features, as a chain of tables ending in ``prefix``."""
    past = 'PARTITION BY bin_id ORDER BY "timestamp", sensor_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW'
    clock = f"epoch_us({A})" if mode == "literal" else "epoch_us(TIMESTAMP '2024-01-01 00:00:00')"
    columns = []
    for h in (1, 6, 24, 48):
        if mode == "literal":
            frame, bound = past, f"x >= -{h}"
        else:
            frame = f'PARTITION BY bin_id ORDER BY "timestamp" RANGE BETWEEN INTERVAL {h} HOUR PRECEDING AND CURRENT ROW'
            bound = "true"
        columns.append(f"count(*) FILTER ({bound}) OVER ({frame}) AS n{h}, {_slope('x', frame, bound)} AS s{h}")
    if mode == "literal":
        week = f"avg(fill_level) FILTER (x >= -168) OVER ({past})"
        moment = A
        days = "coalesce(s.days_since_maintenance, -1)"
        join = "LEFT JOIN since_maintenance s USING (bin_id)"
    else:
        week = (
            'avg(fill_level) OVER (PARTITION BY bin_id ORDER BY "timestamp" RANGE BETWEEN INTERVAL 7 DAY'
            " PRECEDING AND CURRENT ROW)"
        )
        moment = '"timestamp"'
        days = """CAST(coalesce(date_diff('day', coalesce(CAST(m.event_timestamp AS DATE),
    CASE WHEN CAST(b.last_maintenance_date AS DATE) <= CAST("timestamp" AS DATE) THEN CAST(b.last_maintenance_date AS DATE) END),
    CAST("timestamp" AS DATE)), -1) AS INTEGER)"""
        join = """ASOF LEFT JOIN (SELECT bin_id, event_timestamp FROM maintenance_events) m
    ON w.bin_id = m.bin_id AND w."timestamp" >= m.event_timestamp
  LEFT JOIN bins b ON w.bin_id = b.bin_id"""
    rates = ", ".join(
        f"greatest(-1.0, least(5.0, coalesce(CASE WHEN n{h} >= 3 THEN s{h} ELSE s48 END, 0.0))) AS fill_rate_{h}h"
        for h in (1, 6, 24)
    )
    ordered = 'PARTITION BY bin_id ORDER BY "timestamp", sensor_id'
    last_ten = ordered + " ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"
    leads = ", ".join(f"lead(fill_level, {h}) OVER ({ordered}) AS after_{h}" for h in (1, 6, 12, 24))
    chain = f"""placed AS (SELECT *, row_number() OVER ({ordered}) - 1 AS position,
    count(*) OVER (PARTITION BY bin_id) AS total, (us - {clock}) / 3600000000.0 AS x FROM known),
windows AS (SELECT *, {", ".join(columns)}, coalesce({week}, 0.0) AS avg_fill_last_week, {leads},
    CASE WHEN position < 4 THEN 0.0 ELSE regr_slope(temperature, position) OVER ({last_ten}) END AS temperature_trend FROM placed),
prefix AS (SELECT w.bin_id, sensor_id, "timestamp", position, total, fill_level AS current_fill_level, temperature, humidity, weight,
    CAST(hour({moment}) AS INTEGER) AS hour_of_day, CAST(isodow({moment}) - 1 AS INTEGER) AS day_of_week, {rates},
    {days} AS days_since_maintenance, avg_fill_last_week, temperature_trend,
    CAST(isodow({moment}) >= 6 AS INTEGER) AS is_weekend, CAST(floor((month({moment}) - 1) / 3) AS INTEGER) AS season,
    after_1, after_6, after_12, after_24
  FROM windows w {join}),
examples AS (SELECT prefix.* EXCLUDE (after_1, after_6, after_12, after_24), h.horizon,
    CASE h.horizon WHEN 1 THEN after_1 WHEN 6 THEN after_6 WHEN 12 THEN after_12 ELSE after_24 END AS label
  FROM prefix, (VALUES (1), (6), (12), (24)) h(horizon)
  WHERE total >= 50 AND position >= 24 AND position < total - 24)"""
    tables = "known since_maintenance" if mode == "literal" else "known bins maintenance_events"
    return using(tables, "@").replace("\n@", ",\n" + chain)


EXAMPLES = (
    f"SELECT sensor_id, \"timestamp\", {FEATURES}, horizon, round(label, 6) AS label FROM examples"
)
ORACLES["training_examples"] = _examples("literal") + "\n" + EXAMPLES
ORACLES["training_examples_row_clock"] = _examples("row") + "\n" + EXAMPLES
ORACLES["training_profile"] = (
    _examples("row")
    + "\nSELECT count(*) AS examples, "
    + ", ".join(
        f"round(stddev_pop({c}), 3) AS std_{c}"
        for c in (
            "current_fill_level temperature humidity weight hour_of_day day_of_week fill_rate_1h fill_rate_6h"
            " fill_rate_24h days_since_maintenance avg_fill_last_week temperature_trend is_weekend season horizon"
        ).split()
    )
    + " FROM examples"
)
ORACLES["training_split"] = (
    _examples("row")
    + """
SELECT bin_id, sensor_id, horizon,
  CAST('0x' || substr(md5('42|' || bin_id || '|' || sensor_id || '|' || horizon), 1, 7) AS BIGINT) % 10 < 8 AS is_train
FROM examples"""
)
ORACLES["training_labels_by_hours"] = (
    _examples("literal")
    + """
SELECT p.bin_id, p.sensor_id, p.horizon, r.fill_level AS label
FROM (SELECT prefix.*, h.horizon, "timestamp" + to_hours(h.horizon) AS due
  FROM prefix, (VALUES (1), (6), (12), (24)) h(horizon) WHERE total >= 50 AND position >= 24) p
ASOF JOIN (SELECT bin_id, "timestamp" AS seen, min(fill_level) AS fill_level FROM known GROUP BY ALL) r
  ON p.bin_id = r.bin_id AND p.due <= r.seen"""
)
ORACLES["forecast_facts"] = using(
    "bins sensor_data",
    """SELECT b.bin_id, h.horizon, r.bin_id IS NOT NULL AS forecast,
  CASE WHEN r.bin_id IS NOT NULL THEN true END AS in_range, CASE WHEN r.bin_id IS NOT NULL THEN true END AS never_falls
FROM bins b CROSS JOIN (VALUES (1), (6), (12), (24)) h(horizon)
LEFT JOIN (SELECT DISTINCT bin_id FROM sensor_data) r ON b.bin_id = r.bin_id""",
)
ORACLES["forecast_evaluate_facts"] = (
    _examples("row")
    + """
SELECT count(*) AS examples, true AS errors_fit FROM examples
WHERE CAST('0x' || substr(md5('42|' || bin_id || '|' || sensor_id || '|' || horizon), 1, 7) AS BIGINT) % 10 >= 8"""
)
ORACLES["feature_importances_facts"] = (
    "SELECT feature, true AS counts, 1.0::DOUBLE AS total FROM (VALUES "
    + ", ".join(f"('{name}')" for name in features.FEATURES)
    + ") f(feature)"
)
ORACLES["anomaly_facts"] = using(
    "sensor_data", "SELECT count(*) AS readings, true AS scores_fit, true AS share_fits FROM sensor_data"
)
