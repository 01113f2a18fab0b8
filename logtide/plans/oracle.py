"""SQL that computes the registered queries' results on its own, for any engine with the test tables."""

from __future__ import annotations

RAW = r"""
raw0 AS (
  SELECT event_id,
    CASE WHEN event_id % 103 = 0 THEN 'not-a-time'
         ELSE CAST(date_trunc('second', ts) AS VARCHAR) END AS "time",
    '  ' || upper(event_type) || '-SVC-' || CAST(user_id % 4 AS VARCHAR) || ' ' AS svc,
    '/api/v1/' || event_type || '/' || CAST(user_id AS VARCHAR)
      || CASE WHEN event_id % 5 = 0 THEN '/0A1B2C3D-0000-1111-2222-333344445555' ELSE '' END
      || '?k=' || CAST(k AS VARCHAR) AS uri,
    CASE WHEN k % 4 = 0 THEN ' post' ELSE 'get ' END AS verb,
    CASE WHEN event_id % 97 = 0 THEN 'oops' WHEN event_id % 89 = 0 THEN '42'
         WHEN event_type = 'error' AND k < 40 THEN '500'
         WHEN k >= 95 THEN '503' WHEN k >= 90 THEN '404' ELSE '200' END AS status,
    CASE WHEN event_id % 101 = 0 THEN -5.0 WHEN event_id % 107 = 0 THEN 300001.0
         WHEN event_id % 11 = 0 THEN NULL ELSE value END AS duration_ms,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE k * 100 END AS bytes_sent,
    CAST(user_id AS VARCHAR) AS client_id,
    event_type || '-pod-' || CAST(event_id % 3 AS VARCHAR) AS pod
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)),
raw AS (
  SELECT * FROM raw0
  UNION ALL
  SELECT event_id + 1000000000, "time", svc, uri, verb, '200', duration_ms, bytes_sent, client_id, pod
  FROM raw0 WHERE event_id % 50 = 0),
coerced AS (
  SELECT event_id, TRY_CAST("time" AS TIMESTAMP) AS "timestamp", lower(trim(svc)) AS service_name,
    regexp_replace(regexp_replace(split_part(trim(uri), '?', 1),
      '(?i)/[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}', '/{uuid}', 'g'),
      '/\p{Nd}{2,}', '/{id}', 'g') AS endpoint,
    upper(trim(verb)) AS method, TRY_CAST(status AS INTEGER) AS status_code,
    CAST(duration_ms AS DOUBLE) AS latency_ms, CAST(bytes_sent AS DOUBLE) AS bytes_response,
    client_id AS user_id, pod AS instance_id
  FROM raw),
valid AS (
  SELECT * FROM coerced
  WHERE "timestamp" IS NOT NULL AND service_name IS NOT NULL AND status_code BETWEEN 100 AND 599
    AND (latency_ms IS NULL OR latency_ms BETWEEN 0 AND 300000)),
logs AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", service_name, endpoint, instance_id
                                 ORDER BY event_id) AS rn FROM valid)
  WHERE rn = 1)"""

LOG_COLUMNS = """event_id, "timestamp", service_name, endpoint, method, status_code, latency_ms,
  bytes_response, user_id, instance_id"""

FEATURES = (
    RAW
    + """,
spans AS (
  SELECT service_name, count(*) AS total_requests,
    greatest((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 3.6e9, 1.0) AS active_hours
  FROM logs GROUP BY service_name),
peaks AS (
  SELECT service_name, max(n) / avg(n) AS peak_to_avg_ratio
  FROM (SELECT service_name, date_trunc('hour', "timestamp") AS h, count(*) AS n FROM logs GROUP BY ALL)
  GROUP BY service_name),
basics AS (
  SELECT service_name,
    avg(CASE WHEN status_code >= 400 THEN 1e0 ELSE 0e0 END) AS error_rate,
    avg(CASE WHEN status_code >= 500 THEN 1e0 ELSE 0e0 END) AS server_error_rate,
    coalesce(quantile_cont(latency_ms, 0.5), 0) AS latency_p50,
    coalesce(quantile_cont(latency_ms, 0.95), 0) AS latency_p95,
    coalesce(quantile_cont(latency_ms, 0.99), 0) AS latency_p99,
    coalesce(avg(bytes_response), 0) AS avg_bytes,
    count(DISTINCT user_id) AS unique_users, count(DISTINCT endpoint) AS unique_endpoints,
    count(DISTINCT instance_id) AS unique_instances
  FROM logs GROUP BY service_name),
features AS (
  SELECT b.*, s.total_requests, s.active_hours, s.total_requests / s.active_hours AS requests_per_hour,
    p.peak_to_avg_ratio
  FROM basics b JOIN spans s USING (service_name) JOIN peaks p USING (service_name))"""
)

SERIES = (
    RAW
    + """,
hourly AS (
  SELECT service_name, date_trunc('hour', "timestamp") AS time_bucket, count(*) AS request_count,
    avg(CASE WHEN status_code >= 400 THEN 1e0 ELSE 0e0 END) AS error_rate,
    coalesce(quantile_cont(latency_ms, 0.5), 0) AS latency_p50,
    coalesce(quantile_cont(latency_ms, 0.95), 0) AS latency_p95,
    coalesce(sum(bytes_response), 0) AS bytes_total, count(DISTINCT user_id) AS unique_users
  FROM logs GROUP BY ALL),
hours AS (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL 1 HOUR)) AS time_bucket
          FROM hourly),
grid AS (
  SELECT s.service_name, h.time_bucket, coalesce(y.request_count, 0) AS request_count,
    coalesce(y.error_rate, 0) AS error_rate, coalesce(y.latency_p50, 0) AS latency_p50,
    coalesce(y.latency_p95, 0) AS latency_p95, coalesce(y.bytes_total, 0) AS bytes_total,
    coalesce(y.unique_users, 0) AS unique_users
  FROM (SELECT DISTINCT service_name FROM hourly) s CROSS JOIN hours h
  LEFT JOIN hourly y ON y.service_name = s.service_name AND y.time_bucket = h.time_bucket),
calendar AS (
  SELECT *, CAST(hour(time_bucket) AS INTEGER) AS hour_of_day,
    CAST(isodow(time_bucket) - 1 AS INTEGER) AS day_of_week,
    CASE WHEN isodow(time_bucket) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN hour(time_bucket) BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours,
    CAST(weekofyear(time_bucket) AS INTEGER) AS week_of_year
  FROM grid),
growth AS (
  SELECT *, round_even((recent_requests - prior_requests) / prior_requests * 100e0, 2) AS growth_rate_pct
  FROM (SELECT service_name,
          CAST(sum(request_count) FILTER (WHERE k <= 168) AS BIGINT) AS recent_requests,
          CAST(sum(request_count) FILTER (WHERE k > 168 AND k <= 336) AS BIGINT) AS prior_requests,
          count(*) AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY service_name ORDER BY time_bucket DESC) AS k FROM grid)
        GROUP BY service_name)
  WHERE n >= 336 AND prior_requests > 0),
zs AS (
  SELECT *, greatest(
      coalesce(abs(request_count - avg(request_count) OVER w) / nullif(stddev_pop(request_count) OVER w, 0), 0),
      coalesce(abs(error_rate - avg(error_rate) OVER w) / nullif(stddev_pop(error_rate) OVER w, 0), 0),
      coalesce(abs(latency_p50 - avg(latency_p50) OVER w) / nullif(stddev_pop(latency_p50) OVER w, 0), 0),
      coalesce(abs(latency_p95 - avg(latency_p95) OVER w) / nullif(stddev_pop(latency_p95) OVER w, 0), 0)) AS z,
    count(*) OVER w AS n
  FROM grid WINDOW w AS (PARTITION BY service_name)),
windows AS (
  SELECT service_name, time_bucket, request_count, error_rate, latency_p50, latency_p95,
    round_even(z, 4) AS anomaly_score, round_even(z, 4) > 3.0 AS is_anomaly
  FROM zs WHERE n >= 24)"""
)

BOTH = FEATURES + SERIES[len(RAW) :]

SCORED = (
    FEATURES
    + """,
scored AS (
  SELECT f.*, greatest(
      coalesce(abs(requests_per_hour - avg(requests_per_hour) OVER ()) / nullif(stddev_pop(requests_per_hour) OVER (), 0), 0),
      coalesce(abs(error_rate - avg(error_rate) OVER ()) / nullif(stddev_pop(error_rate) OVER (), 0), 0),
      coalesce(abs(latency_p95 - avg(latency_p95) OVER ()) / nullif(stddev_pop(latency_p95) OVER (), 0), 0),
      coalesce(abs(peak_to_avg_ratio - avg(peak_to_avg_ratio) OVER ())
               / nullif(stddev_pop(peak_to_avg_ratio) OVER (), 0), 0)) AS z
  FROM features f),
anomalies AS (
  SELECT *, round_even((z - min(z) OVER ()) / (max(z) OVER () - min(z) OVER () + 1e-8), 4) AS anomaly_score,
    z > 2.5 AS is_anomaly
  FROM scored)"""
)

TIERS = """,
tiers AS (
  SELECT *, CASE WHEN cluster_id = 0 THEN 'high_traffic_stable' WHEN cluster_id = 1 THEN 'high_traffic_spiky'
    ELSE 'medium_traffic' END AS cluster_label
  FROM (SELECT *, CASE WHEN error_rate > 0.2 THEN 0 WHEN peak_to_avg_ratio > 4.5 THEN 1 ELSE 2 END AS cluster_id
        FROM features))"""

CUSTOMERS = """
customers AS (
  SELECT o_custkey AS service_name, count(*) AS total_requests,
    count(*) / greatest(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)), 1)
      AS requests_per_hour,
    avg(CASE WHEN o_orderstatus = 'F' THEN 1e0 ELSE 0e0 END) AS error_rate,
    max(o_totalprice) AS latency_p95, max(o_totalprice) / min(o_totalprice) AS peak_to_avg_ratio
  FROM orders GROUP BY o_custkey)"""


def _z(columns: list[str], table: str) -> str:
    scaled = ", ".join(
        f"coalesce((coalesce({c}, 0) - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 0) AS x{i}"
        for i, c in enumerate(columns)
    )
    return f"pts AS (SELECT service_name AS id, {scaled} FROM {table})"


def _distance2(dims: int) -> str:
    return " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(dims))


def dbscan(ctes: str, table: str, columns: list[str], eps: float, min_samples: int) -> str:
    """Density clusters by brute force: all pairs, transitive closure over core points."""
    return f"""
WITH RECURSIVE {ctes}, {_z(columns, table)},
near AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM pts a JOIN pts b
  ON {_distance2(len(columns))} <= CAST({eps} AS DOUBLE) * CAST({eps} AS DOUBLE)),
core AS MATERIALIZED (SELECT u AS id FROM near GROUP BY u HAVING count(*) >= {min_samples}),
links AS MATERIALIZED (SELECT u, v FROM near WHERE u IN (SELECT id FROM core) AND v IN (SELECT id FROM core)),
reach(u, v) AS (
  SELECT id, id FROM core
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
named AS (SELECT u AS id, min(v) AS first_id FROM reach GROUP BY u),
ranked AS (SELECT id, dense_rank() OVER (ORDER BY first_id) - 1 AS cluster_id FROM named),
edge AS (SELECT n.u AS id, min(r.cluster_id) AS cluster_id FROM near n JOIN ranked r ON r.id = n.v
         WHERE n.u NOT IN (SELECT id FROM core) GROUP BY n.u)
SELECT p.id AS service_name, CAST(coalesce(r.cluster_id, e.cluster_id, -1) AS INTEGER) AS cluster_id
FROM pts p LEFT JOIN ranked r ON r.id = p.id LEFT JOIN edge e ON e.id = p.id"""


CUSTOMER_COLUMNS = ["requests_per_hour", "error_rate", "latency_p95", "peak_to_avg_ratio"]
CLUSTER_COLUMNS = [
    "requests_per_hour",
    "error_rate",
    "latency_p95",
    "peak_to_avg_ratio",
    "unique_users",
    "unique_endpoints",
]

SILHOUETTE = f"""
WITH {CUSTOMERS},
labelled AS (
  SELECT *, CASE WHEN total_requests < 8 THEN 0 WHEN total_requests < 12 THEN 1 ELSE 2 END AS label FROM customers),
pair AS (
  SELECT a.service_name AS id, a.label AS own, b.label AS other,
    sum((a.error_rate - b.error_rate) * (a.error_rate - b.error_rate)
      + (a.requests_per_hour - b.requests_per_hour) * (a.requests_per_hour - b.requests_per_hour)) AS total,
    count(*) AS n
  FROM labelled a CROSS JOIN labelled b GROUP BY ALL),
ab AS (
  SELECT id, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
    min(CASE WHEN own <> other THEN total / n END) AS b
  FROM pair GROUP BY id)
SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END), 6)
  AS silhouette FROM ab"""

# The advice texts, as the report gives them.
ADVICE = """CASE WHEN error_rate > 0.15
    THEN 'High error rate — investigate health, dependencies, and recent deployments'
  WHEN latency_p95 > 2000
    THEN 'High P95 latency — check DB bottlenecks, connection pools, or downstream timeouts'
  WHEN requests_per_hour > 10000
    THEN 'Unexpected traffic volume — verify for DDoS, runaway client, or missing rate limit'
  ELSE 'Anomalous profile — review recent config changes and compare with baseline' END"""

SERIES_COLUMNS = """service_name, time_bucket, request_count, round(error_rate, 6) AS error_rate,
  round(latency_p50, 6) AS latency_p50, round(latency_p95, 6) AS latency_p95,
  round(bytes_total, 6) AS bytes_total, unique_users"""

# models of fixed parameters, started on the first day and moved on hour by hour
ROLLED = """,
numbered AS (
  SELECT service_name, time_bucket, request_count * 1e0 AS y, row_number() OVER (PARTITION BY service_name ORDER BY time_bucket) AS k FROM grid),
day_one AS (SELECT service_name, avg(y) AS level, list(y ORDER BY k) AS ys FROM numbered WHERE k <= 24 GROUP BY ALL),
rolled AS (
  SELECT service_name, CAST(24 AS BIGINT) AS k, level, 0e0 AS trend, list_transform(ys, lambda y: y - level) AS season FROM day_one
  UNION ALL
  SELECT r.service_name, n.k, 0.3e0 * (n.y - r.season[1]) + 0.7e0 * (r.level + 0.9e0 * r.trend),
    0.05e0 * (0.3e0 * (n.y - r.season[1]) + 0.7e0 * (r.level + 0.9e0 * r.trend) - r.level) + 0.95e0 * 0.9e0 * r.trend,
    list_append(r.season[2:], 0.2e0 * (n.y - (r.level + 0.9e0 * r.trend)) + 0.8e0 * r.season[1])
  FROM rolled r JOIN numbered n ON n.service_name = r.service_name AND n.k = r.k + 1),
ends AS (SELECT service_name, max(k) AS k FROM rolled GROUP BY ALL),
ahead AS (
  SELECT r.service_name, step, greatest(level + 0.9e0 * (1 - pow(0.9e0, step)) / 0.1e0 * trend + season[step], 0) AS m
  FROM rolled r JOIN ends USING (service_name, k) CROSS JOIN range(1, 25) t(step)),
forecasts AS (
  SELECT service_name, (SELECT max(time_bucket) FROM grid) + to_hours(CAST(step AS INTEGER)) AS time_bucket, round_even(m, 2) AS forecast,
    round_even(greatest(m - 3.92e0, 0), 2) AS lower_bound, round_even(m + 3.92e0, 2) AS upper_bound FROM ahead)"""

PEAKS = ROLLED + """,
upper_peaks AS (SELECT service_name, max(upper_bound) AS peak_upper,
  arg_min(time_bucket, struct_pack(u := -upper_bound, t := time_bucket)) AS peak_time
  FROM forecasts GROUP BY service_name)"""


def _insight(section: str, category: str, rows: str, order: str, examples: int) -> str:
    names = (
        f"coalesce(string_agg(service_name, ',' ORDER BY k) FILTER (WHERE k <= {examples}), '')"
        if examples
        else "''"
    )
    return f"""SELECT '{section}' AS section, '{category}' AS category, count(*) AS service_count,
  {names} AS sample_services
FROM (SELECT service_name, row_number() OVER (ORDER BY {order}) AS k FROM {rows}) HAVING count(*) > 0"""


WEEKEND = """,
shares AS (
  SELECT service_name, coalesce(sum(CASE WHEN is_weekend = 1 THEN request_count ELSE 0 END)
    / nullif(sum(request_count), 0), 0) AS weekend_share
  FROM calendar GROUP BY service_name)"""

COST = (
    f"WITH RECURSIVE {BOTH}{WEEKEND}{PEAKS},\n"
    "idle AS (SELECT * FROM features WHERE requests_per_hour < 1.0),\n"
    "flat AS (SELECT * FROM features WHERE peak_to_avg_ratio < 3.5 AND requests_per_hour < 100),\n"
    "spot AS (SELECT * FROM shares WHERE weekend_share < 0.27\n"
    "         AND (SELECT max(is_weekend) FROM calendar) = 1),\n"
    "preempt AS (SELECT u.service_name FROM upper_peaks u JOIN features f USING (service_name)\n"
    "            WHERE f.requests_per_hour > 0 AND u.peak_upper > f.requests_per_hour * 2.5),\n"
    "reuse AS (SELECT * FROM features WHERE requests_per_hour > 0.05),\n"
    "dead AS (SELECT * FROM features WHERE total_requests < 100000 AND error_rate > 0.2)\n"
    + "\nUNION ALL\n".join(
        [
            _insight("aws_compute", "Idle Services", "idle", "service_name", 8),
            _insight("aws_compute", "Over-provisioned (Flat Traffic)", "flat", "service_name", 0),
            _insight("aws_compute", "Spot Instance Candidates", "spot", "service_name", 8),
            _insight("aws_compute", "Pre-emptive Auto-Scaling", "preempt", "service_name", 5),
            _insight(
                "architectural", "Reusability Candidates", "reuse", "requests_per_hour DESC, service_name", 8
            ),
            _insight("architectural", "Deprecation Candidates", "dead", "service_name", 8),
        ]
    )
)

FEATURE_COLUMNS = """
SELECT service_name, total_requests, round(error_rate, 6) AS error_rate,
  round(server_error_rate, 6) AS server_error_rate, round(latency_p50, 6) AS latency_p50,
  round(latency_p95, 6) AS latency_p95, round(latency_p99, 6) AS latency_p99, round(avg_bytes, 6) AS avg_bytes,
  unique_users, unique_endpoints, unique_instances, round(active_hours, 6) AS active_hours,
  round(requests_per_hour, 6) AS requests_per_hour, round(peak_to_avg_ratio, 6) AS peak_to_avg_ratio
FROM features"""
NORMALIZED = f"WITH {RAW} SELECT {LOG_COLUMNS} FROM logs"
HOURLY = f"WITH {SERIES} SELECT {SERIES_COLUMNS} FROM hourly"

#: Hours that a stream has closed when its last row is a day ahead; percentiles are values of the hour.
CLOSED_HOURS = """hours AS (SELECT service_name, date_trunc('hour', "timestamp") AS time_bucket, count(*) AS request_count,
  avg(CASE WHEN status_code >= 400 THEN 1e0 ELSE 0e0 END) AS error_rate,
  coalesce(quantile_disc(latency_ms, 0.5), 0) AS latency_p50, coalesce(quantile_disc(latency_ms, 0.95), 0) AS latency_p95,
  coalesce(sum(bytes_response), 0) AS bytes_total, count(DISTINCT user_id) AS unique_users
  FROM logs GROUP BY ALL),
closed AS (SELECT * FROM hours WHERE time_bucket + INTERVAL 1 HOUR <= (SELECT max("timestamp") FROM valid) - INTERVAL 1 DAY)"""
BEFORE_SCORES = "greatest({})".format(
    ", ".join(
        f"coalesce(abs({c} - avg({c}) OVER w) / nullif(stddev_pop({c}) OVER w, 0), 0)"
        for c in ("request_count", "error_rate", "latency_p50", "latency_p95")
    )
)

ORACLE: dict[str, str] = {
    # records
    "normalize_logs": NORMALIZED,
    "convert_json_logs": NORMALIZED,
    "convert_csv_logs": NORMALIZED,
    "dedupe_logs": f"""WITH {RAW}
SELECT service_name, count(*) AS unique_rows, CAST(sum(event_id) AS BIGINT) AS id_sum,
  max(event_id) AS id_max FROM logs GROUP BY service_name""",
    "reject_reasons": f"""WITH {RAW},
f AS (SELECT count(*) AS input_rows,
  count(*) FILTER (WHERE "timestamp" IS NULL) AS bad_timestamp,
  count(*) FILTER (WHERE service_name IS NULL) AS no_service,
  count(*) FILTER (WHERE status_code IS NULL) AS bad_status,
  count(*) FILTER (WHERE status_code NOT BETWEEN 100 AND 599) AS status_out_of_range,
  count(*) FILTER (WHERE latency_ms NOT BETWEEN 0 AND 300000) AS latency_out_of_range,
  count(*) - (SELECT count(*) FROM valid) AS rejected_rows
  FROM coerced)
SELECT reason, row_count FROM f UNPIVOT (row_count FOR reason IN (input_rows, rejected_rows, bad_timestamp,
  no_service, bad_status, status_out_of_range, latency_out_of_range))""",
    "normalize_endpoints": r"""
SELECT page_id, regexp_replace(regexp_replace(split_part(url, '?', 1),
  '(?i)/[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}', '/{uuid}', 'g'),
  '/\p{Nd}{2,}', '/{id}', 'g') AS endpoint FROM pages""",
    "downsample_logs": f"""WITH {RAW}
SELECT {LOG_COLUMNS} FROM logs
WHERE substr(md5('42|' || CAST(epoch_us("timestamp") AS VARCHAR) || '|' || service_name || '|' || endpoint
  || '|' || instance_id), 1, 8) < '40000000'""",
    "downsample_exact": f"""WITH {RAW}
SELECT * EXCLUDE (k, n) FROM (
  SELECT {LOG_COLUMNS}, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42|' || CAST(epoch_us("timestamp") AS VARCHAR) || '|'
    || service_name || '|' || endpoint || '|' || instance_id)) AS k FROM logs) WHERE k <= round_even(0.25e0 * n, 0)""",
    # sources
    "scan_date_range": f"""WITH {RAW} SELECT {LOG_COLUMNS} FROM logs
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'""",
    "guarded_scan": f"""WITH {RAW}
SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day, count(*) AS request_count FROM logs
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' GROUP BY 1""",
    "refused_scan": f"""WITH {RAW}
SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day, count(*) AS request_count, TRUE AS refused FROM logs
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15' GROUP BY 1""",
    "skipped_files": f"""WITH {RAW}
SELECT DISTINCT CAST(day("timestamp") AS INTEGER) AS day, CAST(10 AS BIGINT) AS bytes FROM logs
WHERE day("timestamp") % 10 = 0""",
    "table_run_features": f"""WITH {RAW},
day_logs AS (SELECT * FROM logs WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15')
{FEATURES[len(RAW):].replace("FROM logs", "FROM day_logs")}{FEATURE_COLUMNS}""",
    "table_date_query": f"""WITH {RAW}
SELECT CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS dt, "timestamp", service_name, endpoint, method, status_code, latency_ms,
  bytes_response, user_id, instance_id FROM logs
WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'""",
    "merged_schema_read": f"""WITH {RAW}
SELECT service_name, count(*) AS request_count, count(latency_ms) AS with_latency,
  count(CASE WHEN CAST("timestamp" AS DATE) > DATE '2024-01-15' THEN bytes_response END) AS with_bytes
FROM logs GROUP BY service_name""",
    "cached_query": """
SELECT event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY event_type""",
    "incremental_ingest": f"""WITH {RAW} SELECT {LOG_COLUMNS} FROM valid""",
    "compacted_store": f"""WITH {RAW} SELECT {LOG_COLUMNS} FROM valid""",
    # features
    "service_features": f"WITH {FEATURES}{FEATURE_COLUMNS}",
    "request_span": f"""WITH {FEATURES} SELECT service_name, total_requests,
  round(active_hours, 6) AS active_hours, round(requests_per_hour, 6) AS requests_per_hour FROM features""",
    "peak_ratio": f"""WITH {FEATURES}
SELECT service_name, round(peak_to_avg_ratio, 6) AS peak_to_avg_ratio FROM peaks""",
    "percentiles_hot_groups": """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem GROUP BY l_returnflag""",
    "percentiles_many_groups": """
SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
FROM lineitem GROUP BY l_suppkey""",
    "hourly_traffic": HOURLY,
    "incremental_rollup": HOURLY,
    "incremental_dedupe": NORMALIZED,
    "rollup_from_counts": f"SELECT * EXCLUDE (unique_users) FROM ({HOURLY})",
    "rollup_from_bitmaps": f"""SELECT service_name, time_bucket, unique_users FROM ({HOURLY})
UNION ALL SELECT service_name, NULL, unique_users FROM (WITH {FEATURES} SELECT service_name, unique_users FROM features)""",
    "dense_hourly_grid": f"WITH {SERIES} SELECT {SERIES_COLUMNS} FROM grid",
    "supplier_daily_grid": """
WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS TIMESTAMP) AS time_bucket, count(*) AS n,
    sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL),
days AS (SELECT unnest(generate_series(min(time_bucket), max(time_bucket), INTERVAL 1 DAY)) AS time_bucket
         FROM daily)
SELECT s.l_suppkey, d.time_bucket, coalesce(y.n, 0) AS n, round(coalesce(y.quantity, 0), 6) AS quantity
FROM (SELECT DISTINCT l_suppkey FROM daily) s CROSS JOIN days d
LEFT JOIN daily y ON y.l_suppkey = s.l_suppkey AND y.time_bucket = d.time_bucket""",
    "calendar_features": f"""WITH {SERIES}
SELECT service_name, time_bucket, request_count, hour_of_day, day_of_week, is_weekend, is_business_hours,
  week_of_year FROM calendar""",
    "growth_rates": f"""WITH {SERIES}
SELECT service_name, recent_requests, prior_requests, growth_rate_pct FROM growth""",
    "supplier_growth": """
WITH ends AS (SELECT max(l_shipdate) AS last FROM lineitem),
sums AS (
  SELECT l_suppkey AS service_name,
    sum(CASE WHEN l_shipdate > last - INTERVAL 364 DAY THEN l_quantity ELSE 0 END) AS recent_requests,
    sum(CASE WHEN l_shipdate <= last - INTERVAL 364 DAY THEN l_quantity ELSE 0 END) AS prior_requests
  FROM lineitem, ends WHERE l_shipdate > last - INTERVAL 728 DAY GROUP BY l_suppkey)
SELECT service_name, recent_requests, prior_requests,
  round_even((recent_requests - prior_requests) / prior_requests * 100, 2) AS growth_rate_pct
FROM sums WHERE prior_requests > 0""",
    "weekend_share": f"""WITH {SERIES}{WEEKEND}
SELECT service_name, round(weekend_share, 6) AS weekend_share FROM shares""",
    "fast_growing": f"""WITH {SERIES}
SELECT service_name, recent_requests, prior_requests, growth_rate_pct FROM growth WHERE growth_rate_pct > 2
ORDER BY growth_rate_pct DESC, service_name LIMIT 10""",
    "declining": f"""WITH {SERIES}
SELECT service_name, recent_requests, prior_requests, growth_rate_pct FROM growth WHERE growth_rate_pct < -2
ORDER BY growth_rate_pct, service_name LIMIT 10""",
    # scores
    "standardized_features": f"""WITH {FEATURES}, {_z(CLUSTER_COLUMNS, "features")}
SELECT id AS service_name, {", ".join(f"round(x{i}, 6) AS z_{c}" for i, c in enumerate(CLUSTER_COLUMNS))}
FROM pts""",
    "window_anomalies_incremental": f"""WITH {SERIES}
SELECT service_name, time_bucket, request_count, round(error_rate, 6) AS error_rate, round(latency_p50, 6) AS latency_p50,
  round(latency_p95, 6) AS latency_p95, anomaly_score, is_anomaly FROM windows
WHERE CAST(time_bucket AS DATE) = (SELECT CAST(max(time_bucket) AS DATE) FROM windows)""",
    "window_anomalies": f"""WITH {SERIES}
SELECT service_name, time_bucket, anomaly_score, is_anomaly FROM windows""",
    "top_window_anomalies": f"""WITH {SERIES}
SELECT service_name, time_bucket, anomaly_score FROM windows WHERE is_anomaly
ORDER BY anomaly_score DESC, service_name, time_bucket LIMIT 10""",
    "window_alerts": f"""WITH {SERIES}
SELECT service_name, time_bucket, anomaly_score, request_count, round(error_rate, 6) AS error_rate
FROM windows WHERE is_anomaly ORDER BY anomaly_score DESC, service_name, time_bucket LIMIT 10""",
    "service_anomalies_zscore": f"""WITH {SCORED}
SELECT service_name, anomaly_score, is_anomaly FROM anomalies""",
    "service_alerts": f"""WITH {SCORED}
SELECT service_name AS service, round_even(anomaly_score, 3) AS anomaly_score,
  round_even(error_rate, 3) AS error_rate, round_even(latency_p95, 1) AS latency_p95_ms,
  {ADVICE} AS recommendation
FROM anomalies WHERE is_anomaly AND anomaly_score >= 0.75
ORDER BY anomalies.anomaly_score DESC, service_name LIMIT 10""",
    "alert_recommendations": f"WITH {FEATURES} SELECT service_name, {ADVICE} AS recommendation FROM features",
    # clusters
    "dbscan_services": dbscan(FEATURES, "features", CLUSTER_COLUMNS, 1.5, 3),
    "dbscan_customers": dbscan(CUSTOMERS, "customers", CUSTOMER_COLUMNS, 0.5, 5),
    "silhouette": SILHOUETTE,
    "cluster_profile": f"""WITH {FEATURES}{TIERS}
SELECT cluster_id, cluster_label, count(*) AS service_count, round(avg(requests_per_hour), 6) AS avg_rph,
  round(avg(error_rate), 6) AS avg_error_rate, round(avg(latency_p95), 6) AS avg_latency_p95,
  string_agg(service_name, ',' ORDER BY k) FILTER (WHERE k <= 5) AS sample_services
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY service_name) AS k FROM tiers)
GROUP BY cluster_id, cluster_label""",
    "cluster_breakdown": f"""WITH {FEATURES}{TIERS}
SELECT cluster_label, count(*) AS service_count, CAST(sum(total_requests) AS BIGINT) AS total_requests,
  round(avg(error_rate), 6) AS avg_error_rate, round(avg(latency_p95), 6) AS avg_latency_p95
FROM tiers GROUP BY cluster_label""",
    # report rules
    "report_totals": f"""WITH {FEATURES}
SELECT count(*) AS total_services_analysed, CAST(sum(total_requests) AS BIGINT) AS total_requests FROM features""",
    "top_services": f"""WITH {FEATURES}
SELECT service_name, total_requests, round(requests_per_hour, 6) AS requests_per_hour,
  round(error_rate, 6) AS error_rate, round(latency_p95, 6) AS latency_p95
FROM features ORDER BY total_requests DESC, service_name LIMIT 10""",
    "idle_services": f"""WITH {FEATURES}
SELECT service_name, round(requests_per_hour, 6) AS requests_per_hour FROM features WHERE requests_per_hour < 1.0""",
    "overprovisioned": f"""WITH {FEATURES}
SELECT service_name, round(peak_to_avg_ratio, 6) AS peak_to_avg_ratio FROM features
WHERE peak_to_avg_ratio < 3.5 AND requests_per_hour < 100""",
    "spot_candidates": f"""WITH {SERIES}{WEEKEND}
SELECT service_name, round(weekend_share, 6) AS weekend_share FROM shares WHERE weekend_share < 0.27""",
    "reusability": f"""WITH {FEATURES}
SELECT service_name, round(requests_per_hour, 6) AS requests_per_hour FROM features WHERE requests_per_hour > 0.05""",
    "deprecation": f"""WITH {FEATURES}
SELECT service_name, total_requests, round(error_rate, 6) AS error_rate FROM features
WHERE total_requests < 100000 AND error_rate > 0.2""",
    "cacheable_endpoints": f"""WITH {RAW},
g AS (SELECT service_name, endpoint, count(*) AS request_count,
  avg(CASE WHEN method = 'GET' THEN 1e0 ELSE 0e0 END) AS get_share,
  avg(CASE WHEN status_code = 200 THEN 1e0 ELSE 0e0 END) AS ok_share,
  coalesce(stddev_pop(latency_ms) / nullif(avg(latency_ms), 0), 0) AS latency_variation
  FROM logs GROUP BY ALL)
SELECT service_name, endpoint, request_count, round(get_share, 6) AS get_share, round(ok_share, 6) AS ok_share,
  round(latency_variation, 6) AS latency_variation FROM g
WHERE request_count >= 10 AND get_share >= 0.6 AND ok_share >= 0.8 AND latency_variation <= 2""",
    "cost_insights": COST,
    # capacity
    "busiest_services": f"""WITH {RAW}
SELECT service_name, count(*) AS total FROM logs GROUP BY service_name ORDER BY total DESC, service_name LIMIT 5""",
    "forecast_rolled_forward": f"""WITH RECURSIVE {SERIES}{ROLLED}
SELECT * FROM forecasts""",
    "forecast_peaks": f"""WITH RECURSIVE {SERIES}{ROLLED}
SELECT service_name, arg_min(time_bucket, struct_pack(u := -forecast, t := time_bucket)) AS peak_time,
  round_even(max(forecast), 1) AS peak_forecast,
  round_even(arg_min(upper_bound, struct_pack(u := -forecast, t := time_bucket)), 1) AS peak_upper_bound
FROM forecasts GROUP BY service_name""",
    "forecast_peak_windows": f"""WITH RECURSIVE {SERIES}{PEAKS}
SELECT service_name, peak_time, round_even(peak_upper, 1) AS peak_rph_upper FROM upper_peaks
ORDER BY round_even(peak_upper, 1) DESC, service_name LIMIT 20""",
    "capacity_headroom": f"""WITH RECURSIVE {BOTH}{PEAKS},
c AS (SELECT u.service_name, peak_upper AS peak,
  coalesce(CASE WHEN f.error_rate <= 0.2 THEN f.requests_per_hour * 8 END, peak_upper * 1.5) AS current
  FROM upper_peaks u JOIN features f USING (service_name)),
r AS (SELECT *, CASE WHEN current > 0 THEN (current - peak) / current * 100 ELSE 0 END AS room FROM c)
SELECT service_name, round_even(peak, 1) AS peak_forecast_upper, round_even(current, 1) AS current_capacity,
  round_even(room, 1) AS headroom_pct,
  CASE WHEN room < 10 THEN 'under_provisioned' WHEN room > 50 THEN 'over_provisioned'
    ELSE 'well_provisioned' END AS status FROM r""",
    "scale_recommendations": f"""WITH RECURSIVE {BOTH}{PEAKS},
s AS (SELECT u.service_name, f.requests_per_hour AS rph, peak_upper, peak_time,
  CASE WHEN f.requests_per_hour > 0 THEN peak_upper / f.requests_per_hour ELSE 1.0 END AS factor
  FROM upper_peaks u JOIN features f USING (service_name))
SELECT service_name AS service, round_even(rph, 1) AS current_avg_rph,
  round_even(peak_upper, 1) AS forecast_peak_rph, round_even(factor, 2) AS recommended_scale_factor,
  CASE WHEN factor > 2.5 THEN 'high' ELSE 'medium' END AS urgency,
  'Pre-scale by ' || printf('%.1f', factor) || '× before forecasted peak at '
    || strftime(peak_time, '%Y-%m-%d %H:%M:%S') || '+00:00' AS action
FROM s WHERE factor > 1.3""",
    "preemptive_scaling": f"""WITH RECURSIVE {BOTH}{PEAKS}
SELECT u.service_name, round(peak_upper, 6) AS peak_upper, round(requests_per_hour, 6) AS requests_per_hour
FROM upper_peaks u JOIN features f USING (service_name)
WHERE requests_per_hour > 0 AND peak_upper > requests_per_hour * 2.5""",
    # streams
    "streaming_hourly": f"""WITH {RAW}, {CLOSED_HOURS}
SELECT service_name, time_bucket, request_count, round(error_rate, 6) AS error_rate, round(latency_p50, 6) AS latency_p50,
  round(latency_p95, 6) AS latency_p95, round(bytes_total, 6) AS bytes_total, unique_users FROM closed""",
    "streaming_window_alerts": f"""WITH {RAW}, {CLOSED_HOURS},
z AS (SELECT service_name, time_bucket, count(*) OVER w AS hours_before, {BEFORE_SCORES} AS score FROM closed
  WINDOW w AS (PARTITION BY service_name ORDER BY time_bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT service_name, time_bucket, hours_before, round_even(score, 4) AS anomaly_score, round_even(score, 4) > 3 AS is_anomaly
FROM z WHERE hours_before >= 24""",
    "streaming_dedupe": f"""WITH {RAW}
SELECT "timestamp", service_name, endpoint, instance_id FROM logs""",
    # fitted models: what holds of any right fit
    "traffic_forecast_busiest": f"""WITH {RAW}
SELECT service_name, 24 AS hours, 24 AS different_hours, 24 AS inside, 'fitted' AS status
FROM (SELECT service_name, count(*) AS n FROM logs GROUP BY 1 ORDER BY n DESC, service_name LIMIT 5)""",
    "forecast_from_states": f"""WITH {FEATURES},
m AS (SELECT service_name, step, greatest(total_requests / 7e0 + 0.5e0 * (1 - pow(0.5e0, step)) / 0.5e0 * (total_requests / 1130e0)
  + (step - 1), 0) AS m FROM features, range(1, 7) t(step))
SELECT service_name, TIMESTAMP '1970-01-01' + to_hours(CAST(step AS INTEGER)) AS time_bucket, round_even(m, 2) AS forecast,
  round_even(greatest(m - 3.92, 0), 2) AS lower_bound, round_even(m + 3.92, 2) AS upper_bound FROM m""",
    "score_stored_kmeans": f"""WITH {FEATURES}
SELECT service_name, TRUE AS same, TRUE AS same_alone, TRUE AS ids_follow_traffic FROM features""",
    "score_stored_forest": f"""WITH {FEATURES},
c AS (SELECT 2 * (ln(3e0) + 0.5772156649015329) - 2 * 3 / 4e0 AS c)
SELECT service_name, round(pow(2, -(CASE WHEN error_rate <= 0.15 THEN 1e0 ELSE 2e0 END
  + CASE WHEN latency_p95 <= 500 THEN 1e0 ELSE 2e0 END) / c / 2), 6) AS raw_score FROM features, c""",
    "iforest_flags": f"""WITH {CUSTOMERS}
SELECT service_name, TRUE AS flag_follows_score, TRUE AS in_range FROM customers""",
    "kmeans_nearest": f"""WITH {CUSTOMERS}
SELECT service_name, TRUE AS nearest FROM customers""",
    "kmeans_regions": """
SELECT c_custkey AS service_name, CAST(4 - n_regionkey AS INTEGER) AS cluster_id,
  ['high_traffic_stable', 'high_traffic_spiky', 'medium_traffic', 'low_traffic_reliable', 'low_traffic_error_prone'][5 - n_regionkey] AS cluster_label
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "auto_k_regions": """
WITH p AS (
  SELECT c_custkey AS id, n_regionkey AS r, n_regionkey * 50 + (c_custkey % 11) / 11e0 AS x,
    n_regionkey * 2 % 5 * 50 + (c_custkey % 7) / 7e0 AS y FROM customer JOIN nation ON n_nationkey = c_nationkey),
z AS (SELECT id, r, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM p),
d AS (SELECT a.id, a.r, b.r AS o, sum((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS s, count(*) AS n FROM z a, z b GROUP BY ALL),
m AS (SELECT id, max(CASE WHEN o = r THEN s / (n - 1) END) AS a, min(CASE WHEN o <> r THEN s / n END) AS b FROM d GROUP BY id)
SELECT 5 AS k, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM m""",
    "silhouette_euclidean": f"""WITH {CUSTOMERS},
p AS (SELECT service_name, CASE WHEN total_requests < 8 THEN 0 WHEN total_requests < 12 THEN 1 ELSE 2 END AS l,
  error_rate AS x, requests_per_hour AS y FROM customers),
s AS (SELECT * FROM p ORDER BY md5(CAST(service_name AS VARCHAR)), service_name LIMIT 1000),
d AS (SELECT a.service_name, a.l, b.l AS o, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS f, count(*) AS n
  FROM s a, p b GROUP BY ALL),
m AS (SELECT service_name, l, max(CASE WHEN o = l THEN f / nullif(n - 1, 0) END) AS a, min(CASE WHEN o <> l THEN f / n END) AS b FROM d GROUP BY ALL)
SELECT service_name, l AS cluster_id, round(coalesce((b - a) / nullif(greatest(a, b), 0), 0), 6) AS silhouette FROM m""",
    "chosen_windows": """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS last_run,
  CAST(least(CAST(o_orderdate AS DATE), DATE '1998-01-15') AS VARCHAR) AS start, '1998-01-15' AS end FROM orders""",
    "report_sections": f"""WITH {FEATURES}
SELECT service_name AS item, CAST(k - 1 AS INTEGER) AS place, total_requests AS value
FROM (SELECT *, row_number() OVER (ORDER BY total_requests DESC, service_name) AS k FROM features) WHERE k <= 10
UNION ALL SELECT 'total', 0, CAST(sum(total_requests) AS BIGINT) FROM features""",
    "refused_schema": f"""WITH {RAW} SELECT svc, count(*) AS rows, 'refused' AS said FROM raw GROUP BY svc""",
    "approx_features_error": f"""WITH {FEATURES}
SELECT service_name, total_requests, TRUE AS users_close, TRUE AS median_close FROM features""",
}
