"""The same results in plain SQL, for a second engine to run over the same tables."""

from __future__ import annotations

PRELUDE = """
WITH people AS (
  SELECT c_custkey, r.r_name AS region, r2.r_name AS next_region
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  JOIN region r ON r.r_regionkey = n_regionkey
  JOIN region r2 ON r2.r_regionkey = (r.r_regionkey + 1) % 5),
f0 AS (
  SELECT event_id AS seq, user_id AS customer_id, ts AS start_ts, event_type, value AS latency_ms,
         CAST(json_extract_string(props, '$.k') AS INT) AS k, region, next_region
  FROM events JOIN people ON user_id = c_custkey),
f1 AS (
  SELECT *, 'TX-' || strftime(start_ts, '%Y%m%d%H%M%S') || '-' || printf('%07d', seq) AS txn_id,
         'type_' || (k % 7) AS txn_type, k % 7 < 2 AS impacted_type,
         start_ts + to_microseconds(CAST(floor(latency_ms * 1000) AS BIGINT)) AS end_ts,
         CASE WHEN event_type IN ('error', 'purchase') THEN k % 4 ELSE 0 END AS retry_count,
         CASE WHEN event_type = 'error' THEN 'timeout' WHEN event_type = 'signup' THEN 'retry'
              WHEN event_type = 'purchase' AND k % 4 > 0 THEN 'completed_after_retry' ELSE 'success' END AS status,
         CAST(seq % 1001 - 500 AS INT) AS skew_ms
  FROM f0),
f2 AS (
  SELECT *, CASE WHEN (impacted_type AND region = 'ASIA') OR seq % 12 = 0 THEN next_region END AS dep_region FROM f1),
facts AS (
  SELECT *, CASE WHEN dep_region IS NOT NULL THEN latency_ms * 0.9::DOUBLE END AS dep_latency_ms,
         CASE WHEN dep_region IS NULL OR seq % 211 = 0 THEN NULL
              WHEN seq % 223 = 0 THEN 'CKT-UNKNOWN'
              WHEN seq % 227 = 0 THEN 'CKT-' || upper(left(dep_region, 3)) || '-' || upper(left(region, 3)) || '-' || (customer_id % 7)
              ELSE 'CKT-' || upper(left(region, 3)) || '-' || upper(left(dep_region, 3)) || '-' || (customer_id % 7) END AS circuit_id
  FROM f2),
windows AS (
  SELECT CAST(i AS INT) AS window_id, TIMESTAMP '2024-01-10 12:20:00' + to_hours(CAST(6 * i AS INT)) AS w0,
         TIMESTAMP '2024-01-10 12:20:00' + to_hours(CAST(6 * i AS INT)) + to_minutes(CAST(60 + (37 * i) % 120 AS INT)) AS w1
  FROM range(20) t(i)),
confounders(name, c_region, c0, c1, priority) AS (VALUES
  ('cpu_spike', 'ASIA', TIMESTAMP '2024-01-05 09:00:00', TIMESTAMP '2024-01-06 11:00:00', 1),
  ('deploy_blip', 'EUROPE', TIMESTAMP '2024-01-20 17:00:00', TIMESTAMP '2024-01-21 18:00:00', 2),
  ('any_maint', '*', TIMESTAMP '2024-01-06 00:00:00', TIMESTAMP '2024-01-06 18:00:00', 3)),
labelled AS (
  SELECT seq, arg_min(name, priority) AS confounder_label FROM facts JOIN confounders
  ON start_ts >= c0 AND start_ts < c1 AND (c_region = region OR c_region = '*') GROUP BY seq),
flagged AS (
  SELECT f.*, window_id, confounder_label,
         window_id IS NOT NULL AND impacted_type AND region = 'ASIA' AS impacted_by_primary,
         confounder_label IS NOT NULL AS impacted_by_confounder
  FROM facts f LEFT JOIN windows ON start_ts >= w0 AND start_ts < w1 LEFT JOIN labelled USING (seq)),
lbase AS (
  SELECT *, start_ts + to_microseconds(CAST(skew_ms AS BIGINT) * 1000) AS b,
         end_ts + to_microseconds(CAST(skew_ms AS BIGINT) * 1000) AS done,
         CASE WHEN dep_region IS NULL THEN 1 ELSE 2 END AS per FROM flagged),
tries AS (
  SELECT *, b + to_microseconds(CAST((90 + 30 * a) * 1000 AS BIGINT)) AS att
  FROM lbase, unnest(range(0, CAST(retry_count + 1 AS BIGINT))) t(a)),
lrows AS (
  SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 1 AS event_no, 'received' AS event, 'api' AS service, b AS ts,
         'INFO' AS level, NULL AS attempt, NULL AS dep, NULL AS lat FROM lbase
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 2, 'queued', 'api', b + to_microseconds(10000), 'INFO', NULL, NULL, NULL FROM lbase
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 3, 'orchestrated', 'orchestrator', b + to_microseconds(40000), 'INFO', NULL, NULL, NULL FROM lbase
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 4 + 2 * a, 'dependency_call', 'orchestrator', att,
         CASE WHEN impacted_by_primary THEN 'WARN' ELSE 'INFO' END, a, floor(dep_latency_ms), NULL FROM tries WHERE dep_region IS NOT NULL
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 3 + per * (a + 1), 'worker_progress',
         CASE WHEN a = retry_count THEN 'worker' ELSE 'worker-retry' END,
         att + to_microseconds(CAST(floor(coalesce(dep_latency_ms, 80) * 1000) AS BIGINT)), 'INFO', a, NULL, NULL FROM tries
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 4 + per * (retry_count + 1),
         CASE WHEN status = 'timeout' THEN 'timeout' ELSE 'completed' END, 'api', done,
         CASE WHEN status = 'timeout' THEN 'ERROR' ELSE 'INFO' END, NULL, floor(dep_latency_ms), round(latency_ms, 2) FROM lbase
  UNION ALL SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, 5 + per * (retry_count + 1), 'retry', 'api',
         done + to_microseconds(5000), 'WARN', NULL, NULL, NULL FROM lbase WHERE status = 'timeout'),
logs AS (
  SELECT txn_id, seq, customer_id, region, txn_type, circuit_id, CAST(event_no AS INT) AS event_no, event, service, ts, level,
         CAST(attempt AS INT) AS attempt, CAST(dep AS BIGINT) AS dependency_latency_ms, CAST(lat AS DOUBLE) AS end_to_end_latency_ms,
         coalesce(CAST(lat AS DOUBLE), 0) AS lat FROM lrows),
spans AS (
  SELECT txn_id AS trace_id, txn_id, region, start_ts AS ts, CAST(1 AS INT) AS span_no, CAST(NULL AS INT) AS parent_no, 'api' AS service,
         floor(latency_ms * 100 + 0.5::DOUBLE) / 100 AS duration_ms, CASE WHEN status = 'timeout' THEN 'error' ELSE 'ok' END AS status, '' AS circuit_id FROM facts
  UNION ALL SELECT txn_id, txn_id, region, start_ts, 2, 1, 'orchestrator', floor(latency_ms * 0.4::DOUBLE * 100 + 0.5::DOUBLE) / 100, 'ok', '' FROM facts
  UNION ALL SELECT txn_id, txn_id, region, start_ts, 3, 2, 'worker', round(latency_ms * 0.5::DOUBLE, 2),
         CASE WHEN status = 'timeout' THEN 'error' ELSE 'ok' END, '' FROM facts
  UNION ALL SELECT txn_id, txn_id, region, start_ts, 4, 2, 'inventory-client', round(dep_latency_ms, 2),
         CASE WHEN status = 'timeout' THEN 'error' ELSE 'ok' END, coalesce(circuit_id, '') FROM facts WHERE dep_region IS NOT NULL),
c0 AS (
  SELECT printf('C-%09d', f.seq) AS call_id, f.seq, f.customer_id, f.region, f.end_ts AS txn_end_ts,
         f.end_ts + to_minutes(CAST(f.seq * 7 % 116 + 5 AS INT)) AS call_ts, f.txn_id AS true_txn, o.txn_id AS other_txn,
         CASE WHEN f.seq % 37 = 0 THEN 'missing' WHEN f.seq % 101 = 0 THEN 'fabricated' WHEN f.seq % 53 = 0 THEN 'wrong_customer' ELSE 'clean' END AS noise_type,
         CASE f.seq % 3 WHEN 0 THEN 'slow_provisioning' WHEN 1 THEN 'timeout' ELSE 'failure' END AS issue_category,
         f.seq % 4 = 0 AS escalated, CAST(f.seq % 171 + 10 AS INT) AS resolution_min
  FROM facts f LEFT JOIN facts o ON o.seq = f.seq - 1 WHERE f.status <> 'success'),
calls AS (
  SELECT *, CASE noise_type WHEN 'missing' THEN '' WHEN 'fabricated' THEN 'FAKE-' || true_txn
            WHEN 'wrong_customer' THEN coalesce(other_txn, true_txn) ELSE true_txn END AS ref FROM c0),
circuit_metrics AS (
  SELECT s.region AS src, d.region AS dst,
         'CKT-' || upper(left(s.region, 3)) || '-' || upper(left(d.region, 3)) || '-' || (l_suppkey % 7) AS circuit_id,
         l_shipdate AS ts, l_extendedprice AS value, l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN people d ON d.c_custkey = o_custkey
  JOIN (SELECT s_suppkey, r_name AS region FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey) s
    ON s_suppkey = l_suppkey
  WHERE s.region <> d.region),
circuits AS (SELECT DISTINCT circuit_id, src, dst FROM circuit_metrics),
samples AS (
  SELECT seq AS sample_id, circuit_id, region AS src, dep_region AS dst, start_ts AS ts, dep_latency_ms AS value
  FROM facts WHERE circuit_id IS NOT NULL),
hosts AS (SELECT start_ts AS ts, region, customer_id AS host, latency_ms AS cpu FROM facts),
net_events AS (
  SELECT seq, start_ts AS ts, CASE k % 4 WHEN 0 THEN 'flap' WHEN 1 THEN 'maintenance' WHEN 2 THEN 'reroute' ELSE 'packet_loss_burst' END AS event_type,
         region AS src, next_region AS dst,
         'CKT-' || upper(left(region, 3)) || '-' || upper(left(next_region, 3)) || '-' || ((customer_id + 1) % 7) AS circuit_id,
         CASE WHEN k >= 85 THEN 'critical' WHEN k >= 40 THEN 'warning' ELSE 'info' END AS reported_severity
  FROM facts),
alerts AS (SELECT seq AS alert_id, start_ts AS ts FROM facts WHERE latency_ms > 150),
outcomes AS (SELECT * FROM logs WHERE event IN ('completed', 'timeout') AND txn_type IN ('type_0', 'type_1')),
known AS (SELECT txn_id, min(customer_id) AS log_customer FROM logs WHERE event = 'received' GROUP BY txn_id),
classed AS (
  SELECT c.*, CASE WHEN ref = '' THEN 'fn' WHEN log_customer IS NULL THEN 'fp' WHEN customer_id <> log_customer THEN 'wrong_link' ELSE 'tp' END AS link_class
  FROM calls c LEFT JOIN known ON ref = txn_id),
confusion AS (
  SELECT count(*) FILTER (link_class = 'tp') AS tp, count(*) FILTER (link_class = 'fn') AS fn,
         count(*) FILTER (link_class = 'fp') AS fp, count(*) FILTER (link_class = 'wrong_link') AS wrong_link FROM classed),
rates AS (
  SELECT tp, fn, fp, wrong_link, round(coalesce(fn::DOUBLE / nullif(tp + fn + fp + wrong_link, 0), 0), 4) AS fn_rate,
         round(coalesce(fp::DOUBLE / nullif(tp + fp + wrong_link, 0), 0), 4) AS fp_rate_non_empty,
         round(coalesce(wrong_link::DOUBLE / nullif(tp + wrong_link, 0), 0), 4) AS wrong_link_rate_joined,
         round(coalesce(tp::DOUBLE / nullif(tp + fn + fp + wrong_link, 0), 0), 4) AS tp_rate FROM confusion)
"""

COHERENCE = """
coh AS (
  SELECT round(coalesce(avg(dep_latency_ms) FILTER (impacted_by_primary), 0) / greatest(1.0, coalesce(avg(dep_latency_ms) FILTER (NOT impacted_by_primary), 0)), 2) AS latency_multiplier,
         round(count(*) FILTER (impacted_by_primary AND status = 'timeout') / greatest(1, count(*) FILTER (impacted_by_primary))::DOUBLE
               / greatest(0.01, count(*) FILTER (NOT impacted_by_primary AND status = 'timeout') / greatest(1, count(*) FILTER (NOT impacted_by_primary))::DOUBLE), 2) AS timeout_multiplier
  FROM flagged WHERE dep_region IS NOT NULL AND region = 'ASIA' AND impacted_type),
rtt AS (
  SELECT round(coalesce(max(value) FILTER (window_id IS NOT NULL), min(value) FILTER (window_id IS NULL), 1)
               / greatest(1.0, coalesce(min(value) FILTER (window_id IS NULL), max(value) FILTER (window_id IS NOT NULL), 1)), 2) AS rtt_multiplier
  FROM samples LEFT JOIN windows ON ts >= w0 AND ts < w1 WHERE circuit_id = 'CKT-ASI-EUR-0')"""
SEPARABILITY = """
sep_cpu AS (SELECT round(max(cpu), 2) AS cpu_peak FROM hosts WHERE region = 'ASIA'),
sep_net AS (
  SELECT round(greatest(0.0001, coalesce(max(value / base), 1)), 4) AS network_peak_during_cpu
  FROM samples, (SELECT quantile_cont(value, 0.5) AS base FROM samples WHERE circuit_id = 'CKT-ASI-EUR-0')
  WHERE circuit_id = 'CKT-ASI-EUR-0' AND ts >= TIMESTAMP '2024-01-05 09:00:00' AND ts < TIMESTAMP '2024-01-06 11:00:00')"""
REFERENTIAL = """
refs AS (
  SELECT round(100.0 * count(*) FILTER (EXISTS (SELECT 1 FROM facts f WHERE f.txn_id = s.txn_id)) / count(*), 3)::DOUBLE AS span_match_pct FROM spans s),
crefs AS (
  SELECT round(100.0 * count(f.txn_id) / count(*), 3)::DOUBLE AS call_match_pct FROM calls LEFT JOIN facts f ON ref = f.txn_id WHERE ref <> '')"""
ALERTS = """
al AS (
  SELECT count(*) FILTER (hit) AS tp, count(*) FILTER (NOT hit) AS fp FROM (
    SELECT EXISTS (SELECT 1 FROM windows WHERE ts >= w0 AND ts < w1) AS hit FROM alerts)),
al_fn AS (SELECT count(*) AS fn FROM windows WHERE NOT EXISTS (SELECT 1 FROM alerts WHERE ts >= w0 AND ts < w1))"""
SHARDS = """
span AS (SELECT min(ts::DATE) AS d0, max(ts::DATE) AS d1 FROM logs),
days AS (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY))::DATE AS day FROM span),
shards AS (
  SELECT r.region, d.day, count(l.txn_id) AS rows FROM (SELECT r_name AS region FROM region UNION SELECT region FROM logs) r CROSS JOIN days d
  LEFT JOIN logs l ON l.region = r.region AND l.ts::DATE = d.day GROUP BY ALL)"""

# Rows of a nearest-rank percentile: 1-based index into the sorted list.
NEAREST = "list_sort(list(latency_ms))[CAST(least(count(*) - 1, floor(count(*) * {p}::DOUBLE)) AS BIGINT) + 1]"

QUERIES = {
    # projections and fan-out
    "impacted_slice": "SELECT txn_id, event_no, event, service, ts, level, end_to_end_latency_ms FROM outcomes WHERE region = 'ASIA'",
    "day_slice": "SELECT txn_id, event_no, event, ts, ts::DATE AS day FROM logs WHERE region = 'ASIA' AND ts::DATE = DATE '2024-01-12'",
    "txn_fact_projection": """SELECT txn_id AS transaction_id, customer_id, region AS origin_region, txn_type,
        strftime(start_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS start_ts, strftime(end_ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS end_ts,
        CASE WHEN status <> 'timeout' THEN 'true' ELSE 'false' END AS success,
        CASE WHEN status <> 'timeout' THEN '' WHEN dep_region IS NOT NULL THEN 'DEP_TIMEOUT' ELSE 'ORCH_TIMEOUT' END AS error_code,
        round(latency_ms, 2) AS end_to_end_latency_ms FROM facts""",
    "status_normalise": """SELECT txn_id, status, CASE WHEN status = 'timeout' THEN 'timeout' ELSE 'completed' END AS event,
        CASE WHEN status = 'timeout' THEN 'ERROR' ELSE 'INFO' END AS level,
        CASE status WHEN 'timeout' THEN '504' WHEN 'retry' THEN '202' ELSE '200' END AS http_status,
        CASE WHEN status <> 'timeout' THEN '' WHEN dep_region IS NOT NULL THEN 'DEP_TIMEOUT' ELSE 'ORCH_TIMEOUT' END AS error_code,
        CASE WHEN status LIKE 'completed%' THEN 'completed' ELSE status END AS message FROM facts""",
    "severity_normalise": """SELECT seq, event_type, CASE WHEN circuit_id = 'CKT-ASI-EUR-0' AND event_type = 'packet_loss_burst' THEN 'critical'
        WHEN circuit_id = 'CKT-ASI-EUR-0' AND event_type = 'reroute' THEN 'info' WHEN reported_severity = 'critical' THEN 'warning' WHEN event_type = 'maintenance' THEN 'info' ELSE 'warning' END AS severity,
        CASE WHEN circuit_id = 'CKT-ASI-EUR-0' AND event_type = 'packet_loss_burst' THEN 'Packet loss burst and RTT elevation detected on primary circuit'
        WHEN circuit_id = 'CKT-ASI-EUR-0' AND event_type = 'reroute' THEN 'Traffic rerouted away from degraded circuit; service latency recovers'
        ELSE CASE event_type WHEN 'flap' THEN 'Intermittent circuit flap observed' WHEN 'maintenance' THEN 'Planned maintenance window on circuit'
        WHEN 'reroute' THEN 'Routing policy change applied; path flaps briefly' ELSE 'Short packet loss burst on circuit' END END AS description FROM net_events""",
    "pre_post_label": "SELECT txn_id, ts, CASE WHEN ts < TIMESTAMP '2024-01-15 18:15:00' THEN 'pre_fix' ELSE 'post_fix' END AS phase FROM outcomes WHERE region = 'ASIA'",
    "impacted_flags": "SELECT txn_id, impacted_by_primary, impacted_by_confounder, confounder_label FROM flagged",
    "txn_key_build_parse": """SELECT txn_id, date_trunc('second', start_ts) AS id_ts, seq AS id_seq, true AS agrees FROM facts""",
    "lifecycle_explode": "SELECT txn_id, event_no, event, service, ts, level, attempt, dependency_latency_ms, end_to_end_latency_ms FROM logs",
    "span_explode": "SELECT trace_id, span_no, parent_no, service, duration_ms, status, circuit_id FROM spans",
    "txn_rebuild": """SELECT txn_id, b AS received_ts, done AS completed_ts, CAST(retry_count + 1 AS BIGINT) AS attempts,
        CAST(CASE WHEN dep_region IS NULL THEN 0 ELSE retry_count + 1 END AS BIGINT) AS dep_calls,
        CASE WHEN status = 'timeout' THEN 'timeout' ELSE 'completed' END AS final_event, round(latency_ms, 2) AS latency_ms,
        done < b AS out_of_order FROM lbase""",
    "time_spine_densify": """SELECT region, t.ts, coalesce(max(cpu), 0) AS value
        FROM (SELECT r_name AS region FROM region) CROSS JOIN (SELECT unnest(generate_series((SELECT min(ts::DATE) FROM hosts)::TIMESTAMP,
          (SELECT max(ts::DATE) FROM hosts)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS ts) t
        LEFT JOIN (SELECT region, time_bucket(INTERVAL 5 MINUTE, ts) AS ts, cpu FROM hosts) h USING (region, ts) GROUP BY ALL""",
    "route_matrix": """SELECT a.r_name AS src, b.r_name AS dst, count(f.seq) AS calls FROM region a JOIN region b ON a.r_name <> b.r_name
        LEFT JOIN facts f ON f.region = a.r_name AND f.dep_region = b.r_name GROUP BY ALL""",
    # joins
    "burst_membership": "SELECT txn_id, window_id FROM flagged",
    "confounder_first_match": "SELECT txn_id, confounder_label AS label FROM flagged",
    "link_confusion_matrix": "SELECT * FROM rates",
    "link_nonexistent_rate": "SELECT round(coalesce(count(*) FILTER (ref NOT IN (SELECT txn_id FROM known))::DOUBLE / nullif(count(*), 0), 0), 4) AS nonexistent_rate FROM calls WHERE ref <> ''",
    "link_mismatch_rate": "SELECT round(coalesce(count(*) FILTER (customer_id <> log_customer)::DOUBLE / nullif(count(*), 0), 0), 4) AS mismatch_rate FROM calls JOIN known ON ref = txn_id WHERE ref <> ''",
    "decoy_candidates": """, near AS (
        SELECT call_id, f.txn_id, abs(date_diff('microsecond', f.end_ts, call_ts)) AS gap FROM calls c JOIN facts f
        ON f.region = c.region AND f.customer_id <> c.customer_id AND f.end_ts BETWEEN call_ts - INTERVAL 2 HOUR AND call_ts + INTERVAL 2 HOUR),
      per AS (
        SELECT call_id, count(*) AS candidates, count(*) FILTER (gap BETWEEN 1200000000 AND 4800000000) AS preferred,
               arg_min(txn_id, gap) FILTER (gap BETWEEN 1200000000 AND 4800000000) AS p, arg_min(txn_id, gap) AS a FROM near GROUP BY call_id)
      SELECT call_id, coalesce(candidates, 0) AS candidates, coalesce(preferred, 0) AS preferred, coalesce(p, a) AS nearest_txn_id
      FROM calls LEFT JOIN per USING (call_id)""",
    "circuit_consistency": """SELECT reason, count(*) AS rows FROM (
        SELECT CASE WHEN f.circuit_id IS NULL THEN 'missing' WHEN c.circuit_id IS NULL THEN 'unknown'
               WHEN c.src <> f.region OR c.dst <> f.dep_region THEN 'mismatch' END AS reason
        FROM facts f LEFT JOIN circuits c ON c.circuit_id = f.circuit_id WHERE f.dep_region IS NOT NULL) WHERE reason IS NOT NULL GROUP BY reason""",
    "span_referential_check": "," + REFERENTIAL + " SELECT * FROM refs, crefs",
    "call_delay": """SELECT CAST((d >= 5)::INT + (d >= 15)::INT + (d >= 30)::INT + (d >= 60)::INT + (d >= 90)::INT + (d >= 120)::INT AS INT) AS delay_bucket,
        count(*) AS calls, round(avg(d), 4) AS mean_delay FROM (
        SELECT greatest(0, floor(date_diff('microsecond', end_ts, call_ts) / 6e7)) AS d FROM calls JOIN facts ON txn_id = true_txn) GROUP BY 1""",
    "truth_scoring": """SELECT t AS noise_type, count(*) FILTER (noise_type = t AND link_class = c) AS tp, count(*) FILTER (noise_type <> t AND link_class = c) AS fp,
        count(*) FILTER (noise_type = t AND link_class <> c) AS fn,
        round(coalesce(count(*) FILTER (noise_type = t AND link_class = c)::DOUBLE / nullif(count(*) FILTER (link_class = c), 0), 0), 4) AS precision,
        round(coalesce(count(*) FILTER (noise_type = t AND link_class = c)::DOUBLE / nullif(count(*) FILTER (noise_type = t), 0), 0), 4) AS recall
        FROM classed CROSS JOIN (VALUES ('clean', 'tp'), ('missing', 'fn'), ('fabricated', 'fp'), ('wrong_customer', 'wrong_link')) v(t, c) GROUP BY t, c""",
    "clock_skew": """SELECT l.region, count(*) AS n, min(d) AS min_ms, round(avg(d), 4) AS mean_ms, max(d) AS max_ms FROM (
        SELECT l.region, date_diff('microsecond', s.ts, l.ts) / 1000.0::DOUBLE AS d FROM logs l JOIN spans s ON s.trace_id = l.txn_id AND s.parent_no IS NULL
        WHERE l.event = 'received') l GROUP BY 1""",
    "skew_corrected_logs": "SELECT l.txn_id, l.event_no, l.ts - to_microseconds(CAST(skew_ms AS BIGINT) * 1000) AS corrected_ts FROM logs l JOIN facts USING (txn_id)",
    "span_tree": """, deep AS (
        WITH RECURSIVE r AS (SELECT trace_id, span_no, 0 AS depth FROM spans WHERE parent_no IS NULL
                             UNION SELECT s.trace_id, s.span_no, r.depth + 1 FROM r JOIN spans s ON s.trace_id = r.trace_id AND s.parent_no = r.span_no)
        SELECT * FROM r), j AS (
        SELECT s.service, s.duration_ms, d.depth,
               coalesce(c.child_ms, 0) AS child_ms, p.duration_ms AS parent_ms, s.parent_no FROM spans s
        LEFT JOIN (SELECT trace_id, parent_no, sum(duration_ms) AS child_ms FROM spans GROUP BY ALL) c ON c.trace_id = s.trace_id AND c.parent_no = s.span_no
        LEFT JOIN deep d ON d.trace_id = s.trace_id AND d.span_no = s.span_no
        LEFT JOIN spans p ON p.trace_id = s.trace_id AND p.span_no = s.parent_no)
      SELECT service, CAST(depth AS INT) AS depth, count(*) AS spans, round(sum(child_ms), 2) AS child_ms, round(sum(greatest(0, duration_ms - child_ms)), 2) AS self_ms,
             count(*) FILTER (duration_ms > parent_ms) AS longer_than_parent, count(*) FILTER (parent_no IS NOT NULL AND parent_ms IS NULL) AS orphans
      FROM j GROUP BY service, depth""",
    "event_asof_metric": """SELECT m.sample_id, m.circuit_id, m.ts, m.value, e.seq AS event_id, date_diff('microsecond', e.ts, m.ts) / 1e6::DOUBLE AS event_age_s
        FROM samples m ASOF LEFT JOIN net_events e ON e.circuit_id = m.circuit_id AND m.ts >= e.ts""",
    "signal_timeline": """, a AS (
        SELECT date_trunc('hour', start_ts) AS ts, region, round(quantile_cont(latency_ms, 0.95), 4) AS p95_ms,
               round(count(*) FILTER (status = 'timeout') / count(*)::DOUBLE, 4) AS timeout_rate FROM facts GROUP BY ALL),
      n AS (SELECT date_trunc('hour', ts) AS ts, src AS region, round(max(value), 4) AS rtt FROM samples GROUP BY ALL),
      h AS (SELECT date_trunc('hour', ts) AS ts, region, max(cpu) AS cpu_max FROM hosts GROUP BY ALL),
      p AS (SELECT date_trunc('hour', call_ts) AS ts, region, count(*) AS calls FROM calls GROUP BY ALL)
      SELECT ts, region, p95_ms, timeout_rate, rtt, cpu_max, coalesce(calls, 0) AS calls
      FROM a FULL JOIN n USING (ts, region) FULL JOIN h USING (ts, region) FULL JOIN p USING (ts, region)""",
    # aggregations
    "region_distribution": """, w(region, expected) AS (VALUES ('AFRICA', 0.35), ('AMERICA', 0.25), ('ASIA', 0.20), ('EUROPE', 0.10), ('MIDDLE EAST', 0.10)),
      c AS (SELECT region, count(*) AS rows FROM logs GROUP BY region)
      SELECT region, rows, round(rows::DOUBLE / sum(rows) OVER (), 4) AS share, expected::DOUBLE AS expected,
             round(round(rows::DOUBLE / sum(rows) OVER (), 4) - expected::DOUBLE, 4) AS diff FROM c JOIN w USING (region)""",
    "day_span": "SELECT min(ts::DATE) AS min_day, max(ts::DATE) AS max_day FROM logs",
    "p95_by_region": "SELECT region, round(quantile_cont(lat, 0.95), 4) AS p95_ms FROM outcomes GROUP BY region",
    "shard_p95_timeout": """SELECT round(quantile_cont(lat, 0.95), 4) AS p95_ms, round(count(*) FILTER (event = 'timeout') / count(*)::DOUBLE, 4) AS timeout_rate
        FROM outcomes WHERE region = 'ASIA' AND ts::DATE = DATE '2024-01-12'""",
    "impacted_volume": """SELECT round(quantile_cont(n, 0.5), 4) AS median_rpm, round(quantile_cont(n, 0.95), 4) AS p95_rpm, CAST(max(n) AS BIGINT) AS max_rpm FROM (
        SELECT count(*)::DOUBLE AS n FROM logs WHERE event = 'received' AND region = 'ASIA' AND txn_type IN ('type_0', 'type_1') GROUP BY date_trunc('minute', ts))""",
    "fix_verification": """SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 18:15:00' THEN 'pre_fix' ELSE 'post_fix' END AS phase, round(quantile_cont(lat, 0.95), 4) AS p95_ms,
        round(quantile_cont(lat, 0.99), 4) AS p99_ms, round(count(*) FILTER (event = 'timeout') / count(*)::DOUBLE, 4) AS timeout_rate, count(*) AS n
        FROM outcomes WHERE region = 'ASIA' GROUP BY 1""",
    "incident_multiplier": """, q AS (
        SELECT region, quantile_cont(lat, 0.95) FILTER (ts < TIMESTAMP '2024-01-10 12:20:00') AS b,
               quantile_cont(lat, 0.95) FILTER (ts >= TIMESTAMP '2024-01-10 12:20:00' AND ts < TIMESTAMP '2024-01-15 18:10:00') AS d FROM outcomes GROUP BY region)
      SELECT region, round(b, 4) AS p95_baseline, round(d, 4) AS p95_incident, CASE WHEN b = 0 THEN 0 ELSE round(d / b, 2) END AS p95_multiplier FROM q""",
    "top_circuit_uplift": """, q AS (
        SELECT circuit_id, quantile_cont(value, 0.95) FILTER (ts < TIMESTAMP '1998-06-01') AS b,
               quantile_cont(value, 0.95) FILTER (ts >= TIMESTAMP '1998-06-01' AND ts < TIMESTAMP '2000-01-01') AS d
        FROM circuit_metrics WHERE src = 'ASIA' AND dst = 'EUROPE' GROUP BY circuit_id)
      SELECT circuit_id, 'ASIA' AS src, 'EUROPE' AS dst, round(b, 4) AS p95_baseline, round(d, 4) AS p95_incident,
             CASE WHEN b = 0 THEN 0 ELSE round(d / b, 2) END AS p95_multiplier FROM q ORDER BY p95_multiplier DESC NULLS LAST, circuit_id LIMIT 5""",
    "link_missing_rate": "SELECT round(count(*) FILTER (ref = '') / count(*)::DOUBLE, 4) AS missing_rate, count(*) AS total FROM calls",
    "service_kpi_minute": f""", g AS (
        SELECT date_trunc('minute', start_ts) AS ts, region, txn_type, count(*) AS n, count(*) FILTER (status = 'timeout') AS e, count(*) FILTER (retry_count > 0) AS r,
               {NEAREST.format(p=0.95)} AS p95, {NEAREST.format(p=0.99)} AS p99 FROM facts GROUP BY ALL)
      SELECT ts, region, txn_type, round(n / 60.0::DOUBLE, 4) AS request_rate, round(e / n::DOUBLE, 4) AS error_rate, round(p95, 2) AS p95_ms, round(p99, 2) AS p99_ms,
             floor(least(1.0::DOUBLE, 0.15::DOUBLE + 0.7::DOUBLE * (r / n::DOUBLE) + 1.0::DOUBLE * (e / n::DOUBLE) + 0.25::DOUBLE * least(1.0::DOUBLE, p95 / 2500.0::DOUBLE)) * 10000 + 0.5::DOUBLE) / 10000 AS saturation FROM g""",
    "incident_coherence": "," + COHERENCE + " SELECT * FROM coh, rtt",
    "confounder_separability": "," + SEPARABILITY + " SELECT * FROM sep_cpu, sep_net",
    "host_peak": "SELECT region, host, max(cpu) AS cpu_max FROM hosts GROUP BY ALL",
    "host_peak_in_windows": "SELECT window_id, region, host, max(cpu) AS cpu_max FROM hosts JOIN windows ON ts >= w0 AND ts < w1 GROUP BY ALL",
    "call_stats": """, s AS (
        SELECT noise_type, count(*) AS calls, count(*) FILTER (ref <> '') AS non_empty, count(*) FILTER (ref <> '' AND noise_type = 'clean') AS matches,
               count(*) FILTER (impacted_by_primary) AS incident_calls FROM calls LEFT JOIN (SELECT txn_id, impacted_by_primary FROM flagged) ON txn_id = true_txn GROUP BY 1)
      SELECT t AS noise_type, coalesce(calls, 0) AS calls, round(coalesce(calls, 0)::DOUBLE / sum(calls) OVER (), 4) AS rate, coalesce(non_empty, 0) AS non_empty,
             coalesce(matches, 0) AS matches, coalesce(incident_calls, 0) AS incident_calls
      FROM (VALUES ('clean'), ('missing'), ('fabricated'), ('wrong_customer')) v(t) LEFT JOIN s ON noise_type = t""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows FROM {t}"
        for n, t in [("txn_facts", "facts"), ("app_logs", "logs"), ("trace_spans", "spans"), ("tso_calls", "calls"),
                     ("network_circuit_metrics", "circuit_metrics"), ("infra_host_metrics", "hosts"), ("network_events", "net_events")]),
    "alert_quality": "," + ALERTS + " SELECT * FROM al, al_fn",
    "circuits_per_route": "SELECT src, dst, string_agg(circuit_id, ',' ORDER BY circuit_id) AS circuits, count(*) AS n FROM circuits GROUP BY ALL",
    "seasonal_profile": """, per AS (SELECT start_ts::DATE AS day, CAST(hour(start_ts) AS INT) AS hour, count(*) AS n FROM facts GROUP BY ALL),
      kinds AS (SELECT isodow(d) >= 6 AS weekend, count(*) AS days FROM (
        SELECT unnest(generate_series((SELECT min(day) FROM per)::TIMESTAMP, (SELECT max(day) FROM per)::TIMESTAMP, INTERVAL 1 DAY)) AS d) GROUP BY 1),
      cells AS (SELECT hour, isodow(day) >= 6 AS weekend, CAST(sum(n) AS BIGINT) / CAST(any_value(days) AS DOUBLE) AS mean,
                greatest(0.2, 0.55 + 0.45 * sin((hour - 3) / 24.0 * 2 * pi())) * CASE WHEN isodow(day) >= 6 THEN 0.85 ELSE 1.0 END AS curve FROM per JOIN kinds ON weekend = (isodow(day) >= 6) GROUP BY hour, isodow(day) >= 6),
      s AS (SELECT *, curve * sum(mean) OVER () / sum(curve) OVER () AS scaled FROM cells)
      SELECT hour, weekend, round(mean, 4) AS observed, round(scaled, 4) AS expected, round(mean - scaled, 4) AS residual FROM s""",
    "call_rate_by_segment": """SELECT segment, count(*) AS transactions, count(call_id) AS calls, round(count(call_id)::DOUBLE / count(*), 4) AS call_rate,
        round(coalesce(count(*) FILTER (escalated)::DOUBLE / nullif(count(call_id), 0), 0), 4) AS escalated_rate,
        round(coalesce(sum(resolution_min)::DOUBLE / nullif(count(call_id), 0), 0), 4) AS mean_resolution_min FROM (
        SELECT CASE WHEN impacted_by_primary THEN 'impacted_burst' WHEN impacted_type AND f.region = 'ASIA' THEN 'impacted_base' WHEN impacted_by_confounder THEN 'confounded'
               WHEN status = 'timeout' THEN 'timed_out' ELSE 'other' END AS segment, call_id, escalated, resolution_min FROM flagged f LEFT JOIN calls ON true_txn = txn_id) GROUP BY 1""",
    "band_check": """SELECT measure, value, lower::DOUBLE AS lower, upper::DOUBLE AS upper, value BETWEEN lower::DOUBLE AND upper::DOUBLE AS inside FROM (
        SELECT 'fn_rate' AS measure, fn_rate AS value, 0.02 AS lower, 0.035 AS upper FROM rates
        UNION ALL SELECT 'fp_rate_non_empty', fp_rate_non_empty, 0.0, 0.002 FROM rates
        UNION ALL SELECT 'wrong_link_rate_joined', wrong_link_rate_joined, 0.003, 0.007 FROM rates)""",
    "tail_summary": """SELECT txn_type, status, round(quantile_cont(latency_ms, 0.5), 4) AS p50, round(quantile_cont(latency_ms, 0.95), 4) AS p95,
        round(quantile_cont(latency_ms, 0.99), 4) AS p99, max(latency_ms) AS max_ms, round(quantile_cont(latency_ms, 0.99) / quantile_cont(latency_ms, 0.5), 4) AS tail_ratio
        FROM facts GROUP BY ALL""",
    "dependency_share": """SELECT region, txn_type, count(dep_region) AS cross_calls, round(count(dep_region)::DOUBLE / count(*), 4) AS share,
        round(avg(dep_latency_ms / nullif(latency_ms, 0)), 4) AS mean_dep_ratio FROM facts GROUP BY ALL""",
    "validation_summary": ", " + ",".join([REFERENTIAL, COHERENCE, SEPARABILITY, ALERTS]) + " SELECT * FROM refs, crefs, coh, rtt, sep_cpu, sep_net, al, al_fn",
    "quality_cube": """SELECT region, issue_category, CAST(grouping(region, issue_category) AS BIGINT) AS level, count(*) FILTER (link_class = 'tp') AS tp,
        count(*) FILTER (link_class = 'fn') AS fn, count(*) FILTER (link_class = 'fp') AS fp, count(*) FILTER (link_class = 'wrong_link') AS wrong_link
        FROM classed GROUP BY CUBE (region, issue_category)""",
    # running computations
    "running_noise_rate": """, s AS (
        SELECT call_id, region, row_number() OVER w AS n, count(*) FILTER (ref = '') OVER w AS missing,
               count(*) FILTER (noise_type = 'fabricated') OVER w AS fabricated, count(*) FILTER (noise_type = 'wrong_customer') OVER w AS wrong
        FROM calls WINDOW w AS (PARTITION BY region ORDER BY call_ts, call_id ROWS UNBOUNDED PRECEDING))
      SELECT call_id, region, n, missing, fabricated, wrong, round(missing / n::DOUBLE, 4) AS missing_rate,
             round(coalesce(fabricated::DOUBLE / nullif(n - missing, 0), 0), 4) AS fabricated_rate,
             round(coalesce(wrong::DOUBLE / nullif(n - missing - fabricated, 0), 0), 4) AS wrong_rate,
             CAST(ceil(0.02::DOUBLE * n) AS BIGINT) AS lower, CAST(floor(0.035::DOUBLE * n) AS BIGINT) AS upper FROM s""",
    "spike_islands": """, m AS (
        SELECT c.*, value > 1.8::DOUBLE * quantile_cont(value, 0.5) OVER (PARTITION BY circuit_id) AS high FROM circuit_metrics c),
      s AS (SELECT *, count(*) FILTER (NOT high) OVER (PARTITION BY circuit_id ORDER BY ts, l_orderkey, l_linenumber, l_partkey, value ROWS UNBOUNDED PRECEDING) AS g FROM m)
      SELECT circuit_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n, max(value) AS peak FROM s WHERE high GROUP BY circuit_id, g""",
    "nearest_rank_window": f"SELECT date_trunc('hour', start_ts) AS ts, region, {NEAREST.format(p=0.95)} AS value FROM facts GROUP BY ALL",
    "event_numbering": """SELECT printf('EVT-%06d', row_number() OVER (ORDER BY ts, seq) - 1) AS event_key, seq, ts, event_type, circuit_id FROM net_events""",
    "arrival_disorder": """, s AS (SELECT seq, call_ts, max(call_ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM calls)
      SELECT seq, coalesce(call_ts < peak, false) AS late, CASE WHEN call_ts < peak THEN date_diff('microsecond', call_ts, peak) / 1e6::DOUBLE ELSE 0 END AS lateness_s FROM s""",
    "lookback_2h": """SELECT a.seq, count(b.seq) AS prior_txns FROM facts a LEFT JOIN facts b
        ON b.region = a.region AND b.end_ts BETWEEN a.start_ts - INTERVAL 2 HOUR AND a.start_ts GROUP BY a.seq""",
    "attempt_sequence": """SELECT txn_id, row_number() OVER w AS attempt, date_diff('microsecond', lag(ts) OVER w, ts) / 1000.0::DOUBLE AS gap_ms, lead(ts) OVER w IS NULL AS is_last
        FROM logs WHERE event = 'worker_progress' WINDOW w AS (PARTITION BY txn_id ORDER BY ts, attempt)""",
    "recovery_time": """, h AS (SELECT date_trunc('hour', start_ts) AS ts, region, quantile_cont(latency_ms, 0.95) AS p95 FROM facts GROUP BY ALL),
      b AS (SELECT region, quantile_cont(latency_ms, 0.95) AS base FROM facts WHERE start_ts < TIMESTAMP '2024-01-10 12:20:00' GROUP BY region),
      r AS (SELECT region, min(ts) FILTER (ts >= TIMESTAMP '2024-01-15 18:15:00' AND p95 <= 0.5::DOUBLE * base) AS recovered_at FROM h JOIN b USING (region) GROUP BY region)
      SELECT region, recovered_at, date_diff('microsecond', TIMESTAMP '2024-01-15 18:15:00', recovered_at) / 6e7::DOUBLE AS minutes_after_fix FROM r""",
    # sources, sinks and views
    "ingest_csv_typed": """SELECT txn_id AS transaction_id, event, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp, level, CAST(customer_id AS VARCHAR) AS customer_id,
        coalesce(CAST(dependency_latency_ms AS VARCHAR), '') AS dependency_latency_ms, coalesce(circuit_id, '') AS circuit_id FROM logs""",
    "ingest_directory": " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows FROM {t}"
        for n, t in [("txn_facts", "facts"), ("app_logs", "logs"), ("trace_spans", "spans"), ("tso_calls", "calls"),
                     ("network_circuit_metrics", "circuit_metrics"), ("infra_host_metrics", "hosts"), ("network_events", "net_events"),
                     ("service_metrics", "(SELECT DISTINCT date_trunc('minute', start_ts), region, txn_type FROM facts)")]),
    "derive_ingest_columns": "SELECT txn_id AS transaction_id, event, ts, lat AS end_to_end_latency_ms_f64 FROM logs",
    "read_ground_truth": """SELECT call_id, true_txn AS true_id, ref AS emitted_id, noise_type,
        CAST(floor(date_diff('microsecond', txn_end_ts, call_ts) / 6e7) AS BIGINT) AS delay_minutes FROM calls""",
    "truth_sections": """, kinds(k, nth) AS (VALUES ('clean', 0), ('missing', 1), ('fabricated', 2), ('wrong_customer', 3)),
      per AS (SELECT k, count(call_id) AS n FROM kinds LEFT JOIN calls ON noise_type = k GROUP BY k),
      conf(name, region, a, b) AS (VALUES ('cpu_spike', 'ASIA', '2024-01-05T09:00:00Z', '2024-01-06T11:00:00Z'),
        ('deploy_blip', 'EUROPE', '2024-01-20T17:00:00Z', '2024-01-21T18:00:00Z'), ('any_maint', '*', '2024-01-06T00:00:00Z', '2024-01-06T18:00:00Z'))
      SELECT * FROM (VALUES ('dataset_name', '', 'telemetry'), ('time_range', 'start', '2024-01-01T00:00:00Z'), ('time_range', 'end', '2024-01-31T00:00:00Z'),
        ('primary_incident', 'root_cause_type', 'network'), ('primary_incident', 'circuit_id', 'CKT-ASI-EUR-0'), ('primary_incident', 'src_region', 'ASIA'),
        ('primary_incident', 'dst_region', 'EUROPE'), ('primary_incident', 'start', '2024-01-10T12:20:00Z'), ('primary_incident', 'end', '2024-01-15T18:10:00Z'),
        ('primary_incident', 'fix_time', '2024-01-15T18:15:00Z'), ('primary_incident', 'affected_transaction_types[0]', 'type_0'),
        ('primary_incident', 'affected_transaction_types[1]', 'type_1'), ('generation', 'seed', '42'),
        ('generation', 'parameters.incident_burst_interval_minutes', '20'), ('generation', 'parameters.incident_burst_duration_minutes', '[4,7]')) t(section, key, value)
      UNION ALL SELECT 'confounders', '[' || name || '].' || f, v FROM conf, LATERAL (VALUES ('name', name), ('start', a), ('end', b), ('component', 'infra'),
        ('region', region), ('description', name)) x(f, v)
      UNION ALL SELECT 'generation', 'row_counts.tso_calls', CAST(count(*) AS VARCHAR) FROM calls
      UNION ALL SELECT 'generation', 'row_counts.txn_facts', CAST(count(*) AS VARCHAR) FROM facts
      UNION ALL SELECT 'tso_noise', 'total_calls', CAST(count(*) AS VARCHAR) FROM calls
      UNION ALL SELECT 'tso_noise', 'noise_counts.' || k, CAST(n AS VARCHAR) FROM per
      UNION ALL SELECT 'tso_noise', 'noise_rates.' || k, CAST(round(n / greatest(1, (SELECT count(*) FROM calls)), 4) AS VARCHAR) FROM per
      UNION ALL SELECT 'tso_noise', 'call_details[' || call_id || '].' || f, v FROM calls, LATERAL (VALUES ('call_id', call_id), ('true_transaction_id', true_txn),
        ('emitted_transaction_id', ref), ('noise_type', noise_type),
        ('delay_minutes', CAST(CAST(floor(date_diff('microsecond', txn_end_ts, call_ts) / 6e7) AS BIGINT) AS VARCHAR))) x(f, v)""",
    "csv_stream_ingest": "SELECT txn_id AS transaction_id, event, ts, ts::DATE AS day, lat AS end_to_end_latency_ms_f64 FROM logs",
    "sink_partitioned_table": "SELECT txn_id, event_no, event, region, ts, ts::DATE AS day, end_to_end_latency_ms FROM logs",
    "sink_csv_header": """SELECT txn_id AS transaction_id, CASE WHEN status <> 'timeout' THEN 'true' ELSE 'false' END AS success,
        CASE WHEN status <> 'timeout' THEN '' WHEN dep_region IS NOT NULL THEN 'DEP_TIMEOUT' ELSE 'ORCH_TIMEOUT' END AS error_code,
        end_ts AS end_dt, round(latency_ms, 2) AS end_to_end_latency_ms FROM facts""",
    "sink_json_report": "," + SHARDS + """, sec AS (SELECT * FROM (
        SELECT 'impacted_slice_volume' AS section, 1 AS row_no, unnest(['median_rpm', 'p95_rpm', 'max_rpm']) AS key,
               unnest([CAST(round(quantile_cont(n, 0.5), 4) AS VARCHAR), CAST(round(quantile_cont(n, 0.95), 4) AS VARCHAR), CAST(CAST(max(n) AS BIGINT) AS VARCHAR)]) AS value
        FROM (SELECT count(*)::DOUBLE AS n FROM logs WHERE event = 'received' AND region = 'ASIA' AND txn_type IN ('type_0', 'type_1') GROUP BY date_trunc('minute', ts))
        UNION ALL SELECT 'dataset_bounds', 1, unnest(['min_day', 'max_day']), unnest([CAST(min(ts::DATE) AS VARCHAR), CAST(max(ts::DATE) AS VARCHAR)]) FROM logs
        UNION ALL SELECT 'fix_verification', row_number() OVER (ORDER BY phase), unnest(['phase', 'p95_ms', 'p99_ms', 'timeout_rate', 'n']),
               unnest([phase, CAST(p95 AS VARCHAR), CAST(p99 AS VARCHAR), CAST(tr AS VARCHAR), CAST(n AS VARCHAR)]) FROM (
          SELECT CASE WHEN ts < TIMESTAMP '2024-01-15 18:15:00' THEN 'pre_fix' ELSE 'post_fix' END AS phase, round(quantile_cont(lat, 0.95), 4) AS p95,
                 round(quantile_cont(lat, 0.99), 4) AS p99, round(count(*) FILTER (event = 'timeout') / count(*)::DOUBLE, 4) AS tr, count(*) AS n
          FROM outcomes WHERE region = 'ASIA' GROUP BY 1)
        UNION ALL SELECT 'app_log_region_distribution', row_number() OVER (ORDER BY region), unnest(['region', 'rows']), unnest([region, CAST(n AS VARCHAR)])
        FROM (SELECT region, count(*) AS n FROM logs GROUP BY region)
        UNION ALL SELECT 'view_creation', row_number() OVER (ORDER BY region), unnest(['region', 'expected_shards', 'non_empty_shards', 'rows']),
               unnest([region, CAST(e AS VARCHAR), CAST(f AS VARCHAR), CAST(n AS VARCHAR)]) FROM (
          SELECT region, count(*) AS e, count(*) FILTER (rows > 0) AS f, CAST(sum(rows) AS BIGINT) AS n FROM shards GROUP BY region)
        UNION ALL SELECT 'tso_postload.missing', 1, unnest(['missing_rate', 'total']), unnest([CAST(round(count(*) FILTER (ref = '') / count(*)::DOUBLE, 4) AS VARCHAR), CAST(count(*) AS VARCHAR)]) FROM calls
        UNION ALL SELECT 'tso_postload.nonexistent', 1, 'nonexistent_rate', CAST(fp_rate_non_empty AS VARCHAR) FROM rates
        UNION ALL SELECT 'tso_postload.customer_mismatch', 1, 'mismatch_rate', CAST(wrong_link_rate_joined AS VARCHAR) FROM rates
        UNION ALL SELECT 'tso_postload.confusion_matrix', 1, unnest(['tp', 'fn', 'fp', 'wrong_link', 'fn_rate', 'fp_rate_non_empty', 'wrong_link_rate_joined', 'tp_rate']),
               unnest([CAST(tp AS VARCHAR), CAST(fn AS VARCHAR), CAST(fp AS VARCHAR), CAST(wrong_link AS VARCHAR), CAST(fn_rate AS VARCHAR), CAST(fp_rate_non_empty AS VARCHAR),
                       CAST(wrong_link_rate_joined AS VARCHAR), CAST(tp_rate AS VARCHAR)]) FROM rates
        UNION ALL SELECT 'incident_p95_multiplier', row_number() OVER (ORDER BY region), unnest(['region', 'p95_baseline', 'p95_incident', 'p95_multiplier']),
               unnest([region, CAST(round(b, 4) AS VARCHAR), CAST(round(d, 4) AS VARCHAR), CAST(round(d / b, 2) AS VARCHAR)]) FROM (
          SELECT region, quantile_cont(lat, 0.95) FILTER (ts < TIMESTAMP '2024-01-10 12:20:00') AS b,
                 quantile_cont(lat, 0.95) FILTER (ts >= TIMESTAMP '2024-01-10 12:20:00' AND ts < TIMESTAMP '2024-01-15 18:10:00') AS d FROM outcomes GROUP BY region)
        UNION ALL SELECT 'tier2.tables', row_number() OVER (ORDER BY table_name), unnest(['table_name', 'present', 'rows']),
               unnest([table_name, CAST(present AS VARCHAR), CAST(rows AS VARCHAR)]) FROM (
          SELECT 'service_metrics' AS table_name, true AS present, count(*) AS rows FROM (SELECT DISTINCT date_trunc('minute', start_ts), region, txn_type FROM facts)
          UNION ALL SELECT 'network_events', true, count(*) FROM net_events UNION ALL SELECT 'txn_facts', true, count(*) FROM facts
          UNION ALL SELECT 'circuit_inventory', false, 0)
        UNION ALL SELECT 'top_circuit_uplift', row_number() OVER (ORDER BY round(d / b, 2) DESC NULLS LAST, circuit_id), unnest(['circuit_id', 'src', 'dst', 'p95_baseline', 'p95_incident', 'p95_multiplier']),
               unnest([circuit_id, 'ASIA', 'EUROPE', CAST(round(b, 4) AS VARCHAR), CAST(round(d, 4) AS VARCHAR), CAST(round(d / b, 2) AS VARCHAR)]) FROM (
          SELECT circuit_id, quantile_cont(value, 0.95) FILTER (ts < TIMESTAMP '1998-06-01') AS b,
                 quantile_cont(value, 0.95) FILTER (ts >= TIMESTAMP '1998-06-01' AND ts < TIMESTAMP '2000-01-01') AS d
          FROM circuit_metrics WHERE src = 'ASIA' AND dst = 'EUROPE' GROUP BY circuit_id ORDER BY round(d / b, 2) DESC NULLS LAST, circuit_id LIMIT 5)))
      SELECT section, CAST(row_no AS INT) AS row_no, key, value FROM sec""",
    "compat_views": " UNION ALL ".join(
        f"SELECT '{n}' AS view_name, count(*) AS rows FROM {t}"
        for n, t in [("legacy_app_logs", "logs"), ("trace_spans", "spans"), ("network_circuit_metrics", "circuit_metrics"),
                     ("infra_host_metrics", "hosts"), ("tso_calls", "calls")]),
    "view_alias": "SELECT region, count(*) AS rows FROM logs GROUP BY region",
    "view_region_shards": "SELECT region, count(*) AS rows FROM logs GROUP BY region",
    "view_daily_shards": "," + SHARDS + " SELECT region, day, rows FROM shards",
    "shard_inventory": "," + SHARDS + """ SELECT region, count(*) AS expected_shards, count(*) FILTER (rows > 0) AS non_empty_shards,
        CAST(sum(rows) AS BIGINT) AS rows FROM shards GROUP BY region""",
    "table_presence_rows": """SELECT 'service_metrics' AS table_name, true AS present, count(*) AS rows FROM (SELECT DISTINCT date_trunc('minute', start_ts), region, txn_type FROM facts)
        UNION ALL SELECT 'network_events', true, count(*) FROM net_events UNION ALL SELECT 'txn_facts', true, count(*) FROM facts
        UNION ALL SELECT 'circuit_inventory', false, 0""",
    # streams
    "stream_service_kpi": """
        SELECT date_trunc('minute', start_ts) AS ts, region, txn_type, count(*) AS n, count(*) FILTER (status = 'timeout') AS errors,
               count(*) FILTER (retry_count > 0) AS retries, quantile_disc(latency_ms, 0.95) AS p95_ms FROM facts GROUP BY ALL""",
    "stream_call_link": """SELECT call_id, txn_id, CAST(floor(date_diff('microsecond', f.end_ts, call_ts) / 6e7) AS BIGINT) AS delay_min FROM calls c JOIN facts f
        ON c.ref = f.txn_id AND c.customer_id = f.customer_id AND call_ts BETWEEN f.end_ts AND f.end_ts + INTERVAL 2 HOUR""",
    "stream_dedup": "SELECT call_id, region, call_ts, noise_type FROM calls",
    "stream_noise_counters": "SELECT region, noise_type, count(*) AS calls FROM calls GROUP BY ALL",
    "stream_sliding_lookback": """SELECT ts, region, count(*) AS n FROM (SELECT region, time_bucket(INTERVAL 10 MINUTE, start_ts) - to_minutes(CAST(10 * i AS INT)) AS ts FROM facts, range(12) t(i))
      GROUP BY ALL""",
    "stream_burst_sessions": """, b AS (SELECT * FROM samples WHERE value > 60),
      s AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM b WINDOW w AS (PARTITION BY circuit_id ORDER BY ts)),
      g AS (SELECT *, sum(fresh) OVER (PARTITION BY circuit_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS id FROM s)
      SELECT circuit_id, min(ts) AS start_ts, max(ts) + INTERVAL 6 HOUR AS end_ts, count(*) AS n, max(value) AS peak FROM g GROUP BY circuit_id, id""",
    "stream_late_rows": """, s AS (SELECT call_ts, max(call_ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM calls)
      SELECT count(*) FILTER (call_ts >= peak - INTERVAL 30 MINUTE OR peak IS NULL) AS on_time, count(*) FILTER (call_ts < peak - INTERVAL 30 MINUTE) AS late FROM s""",
    # sets
    "distinct_received_txn": "SELECT DISTINCT txn_id AS transaction_id FROM logs WHERE event = 'received'",
    "txn_set_diff": """, a AS (SELECT DISTINCT ref AS id FROM calls WHERE ref <> ''), b AS (SELECT DISTINCT txn_id AS id FROM logs)
      SELECT 'calls_only' AS side, count(*) AS ids FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'both', count(*) FROM (FROM a INTERSECT FROM b)
      UNION ALL SELECT 'logs_only', count(*) FROM (FROM b EXCEPT FROM a)""",
}


def oracle_sql() -> dict[str, str]:
    return {k: (PRELUDE + v if v.lstrip().startswith(",") else PRELUDE + "\n" + v) for k, v in QUERIES.items()}
