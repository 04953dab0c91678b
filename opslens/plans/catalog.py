"""Every operator bound to the role tables: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.functions.quantiles import exact_quantiles
from opslens.functions.scalars import grid_floor, is_absent, ntz
from opslens.operators import joins, rollups, shape, windows
from opslens.plans import report, roles
from opslens.plans.io_catalog import IO, logs_by_day

TYPES, EVENTS, FOCUS = roles.FOCUS_TYPES, shape.OUTCOME_EVENTS, roles.FOCUS_REGION
DAY = "2024-01-12"
DELAY_EDGES = (5, 15, 30, 60, 90, 120)
SPIKE_FACTOR = 1.8
RECOVERY_FACTOR = 0.5

Query = Callable[[SparkSession, str], DataFrame]


def _focus_outcomes(s, d):
    return shape.impacted_slice(roles.logs(s, d), FOCUS, TYPES, EVENTS)


def _classified(s, d):
    return joins.link_classes(roles.calls(s, d), roles.logs(s, d))


def _confusion(s, d):
    return joins.link_confusion_matrix(roles.calls(s, d), roles.logs(s, d))


def day_slice(s, d):
    return shape.day_slice(logs_by_day(s, d), FOCUS, DAY).select("txn_id", "event_no", "event", "ts", "day")


def shard_p95_timeout(s, d):
    return rollups.shard_p95_timeout(shape.day_slice(logs_by_day(s, d), FOCUS, DAY), TYPES, EVENTS)


def time_spine(s, d):
    hosts = roles.host_metrics(s, d)
    slots = hosts.groupBy("region", grid_floor("ts", 300).alias("ts")).agg(F.max("cpu").alias("value"))
    first, last = rollups.day_span(hosts).first()
    start, end = (str(first), str(last + timedelta(days=1))) if first else ("1970-01-01", "1970-01-01")
    return shape.time_spine_densify(slots, roles.regions(s, d), "region", "ts", "value", start, end, 300)


def coherence(s, d):
    return rollups.incident_coherence(roles.flagged(s, d), roles.circuit_samples(s, d), roles.windows(s), FOCUS, roles.INCIDENT_CIRCUIT)


def separability(s, d):
    _, region, start, end, _ = roles.CONFOUNDERS[0]
    return rollups.confounder_separability(roles.host_metrics(s, d), roles.circuit_samples(s, d), region, roles.INCIDENT_CIRCUIT, ntz(start), ntz(end))


def referential(s, d):
    return joins.span_referential_check(roles.spans(s, d), roles.calls(s, d), roles.facts(s, d))


def alert_quality(s, d):
    return rollups.alert_quality(roles.alerts(s, d), roles.windows(s))


def validation_summary(s, d):
    return report.validation_summary(referential(s, d), coherence(s, d), separability(s, d), alert_quality(s, d))


def table_row_counts(s, d):
    return rollups.table_row_counts({
        "txn_facts": roles.facts(s, d), "app_logs": roles.logs(s, d), "trace_spans": roles.spans(s, d), "tso_calls": roles.calls(s, d),
        "network_circuit_metrics": roles.circuit_metrics(s, d), "infra_host_metrics": roles.host_metrics(s, d), "network_events": roles.net_events(s, d),
    })


def nearest_rank(s, d):
    f = roles.facts(s, d).select(grid_floor("start_ts", 3600).alias("ts"), "region", "latency_ms", "seq")
    return windows.nearest_rank_window(f, ["ts", "region"], "latency_ms", 0.95, ["seq"])


def recovery_time(s, d):
    f = roles.facts(s, d)
    hourly = exact_quantiles(f.select(grid_floor("start_ts", 3600).alias("ts"), "region", "latency_ms"), ["ts", "region"], "latency_ms", {"p95_ms": 0.95})
    before = f.where(F.col("start_ts") < ntz(roles.INCIDENT_START))
    base = exact_quantiles(before, ["region"], "latency_ms", {"p95_baseline": 0.95})
    return windows.recovery_time(hourly, base, ntz(roles.FIX_TIME), RECOVERY_FACTOR)


def txn_set_diff(s, d):
    """Ids present on one side or both: one aggregate instead of three set operations."""
    calls = roles.calls(s, d).where(~is_absent("ref")).select(F.col("ref").alias("id"), F.lit(1).alias("c"), F.lit(0).alias("l"))
    logs = roles.logs(s, d).select(F.col("txn_id").alias("id"), F.lit(0).alias("c"), F.lit(1).alias("l"))
    sides = calls.unionByName(logs).groupBy("id").agg(F.max("c").alias("c"), F.max("l").alias("l"))
    counts = sides.agg(
        F.count_if((F.col("c") == 1) & (F.col("l") == 0)).alias("calls_only"),
        F.count_if((F.col("c") == 1) & (F.col("l") == 1)).alias("both"), F.count_if((F.col("c") == 0) & (F.col("l") == 1)).alias("logs_only"),
    )
    return counts.select(F.expr("stack(3, 'calls_only', calls_only, 'both', both, 'logs_only', logs_only) AS (side, ids)"))


BATCH: dict[str, Query] = {
    "impacted_slice": lambda s, d: _focus_outcomes(s, d).select("txn_id", "event_no", "event", "service", "ts", "level", "end_to_end_latency_ms"),
    "day_slice": day_slice,
    "txn_fact_projection": lambda s, d: shape.txn_fact_projection(roles.facts(s, d)),
    "status_normalise": lambda s, d: shape.status_normalise(roles.facts(s, d)).select("txn_id", "status", "event", "level", "http_status", "error_code", "message"),
    "severity_normalise": lambda s, d: shape.severity_normalise(roles.net_events(s, d), roles.INCIDENT_CIRCUIT).select("seq", "event_type", "severity", "description"),
    "pre_post_label": lambda s, d: shape.pre_post_label(_focus_outcomes(s, d), "ts", ntz(roles.FIX_TIME)).select("txn_id", "ts", "phase"),
    "impacted_flags": lambda s, d: roles.flagged(s, d).select("txn_id", "impacted_by_primary", "impacted_by_confounder", "confounder_label"),
    "txn_key_build_parse": lambda s, d: shape.txn_key_build_parse(roles.facts(s, d)),
    "lifecycle_explode": lambda s, d: roles.logs(s, d).select(
        "txn_id", "event_no", "event", "service", "ts", "level", "attempt", "dependency_latency_ms", "end_to_end_latency_ms"),
    "span_explode": lambda s, d: roles.spans(s, d).select("trace_id", "span_no", "parent_no", "service", "duration_ms", "status", "circuit_id"),
    "txn_rebuild": lambda s, d: shape.txn_rebuild(roles.logs(s, d)),
    "time_spine_densify": time_spine,
    "route_matrix": lambda s, d: shape.route_matrix(roles.facts(s, d), roles.regions(s, d)),
    "burst_membership": lambda s, d: joins.burst_membership(roles.facts(s, d), "start_ts", roles.windows(s)).select("txn_id", "window_id"),
    "confounder_first_match": lambda s, d: joins.confounder_first_match(roles.facts(s, d), "start_ts", "region", roles.confounders(s)).select("txn_id", "label"),
    "link_confusion_matrix": _confusion,
    "link_nonexistent_rate": lambda s, d: joins.link_nonexistent_rate(roles.calls(s, d), roles.logs(s, d)),
    "link_mismatch_rate": lambda s, d: joins.link_mismatch_rate(roles.calls(s, d), roles.logs(s, d)),
    "decoy_candidates": lambda s, d: joins.decoy_candidates(roles.calls(s, d), roles.facts(s, d)),
    "circuit_consistency": lambda s, d: joins.circuit_consistency(roles.facts(s, d), roles.circuits(s, d)),
    "span_referential_check": referential,
    "call_delay": lambda s, d: joins.call_delay(roles.calls(s, d), roles.facts(s, d), DELAY_EDGES),
    "truth_scoring": lambda s, d: joins.truth_scoring(_classified(s, d)),
    "clock_skew": lambda s, d: joins.clock_skew(roles.logs(s, d), roles.spans(s, d)),
    "skew_corrected_logs": lambda s, d: joins.skew_corrected_logs(roles.logs(s, d), roles.spans(s, d)).select("txn_id", "event_no", "corrected_ts"),
    "span_tree": lambda s, d: joins.span_tree(roles.spans(s, d)),
    "event_asof_metric": lambda s, d: joins.event_asof_metric(
        roles.circuit_samples(s, d), roles.net_events(s, d), "circuit_id", "sample_id", "seq").drop("src", "dst"),
    "signal_timeline": lambda s, d: joins.signal_timeline(
        roles.facts(s, d), roles.circuit_samples(s, d), roles.host_metrics(s, d), roles.calls(s, d)),
    "region_distribution": lambda s, d: rollups.region_distribution(roles.logs(s, d), roles.REGION_WEIGHTS),
    "day_span": lambda s, d: rollups.day_span(roles.logs(s, d)),
    "p95_by_region": lambda s, d: rollups.p95_by_region(roles.logs(s, d), TYPES, EVENTS),
    "shard_p95_timeout": shard_p95_timeout,
    "impacted_volume": lambda s, d: rollups.impacted_volume(shape.impacted_slice(roles.logs(s, d), FOCUS, TYPES, ["received"])),
    "fix_verification": lambda s, d: rollups.fix_verification(_focus_outcomes(s, d), ntz(roles.FIX_TIME)),
    "incident_multiplier": lambda s, d: rollups.incident_multiplier(rollups.impacted(roles.logs(s, d), TYPES, EVENTS), ntz(roles.INCIDENT_START), ntz(roles.INCIDENT_END)),
    "top_circuit_uplift": lambda s, d: rollups.top_circuit_uplift(
        roles.circuit_metrics(s, d), FOCUS, "EUROPE", ntz(roles.SPLIT_DATE), ntz(roles.SPLIT_END)),
    "link_missing_rate": lambda s, d: rollups.link_missing_rate(roles.calls(s, d)),
    "service_kpi_minute": lambda s, d: rollups.service_kpi(roles.facts(s, d)),
    "incident_coherence": coherence,
    "confounder_separability": separability,
    "host_peak": lambda s, d: rollups.host_peak(roles.host_metrics(s, d)),
    "host_peak_in_windows": lambda s, d: rollups.host_peak_in_windows(roles.host_metrics(s, d), roles.windows(s)),
    "call_stats": lambda s, d: rollups.call_stats(roles.calls(s, d), roles.flagged(s, d)),
    "table_row_counts": table_row_counts,
    "alert_quality": alert_quality,
    "circuits_per_route": lambda s, d: rollups.circuits_per_route(roles.circuits(s, d)),
    "seasonal_profile": lambda s, d: rollups.seasonal_profile(roles.facts(s, d)),
    "call_rate_by_segment": lambda s, d: rollups.call_rate_by_segment(roles.flagged(s, d), roles.calls(s, d), FOCUS),
    "band_check": lambda s, d: rollups.band_check(_confusion(s, d)),
    "tail_summary": lambda s, d: rollups.tail_summary(roles.facts(s, d)),
    "dependency_share": lambda s, d: rollups.dependency_share(roles.facts(s, d)),
    "validation_summary": validation_summary,
    "quality_cube": lambda s, d: rollups.quality_cube(_classified(s, d)),
    "running_noise_rate": lambda s, d: windows.running_noise_rate(roles.calls(s, d), ["region"]),
    "spike_islands": lambda s, d: windows.spike_islands(
        roles.circuit_metrics(s, d), "circuit_id", ["ts", "l_orderkey", "l_linenumber", "l_partkey", "value"], SPIKE_FACTOR),
    "nearest_rank_window": nearest_rank,
    "event_numbering": lambda s, d: windows.event_numbering(roles.net_events(s, d)).select("event_key", "seq", "ts", "event_type", "circuit_id"),
    "arrival_disorder": lambda s, d: windows.arrival_disorder(roles.calls(s, d), "seq", "call_ts"),
    "lookback_2h": lambda s, d: windows.lookback_count(roles.facts(s, d), "region", "start_ts", "end_ts"),
    "attempt_sequence": lambda s, d: windows.attempt_sequence(roles.logs(s, d)),
    "recovery_time": recovery_time,
    "distinct_received_txn": lambda s, d: roles.logs(s, d).where(F.col("event") == "received").select(F.col("txn_id").alias("transaction_id")).distinct(),
    "txn_set_diff": txn_set_diff,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BATCH["signal_timeline"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return BATCH | IO
