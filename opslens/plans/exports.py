"""The role tables in the column layout of the telemetry files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.functions.scalars import text_or_empty
from opslens.operators import rollups, shape, windows
from opslens.plans import roles
from opslens.sources.schemas import TABLES


def iso_seconds(ts: str):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def text(c):
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def app_logs(s: SparkSession, d: str) -> DataFrame:
    logs = roles.logs(s, d, spread=True)
    return logs.select(
        shape.iso_micros("ts").alias("timestamp"), "region", F.concat(F.lit("prod-"), F.lower("region")).alias("cluster"), "service",
        F.concat(F.lit("host-"), (F.col("customer_id") % 48).cast("string")).alias("host"), "level", F.col("txn_id").alias("transaction_id"),
        F.col("txn_id").alias("trace_id"), F.concat("txn_id", F.lit("/"), F.col("event_no").cast("string")).alias("span_id"),
        text("customer_id").alias("customer_id"), F.col("txn_type").alias("transaction_type"), "event",
        text_or_empty("dep_region").alias("dependency_region"),
        F.when(F.col("dep_region").isNotNull(), "inventory-client").otherwise("").alias("dependency_service"),
        text("dependency_latency_ms").alias("dependency_latency_ms"), text("end_to_end_latency_ms").alias("end_to_end_latency_ms"),
        "http_status", "error_code", text_or_empty("circuit_id").alias("circuit_id"), "message",
    )


def trace_spans(s: SparkSession, d: str) -> DataFrame:
    def sid(c):
        return F.concat("trace_id", F.lit("/"), F.col(c).cast("string"))

    return roles.spans(s, d, spread=True).select(
        shape.iso_micros("ts").alias("timestamp"), "trace_id", sid("span_no").alias("span_id"), F.coalesce(sid("parent_no"), F.lit("")).alias("parent_span_id"),
        F.col("txn_id").alias("transaction_id"), "region", "service", F.col("service").alias("operation"), "duration_ms", "status", "circuit_id",
    )


def network_circuit_metrics(s: SparkSession, d: str) -> DataFrame:
    return roles.circuit_metrics(s, d).select(
        iso_seconds("ts").alias("timestamp"), F.col("src").alias("src_region"), F.col("dst").alias("dst_region"), "circuit_id",
        F.col("value").alias("rtt_ms"), *[F.lit(0.0).alias(c) for c in ("packet_loss_pct", "retransmits_per_s", "throughput_mbps")],
    )


def infra_host_metrics(s: SparkSession, d: str) -> DataFrame:
    return roles.host_metrics(s, d).select(
        iso_seconds("ts").alias("timestamp"), "region", text("host").alias("host"), F.col("cpu").alias("cpu_pct"),
        *[F.lit(0.0).alias(c) for c in ("mem_pct", "disk_io_util_pct", "net_errs_per_s")],
    )


def tso_calls(s: SparkSession, d: str) -> DataFrame:
    return roles.calls(s, d).select(
        "call_id", iso_seconds("call_ts").alias("timestamp"), text("customer_id").alias("customer_id"), F.col("region").alias("customer_region"),
        "issue_category", F.concat(F.lit("customer reports "), "issue_category").alias("issue_description"), F.lit("").alias("service_type"),
        F.col("ref").alias("transaction_id"), F.col("resolution_min").alias("resolution_time_minutes"), text("escalated").alias("escalated"),
        F.when(F.col("escalated"), "manual_intervention").otherwise("system_resolved").alias("resolution_code"),
    )


def service_metrics(s: SparkSession, d: str) -> DataFrame:
    return rollups.service_kpi(roles.facts(s, d)).select(
        iso_seconds("ts").alias("timestamp"), "region", F.col("txn_type").alias("transaction_type"), "request_rate", "error_rate",
        F.col("p95_ms").alias("p95_latency_ms"), F.col("p99_ms").alias("p99_latency_ms"), "saturation",
    )


def network_events(s: SparkSession, d: str) -> DataFrame:
    return windows.event_numbering(shape.severity_normalise(roles.net_events(s, d), roles.INCIDENT_CIRCUIT)).select(
        F.col("event_key").alias("event_id"), iso_seconds("ts").alias("timestamp"), "event_type", F.col("src").alias("src_region"),
        F.col("dst").alias("dst_region"), "circuit_id", "severity", "description",
    )


def txn_facts(s: SparkSession, d: str) -> DataFrame:
    f = shape.txn_fact_projection(roles.facts(s, d))
    return f.withColumn("customer_id", text("customer_id"))


EXPORTS = {
    "app_logs": app_logs, "trace_spans": trace_spans, "network_circuit_metrics": network_circuit_metrics,
    "infra_host_metrics": infra_host_metrics, "tso_calls": tso_calls, "service_metrics": service_metrics,
    "network_events": network_events, "txn_facts": txn_facts,
}
assert set(EXPORTS) == set(TABLES)
