"""Declared schemas, derived columns and layout of the telemetry tables."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    columns: str
    times: dict[str, str]
    numbers: tuple[str, ...] = ()
    sort_keys: tuple[str, ...] = ()
    bloom: tuple[str, ...] = field(default_factory=tuple)


# Column names in file order, their types, and each table's sort key.
TABLES = {
    "app_logs": TableSpec(
        "timestamp string, region string, cluster string, service string, host string, level string, transaction_id string, "
        "trace_id string, span_id string, customer_id string, transaction_type string, event string, dependency_region string, "
        "dependency_service string, dependency_latency_ms string, end_to_end_latency_ms string, http_status string, "
        "error_code string, circuit_id string, message string",
        {"timestamp": "ts"}, ("end_to_end_latency_ms",),
        ("region", "transaction_type", "event", "ts", "transaction_id"), ("transaction_id", "trace_id"),
    ),
    "trace_spans": TableSpec(
        "timestamp string, trace_id string, span_id string, parent_span_id string, transaction_id string, region string, "
        "service string, operation string, duration_ms double, status string, circuit_id string",
        {"timestamp": "ts"}, (), ("ts", "trace_id", "span_id"),
    ),
    "network_circuit_metrics": TableSpec(
        "timestamp string, src_region string, dst_region string, circuit_id string, rtt_ms double, packet_loss_pct double, "
        "retransmits_per_s double, throughput_mbps double",
        {"timestamp": "ts"}, (), ("circuit_id", "ts"),
    ),
    "infra_host_metrics": TableSpec(
        "timestamp string, region string, host string, cpu_pct double, mem_pct double, disk_io_util_pct double, net_errs_per_s double",
        {"timestamp": "ts"}, (), ("host", "ts"),
    ),
    "tso_calls": TableSpec(
        "call_id string, timestamp string, customer_id string, customer_region string, issue_category string, "
        "issue_description string, service_type string, transaction_id string, resolution_time_minutes int, escalated string, "
        "resolution_code string",
        {"timestamp": "ts"}, (), ("ts", "call_id"),
    ),
    "service_metrics": TableSpec(
        "timestamp string, region string, transaction_type string, request_rate double, error_rate double, "
        "p95_latency_ms double, p99_latency_ms double, saturation double",
        {"timestamp": "ts"}, (), ("region", "transaction_type", "ts"),
    ),
    "network_events": TableSpec(
        "event_id string, timestamp string, event_type string, src_region string, dst_region string, circuit_id string, "
        "severity string, description string",
        {"timestamp": "ts"}, (), ("ts", "event_id"),
    ),
    "txn_facts": TableSpec(
        "transaction_id string, customer_id string, origin_region string, txn_type string, start_ts string, end_ts string, "
        "success string, error_code string, end_to_end_latency_ms double",
        {"start_ts": "start_dt", "end_ts": "end_dt"}, (), ("origin_region", "txn_type", "start_dt", "transaction_id"),
    ),
}
# Fixed value: prefix of the table files.
FILE_PREFIX = "clickhouse-"

TRUTH_SCHEMA = """
    dataset_name string, time_range struct<start: string, end: string>,
    primary_incident struct<root_cause_type: string, circuit_id: string, src_region: string, dst_region: string,
        start: string, end: string, fix_time: string, affected_transaction_types: array<string>>,
    confounders array<struct<name: string, start: string, end: string, component: string, region: string,
        description: string>>,
    generation struct<seed: bigint, row_counts: map<string, bigint>, parameters: map<string, string>>,
    tso_noise struct<total_calls: bigint, noise_counts: map<string, bigint>, noise_rates: map<string, double>,
        call_details: array<struct<call_id: string, true_transaction_id: string, emitted_transaction_id: string,
            noise_type: string, delay_minutes: bigint>>>
"""
