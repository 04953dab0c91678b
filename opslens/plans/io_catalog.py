"""Sources, sinks, views and streams bound to the role tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.functions.scalars import ntz
from opslens.operators import joins, rollups, shape, views
from opslens.plans import exports, report, roles
from opslens.session import frozen, scratch_path, shuffles_freed
from opslens.sources import csv_tables, sinks, truth
from opslens.sources.schemas import FILE_PREFIX, TABLES
from opslens.streaming import streams

LATENESS_SECONDS = 1800
#: Rows of a compressed text file at most, about 40 MB of text.
FILE_ROWS = 200_000
# Parameters recorded in the truth document.
PARAMETERS = {"incident_burst_interval_minutes": 20, "incident_burst_duration_minutes": [4, 7]}
BURST_MS = 60.0


# Tables with the names they had before, and the roles that fill them.
OLD_NAMES = {
    "app_logs": ("legacy_app_logs", roles.logs), "trace_spans": ("trace_spans", roles.spans),
    "network_circuit_metrics": ("network_circuit_metrics", roles.circuit_metrics), "infra_host_metrics": ("infra_host_metrics", roles.host_metrics),
    "tso_calls": ("tso_calls", roles.calls),
}


def _csv(s: SparkSession, d: str, table: str, folder: str | None = None, **how) -> str:
    path = f"{folder or scratch_path(s, 'csv')}/{FILE_PREFIX}{table}.csv"
    sinks.sink_csv_header(exports.EXPORTS[table](s, d), path, **how)
    return path


def ingest_csv_typed(s, d):
    df = csv_tables.ingest_csv_typed(s, _csv(s, d, "app_logs"), TABLES["app_logs"].columns)
    return df.select("transaction_id", "event", "timestamp", "level", "customer_id", "dependency_latency_ms", "circuit_id")


def ingest_directory(s, d):
    folder, home = scratch_path(s, "inbox"), scratch_path(s, "tables")
    with shuffles_freed(s), ThreadPoolExecutor(csv_tables.AT_ONCE) as pool:  # all of their text lies there before the first is loaded
        list(pool.map(lambda table: _csv(s, d, table, folder, compression="gzip", max_rows=FILE_ROWS), TABLES))
    database = "ops_" + home.rsplit("-", 1)[1]
    s.sql(f"CREATE DATABASE {database} LOCATION '{home}'")
    return csv_tables.ingest_directory(s, folder, database, home)


def derive_ingest_columns(s, d):
    df = csv_tables.read_table(s, _csv(s, d, "app_logs"), "app_logs")
    return df.select("transaction_id", "event", "ts", "end_to_end_latency_ms_f64")


def read_ground_truth(s, d):
    out = scratch_path(s, "truth")
    sinks.sink_truth(roles.calls(s, d), _confounder_docs(), _incident_doc(), out)
    return truth.call_details(truth.read_truth(s, out, lines=True))


def truth_sections(s, d):
    out, calls = scratch_path(s, "truth"), frozen(roles.calls(s, d))
    rows = {"tso_calls": calls.count(), "txn_facts": roles.facts(s, d).count()}
    about = {
        "dataset_name": "telemetry", "time_range": {"start": "2024-01-01T00:00:00Z", "end": "2024-01-31T00:00:00Z"},
        "generation": {"seed": 42, "row_counts": rows, "parameters": PARAMETERS},
    }
    sinks.sink_truth(calls, _confounder_docs(), _incident_doc() | {"affected_transaction_types": list(roles.FOCUS_TYPES)}, out, about=about)
    return truth.flatten(truth.read_truth(s, out, lines=True), truth.IDS)


def _incident_doc():
    def iso(t):
        return t.replace(" ", "T") + "Z"

    return {
        "root_cause_type": "network", "circuit_id": "CKT-ASI-EUR-0", "src_region": "ASIA", "dst_region": "EUROPE",
        "start": iso(roles.INCIDENT_START), "end": iso(roles.INCIDENT_END), "fix_time": iso(roles.FIX_TIME),
    }


def _confounder_docs():
    return [
        {"name": n, "start": a.replace(" ", "T") + "Z", "end": b.replace(" ", "T") + "Z", "component": "infra", "region": r, "description": n}
        for n, r, a, b, _ in roles.CONFOUNDERS
    ]


def csv_stream_ingest(s, d):
    home = scratch_path(s, "loaded")
    done = csv_tables.load_stream(s, _csv(s, d, "app_logs"), "app_logs", f"{home}/rows", quarantine=f"{home}/bad")
    return done.select("transaction_id", "event", "ts", "day", "end_to_end_latency_ms_f64")


def partitioned_logs(s, d, out: str | None = None) -> DataFrame:
    dated = roles.logs(s, d).withColumn("day", F.to_date("ts"))
    return sinks.sink_partitioned_table(
        dated, out or scratch_path(s, "logs"), "day", ["region", "txn_type", "event", "ts", "txn_id"], ["txn_id"]
    )


_logs_tables: dict[tuple[str, str], str] = {}


def logs_by_day(s, d) -> DataFrame:
    """The log table as ``partitioned_logs`` writes it, written at the first use in an application; readers prune by day."""
    key = (s.sparkContext.applicationId, d)
    if key not in _logs_tables:
        path = scratch_path(s, "logs")
        partitioned_logs(s, d, path)
        _logs_tables[key] = path
    return s.read.parquet(_logs_tables[key])


def sink_csv_header(s, d):
    df = csv_tables.read_table(s, _csv(s, d, "txn_facts"), "txn_facts")
    return df.select("transaction_id", "success", "error_code", "end_dt", "end_to_end_latency_ms")


def report_sections(s, d) -> dict[str, tuple[DataFrame, list]]:
    """Each section's rows and their order. All read the same two tables, so these are written once and then scanned by column."""
    logs = frozen(roles.logs(s, d).select("txn_id", "customer_id", "region", "txn_type", "event", "ts", "end_to_end_latency_ms"))
    calls = frozen(roles.calls(s, d).select("call_id", "customer_id", "ref"))
    start, end = ntz(roles.INCIDENT_START), ntz(roles.INCIDENT_END)
    focus = shape.impacted_slice(logs, roles.FOCUS_REGION, roles.FOCUS_TYPES, shape.OUTCOME_EVENTS)
    received = shape.impacted_slice(logs, roles.FOCUS_REGION, roles.FOCUS_TYPES, ["received"])
    uplift = rollups.top_circuit_uplift(
        roles.circuit_metrics(s, d), roles.FOCUS_REGION, "EUROPE", ntz(roles.SPLIT_DATE), ntz(roles.SPLIT_END))
    return {
        "impacted_slice_volume": (rollups.impacted_volume(received), []),
        "dataset_bounds": (rollups.day_span(logs), []),
        "fix_verification": (rollups.fix_verification(focus, ntz(roles.FIX_TIME)), ["phase"]),
        "app_log_region_distribution": (rollups.region_distribution(logs, roles.REGION_WEIGHTS).select("region", "rows"), ["region"]),
        "view_creation": (views.shard_inventory(logs.withColumn("day", F.to_date("ts")), roles.regions(s, d)), ["region"]),
        "tso_postload.missing": (rollups.link_missing_rate(calls), []),
        "tso_postload.nonexistent": (joins.link_nonexistent_rate(calls, logs), []),
        "tso_postload.customer_mismatch": (joins.link_mismatch_rate(calls, logs), []),
        "tso_postload.confusion_matrix": (joins.link_confusion_matrix(calls, logs), []),
        "incident_p95_multiplier": (rollups.incident_multiplier(
            rollups.impacted(logs, roles.FOCUS_TYPES, shape.OUTCOME_EVENTS), start, end), ["region"]),
        "top_circuit_uplift": (uplift, [F.col("p95_multiplier").desc_nulls_last(), "circuit_id"]),
        "tier2.tables": (table_presence_rows(s, d), ["table_name"]),
    }


def sink_json_report(s, d):
    return report.write_json_report(report_sections(s, d), scratch_path(s, "report"))


def view_alias(s, d):
    alias = views.view_alias(roles.logs(s, d), "legacy_app_logs")
    return alias.groupBy("region").agg(F.count(F.lit(1)).alias("rows"))


def compat_views(s, d):
    """Tables of a database of their own, read under their old names through views in the preferred database."""
    home = scratch_path(s, "compat")
    own, old = (f"{p}_{home.rsplit('-', 1)[1]}" for p in ("ops", "logs"))
    for database in (own, old):
        s.sql(f"CREATE DATABASE {database} LOCATION '{home}/{database}'")
    sources = {}
    for name, (alias, role) in OLD_NAMES.items():
        role(s, d).write.parquet(f"{home}/{name}")
        s.sql(f"CREATE TABLE {own}.{name} USING parquet LOCATION '{home}/{name}'")
        sources[alias] = f"{own}.{name}"
    found = views.compat_views(s, sources, wanted=old)
    rows = [s.table(view).agg(F.lit(alias).alias("view_name"), F.count(F.lit(1)).alias("rows")) for alias, view in found.items()]
    out = reduce(DataFrame.unionByName, rows)
    for database in (own, old):  # the rows stay where they are; nothing of the names is left behind
        s.sql(f"DROP DATABASE {database} CASCADE")
    return out


def view_region_shards(s, d):
    names = views.region_views(roles.logs(s, d), [r.region for r in roles.regions(s, d).collect()])
    return views.rows_through_region_views(s, names)


def view_daily_shards(s, d):
    return views.daily_shards(logs_by_day(s, d), roles.regions(s, d))


def table_presence_rows(s, d):
    for name in ("service_metrics", "network_events", "txn_facts"):
        exports.EXPORTS[name](s, d).createOrReplaceTempView(name)
    return views.table_presence_rows(s, ["service_metrics", "network_events", "txn_facts", "circuit_inventory"])


def _streamed(s, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(s, name)
    df.write.parquet(path)
    return streams.read_stream(s, df, path)


def stream_service_kpi(s, d):
    f = roles.facts(s, d).select("start_ts", "region", "txn_type", "status", "retry_count", "latency_ms")
    return streams.as_zone_free(streams.run_closed(
        streams.stream_service_kpi(_streamed(s, f, "facts")), "kpi", ["ts", "region", "txn_type"]))


def stream_call_link(s, d):
    known = frozen(roles.calls(s, d).select("call_id", "ref", "customer_id", "call_ts"))
    txns = _streamed(s, roles.facts(s, d).select("txn_id", "customer_id", "end_ts"), "txns")
    linked = streams.stream_call_link(_streamed(s, known, "calls"), txns, hot=streams.hot_references(known))
    return streams.run_append(linked, "call-link")


def stream_dedup(s, d):
    """Escalated calls arrive twice and must leave once."""
    calls = roles.calls(s, d).select("call_id", "region", "call_ts", "noise_type", "escalated")
    sent = calls.unionByName(calls.where("escalated")).drop("escalated")
    return streams.as_zone_free(streams.run_append(streams.stream_dedup(_streamed(s, sent, "calls"), ["call_id"]), "dedup"))


def stream_noise_counters(s, d):
    return streams.run_noise_counters(_streamed(s, roles.calls(s, d).select("region", "noise_type"), "calls"))


def stream_sliding_lookback(s, d):
    f = _streamed(s, roles.facts(s, d).select("start_ts", "region"), "facts")
    return streams.as_zone_free(streams.run_closed(streams.stream_sliding_lookback(f), "lookback", ["ts", "region"]))


def stream_burst_sessions(s, d):
    m = _streamed(s, roles.circuit_samples(s, d).select("circuit_id", "ts", "value"), "samples")
    return streams.as_zone_free(streams.run_sessions(
        streams.stream_burst_sessions(m, "circuit_id", "6 hours", BURST_MS), "sessions", lambda state: streams.open_burst_sessions(state, "circuit_id")))


def stream_late_rows(s, d):
    return streams.run_late_rows(_streamed(s, roles.calls(s, d).select("seq", "call_ts"), "calls"), "seq", "call_ts", LATENESS_SECONDS)


IO = {
    "ingest_csv_typed": ingest_csv_typed,
    "ingest_directory": ingest_directory,
    "derive_ingest_columns": derive_ingest_columns,
    "read_ground_truth": read_ground_truth,
    "truth_sections": truth_sections,
    "csv_stream_ingest": csv_stream_ingest,
    "sink_partitioned_table": lambda s, d: partitioned_logs(s, d).select(
        "txn_id", "event_no", "event", "region", "ts", "day", "end_to_end_latency_ms"),
    "sink_csv_header": sink_csv_header,
    "sink_json_report": sink_json_report,
    "view_alias": view_alias,
    "compat_views": compat_views,
    "view_region_shards": view_region_shards,
    "view_daily_shards": view_daily_shards,
    "shard_inventory": lambda s, d: views.shard_inventory(roles.logs(s, d).withColumn("day", F.to_date("ts")), roles.regions(s, d)),
    "table_presence_rows": table_presence_rows,
    "stream_service_kpi": stream_service_kpi,
    "stream_call_link": stream_call_link,
    "stream_dedup": stream_dedup,
    "stream_noise_counters": stream_noise_counters,
    "stream_sliding_lookback": stream_sliding_lookback,
    "stream_burst_sessions": stream_burst_sessions,
    "stream_late_rows": stream_late_rows,
}
