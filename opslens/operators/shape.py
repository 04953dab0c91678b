"""Row-level operators: slices, labels, normalisation, and fan-out of transactions (no UDF, mostly no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.intervals import first_interval
from opslens.functions.scalars import half_up, micros, plus_micros, text_or_empty

# Event names, level names, offsets (ms), span shares and codes of the telemetry format.
OPENING_EVENTS = ("received", "queued", "orchestrated")
OUTCOME_EVENTS = ("completed", "timeout")
QUEUED_AFTER_MS = 10
ORCHESTRATED_AFTER_MS = 40
FIRST_ATTEMPT_AFTER_MS = 50
ATTEMPT_SPACING_MS = 30
LOCAL_WORK_MS = 80
MANUAL_RETRY_AFTER_MS = 5
ORCHESTRATOR_SHARE = 0.4
WORKER_SHARE = 0.5
HTTP_CODES = {"timeout": "504", "retry": "202"}
EVENT_MESSAGES = {
    "received": "request received",
    "queued": "queued for orchestrator",
    "orchestrated": "routing transaction",
    "dependency_call": "dependency call",
    "worker_progress": "worker progressing",
    "retry": "queued for manual retry",
}
EVENT_SEVERITY = {
    "flap": ("warning", "Intermittent circuit flap observed"),
    "maintenance": ("info", "Planned maintenance window on circuit"),
    "reroute": ("warning", "Routing policy change applied; path flaps briefly"),
    "packet_loss_burst": ("warning", "Short packet loss burst on circuit"),
}
# Severity and text of the events on the incident circuit.
INCIDENT_SEVERITY = {
    "packet_loss_burst": ("critical", "Packet loss burst and RTT elevation detected on primary circuit"),
    "reroute": ("info", "Traffic rerouted away from degraded circuit; service latency recovers"),
}
# Ticks of a spine that one array holds.
SPINE_TICKS = 1440


def impacted_slice(df: DataFrame, region: str, types: Sequence[str], events: Sequence[str]) -> DataFrame:
    return df.where((F.col("region") == region) & F.col("txn_type").isin(*types) & F.col("event").isin(*events))


def day_slice(df: DataFrame, region: str, day: str) -> DataFrame:
    """Filters on the ``day`` column, so a table partitioned by day reads one partition."""
    return df.where((F.col("day") == F.lit(day).cast("date")) & (F.col("region") == region))


def iso_micros(ts: str):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def txn_fact_projection(facts: DataFrame) -> DataFrame:
    coded = status_normalise(facts)
    return coded.select(
        F.col("txn_id").alias("transaction_id"), "customer_id", F.col("region").alias("origin_region"), "txn_type",
        iso_micros("start_ts").alias("start_ts"), iso_micros("end_ts").alias("end_ts"),
        F.when(F.col("status") != "timeout", "true").otherwise("false").alias("success"),
        "error_code", F.round("latency_ms", 2).alias("end_to_end_latency_ms"),
    )


def status_normalise(facts: DataFrame) -> DataFrame:
    timeout = F.col("status") == "timeout"
    return facts.withColumns({
        "event": F.when(timeout, "timeout").otherwise("completed"),
        "level": F.when(timeout, "ERROR").otherwise("INFO"),
        "http_status": F.when(timeout, HTTP_CODES["timeout"]).when(F.col("status") == "retry", HTTP_CODES["retry"]).otherwise("200"),
        "error_code": F.when(~timeout, "").when(F.col("dep_region").isNotNull(), "DEP_TIMEOUT").otherwise("ORCH_TIMEOUT"),
        "message": F.when(F.col("status").startswith("completed"), "completed").otherwise(F.col("status")),
    })


def severity_normalise(events: DataFrame, incident_circuit: str | None = None) -> DataFrame:
    """Severity and text by event type.

    Background events that report critical are capped to warning. A burst on the incident circuit is critical and a
    reroute there is informational, with texts of their own; other events there are background.
    """
    def by_type(fixed):
        return F.create_map(*[x for k, (s, d) in fixed.items() for x in (F.lit(k), F.struct(F.lit(s).alias("s"), F.lit(d).alias("d")))])

    found = by_type(EVENT_SEVERITY)[F.col("event_type")]
    own = F.when(F.col("circuit_id") == incident_circuit, by_type(INCIDENT_SEVERITY)[F.col("event_type")]) if incident_circuit else None
    capped = F.when(F.col("reported_severity") == "critical", "warning").otherwise(found["s"])
    if own is None:
        return events.withColumns({"severity": capped, "description": found["d"]})
    return events.withColumns({"severity": F.coalesce(own["s"], capped), "description": F.coalesce(own["d"], found["d"])})


def pre_post_label(df: DataFrame, ts: str, fix) -> DataFrame:
    return df.withColumn("phase", F.when(F.col(ts) < fix, "pre_fix").otherwise("post_fix"))


def impacted_flags(facts: DataFrame, windows: DataFrame, confounders: DataFrame, focus_region: str) -> DataFrame:
    tagged = first_interval(facts, "start_ts", windows, "window_id", "window_id", "w0", "w1", "window_id")
    tagged = first_interval(
        tagged, "start_ts", confounders, "name", "confounder_label", "c0", "c1", "priority",
        region="region", window_region="c_region",
    )
    primary = F.col("window_id").isNotNull() & F.col("impacted_type") & (F.col("region") == focus_region)
    return tagged.withColumns({
        "impacted_by_primary": primary, "impacted_by_confounder": F.col("confounder_label").isNotNull(),
    })


def txn_key_build_parse(facts: DataFrame) -> DataFrame:
    """Read stamp and sequence back out of the id and compare them with the row."""
    pattern = r"^TX-(\d{14})-(\d{7,})$"
    stamp = F.to_timestamp_ntz(F.regexp_extract("txn_id", pattern, 1), F.lit("yyyyMMddHHmmss"))
    seq = F.regexp_extract("txn_id", pattern, 2).cast("bigint")
    return facts.select(
        "txn_id", stamp.alias("id_ts"), seq.alias("id_seq"),
        ((stamp == F.date_trunc("second", "start_ts").cast("timestamp_ntz")) & (seq == F.col("seq"))).alias("agrees"),
    )


def lifecycle_explode(facts: DataFrame) -> DataFrame:
    """One transaction to its ordered log rows, in one map-side pass.

    Rows 1-3 open the transaction, then each attempt gives one row (two with a
    cross-region call), then the outcome, then a manual retry after a timeout. Each
    column is a plain expression over the row number, so unused ones are pruned and
    the pass stays inside generated code.
    """
    coded = status_normalise(facts)
    cross, timeout = F.col("dep_region").isNotNull(), F.col("status") == "timeout"
    per = F.when(cross, 2).otherwise(1)
    outcome_no = len(OPENING_EVENTS) + per * (F.col("retry_count") + 1) + 1
    numbered = coded.withColumn("_outcome", outcome_no).withColumn(
        "event_no", F.explode(F.sequence(F.lit(1), F.col("_outcome") + F.when(timeout, 1).otherwise(0)))
    )
    no, in_try = F.col("event_no"), F.col("event_no") - len(OPENING_EVENTS) - 1
    trying = (no > len(OPENING_EVENTS)) & (no < F.col("_outcome"))
    calling = trying & cross & (in_try % 2 == 0)
    at_end, after_end = no == F.col("_outcome"), no > F.col("_outcome")
    rows = numbered.withColumn("attempt", F.when(trying, F.floor(in_try / per).cast("int")))

    attempt_ms = ORCHESTRATED_AFTER_MS + FIRST_ATTEMPT_AFTER_MS + F.col("attempt") * ATTEMPT_SPACING_MS
    work = F.floor(F.coalesce(F.col("dep_latency_ms"), F.lit(float(LOCAL_WORK_MS))) * 1000)
    offset = (
        F.when(no == 1, 0).when(no == 2, QUEUED_AFTER_MS * 1000).when(no == 3, ORCHESTRATED_AFTER_MS * 1000)
        .when(calling, attempt_ms * 1000).when(trying, attempt_ms * 1000 + work)
        .when(at_end, 0).otherwise(MANUAL_RETRY_AFTER_MS * 1000)
    )
    origin = F.when(at_end | after_end, F.col("end_ts")).otherwise(F.col("start_ts"))
    event = (
        F.when(no == 1, OPENING_EVENTS[0]).when(no == 2, OPENING_EVENTS[1]).when(no == 3, OPENING_EVENTS[2])
        .when(calling, "dependency_call").when(trying, "worker_progress").when(at_end, F.col("event")).otherwise("retry")
    )
    service = (
        F.when(trying & ~calling, F.when(F.col("attempt") == F.col("retry_count"), "worker").otherwise("worker-retry"))
        .when((no == 3) | calling, "orchestrator").otherwise("api")
    )
    level = (
        F.when(at_end, F.col("level")).when(after_end, "WARN")
        .when(calling & F.col("impacted_by_primary"), "WARN").otherwise("INFO")
    )
    said = EVENT_MESSAGES
    message = (
        F.when(no == 1, said["received"]).when(no == 2, said["queued"]).when(no == 3, said["orchestrated"])
        .when(calling, said["dependency_call"]).when(trying, said["worker_progress"]).when(at_end, F.col("message")).otherwise(said["retry"])
    )
    ids = ["txn_id", "seq", "customer_id", "region", "txn_type", "circuit_id", "dep_region"]
    return rows.select(
        *ids, "event_no", event.alias("event"), service.alias("service"),
        plus_micros(origin, offset + F.col("skew_ms") * 1000).alias("ts"), level.alias("level"), "attempt",
        F.when(calling | at_end, F.floor("dep_latency_ms")).alias("dependency_latency_ms"),
        F.when(at_end, F.round("latency_ms", 2)).alias("end_to_end_latency_ms"),
        *[F.when(at_end, F.col(c)).otherwise("").alias(c) for c in ("http_status", "error_code")],
        message.alias("message"),
    )


def span_explode(facts: DataFrame) -> DataFrame:
    """One transaction to three spans, plus one for a cross-region call."""
    cross = F.col("dep_region").isNotNull()
    numbered = facts.withColumn("span_no", F.explode(F.sequence(F.lit(1), F.when(cross, 4).otherwise(3))))
    no, latency = F.col("span_no"), F.col("latency_ms")
    ms = (
        F.when(no == 1, latency).when(no == 2, latency * ORCHESTRATOR_SHARE).when(no == 3, latency * WORKER_SHARE)
        .otherwise(F.col("dep_latency_ms"))
    )
    service = F.when(no == 1, "api").when(no == 2, "orchestrator").when(no == 3, "worker").otherwise("inventory-client")
    return numbered.select(
        F.col("txn_id").alias("trace_id"), "txn_id", "region", F.col("start_ts").alias("ts"), "span_no",
        F.when(no == 2, 1).when(no > 2, 2).alias("parent_no"), service.alias("service"), half_up(ms, 2).alias("duration_ms"),
        F.when((F.col("status") == "timeout") & (no != 2), "error").otherwise("ok").alias("status"),
        F.when(no == 4, text_or_empty("circuit_id")).otherwise("").alias("circuit_id"),
    )


def txn_rebuild(logs: DataFrame) -> DataFrame:
    """Log rows back to one row per transaction: one partial and one final aggregate."""
    outcome = F.col("event").isin(*OUTCOME_EVENTS)
    return logs.groupBy("txn_id").agg(
        F.min(F.when(F.col("event") == "received", F.col("ts"))).alias("received_ts"),
        F.max(F.when(outcome, F.col("ts"))).alias("completed_ts"),
        F.count_if(F.col("event") == "worker_progress").alias("attempts"),
        F.count_if(F.col("event") == "dependency_call").alias("dep_calls"),
        F.max(F.when(outcome, F.col("event"))).alias("final_event"),
        F.max("end_to_end_latency_ms").alias("latency_ms"),
    ).withColumn("out_of_order", F.col("completed_ts") < F.col("received_ts"))


def time_spine_densify(
    df: DataFrame, entities: DataFrame, entity: str, ts: str, value: str, start: str, end: str, step_seconds: int
) -> DataFrame:
    """Every entity at every tick of [start, end), with 0 where ``df`` has no row.

    The grid grows on each entity row, so no cross join is planned; no array holds more than ``SPINE_TICKS`` ticks.
    """
    first, past = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    step = step_seconds * 1_000_000
    ticks = F.ceil((micros(past) - micros(first)) / step)
    spread = entities.select(entity).distinct().withColumn("_n", ticks).where("_n > 0").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / SPINE_TICKS))))
    last = F.least(F.col("_n"), (F.col("_part") + 1) * SPINE_TICKS) - 1
    numbered = spread.withColumn("_tick", F.explode(F.sequence(F.col("_part") * SPINE_TICKS, last)))
    grid = numbered.select(entity, plus_micros(first, F.col("_tick") * step).alias(ts))
    return grid.join(df.select(entity, ts, value), [entity, ts], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def route_matrix(facts: DataFrame, regions: DataFrame) -> DataFrame:
    """All ordered pairs of the ``region`` values of ``regions`` with their cross-region traffic; unused routes show 0.

    Traffic on a route outside that list is kept.
    """
    names = regions.agg(F.array_sort(F.collect_set("region")).alias("names"))
    pairs = names.select("names", F.explode("names").alias("src")).select("src", F.explode("names").alias("dst")).where("src <> dst")
    used = facts.where(F.col("dep_region").isNotNull()).groupBy(
        F.col("region").alias("src"), F.col("dep_region").alias("dst")
    ).agg(F.count(F.lit(1)).alias("calls"))
    return pairs.join(used, ["src", "dst"], "full").withColumn("calls", F.coalesce("calls", F.lit(0).cast("bigint")))
