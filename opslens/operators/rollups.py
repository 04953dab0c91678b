"""Aggregations: distributions, percentiles, incident ratios, service indicators, quality bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.functions.intervals import first_interval
from opslens.functions.quantiles import exact_quantiles
from opslens.functions.running import running
from opslens.functions.scalars import grid_floor, half_up, is_absent, micros, ratio, share_of, within_half_open
from opslens.session import frozen, within

#: Rows that a window without a key may order in one task; more are ordered in slices.
PLAIN = 10_000

# Saturation weights, noise bands, noise classes, seasonal curve and coherence floors.
SATURATION_BASE = 0.15
SATURATION_RETRY = 0.7
SATURATION_ERROR = 1.0
SATURATION_LATENCY = 0.25
SATURATION_LATENCY_MS = 2500.0
NOISE_BANDS = {
    "fn_rate": (0.02, 0.035),
    "fp_rate_non_empty": (0.0, 0.002),
    "wrong_link_rate_joined": (0.003, 0.007),
}
NOISE_TYPES = ("clean", "missing", "fabricated", "wrong_customer")
CURVE_LEVEL, CURVE_SWING, CURVE_FLOOR, CURVE_LAG_HOURS, WEEKEND_FACTOR = 0.55, 0.45, 0.2, 3, 0.85
LATENCY_FLOOR, TIMEOUT_FLOOR, RTT_FLOOR, PEAK_FLOOR = 1.0, 0.01, 1.0, 0.0001


def n_rows() -> Column:
    return F.count(F.lit(1))


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row results with different columns side by side, by stacking and folding them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def impacted(df: DataFrame, types: Sequence[str], events: Sequence[str]) -> DataFrame:
    return df.where(F.col("txn_type").isin(*types) & F.col("event").isin(*events))


def latency(df: DataFrame) -> DataFrame:
    """Log rows with the latency as a number, 0 when absent."""
    return df.withColumn("lat", F.coalesce(F.col("end_to_end_latency_ms").cast("double"), F.lit(0.0)))


def region_distribution(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    expected = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("region")]
    counts = df.groupBy("region").agg(n_rows().alias("rows"))
    share = F.round(F.col("rows") / F.sum("rows").over(W.partitionBy(F.lit(1))), 4)
    return counts.select("region", "rows", share.alias("share"), expected.alias("expected")).withColumn(
        "diff", F.round(F.col("share") - F.col("expected"), 4)
    ).orderBy("region")


def day_span(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(F.to_date(ts)).alias("min_day"), F.max(F.to_date(ts)).alias("max_day"))


def p95_by_region(df: DataFrame, types: Sequence[str], events: Sequence[str]) -> DataFrame:
    q = exact_quantiles(latency(impacted(df, types, events)), ["region"], "lat", {"p95_ms": 0.95})
    return q.withColumn("p95_ms", F.round("p95_ms", 4)).orderBy("region")


def shard_p95_timeout(df: DataFrame, types: Sequence[str], events: Sequence[str]) -> DataFrame:
    """p95 and timeout rate of one shard (a region-day view)."""
    q = exact_quantiles(
        latency(impacted(df, types, events)), [], "lat", {"p95_ms": 0.95}, extra={"timeout_rate": share_of(F.col("event") == "timeout")}
    )
    return q.select(F.round("p95_ms", 4).alias("p95_ms"), "timeout_rate")


def impacted_volume(df: DataFrame, step_seconds: int = 60) -> DataFrame:
    """Median, p95 and maximum of the row count per slot."""
    per_slot = df.groupBy(grid_floor("ts", step_seconds).alias("slot")).agg(n_rows().cast("double").alias("reqs"))
    q = exact_quantiles(per_slot, [], "reqs", {"median_rpm": 0.5, "p95_rpm": 0.95}, extra={"max_rpm": F.max("reqs")})
    return q.select(*[F.round(c, 4).alias(c) for c in ("median_rpm", "p95_rpm")], F.col("max_rpm").cast("bigint").alias("max_rpm"))


def fix_verification(df: DataFrame, fix: Column) -> DataFrame:
    phased = latency(df).withColumn("phase", F.when(F.col("ts") < fix, "pre_fix").otherwise("post_fix"))
    q = exact_quantiles(
        phased, ["phase"], "lat", {"p95_ms": 0.95, "p99_ms": 0.99},
        extra={"timeout_rate": share_of(F.col("event") == "timeout"), "n": n_rows()},
    )
    return q.select("phase", F.round("p95_ms", 4).alias("p95_ms"), F.round("p99_ms", 4).alias("p99_ms"), "timeout_rate", "n").orderBy("phase")


def before_and_during(df: DataFrame, keys: Sequence[str], ts: str, value: str, start: Column, end: Column) -> DataFrame:
    """p95 per key before the incident and inside [start, end), and their ratio (0 if the base is 0)."""
    phase = F.when(F.col(ts) < start, "before").when(within_half_open(ts, start, end), "during").otherwise("after")
    q = exact_quantiles(df.withColumn("_phase", phase), [*keys, "_phase"], value, {"_p": 0.95})
    wide = q.groupBy(*keys).agg(
        F.max(F.when(F.col("_phase") == "before", F.col("_p"))).alias("_b"),
        F.max(F.when(F.col("_phase") == "during", F.col("_p"))).alias("_d"),
    )
    multiplier = F.when(F.col("_b") == 0, F.lit(0.0)).otherwise(F.round(F.col("_d") / F.nullif(F.col("_b"), F.lit(0.0)), 2))
    return wide.select(
        *keys, F.round("_b", 4).alias("p95_baseline"), F.round("_d", 4).alias("p95_incident"), multiplier.alias("p95_multiplier")
    )


def incident_multiplier(df: DataFrame, start: Column, end: Column) -> DataFrame:
    return before_and_during(latency(df), ["region"], "ts", "lat", start, end).orderBy("region")


def top_circuit_uplift(metrics: DataFrame, src: str, dst: str, start: Column, end: Column, k: int = 5) -> DataFrame:
    """The ``k`` circuits of one route with the largest rise; ties go to the lower circuit id."""
    route = frozen(metrics.where((F.col("src") == src) & (F.col("dst") == dst)).select("circuit_id", "ts", "value"))
    q = before_and_during(route, ["circuit_id"], "ts", "value", start, end)
    named = q.select("circuit_id", F.lit(src).alias("src"), F.lit(dst).alias("dst"), "p95_baseline", "p95_incident", "p95_multiplier")
    return named.orderBy(F.col("p95_multiplier").desc_nulls_last(), "circuit_id").limit(k)


def link_missing_rate(calls: DataFrame) -> DataFrame:
    return calls.agg(share_of(is_absent("ref")).alias("missing_rate"), n_rows().alias("total"))


def service_kpi(facts: DataFrame, step_seconds: int = 60) -> DataFrame:
    """Request rate, error rate, nearest-rank percentiles and saturation per slot, region and type."""
    base = facts.select(grid_floor("start_ts", step_seconds).alias("ts"), "region", "txn_type", "latency_ms", "status", "retry_count")
    q = exact_quantiles(
        base, ["ts", "region", "txn_type"], "latency_ms", {"_p95": 0.95, "_p99": 0.99}, how="nearest",
        extra={
            "_n": n_rows(), "_errors": F.count_if(F.col("status") == "timeout"), "_retries": F.count_if(F.col("retry_count") > 0),
        },
    )
    n = F.col("_n")
    load = (
        F.lit(SATURATION_BASE) + SATURATION_RETRY * (F.col("_retries") / n) + SATURATION_ERROR * (F.col("_errors") / n)
        + SATURATION_LATENCY * F.least(F.lit(1.0), F.col("_p95") / SATURATION_LATENCY_MS)
    )
    return q.select(
        "ts", "region", "txn_type", F.round(n / float(step_seconds), 4).alias("request_rate"),
        F.round(F.col("_errors") / n, 4).alias("error_rate"), F.round("_p95", 2).alias("p95_ms"), F.round("_p99", 2).alias("p99_ms"),
        half_up(F.least(F.lit(1.0), load), 4).alias("saturation"),
    )


def incident_coherence(flagged: DataFrame, samples: DataFrame, windows: DataFrame, region: str, circuit: str) -> DataFrame:
    """How much dependency latency and timeouts of the region, and round trips of the incident circuit, rise inside the bursts."""
    focus = flagged.where(F.col("dep_region").isNotNull() & (F.col("region") == region) & F.col("impacted_type"))
    burst = F.col("impacted_by_primary")
    timeout = F.col("status") == "timeout"

    def mean(cond):
        return F.coalesce(F.avg(F.when(cond, F.col("dep_latency_ms"))), F.lit(0.0))

    def rate(cond):
        return F.count_if(cond & timeout) / F.greatest(F.lit(1), F.count_if(cond))

    rise = focus.agg(
        F.round(mean(burst) / F.greatest(F.lit(LATENCY_FLOOR), mean(~burst)), 2).alias("latency_multiplier"),
        F.round(rate(burst) / F.greatest(F.lit(TIMEOUT_FLOOR), rate(~burst)), 2).alias("timeout_multiplier"),
    )
    tagged = first_interval(samples.where(F.col("circuit_id") == circuit), "ts", windows, "window_id", "window_id", "w0", "w1", "window_id")
    inside = F.max(F.when(F.col("window_id").isNotNull(), F.col("value")))
    outside = F.min(F.when(F.col("window_id").isNull(), F.col("value")))
    peak = F.coalesce(inside, outside, F.lit(1.0))
    base = F.coalesce(outside, inside, F.lit(1.0))
    rtt = tagged.agg(F.round(peak / F.greatest(F.lit(RTT_FLOOR), base), 2).alias("rtt_multiplier"))
    return one_row(rise, rtt)


def confounder_separability(hosts: DataFrame, samples: DataFrame, region: str, circuit: str, start: Column, end: Column) -> DataFrame:
    """Peak CPU of the region, and the incident circuit's highest reading in the decoy window over its own median."""
    cpu = hosts.where(F.col("region") == region).agg(F.round(F.max("cpu"), 2).alias("cpu_peak"))
    samples = samples.where(F.col("circuit_id") == circuit)
    medians = exact_quantiles(samples, ["circuit_id"], "value", {"base": 0.5})
    peaks = samples.where(within_half_open("ts", start, end)).groupBy("circuit_id").agg(F.max("value").alias("peak"))
    net = peaks.join(medians, "circuit_id").agg(
        F.round(F.greatest(F.lit(PEAK_FLOOR), F.coalesce(F.max(F.try_divide("peak", "base")), F.lit(1.0))), 4).alias("network_peak_during_cpu")
    )
    return one_row(cpu, net)


def host_peak(hosts: DataFrame) -> DataFrame:
    return hosts.groupBy("region", "host").agg(F.max("cpu").alias("cpu_max"))


def host_peak_in_windows(hosts: DataFrame, windows: DataFrame) -> DataFrame:
    tagged = first_interval(hosts, "ts", windows, "window_id", "window_id", "w0", "w1", "window_id")
    return tagged.where("window_id IS NOT NULL").groupBy("window_id", "region", "host").agg(F.max("cpu").alias("cpu_max"))


def call_stats(calls: DataFrame, flagged: DataFrame) -> DataFrame:
    """Counts per noise class; classes without calls show 0."""
    primary = flagged.groupBy(F.col("txn_id").alias("true_txn")).agg(F.max("impacted_by_primary").alias("impacted_by_primary"))
    joined = calls.select("true_txn", "noise_type", "ref").join(primary, "true_txn", "left")
    counts = joined.groupBy("noise_type").agg(
        n_rows().alias("calls"), F.count_if(~is_absent("ref")).alias("non_empty"),
        F.count_if(~is_absent("ref") & (F.col("noise_type") == "clean")).alias("matches"),
        F.count_if(F.coalesce("impacted_by_primary", F.lit(False))).alias("incident_calls"),
    )
    kinds = calls.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in NOISE_TYPES])).alias("noise_type"))
    cols = ("calls", "non_empty", "matches", "incident_calls")
    filled = kinds.join(counts, "noise_type", "left").select("noise_type", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in cols])
    rate = ratio(F.col("calls"), F.sum("calls").over(W.partitionBy(F.lit(1))))
    return filled.select("noise_type", "calls", rate.alias("rate"), "non_empty", "matches", "incident_calls")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.lit(name).alias("table_name"), n_rows().alias("rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def alert_quality(alerts: DataFrame, windows: DataFrame) -> DataFrame:
    """tp: alerts inside any window; fp: outside all; fn: windows without an alert.

    Windows are cut into disjoint pieces. A window without an alert is one whose start is followed by none of its
    pieces that hold one, which is read off one sorted order of window starts and such pieces.
    """
    tagged = first_interval(alerts, "ts", windows, "window_id", "first", "w0", "w1", "window_id", piece="at")
    per = frozen(tagged.groupBy("at").agg(n_rows().alias("n")))
    count = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    counted = per.agg(F.coalesce(F.sum(F.when(F.col("at").isNotNull(), F.col("n"))), F.lit(0).cast("bigint")).alias("tp"), count.alias("_all"))
    counted = counted.select("tp", (F.col("_all") - F.col("tp")).alias("fp"))
    starts = windows.select(micros("w0").alias("t"), F.lit(0).alias("k"), F.col("window_id").alias("id"), micros("w1").alias("end"))
    held = per.where("at IS NOT NULL").select(F.col("at").alias("t"), F.lit(1).alias("k"), F.col("at").alias("held"))
    both = starts.unionByName(held, allowMissingColumns=True)
    if within(both, PLAIN):
        after = W.orderBy(F.col("t").desc(), F.col("k").desc()).rowsBetween(W.unboundedPreceding, 0)
        seen = both.withColumn("next_held", F.last("held", ignorenulls=True).over(after)).where("k = 0")
    else:
        seen = running(both, [], ["t", "k", "id"], next={"next_held": F.col("held")}).where("k = 0")
    missed = seen.agg(F.count_if(F.coalesce(F.col("next_held") >= F.col("end"), F.lit(True))).alias("fn"))
    return one_row(counted, missed)


def circuits_per_route(circuits: DataFrame) -> DataFrame:
    named = circuits.select("src", "dst", "circuit_id").distinct()
    return named.groupBy("src", "dst").agg(
        F.array_join(F.array_sort(F.collect_list("circuit_id")), ",").alias("circuits"), n_rows().alias("n")
    )


def seasonal_profile(facts: DataFrame, ts: str = "start_ts") -> DataFrame:
    """Mean rows per day and hour, working days and weekends apart, against the expected daily curve.

    The mean is over all days of the kind from the first day to the last, with or without rows in the hour.
    """
    day, hour = F.to_date(ts), F.hour(ts)
    per_hour = facts.groupBy(day.alias("day"), hour.alias("hour")).agg(n_rows().alias("n"))
    weekend = F.weekday("day") >= 5
    span = per_hour.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("day")).groupBy(weekend.alias("weekend")).agg(F.count(F.lit(1)).alias("days"))
    cells = per_hour.groupBy("hour", weekend.alias("weekend")).agg(F.sum("n").alias("n")).join(days, "weekend")
    cells = cells.select("hour", "weekend", (F.col("n") / F.col("days")).alias("mean"))
    wave = CURVE_LEVEL + CURVE_SWING * F.sin((F.col("hour") - CURVE_LAG_HOURS) / F.lit(24.0) * 2 * F.pi())
    curve = F.greatest(F.lit(CURVE_FLOOR), wave) * F.when(F.col("weekend"), F.lit(WEEKEND_FACTOR)).otherwise(F.lit(1.0))
    every = W.partitionBy(F.lit(1))
    scaled = curve * F.sum("mean").over(every) / F.sum(curve).over(every)
    return cells.withColumn("scaled", scaled).select(
        "hour", "weekend", F.round("mean", 4).alias("observed"), F.round("scaled", 4).alias("expected"),
        F.round(F.col("mean") - F.col("scaled"), 4).alias("residual"),
    )


def call_rate_by_segment(flagged: DataFrame, calls: DataFrame, region: str) -> DataFrame:
    """Observed calls per transaction, by the first segment that applies."""
    segment = (
        F.when(F.col("impacted_by_primary"), "impacted_burst")
        .when(F.col("impacted_type") & (F.col("region") == region), "impacted_base")
        .when(F.col("impacted_by_confounder"), "confounded").when(F.col("status") == "timeout", "timed_out").otherwise("other")
    )
    per_txn = calls.groupBy(F.col("true_txn").alias("txn_id")).agg(
        n_rows().alias("c"), F.count_if("escalated").alias("e"), F.sum("resolution_min").alias("m")
    )
    joined = flagged.select("txn_id", segment.alias("segment")).join(per_txn, "txn_id", "left")
    sums = joined.groupBy("segment").agg(
        n_rows().alias("transactions"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("c", "e", "m")]
    )
    c = F.col("c")
    return sums.select(
        "segment", "transactions", c.alias("calls"), ratio(c, F.col("transactions")).alias("call_rate"),
        ratio(F.col("e"), c).alias("escalated_rate"), ratio(F.col("m"), c).alias("mean_resolution_min"),
    )


def band_check(rates: DataFrame, bands: Mapping[str, tuple[float, float]] = NOISE_BANDS) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("value"), F.lit(lo).alias("lower"), F.lit(hi).alias("upper"))
        for m, (lo, hi) in bands.items()
    ])
    return rates.select(F.inline(rows)).withColumn("inside", F.col("value").between(F.col("lower"), F.col("upper")))


def tail_summary(facts: DataFrame) -> DataFrame:
    q = exact_quantiles(
        facts.select("txn_type", "status", "latency_ms"), ["txn_type", "status"], "latency_ms",
        {"p50": 0.5, "p95": 0.95, "p99": 0.99}, extra={"max_ms": F.max("latency_ms")},
    )
    return q.select(
        "txn_type", "status", *[F.round(c, 4).alias(c) for c in ("p50", "p95", "p99")], "max_ms",
        F.round(F.try_divide("p99", "p50"), 4).alias("tail_ratio"),
    )


def dependency_share(facts: DataFrame) -> DataFrame:
    cross = F.col("dep_region").isNotNull()
    return facts.groupBy("region", "txn_type").agg(
        F.count_if(cross).alias("cross_calls"), share_of(cross).alias("share"),
        F.round(F.avg(F.when(cross, F.try_divide("dep_latency_ms", "latency_ms"))), 4).alias("mean_dep_ratio"),
    )


def quality_cube(classified: DataFrame) -> DataFrame:
    """Link classes by region and issue with all subtotals; rows are counted before the cube expands them."""
    counts = classified.groupBy("region", "issue_category", "link_class").agg(n_rows().alias("n"))

    def of(c):
        return F.sum(F.when(F.col("link_class") == c, F.col("n")).otherwise(F.lit(0))).alias(c)

    return counts.cube("region", "issue_category").agg(
        F.grouping_id().cast("bigint").alias("level"), *[of(c) for c in ("tp", "fn", "fp", "wrong_link")]
    )
