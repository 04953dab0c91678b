"""Join operators: link quality, consistency checks, nearest candidates, as-of and timeline correlation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.intervals import first_interval
from opslens.functions.quantiles import exact_quantiles
from opslens.functions.running import running
from opslens.functions.scalars import grid_floor, is_absent, micros, ratio, seconds_between, share_of
from opslens.session import broadcast_if_small, frozen

#: Rows of a slice of the decoys' running values; a task that sorts so many needs no disk.
SLICE_ROWS = 250_000
# Noise classes of a call's reference and the link class each one should produce.
EXPECTED_CLASS = {"clean": "tp", "missing": "fn", "fabricated": "fp", "wrong_customer": "wrong_link"}


def burst_membership(df: DataFrame, ts: str, windows: DataFrame) -> DataFrame:
    return first_interval(df, ts, windows, "window_id", "window_id", "w0", "w1", "window_id")


def confounder_first_match(df: DataFrame, ts: str, region: str, confounders: DataFrame) -> DataFrame:
    return first_interval(
        df, ts, confounders, "name", "label", "c0", "c1", "priority", region=region, window_region="c_region"
    )


def customer_of_txn(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("event") == "received").groupBy(F.col("txn_id").alias("ref")).agg(
        F.min("customer_id").alias("log_customer")
    )


def link_classes(calls: DataFrame, logs: DataFrame) -> DataFrame:
    """calls + link_class (tp, fn, fp, wrong_link).

    Empty references can be a large share of all calls, so each gets a join key of
    its own instead of one shared key.
    """
    keyed = calls.withColumn("_key", F.when(is_absent("ref"), F.concat(F.lit("\u0001"), "call_id")).otherwise(F.col("ref")))
    known = customer_of_txn(logs).withColumnRenamed("ref", "_key")
    return keyed.join(known, "_key", "left").withColumn(
        "link_class",
        F.when(is_absent("ref"), "fn").when(F.col("log_customer").isNull(), "fp")
        .when(F.col("customer_id") != F.col("log_customer"), "wrong_link").otherwise("tp"),
    ).drop("_key", "log_customer")


def link_confusion_matrix(calls: DataFrame, logs: DataFrame) -> DataFrame:
    classes = ("tp", "fn", "fp", "wrong_link")
    counts = link_classes(calls, logs).agg(*[F.count_if(F.col("link_class") == c).alias(c) for c in classes])
    tp, fn, fp, wrong = (F.col(c) for c in classes)
    total = tp + fn + fp + wrong
    return counts.select(
        *classes, ratio(fn, total).alias("fn_rate"), ratio(fp, total - fn).alias("fp_rate_non_empty"),
        ratio(wrong, tp + wrong).alias("wrong_link_rate_joined"), ratio(tp, total).alias("tp_rate"),
    )


def link_nonexistent_rate(calls: DataFrame, logs: DataFrame) -> DataFrame:
    """Repeated references are counted before the join, so a hot reference is one row in it."""
    refs = calls.where(~is_absent("ref")).groupBy("ref").agg(F.count(F.lit(1)).alias("n"))
    known = logs.where(F.col("event") == "received").select(F.col("txn_id").alias("ref")).distinct().withColumn("known", F.lit(True))
    return refs.join(known, "ref", "left").agg(
        ratio(F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(F.lit(0))), F.sum("n")).alias("nonexistent_rate")
    )


def link_mismatch_rate(calls: DataFrame, logs: DataFrame) -> DataFrame:
    pairs = calls.where(~is_absent("ref")).groupBy("ref", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    joined = pairs.join(customer_of_txn(logs), "ref")
    other = F.when(F.col("customer_id") != F.col("log_customer"), F.col("n")).otherwise(F.lit(0))
    return joined.agg(ratio(F.sum(other), F.sum("n")).alias("mismatch_rate"))


def decoy_candidates(
    calls: DataFrame, txns: DataFrame, horizon: int = 7200, near: int = 1200, far: int = 4800
) -> DataFrame:
    """Per call: how many other customers' transactions of the region ended near it, and the nearest one.

    ``candidates`` counts those at most ``horizon`` seconds away, ``preferred`` those
    ``near``..``far`` away; the nearest comes from the preferred ones if there are any.
    No call-transaction pairs are formed: counts are differences of running counts, and
    the nearest is the last transaction in time order, or the last one of another customer.
    """
    # Rows are shuffled and written several times, so a probe holds no more than its call, its instant and its edge.
    second, point = 1_000_000, 50
    calls = frozen(calls.select(F.col("call_id").alias("id"), "region", "customer_id", micros("call_ts").alias("call_t")))
    points = frozen(txns.select(
        "region", "customer_id", "seq", F.col("txn_id").alias("id"), micros("end_ts").alias("t"), F.lit(point).cast("tinyint").alias("e")
    ))
    # number, which also orders (below 50 before points at the same instant, above behind): offset (s), signs in both counts, tag
    edges = {
        0: (-horizon, -1, 0, ""), 1: (-far, 0, -1, ""), 2: (near, 0, -1, "ahead"), 3: (0, 0, 0, "ahead_any"),
        101: (horizon, 1, 0, ""), 102: (-near, 0, 1, "past"), 103: (far, 0, 1, ""), 104: (0, 0, 0, "past_any"),
    }
    counted = [n for n, (_, sa, sp, _) in edges.items() if sa or sp]

    def of_edge(i):
        value = {n: F.lit(e[i] * second).cast("bigint") if i == 0 else e[i] for n, e in edges.items()}
        return reduce(lambda found, n: found.when(F.col("e") == n, value[n]), value, F)

    items = F.array(*[F.lit(n).cast("tinyint") for n in edges])
    probes = calls.withColumn("e", F.explode(items)).select(
        "region", "customer_id", "id", (F.col("call_t") + of_edge(0)).alias("t"), "e")
    is_point = F.col("e") == point
    one = F.when(is_point, 1).otherwise(0)
    me = F.when(is_point, F.struct("t", "id", F.col("customer_id").alias("c")))
    order = ["t", "e", "seq"]  # probes without seq may tie, which no running value sees
    stacked = points.unionByName(probes, allowMissingColumns=True)
    slices = ceil((points.count() + len(edges) * calls.count()) / SLICE_ROWS) or 1

    # The nearest point on either side and the nearest one of another customer than that.
    customer = F.col("customer_id")
    seen = running(stacked, ["region"], order, sums={"n": one}, two_last={"past": (me, customer)}, two_next={"ahead": (me, customer)}, slices=slices).where(~is_point)
    own = running(
        points.drop("id").unionByName(probes.where(F.col("e").isin(counted)), allowMissingColumns=True),
        ["region", "customer_id"], order, sums={"n": one}, slices=slices,
    ).where(~is_point)

    def not_own(side):
        return F.when(F.col(f"{side}.a.c") != customer, F.col(f"{side}.a")).otherwise(F.col(f"{side}.b"))

    tag, at = of_edge(3), F.col("t") - of_edge(0)
    nearest = F.when(tag.startswith("past"), not_own("past")).when(tag.startswith("ahead"), not_own("ahead"))
    rows = seen.select("id", at.alias("call_t"), of_edge(1).alias("sa"), of_edge(2).alias("sp"), "n", tag.alias("tag"), nearest.alias("o")).unionByName(
        own.select("id", (-of_edge(1)).alias("sa"), (-of_edge(2)).alias("sp"), "n"), allowMissingColumns=True
    )
    gap = F.abs(F.col("call_t") - F.col("o.t"))

    def best(tags, limit):
        ok = F.col("tag").isin(*tags) & (gap <= limit * second)
        return F.min(F.when(ok, F.struct(gap.alias("gap"), F.col("o.id").alias("id"))))

    return rows.groupBy(F.col("id").alias("call_id")).agg(
        F.sum(F.col("sa") * F.col("n")).alias("candidates"), F.sum(F.col("sp") * F.col("n")).alias("preferred"),
        best(["past", "ahead"], far).alias("p"), best(["past_any", "ahead_any"], horizon).alias("a"),
    ).select(
        "call_id", "candidates", "preferred",
        F.when(F.col("preferred") > 0, F.col("p.id")).otherwise(F.col("a.id")).alias("nearest_txn_id"),
    )


def circuit_consistency(facts: DataFrame, circuits: DataFrame) -> DataFrame:
    """Cross-region transactions with a missing, unknown or mismatching circuit; none if all is well."""
    route = F.min(F.struct("src", "dst")).alias("route")
    known = circuits.groupBy("circuit_id").agg(route).select("circuit_id", F.col("route.src").alias("c_src"), F.col("route.dst").alias("c_dst"))
    known = broadcast_if_small(frozen(known))
    cross = facts.where(F.col("dep_region").isNotNull()).select("txn_id", "circuit_id", "region", "dep_region")
    keyed = cross.withColumn("_key", F.coalesce("circuit_id", "txn_id"))
    joined = keyed.join(known.withColumnRenamed("circuit_id", "_key"), "_key", "left")
    reason = (
        F.when(is_absent("circuit_id"), "missing").when(F.col("c_src").isNull(), "unknown")
        .when((F.col("c_src") != F.col("region")) | (F.col("c_dst") != F.col("dep_region")), "mismatch")
    )
    return joined.select(reason.alias("reason")).where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def span_referential_check(spans: DataFrame, calls: DataFrame, facts: DataFrame) -> DataFrame:
    refs = spans.select(F.lit("span").alias("side"), F.col("txn_id").alias("ref")).unionByName(
        calls.where(~is_absent("ref")).select(F.lit("call").alias("side"), "ref")
    ).groupBy("side", "ref").agg(F.count(F.lit(1)).alias("n"))
    known = facts.select(F.col("txn_id").alias("ref")).distinct().withColumn("known", F.lit(1))
    joined = refs.join(known, "ref", "left")

    def pct(side):
        here = F.when(F.col("side") == side, F.col("n")).otherwise(F.lit(0))
        total = F.coalesce(F.sum(here), F.lit(0))
        hits = F.sum(F.when(F.col("known").isNotNull(), here).otherwise(F.lit(0)))
        return F.when(total == 0, F.lit(100.0)).otherwise(F.round(hits * 100.0 / F.nullif(total, F.lit(0)), 3))

    return joined.agg(pct("span").cast("double").alias("span_match_pct"), pct("call").cast("double").alias("call_match_pct"))


def call_delay(calls: DataFrame, facts: DataFrame, edges: Sequence[int]) -> DataFrame:
    ended = facts.groupBy(F.col("txn_id").alias("true_txn")).agg(F.min("end_ts").alias("end_ts"))
    minutes = F.greatest(F.lit(0), F.floor(seconds_between("call_ts", "end_ts") / 60))
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= F.col("delay")))
    return calls.select("true_txn", "call_ts").join(ended, "true_txn").select(minutes.alias("delay")).groupBy(
        bucket.alias("delay_bucket")
    ).agg(F.count(F.lit(1)).alias("calls"), F.round(F.avg("delay"), 4).alias("mean_delay"))


def truth_scoring(classified: DataFrame) -> DataFrame:
    """Precision and recall of the link classes against the recorded noise type."""
    counts = classified.groupBy("noise_type", "link_class").agg(F.count(F.lit(1)).alias("n"))
    kinds = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(c).alias("c")) for t, c in EXPECTED_CLASS.items()])
    each = counts.withColumnRenamed("noise_type", "truth").withColumn("kind", F.explode(kinds))
    is_true, is_found = F.col("truth") == F.col("kind.t"), F.col("link_class") == F.col("kind.c")

    def total(cond):
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))

    scored = each.groupBy(F.col("kind.t").alias("noise_type")).agg(
        total(is_true & is_found).alias("tp"), total(~is_true & is_found).alias("fp"), total(is_true & ~is_found).alias("fn")
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return scored.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)})


def _root_times(spans: DataFrame) -> DataFrame:
    """One start per trace, so that repeated spans do not multiply in a join."""
    return spans.where(F.col("parent_no").isNull()).groupBy(F.col("trace_id").alias("txn_id")).agg(F.min("ts").alias("span_ts"))


def clock_skew(logs: DataFrame, spans: DataFrame) -> DataFrame:
    received = logs.where(F.col("event") == "received").select("txn_id", "region", F.col("ts").alias("log_ts"))
    skew = (micros("log_ts") - micros("span_ts")) / F.lit(1000.0)
    return received.join(_root_times(spans), "txn_id").select("region", skew.alias("skew")).groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.min("skew").alias("min_ms"), F.round(F.avg("skew"), 4).alias("mean_ms"),
        F.max("skew").alias("max_ms"),
    )


def skew_corrected_logs(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """logs + corrected_ts: each transaction's log rows moved onto the clock of its root span."""
    received = logs.where(F.col("event") == "received").groupBy("txn_id").agg(F.min("ts").alias("log_ts"))
    shift = received.join(_root_times(spans), "txn_id").select("txn_id", (micros("span_ts") - micros("log_ts")).alias("shift"))
    moved = F.timestamp_add("MICROSECOND", F.coalesce("shift", F.lit(0).cast("bigint")), F.col("ts"))
    return logs.join(shift, "txn_id", "left").withColumn("corrected_ts", moved).drop("shift")


def span_depths(spans: DataFrame) -> DataFrame:
    """(trace_id, span_no, depth) of every span that a root is above; the least depth if there are several ways up.

    Pointer doubling: each span holds a span above it and how far that is. A round replaces it by the one that that
    span holds, so distances double and a chain of n spans takes about log2(n) rounds. Spans that still point upwards
    when a round has reached no further span hang in a circle; they have no depth, nor have orphans.
    """
    parent = F.col("parent_no")
    per = frozen(spans.groupBy("trace_id", "span_no").agg(
        F.min(parent).alias("up"), F.max(parent).alias("other"), F.count_if(parent.isNull()).alias("roots")))
    several = not per.where("up <> other OR (roots > 0 AND up IS NOT NULL)").isEmpty()
    state = spans.select("trace_id", "span_no", parent.alias("up")).distinct() if several else per.select("trace_id", "span_no", "up")
    state = frozen(state.withColumn("dist", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint")))
    reached = -1
    while True:
        now, left = state.agg(F.count_if(F.col("up").isNull()), F.count_if(F.col("up").isNotNull())).first()
        # Above a span that is too deep for this round hangs one that is not: if none is reached, none is left to reach.
        if not left or now == reached:
            break
        reached = now
        above = state.select("trace_id", F.col("span_no").alias("up"), F.col("up").alias("up2"), F.col("dist").alias("dist2"))
        moved = state.where("up IS NOT NULL").join(above, ["trace_id", "up"]).select(
            "trace_id", "span_no", F.col("up2").alias("up"), (F.col("dist") + F.col("dist2")).alias("dist"))
        state = state.where("up IS NULL").unionByName(moved)
        if several:  # ways that meet again are one
            state = state.groupBy("trace_id", "span_no", "up").agg(F.min("dist").alias("dist"))
        state = frozen(state)
    found = state.where("up IS NULL")
    if several:
        found = found.groupBy("trace_id", "span_no").agg(F.min("dist").alias("dist"))
    return found.select("trace_id", "span_no", F.col("dist").cast("int").alias("depth"))


def span_tree(spans: DataFrame) -> DataFrame:
    """Depth, child time and self time per service; spans longer than their parent are counted, not rejected.

    The depth of orphans and of what hangs below them is NULL.
    """
    cols = frozen(spans.select("trace_id", "span_no", "parent_no", "service", "duration_ms"))
    children = cols.where("parent_no IS NOT NULL").groupBy("trace_id", F.col("parent_no").alias("span_no")).agg(
        F.sum("duration_ms").alias("child_ms")
    )
    # What is known of a span number in one row: how long it took, its children, its depth.
    own = cols.groupBy("trace_id", "span_no").agg(F.max("duration_ms").alias("own_ms"))
    known = own.join(children, ["trace_id", "span_no"], "left").join(span_depths(cols), ["trace_id", "span_no"], "left")
    joined = cols.join(known.drop("own_ms"), ["trace_id", "span_no"], "left")
    parents = own.select("trace_id", F.col("span_no").alias("parent_no"), F.col("own_ms").alias("parent_ms"))
    joined = joined.join(parents, ["trace_id", "parent_no"], "left")
    child = F.coalesce("child_ms", F.lit(0.0))
    return joined.groupBy("service", "depth").agg(
        F.count(F.lit(1)).alias("spans"), F.round(F.sum(child), 2).alias("child_ms"),
        F.round(F.sum(F.greatest(F.lit(0.0), F.col("duration_ms") - child)), 2).alias("self_ms"),
        F.count_if(F.col("duration_ms") > F.col("parent_ms")).alias("longer_than_parent"),
        F.count_if(F.col("parent_no").isNotNull() & F.col("parent_ms").isNull()).alias("orphans"),
    )


def event_asof_metric(metrics: DataFrame, events: DataFrame, key: str, metric_id: str, event_id: str) -> DataFrame:
    """metrics + the latest event of the same key at or before the row, and its age.

    Both tables share one order; the last event is carried forward, also across slices of a hot key.
    """
    m = metrics.withColumns({"_t": micros("ts"), "_k": F.lit(1), "_id": F.col(metric_id).cast("string")})
    e = events.select(
        key, micros("ts").alias("_t"), F.lit(0).alias("_k"), F.col(event_id).cast("string").alias("_id"),
        F.struct(F.col(event_id).alias("id"), micros("ts").alias("t")).alias("_e"),
    )
    both = m.unionByName(e, allowMissingColumns=True)
    carried = running(both, [key], ["_t", "_k", "_id"], last={"_seen": F.col("_e")}).where("_k = 1")
    return carried.select(
        *metrics.columns, F.col("_seen.id").alias("event_id"), ((F.col("_t") - F.col("_seen.t")) / F.lit(1e6)).alias("event_age_s")
    )


def signal_timeline(
    facts: DataFrame, metrics: DataFrame, hosts: DataFrame, calls: DataFrame, step_seconds: int = 3600
) -> DataFrame:
    """One row per slot and region over all signals.

    Each signal is aggregated first; the small results are stacked and folded by
    one more aggregate, which equals a chain of full outer joins with one shuffle.
    """
    slot = [F.col("ts"), F.col("region")]
    f = facts.select(grid_floor("start_ts", step_seconds).alias("ts"), "region", "latency_ms", "status")
    traffic = exact_quantiles(
        f, ["ts", "region"], "latency_ms", {"p95_ms": 0.95},
        extra={"timeout_rate": share_of(F.col("status") == "timeout")},
    ).withColumn("p95_ms", F.round("p95_ms", 4))
    network = metrics.select(grid_floor("ts", step_seconds).alias("ts"), F.col("src").alias("region"), "value").groupBy(*slot).agg(
        F.round(F.max("value"), 4).alias("rtt")
    )
    cpu = hosts.select(grid_floor("ts", step_seconds).alias("ts"), "region", "cpu").groupBy(*slot).agg(F.max("cpu").alias("cpu_max"))
    phone = calls.select(grid_floor("call_ts", step_seconds).alias("ts"), "region").groupBy(*slot).agg(F.count(F.lit(1)).alias("calls"))
    stacked = traffic
    for part in (network, cpu, phone):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*slot).agg(
        *[F.max(c).alias(c) for c in ("p95_ms", "timeout_rate", "rtt", "cpu_max")],
        F.coalesce(F.max("calls"), F.lit(0).cast("bigint")).alias("calls"),
    )
