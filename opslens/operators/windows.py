"""Running computations over ordered rows, all built on range-partitioned slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.quantiles import exact_quantiles
from opslens.functions.running import running
from opslens.functions.scalars import is_absent, join_null_safe, micros, ratio, seconds_between
from opslens.session import broadcast_if_small, frozen

# Bounds of the missing-reference rate.
MISSING_BOUNDS = (0.02, 0.035)


def running_noise_rate(calls: DataFrame, part: Sequence[str], bounds: tuple[float, float] = MISSING_BOUNDS) -> DataFrame:
    """As of each call: cumulative noise counts, their rates, and the allowed range of missing references."""
    base = calls.select("call_id", *part, "call_ts", "noise_type", "ref")

    def one(cond):
        return F.when(cond, 1).otherwise(0)

    rows = running(
        base, part, ["call_ts", "call_id"],
        sums={
            "n": F.lit(1), "missing": one(is_absent("ref")),
            "fabricated": one(F.col("noise_type") == "fabricated"), "wrong": one(F.col("noise_type") == "wrong_customer"),
        },
    )
    n, missing, fabricated = F.col("n"), F.col("missing"), F.col("fabricated")
    return rows.select(
        "call_id", *part, "n", "missing", "fabricated", "wrong", ratio(missing, n).alias("missing_rate"),
        ratio(fabricated, n - missing).alias("fabricated_rate"), ratio(F.col("wrong"), n - missing - fabricated).alias("wrong_rate"),
        F.ceil(F.lit(bounds[0]) * n).alias("lower"), F.floor(F.lit(bounds[1]) * n).alias("upper"),
    )


def spike_islands(metrics: DataFrame, key: str, order: Sequence[str], k: float) -> DataFrame:
    """Contiguous rows above ``k`` times the key's median, as bursts.

    Within a burst no calm row intervenes, so the running count of calm rows names the burst.
    """
    metrics = frozen(metrics.select(key, "ts", "value", *[c for c in order if c not in ("ts", "value")]))
    medians = exact_quantiles(metrics, [key], "value", {"_median": 0.5})
    rows = join_null_safe(metrics, broadcast_if_small(frozen(medians)), [key])
    rows = rows.withColumn("_high", F.col("value") > k * F.col("_median")).drop("_median")
    numbered = running(rows, [key], order, sums={"_calm": F.when(F.col("_high"), 0).otherwise(1)})
    return numbered.where("_high").groupBy(key, "_calm").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("n"), F.max("value").alias("peak")
    ).drop("_calm")


def nearest_rank_window(df: DataFrame, keys: Sequence[str], x: str, p: float, tie: Sequence[str]) -> DataFrame:
    """Element at index min(n-1, floor(n*p)) per key, found by its running row number."""
    keys = list(keys)
    rows = running(df.select(*keys, x, *tie).where(F.col(x).isNotNull()), keys, [x, *tie], sums={"_r": F.lit(1)})
    n = F.col("n")
    wanted = df.where(F.col(x).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        *keys, (F.least(n - 1, F.floor(n * F.lit(p))) + 1).alias("_r")
    )
    # One row per key: few keys reach the numbered rows where they are, which then need no shuffle.
    return join_null_safe(rows, broadcast_if_small(frozen(wanted)), [*keys, "_r"]).select(*keys, F.col(x).alias("value"))


def event_numbering(events: DataFrame) -> DataFrame:
    rows = running(events, [], ["ts", "seq"], sums={"_n": F.lit(1)})
    return rows.select(F.format_string("EVT-%06d", F.col("_n") - 1).alias("event_key"), *events.columns)


def arrival_disorder(df: DataFrame, seq: str, ts: str) -> DataFrame:
    """Rows whose time precedes that of any row with a lower sequence number."""
    rows = running(df.select(seq, ts), [], [seq], max_before={"_peak": F.col(ts)})
    late = F.coalesce(F.col(ts) < F.col("_peak"), F.lit(False))
    return rows.select(
        F.col(seq).alias("seq"), late.alias("late"), F.when(late, seconds_between("_peak", ts)).otherwise(F.lit(0.0)).alias("lateness_s")
    )


def lookback_count(facts: DataFrame, region: str, ts: str, ended: str, horizon_seconds: int = 7200) -> DataFrame:
    """Per row: transactions of the region that ended in the ``horizon`` before it (both ends included).

    The count is the difference of two running counts, so no row meets another.
    """
    span = horizon_seconds * 1_000_000
    ends = facts.select(region, micros(ended).alias("t"), F.lit(1).alias("k"), "seq", F.lit(0).alias("sign"))
    edges = F.array(
        F.struct(F.lit(-span).alias("o"), F.lit(0).alias("k"), F.lit(-1).alias("sign")),
        F.struct(F.lit(0).alias("o"), F.lit(2).alias("k"), F.lit(1).alias("sign")),
    )
    probes = facts.select(region, micros(ts).alias("_t"), "seq", F.explode(edges).alias("e")).select(
        region, (F.col("_t") + F.col("e.o")).alias("t"), "e.k", "seq", "e.sign"
    )
    rows = running(ends.unionByName(probes), [region], ["t", "k", "seq"], sums={"c": F.when(F.col("k") == 1, 1).otherwise(0)})
    return rows.where("sign <> 0").groupBy("seq").agg(F.sum(F.col("sign") * F.col("c")).alias("prior_txns"))


def attempt_sequence(logs: DataFrame) -> DataFrame:
    tries = logs.where(F.col("event") == "worker_progress").select("txn_id", "ts", F.col("attempt").alias("_a"))
    rows = running(
        tries, ["txn_id"], ["ts", "_a"], sums={"attempt": F.lit(1)}, last_before={"_prev": F.col("ts")},
        next_after={"_next": F.col("ts")},
    )
    return rows.select(
        "txn_id", "attempt", ((micros("ts") - micros("_prev")) / F.lit(1000.0)).alias("gap_ms"), F.col("_next").isNull().alias("is_last")
    )


def recovery_time(kpi: DataFrame, baseline: DataFrame, fix, factor: float) -> DataFrame:
    """First slot at or after the fix whose p95 is back within ``factor`` times the baseline.

    ``kpi`` has (ts, region, p95_ms) and ``baseline`` (region, p95_baseline); both are small aggregates.
    """
    back = (F.col("ts") >= fix) & (F.col("p95_ms") <= factor * F.col("p95_baseline"))
    return kpi.join(baseline, "region").groupBy("region").agg(F.min(F.when(back, F.col("ts"))).alias("recovered_at")).withColumn(
        "minutes_after_fix", seconds_between("recovered_at", fix) / 60
    )
