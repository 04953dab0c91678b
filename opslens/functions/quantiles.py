"""Exact quantiles whose memory does not grow with the size of a group.

The built-in exact ``percentile`` keeps every distinct value of a group in one
task, which fails when one region or one minute holds a large part of the table.
Here a group is read twice. The first pass keeps one bounded sketch per group and
yields values that enclose each wanted rank. The second pass counts the rows
below the enclosure and ranks only the distinct values inside it, which are a
fixed small share (``8 / accuracy``) of a large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.functions.scalars import join_null_safe
from opslens.session import frozen

ACCURACY = 10_000
MAX_BROADCAST_GROUPS = 100_000
HOT_SHARE = 1000
#: Distinct values of a group that one task ranks, and parts an enclosure is divided into for narrowing.
MOST, PARTS = 100_000, 64
SALTS = 64


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    how: str = "linear",
    extra: Mapping[str, Column] | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per key with the quantiles named in ``probs``.

    ``how="linear"`` interpolates between the two nearest ranks;
    ``how="nearest"`` returns the element at index ``min(n-1, floor(n*p))``.
    ``extra`` holds further plain aggregates over the same groups.
    """
    keys, names, extra = list(keys), list(probs), dict(extra or {})
    slack = 4.0 / accuracy
    edges = []
    for p in probs.values():
        edges += [max(0.0, p - slack), min(1.0, p + slack)]
    sketch = F.percentile_approx(F.col(value), edges, accuracy)
    bounds = frozen(df.groupBy(*keys).agg(
        F.count(value).alias("_size"), sketch.alias("_edge"), *[c.alias(n) for n, c in extra.items()]
    ))

    groups, largest = bounds.agg(F.count(F.lit(1)), F.max("_size")).first()
    rows = df.select(*keys, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if keys:
        rows = _join(rows, bounds.select(*keys, "_edge", "_size"), keys, groups)
    else:  # one group: its enclosures are a handful of numbers
        enclosing = bounds.select("_edge").first()[0] or [None] * len(edges)
        rows = rows.withColumn("_edge", F.array(*[F.lit(e).cast("double") for e in enclosing]))

    v = F.col("_v")
    at = range(len(names))
    rows = rows.select(
        *keys, v, *[F.col("_edge")[2 * i].alias(f"_lo{i}") for i in at], *[F.col("_edge")[2 * i + 1].alias(f"_hi{i}") for i in at]
    )
    inside = [(v >= F.col(f"_lo{i}")) & (v <= F.col(f"_hi{i}")) for i in at]
    counted = rows.withColumn("_x", F.when(reduce(or_, inside), v)).groupBy(*keys, "_x").agg(
        F.count(F.lit(1)).alias("_c"),
        *[F.count_if(v < F.col(f"_lo{i}")).alias(f"_lt{i}") for i in at],
        *[F.count_if(inside[i]).alias(f"_in{i}") for i in at],
        *[F.max(F.when(v < F.col(f"_lo{i}"), v)).alias(f"_under{i}") for i in at],
        *[F.min(F.when(v > F.col(f"_hi{i}"), v)).alias(f"_over{i}") for i in at],
    )

    # An enclosure holds 8 / accuracy of a group, and as much again if the sketch is off by its bound at both ends.
    if (largest or 0) * 16 * len(names) / accuracy > MOST:
        solved = _solve_narrowed(frozen(counted), keys, probs, how)
        return _with_extra(bounds, solved, keys, names, extra)

    whole = W.partitionBy(*[F.col(k) for k in keys]) if keys else W.partitionBy(F.lit(1))
    upto = whole.orderBy(F.col("_x").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    x = F.col("_x")
    ranked = counted.select(
        "*",
        F.sum("_c").over(whole).alias("_rows"),
        *[F.sum(f"_lt{i}").over(whole).alias(f"_base{i}") for i in at],
        *[F.sum(f"_in{i}").over(upto).alias(f"_cum{i}") for i in at],
        *[F.sum(f"_in{i}").over(whole).alias(f"_all{i}") for i in at],
    )

    n = F.col("_rows")
    picks, finals = [], []
    for i, name in enumerate(names):
        pos = _position(F.lit(float(probs[name])), n, how)
        for tag, rank in (("l", F.floor(pos)), ("h", F.ceil(pos))):
            first = F.col(f"_base{i}") + F.col(f"_cum{i}") - F.col(f"_in{i}")
            last = F.col(f"_base{i}") + F.col(f"_cum{i}")
            found = F.max(F.when((F.col(f"_in{i}") > 0) & (rank >= first) & (rank < last), x))
            below = F.max(F.when(rank == F.col(f"_base{i}") - 1, F.col(f"_under{i}")))
            above = F.min(F.when(rank == F.col(f"_base{i}") + F.col(f"_all{i}"), F.col(f"_over{i}")))
            picks.append(F.coalesce(found, below, above).alias(f"_{tag}{i}"))
        picks.append(F.max(pos).alias(f"_pos{i}"))
        finals.append(_between(F.col(f"_l{i}"), F.col(f"_h{i}"), F.col(f"_pos{i}"), how).alias(name))
    solved = ranked.groupBy(*keys).agg(*picks).select(*keys, *finals)
    return _with_extra(bounds, solved, keys, names, extra)


def _position(p: float, n: Column, how: str) -> Column:
    return p * (n - 1) if how == "linear" else F.least((n - 1).cast("double"), F.floor(n * p).cast("double"))


def _between(low: Column, high: Column, pos: Column, how: str) -> Column:
    missed = F.raise_error(F.lit("quantile rank fell outside its enclosure; raise accuracy"))
    value_at = low + (high - low) * (pos - F.floor(pos)) if how == "linear" else low
    return F.when(pos.isNull(), F.lit(None)).when(low.isNull() | high.isNull(), missed.cast("double")).otherwise(value_at)


def _with_extra(bounds: DataFrame, solved: DataFrame, keys: list[str], names: list[str], extra: Mapping[str, Column]) -> DataFrame:
    kept = bounds.select(*keys, *extra)
    if not keys:
        both = kept.unionByName(solved, allowMissingColumns=True) if extra else solved
        return both.agg(*[F.max(c).alias(c) for c in [*extra, *names]])
    return join_null_safe(kept, solved, keys, "left")


def _solve_narrowed(counted: DataFrame, keys: list[str], probs: Mapping[str, float], how: str) -> DataFrame:
    """The quantiles of each key from the counts of distinct values, where a key may have any number of these."""
    by = [*keys, "_all"]
    counted = counted.withColumn("_all", F.lit(0))
    totals = frozen(counted.groupBy(*by).agg(F.sum("_c").alias("_rows"), *[
        a for i in range(len(probs)) for a in (
            F.sum(f"_lt{i}").alias(f"_base{i}"), F.sum(f"_in{i}").alias(f"_sum{i}"), F.max(f"_under{i}").alias(f"_below{i}"), F.min(f"_over{i}").alias(f"_above{i}"))
    ]))
    solved = totals.select(*by)
    for i, (name, p) in enumerate(probs.items()):
        pos = _position(F.lit(float(p)), F.col("_rows"), how)
        wanted = totals.select(
            *by, pos.alias("_pos"), F.floor(pos).alias("_first"), F.ceil(pos).alias("_last"), F.col(f"_base{i}").alias("_base"),
            F.col(f"_sum{i}").alias("_sum"), F.col(f"_below{i}").alias("_below"), F.col(f"_above{i}").alias("_above"))
        inside = counted.where(F.col(f"_in{i}") > 0).select(*by, "_x", F.col(f"_in{i}").alias("_c"))
        inside, start = narrowed(inside, wanted, by)
        upto = W.partitionBy(*by).orderBy("_x").rowsBetween(W.unboundedPreceding, 0)
        ranked = inside.select(*by, "_x", "_c", F.sum("_c").over(upto).alias("_cum"))
        ranked = join_null_safe(join_null_safe(wanted, start, by, "left"), ranked, by, "left")
        end = F.col("_base") + F.coalesce("_skipped", F.lit(0)) + F.col("_cum")

        def at(rank: str) -> Column:
            found = F.max(F.when((F.col(rank) >= end - F.col("_c")) & (F.col(rank) < end), F.col("_x")))
            below = F.max(F.when(F.col(rank) == F.col("_base") - 1, F.col("_below")))
            above = F.min(F.when(F.col(rank) == F.col("_base") + F.col("_sum"), F.col("_above")))
            return F.coalesce(found, below, above)

        picked = ranked.groupBy(*by).agg(at("_first").alias("_l"), at("_last").alias("_h"), F.max("_pos").alias("_p"))
        solved = join_null_safe(solved, picked.select(*by, _between(F.col("_l"), F.col("_h"), F.col("_p"), how).alias(name)), by, "left")
    return solved.drop("_all")


def narrowed(inside: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """At most MOST of the distinct values ``inside`` (keys, _x, _c) of each key, those around the ranks ``_first`` to ``_last``
    of ``wanted``; and (keys, _skipped), the rows counted at values of ``inside`` left out below them.

    A round divides each key's values into PARTS parts of about as many distinct values and keeps the parts that hold a
    wanted rank, two at most. Values are distinct, so every round leaves a small share of them.
    """
    skipped = wanted.select(*keys, F.lit(0).cast("bigint").alias("_skipped"))
    while True:
        sizes = inside.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.percentile_approx("_x", [k / PARTS for k in range(1, PARTS)], ACCURACY).alias("_grid"))
        sizes = frozen(sizes)
        groups, largest = sizes.agg(F.count(F.lit(1)), F.max("_size")).first()
        if (largest or 0) <= MOST:
            return inside, skipped
        placed = _join(inside, sizes, keys, groups).withColumn("_part", F.size(F.filter("_grid", lambda e: e < F.col("_x")))).drop("_grid")
        parts = placed.groupBy(*keys, "_part").agg(F.sum("_c").alias("_rows"))
        before = F.coalesce(F.sum("_rows").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        ranges = join_null_safe(join_null_safe(parts.withColumn("_before", before), wanted.select(*keys, "_first", "_last", "_base"), keys), skipped, keys)
        start = F.col("_base") + F.col("_skipped") + F.col("_before")
        kept = frozen(ranges.where((start <= F.col("_last")) & (start + F.col("_rows") > F.col("_first"))).select(
            *keys, "_part", (F.col("_skipped") + F.col("_before")).alias("_skipped")))
        inside = frozen(join_null_safe(placed, kept.drop("_skipped"), [*keys, "_part"], "left_semi").select(*keys, "_x", "_c"))
        skipped = frozen(kept.groupBy(*keys).agg(F.min("_skipped").alias("_skipped")))


def _join(rows: DataFrame, lookup: DataFrame, keys: list[str], groups: int) -> DataFrame:
    """Attach one lookup row per key: broadcast if there are few (``groups``), else a shuffle with salted hot keys.

    A key is hot if it holds more than 1/HOT_SHARE of all rows, so at most HOT_SHARE keys are;
    only these are broadcast as a set and spread over salts.
    """
    if groups <= MAX_BROADCAST_GROUPS:
        # Without keys there is one lookup row, and Spark needs no condition for it.
        small = F.broadcast(lookup.drop("_size"))
        return join_null_safe(rows, small, keys) if keys else rows.join(small, keys)
    total = lookup.agg(F.sum("_size")).first()[0] or 0
    is_hot = F.col("_size") * HOT_SHARE > total
    hot = F.broadcast(lookup.where(is_hot).select(*keys, F.lit(True).alias("_hot")))
    value = [c for c in rows.columns if c not in keys]
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(*value), F.lit(SALTS)).cast("int")).otherwise(0)
    salted = join_null_safe(rows, hot, keys, "left").withColumn("_salt", spread).drop("_hot")
    copies = F.explode(F.sequence(F.lit(0), F.when(is_hot, SALTS - 1).otherwise(0)))
    return join_null_safe(salted, lookup.withColumn("_salt", copies).drop("_size"), [*keys, "_salt"]).drop("_salt")
