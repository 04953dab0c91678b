"""Shared functions against plain Python on small frames, including skewed and edge-case groups."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslens.functions import intervals
from opslens.functions.intervals import first_interval
from opslens.functions.quantiles import exact_quantiles
from opslens.functions.running import running
from opslens.functions.scalars import half_up, number_or_zero, ratio
from opslens.session import shared_dir, within


def nearest(values, p):
    values = sorted(values)
    return values[min(len(values) - 1, math.floor(len(values) * p))]


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_equal_numpy_on_skewed_groups(spark, accuracy):
    """A low accuracy makes the enclosures narrow, as they are on huge groups."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([rng.random() * 5, rng.paretovariate(1.1)])) for _ in range(6000)]
    rows += [("ties", float(rng.randint(0, 3))) for _ in range(900)]
    rows += [("one", 4.5), ("two", 1.0), ("two", 2.0)] + [("twenty", float(i)) for i in range(20)] + [("hundred", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows + [("none", None)], "g string, x double").repartition(7)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    groups = {}
    for g, x in rows:
        groups.setdefault(g, []).append(x)
    linear = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs, extra={"n": F.count("x")}, accuracy=accuracy).collect()}
    near = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs, how="nearest", accuracy=accuracy).collect()}
    assert linear["none"]["p50"] is None and linear["none"]["n"] == 0
    for g, xs in groups.items():
        assert linear[g]["n"] == len(xs)
        for name, p in probs.items():
            assert linear[g][name] == pytest.approx(np.quantile(xs, p), abs=1e-9)
            assert near[g][name] == nearest(xs, p)


def test_quantiles_without_keys(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(df, [], "x", {"p": 0.5}, extra={"n": F.count("x")}).first().asDict() == {"p": 500.0, "n": 1001}
    assert exact_quantiles(df.where("x < 0"), [], "x", {"p": 0.5}, extra={"n": F.count("x")}).first().asDict() == {"p": None, "n": 0}


def test_quantiles_with_salted_lookup(spark, monkeypatch):
    import opslens.functions.quantiles as q

    monkeypatch.setattr(q, "MAX_BROADCAST_GROUPS", 0)
    monkeypatch.setattr(q, "HOT_SHARE", 2)
    df = spark.range(5000).select(F.greatest(F.col("id") % 3, (F.col("id") < 4000).cast("int") * 2).alias("g"), F.col("id").cast("double").alias("x"))
    got = {r["g"]: r["p"] for r in exact_quantiles(df, ["g"], "x", {"p": 0.95}).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(np.quantile([i for i in range(5000) if max(i % 3, 2 * (i < 4000)) == g], 0.95))


@pytest.mark.parametrize("broadcast,how", [(0, "linear"), (100_000, "nearest")])
def test_quantiles_narrow_until_few_values_are_ranked(spark, monkeypatch, broadcast, how):
    import opslens.functions.quantiles as q

    seen, narrow = [], q.narrowed

    def watched(inside, wanted, keys):
        out = narrow(inside, wanted, keys)
        seen.append(out[0].groupBy(*keys).count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(q, "MOST", 40)
    monkeypatch.setattr(q, "narrowed", watched)
    monkeypatch.setattr(q, "MAX_BROADCAST_GROUPS", broadcast)
    rng = random.Random(8)
    rows = [("hot", rng.random()) for _ in range(20_000)] + [("ties", rng.choice([1.0, 2.0, 1.0 + rng.random()])) for _ in range(6000)]
    rows += [(None, rng.gauss(0, 1)) for _ in range(3000)] + [("one", 4.5), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", probs, how=how, extra={"n": F.count("x")}, accuracy=20).collect()}
    assert got["none"]["p50"] is None and len(got) == 6
    for g in {r[0] for r in rows} - {"none"}:
        xs = [x for k, x in rows if k == g]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(xs, p) if how == "linear" else nearest(xs, p), abs=1e-9)
    assert len(seen) == 3 and max(seen) <= 40
    one = exact_quantiles(df.where("g = 'hot'"), [], "x", {"p": 0.7}, accuracy=20).first()
    assert one.p == pytest.approx(np.quantile([x for g, x in rows if g == "hot"], 0.7), abs=1e-9)


def test_running_kinds_with_a_hot_key_over_many_slices(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.8 else "cold", i, rng.choice([None, rng.randint(0, 99)])) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, i int, v int").repartition(5)
        got = running(
            df, ["g"], ["i"], sums={"s": F.coalesce("v", F.lit(0))}, max_before={"m": F.col("v")}, last={"l": F.col("v")},
            last_before={"lb": F.col("v")}, next={"n": F.col("v")}, next_after={"na": F.col("v")}, keep_slices=True,
        ).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r["_slice"] for r in got if r["g"] == "hot"}) > 2
    for g in ("hot", "cold"):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["i"])
        seen = [v for v in (r["v"] for r in mine)]
        for at, r in enumerate(mine):
            before = [v for v in seen[:at] if v is not None]
            after = [v for v in seen[at + 1:] if v is not None]
            here = [seen[at]] if seen[at] is not None else []
            assert r["s"] == sum(before + here)
            assert r["m"] == (max(before) if before else None)
            assert r["l"] == ((before + here)[-1] if before + here else None)
            assert r["lb"] == (before[-1] if before else None)
            assert r["n"] == ((here + after)[0] if here + after else None)
            assert r["na"] == (after[0] if after else None)


@pytest.mark.parametrize("part", [["g"], []])
def test_two_latest_values_of_different_keys_over_many_slices(spark, part):
    rng = random.Random(9)
    rows = [("hot" if rng.random() < 0.8 else None, i, rng.choice("AAAAAAAAAAAAAAAAB" if i < 900 else "CD"), rng.choice([None, i])) for i in range(1500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, i int, k string, v int").repartition(4)
        got = running(df, part, ["i"], two_last={"p": (F.col("v"), F.col("k"))}, two_next={"n": (F.col("v"), F.col("k"))}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def two(seen):
        seen = [r for r in seen if r[3] is not None]
        first = seen[0] if seen else None
        other = next((r for r in seen if r[2] != first[2]), None) if first else None
        return tuple(r and r[3] for r in (first, other))

    assert len(got) == len(rows)
    for r in got:
        mine = [x for x in rows if not part or x[0] == r.g]
        assert (r.p.a, r.p.b) == two([x for x in reversed(mine) if x[1] <= r.i]) and (r.n.a, r.n.b) == two([x for x in mine if x[1] >= r.i])


def test_running_over_one_global_order(spark):
    df = spark.range(2000, numPartitions=6).select(F.col("id").alias("i"))
    got = running(df, [], ["i"], sums={"s": F.lit(1)}).where("s <> i + 1").count()
    assert got == 0


def test_running_rejects_unknown_kind(spark):
    with pytest.raises(ValueError):
        running(spark.range(1), [], ["id"], median={"x": F.lit(1)})


def test_first_interval_half_open_priority_and_any_region(spark):
    t0 = datetime(2024, 1, 1)
    wins = spark.createDataFrame(
        [("late", "*", t0, t0 + timedelta(hours=5), 2), ("first", "A", t0 + timedelta(minutes=30), t0 + timedelta(minutes=90), 1),
         ("empty", "*", t0, t0, 0)],
        "name string, r string, a timestamp_ntz, b timestamp_ntz, p int",
    )
    at = [("A", 29), ("A", 30), ("A", 89), ("A", 90), ("B", 45), ("B", 300), ("B", -1), ("B", 299)]
    df = spark.createDataFrame([(i, g, t0 + timedelta(minutes=m)) for i, (g, m) in enumerate(at)], "i int, g string, ts timestamp_ntz")
    got = first_interval(df, "ts", wins, "name", "hit", "a", "b", "p", region="g", window_region="r").orderBy("i").collect()
    assert [r["hit"] for r in got] == ["late", "first", "first", "late", "late", None, None, "late"]


def slow_first(windows, t, g):
    fits = [w for w in windows if w[2] <= t < w[3] and w[1] in ("*", g)]
    return min(fits, key=lambda w: (w[4], w[2], w[3], w[0]))[0] if fits else None


@pytest.mark.parametrize("small", [0, 1000])
def test_intervals_cut_by_spark_and_on_the_driver_agree_with_a_scan(spark, monkeypatch, small):
    monkeypatch.setattr(intervals, "SMALL", small)
    t0, rng = datetime(2024, 1, 1), random.Random(small)
    wins = []
    for i in range(150):
        a = rng.randint(0, 300)
        wins.append((f"w{i}", rng.choice("*AB"), t0 + timedelta(seconds=a), t0 + timedelta(seconds=a + rng.choice([0, 1, 5, 80])), rng.randint(0, 20)))
    rows = [(i, rng.choice(["A", "B", "C", None]), t0 + timedelta(seconds=rng.randint(-5, 400))) for i in range(500)]
    w = spark.createDataFrame(wins, "name string, r string, a timestamp_ntz, b timestamp_ntz, p int")
    df = spark.createDataFrame(rows, "i int, g string, ts timestamp_ntz")
    got = first_interval(df, "ts", w, "name", "hit", "a", "b", "p", region="g", window_region="r").collect()
    assert {r.i: r.hit for r in got} == {i: slow_first(wins, t, g) for i, g, t in rows} and len(got) == len(rows)
    plain = first_interval(df, "ts", w, "name", "hit", "a", "b", "p", piece="at").collect()
    all_any = [(n, "*", a, b, p) for n, _, a, b, p in wins]
    assert {r.i: r.hit for r in plain} == {i: slow_first(all_any, t, g) for i, g, t in rows}
    edges = sorted({x for w_ in wins if w_[2] < w_[3] for x in w_[2:4]})
    for r in plain:
        assert (r.at is None) == (r.hit is None)
        if r.hit:
            assert t0 + timedelta(microseconds=r.at - 1704067200000000) == max(e for e in edges if e <= r.ts)


def test_ten_thousand_windows_in_one_hour(spark):
    """No row of any stage holds more than one window, and rows stay as many as they are."""
    t0, n = datetime(2024, 1, 1), 10_000
    w = spark.range(n).select(
        F.col("id").alias("w"), (F.col("id") * 7919 % n).alias("p"), F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 100_000).alias("a"),
        F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 100_000 + 1_200_000_000 + F.col("id") % 13 * 50_000_000).alias("b"))
    df = spark.range(2000).select("id", F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 1_800_000 + 7).alias("ts"))
    got = {r.id: r.hit for r in first_interval(df, "ts", w, "w", "hit", "a", "b", "p").collect()}
    a = np.arange(n) * 100_000
    b, p = a + 1_200_000_000 + np.arange(n) % 13 * 50_000_000, np.arange(n) * 7919 % n
    for i in range(2000):
        open_ = np.flatnonzero((a <= i * 1_800_000 + 7) & (b > i * 1_800_000 + 7))
        assert got[i] == (int(open_[p[open_].argmin()]) if len(open_) else None)
    cut = intervals.pieces(w.select(F.struct("p", F.unix_micros("a").alias("a"), F.unix_micros("b").alias("b"), F.col("w").alias("v")).alias("_w")), [])
    assert cut.count() <= 2 * n and cut.groupBy("_a").count().where("count > 1").isEmpty()


def test_scalars(spark):
    df = spark.createDataFrame([("1.5", 1, 0), ("", 1, 8), (None, 0, 0), ("x", 2, 3)], "t string, a int, b int")
    got = df.select(number_or_zero("t").alias("n"), ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [tuple(r) for r in got] == [(1.5, 0.0), (0.0, 0.125), (0.0, 0.0), (0.0, 0.6667)]
    assert spark.range(1).select(half_up(F.lit(0.125), 2)).first()[0] == 0.13


def test_within_and_shared_dir(spark):
    assert within(spark.range(5), 5) and not within(spark.range(6), 5)
    assert shared_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def test_null_keys_keep_their_values(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit("a")).alias("k"), "id")
    counted = running(rows, ["k"], ["id"], sums={"n": F.lit(1)})
    assert {r.k: r.m for r in counted.groupBy("k").agg(F.max("n").alias("m")).collect()} == {"a": 2000, None: 2000}
    got = {r.k: r.p for r in exact_quantiles(rows.withColumn("x", F.col("id").cast("double")), ["k"], "x", {"p": 0.5}).collect()}
    assert got == {"a": 1999.0, None: 2000.0}
