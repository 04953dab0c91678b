"""Operators on hand-made frames and invariants over the role tables."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslens.functions.scalars import ntz
from opslens.operators import joins, rollups, shape, windows
from opslens.plans import roles

T0 = datetime(2024, 1, 1)


def logs_of(spark, pairs):
    return spark.createDataFrame([(t, c, "received") for t, c in pairs], "txn_id string, customer_id bigint, event string")


def calls_of(spark, rows):
    return spark.createDataFrame(
        [(f"C{i}", c, ref, kind) for i, (c, ref, kind) in enumerate(rows)], "call_id string, customer_id bigint, ref string, noise_type string"
    )


def test_confusion_matrix_classes_and_rates(spark):
    logs = logs_of(spark, [("T1", 1), ("T1", 1), ("T2", 2)])
    calls = calls_of(spark, [(1, "T1", "clean"), (1, "T2", "wrong_customer"), (1, "", "missing"), (1, None, "missing"), (1, "FAKE", "fabricated")])
    row = joins.link_confusion_matrix(calls, logs).first()
    assert (row.tp, row.fn, row.fp, row.wrong_link) == (1, 2, 1, 1)
    assert (row.fn_rate, row.fp_rate_non_empty, row.wrong_link_rate_joined, row.tp_rate) == (0.4, 0.3333, 0.5, 0.2)
    assert joins.link_nonexistent_rate(calls, logs).first()[0] == 0.3333
    assert joins.link_mismatch_rate(calls, logs).first()[0] == 0.5
    score = {r.noise_type: (r.tp, r.fp, r.fn) for r in joins.truth_scoring(joins.link_classes(calls, logs)).collect()}
    assert score["missing"] == (2, 0, 0) and score["clean"] == (1, 0, 0)


def test_rates_are_zero_without_calls(spark):
    logs, none = logs_of(spark, [("T1", 1)]), calls_of(spark, [(1, "", "missing")]).where("false")
    row = joins.link_confusion_matrix(none, logs).first()
    assert (row.tp, row.fn_rate, row.fp_rate_non_empty, row.wrong_link_rate_joined, row.tp_rate) == (0, 0.0, 0.0, 0.0, 0.0)
    assert joins.link_nonexistent_rate(none, logs).first()[0] == 0.0
    assert joins.link_mismatch_rate(none, logs).first()[0] == 0.0
    assert rollups.link_missing_rate(none).first().missing_rate == 0.0


def test_classes_add_up_to_all_calls(spark, sf_dir):
    calls, logs = roles.calls(spark, sf_dir), roles.logs(spark, sf_dir)
    row = joins.link_confusion_matrix(calls, logs).first()
    assert row.tp + row.fn + row.fp + row.wrong_link == calls.count()


def test_rebuild_inverts_the_fan_out(spark, sf_dir):
    facts = roles.flagged(spark, sf_dir)
    back = shape.txn_rebuild(shape.lifecycle_explode(facts))
    joined = back.join(facts.select("txn_id", "retry_count", "status", F.col("latency_ms").alias("ms"), "start_ts", "skew_ms"), "txn_id")
    assert joined.count() == facts.count()
    wrong = joined.where(
        (F.col("attempts") != F.col("retry_count") + 1) | (F.col("latency_ms") != F.round("ms", 2))
        | ((F.col("status") == "timeout") != (F.col("final_event") == "timeout"))
    )
    assert wrong.count() == 0


def test_fan_out_of_one_transaction(spark):
    cols = ("txn_id string, seq bigint, customer_id bigint, region string, txn_type string, circuit_id string, dep_region string, "
            "status string, retry_count int, latency_ms double, dep_latency_ms double, skew_ms int, start_ts timestamp_ntz, "
            "end_ts timestamp_ntz, impacted_by_primary boolean")
    rows = [("A", 1, 1, "r", "t", "K", "q", "timeout", 1, 100.0, 20.5, -250, T0, T0 + timedelta(milliseconds=100), True),
            ("B", 2, 1, "r", "t", None, None, "retry", 0, 100.0, None, 0, T0, T0 + timedelta(milliseconds=100), False)]
    out = shape.lifecycle_explode(spark.createDataFrame(rows, cols)).orderBy("txn_id", "event_no").collect()
    a, b = [r for r in out if r.txn_id == "A"], [r for r in out if r.txn_id == "B"]
    assert [r.event for r in a] == [
        "received", "queued", "orchestrated", "dependency_call", "worker_progress", "dependency_call", "worker_progress", "timeout", "retry"]
    assert [r.service for r in a][4:7:2] == ["worker-retry", "worker"]
    base = T0 - timedelta(milliseconds=250)
    assert [(r.ts - base) / timedelta(milliseconds=1) for r in a] == [0, 10, 40, 90, 110.5, 120, 140.5, 100, 105]
    assert [r.level for r in a] == ["INFO", "INFO", "INFO", "WARN", "INFO", "WARN", "INFO", "ERROR", "WARN"]
    assert a[7].http_status == "504" and a[7].error_code == "DEP_TIMEOUT" and a[7].message == "timeout"
    assert [r.event for r in b] == ["received", "queued", "orchestrated", "worker_progress", "completed"]
    assert b[4].http_status == "202" and b[4].message == "retry" and b[3].ts == T0 + timedelta(milliseconds=170)


def test_decoys_equal_brute_force_with_ties_and_hot_region(spark):
    rng = random.Random(11)
    txns = [(i, f"T{i:04d}", "hot" if rng.random() < 0.8 else "cold", rng.randint(1, 4), T0 + timedelta(seconds=rng.randint(0, 5 * 3600))) for i in range(400)]
    calls = [(1000 + i, f"C{i}", rng.choice(["hot", "cold", "none"]), rng.randint(1, 4), T0 + timedelta(seconds=rng.randint(0, 6 * 3600))) for i in range(120)]
    t = spark.createDataFrame(txns, "seq bigint, txn_id string, region string, customer_id bigint, end_ts timestamp_ntz")
    c = spark.createDataFrame(calls, "seq bigint, call_id string, region string, customer_id bigint, call_ts timestamp_ntz")
    got = {r.call_id: r for r in joins.decoy_candidates(c, t).collect()}
    assert len(got) == len(calls)
    for _, cid, region, cust, at in calls:
        near = [(abs((e - at).total_seconds()), x) for _, x, r, cu, e in txns if r == region and cu != cust]
        all_ = [g for g in near if g[0] <= 7200]
        pref = [g for g in near if 1200 <= g[0] <= 4800]
        r = got[cid]
        assert (r.candidates, r.preferred) == (len(all_), len(pref))
        pool = pref or all_
        if not pool:
            assert r.nearest_txn_id is None
        else:
            assert r.nearest_txn_id in {x for g, x in pool if g == min(p[0] for p in pool)}


def test_decoy_probes_are_narrow(spark, monkeypatch):
    wide, run = [], joins.running
    monkeypatch.setattr(joins, "running", lambda df, *a, **k: wide.append(set(df.columns)) or run(df, *a, **k))
    t = spark.createDataFrame([(1, "T", "r", 1, T0)], "seq bigint, txn_id string, region string, customer_id bigint, end_ts timestamp_ntz")
    c = spark.createDataFrame([(2, "C", "r", 2, T0 + timedelta(minutes=30))], "seq bigint, call_id string, region string, customer_id bigint, call_ts timestamp_ntz")
    assert [tuple(r) for r in joins.decoy_candidates(c, t).collect()] == [("C", 1, 1, "T")]
    assert len(wide) == 2 and all(w <= {"region", "customer_id", "seq", "id", "t", "e"} for w in wide)


def test_decoy_slices_follow_the_rows(spark, monkeypatch):
    given, run = [], joins.running
    monkeypatch.setattr(joins, "SLICE_ROWS", 100)
    monkeypatch.setattr(joins, "running", lambda df, *a, **k: given.append(k["slices"]) or run(df, *a, **k))
    test_decoys_equal_brute_force_with_ties_and_hot_region(spark)
    assert given == [14, 14]  # 400 points and 8 probes of 120 calls


def test_spike_islands_break_at_calm_rows(spark):
    values = [1, 1, 9, 8, 1, 1, 7, 1, 1, 1, 9]
    rows = [("k", T0 + timedelta(minutes=i), float(v), i) for i, v in enumerate(values)]
    m = spark.createDataFrame(rows, "circuit string, ts timestamp_ntz, value double, i int")
    got = windows.spike_islands(m, "circuit", ["ts", "i"], 3.0).orderBy("start_ts").collect()
    assert [(r.n, r.peak) for r in got] == [(2, 9.0), (1, 7.0), (1, 9.0)]
    assert got[0].start_ts == T0 + timedelta(minutes=2) and got[0].end_ts == T0 + timedelta(minutes=3)


@pytest.mark.parametrize("n", [1, 20, 100])
def test_nearest_rank_by_row_number_equals_kpi(spark, n):
    rows = [(T0, "r", "t", float(i * 7 % n), "timeout" if i % 4 == 0 else "success", i % 2, i) for i in range(n)]
    f = spark.createDataFrame(rows, "start_ts timestamp_ntz, region string, txn_type string, latency_ms double, status string, retry_count int, seq int")
    kpi = rollups.service_kpi(f).first()
    by_row = windows.nearest_rank_window(f, ["region"], "latency_ms", 0.95, ["seq"]).first()
    assert kpi.p95_ms == by_row.value == float(min(n - 1, int(n * 0.95)))
    errors, retries = -(-n // 4), n // 2
    load = 0.15 + 0.7 * retries / n + errors / n + 0.25 * min(1.0, kpi.p95_ms / 2500)
    assert kpi.saturation == pytest.approx(min(1.0, load), abs=6e-5) and kpi.request_rate == round(n / 60, 4)


def test_ratio_is_zero_for_a_zero_base(spark):
    rows = [("r", T0, 0.0, "completed"), ("r", T0 + timedelta(hours=2), 5.0, "completed"), ("late", T0 + timedelta(hours=9), 1.0, "completed")]
    df = spark.createDataFrame(rows, "region string, ts timestamp_ntz, end_to_end_latency_ms double, event string")
    got = {r.region: r for r in rollups.incident_multiplier(df, ntz("2024-01-01 01:00:00"), ntz("2024-01-01 03:00:00")).collect()}
    assert got["r"].p95_multiplier == 0.0 and got["r"].p95_incident == 5.0
    assert got["late"].p95_baseline is None and got["late"].p95_multiplier is None


def test_circuit_reasons_and_severity(spark):
    circuits = spark.createDataFrame([("K1", "a", "b")], "circuit_id string, src string, dst string")
    rows = [("T1", "K1", "a", "b"), ("T2", None, "a", "b"), ("T3", "K9", "a", "b"), ("T4", "K1", "b", "a"), ("T5", None, "a", None)]
    facts = spark.createDataFrame(rows, "txn_id string, circuit_id string, region string, dep_region string")
    got = {r.reason: r.rows for r in joins.circuit_consistency(facts, circuits).collect()}
    assert got == {"missing": 1, "unknown": 1, "mismatch": 1}
    ev = spark.createDataFrame([("packet_loss_burst", "critical"), ("maintenance", "info")], "event_type string, reported_severity string")
    assert [r.severity for r in shape.severity_normalise(ev).collect()] == ["warning", "info"]


def test_span_tree_flags_orphans(spark):
    rows = [("t", 1, None, "api", 10.0), ("t", 2, 1, "orch", 12.0), ("t", 3, 9, "worker", 1.0)]
    s = spark.createDataFrame(rows, "trace_id string, span_no int, parent_no int, service string, duration_ms double")
    got = {r.service: r for r in joins.span_tree(s).collect()}
    assert got["orch"].longer_than_parent == 1 and got["api"].self_ms == 0.0 and got["worker"].orphans == 1


def test_span_depths_have_no_bound(spark):
    rows = [("t", i, i - 1 if i else None, f"s{i}", 1.0) for i in range(6)] + [("u", 1, 2, "loop", 1.0), ("u", 2, 1, "loop", 1.0)]
    s = spark.createDataFrame(rows, "trace_id string, span_no int, parent_no int, service string, duration_ms double")
    got = {r.service: r.depth for r in joins.span_tree(s).collect()}
    assert got == {**{f"s{i}": i for i in range(6)}, "loop": None}


def test_a_thousand_levels_take_ten_rounds(spark, monkeypatch):
    rounds, keep = [], joins.frozen
    monkeypatch.setattr(joins, "frozen", lambda df: rounds.append(1) or keep(df))
    chain = [("t", i, i - 1 if i else None) for i in range(1000)] + [("u", 1, 3), ("u", 2, 1), ("u", 3, 2), ("u", 4, 3), ("u", 9, 8)]
    # Two ways up of different length, one of them through a circle.
    chain += [("v", 0, None), ("v", 1, 0), ("v", 2, 1), ("v", 3, 2), ("v", 3, 0), ("v", 4, 3), ("v", 5, 6), ("v", 6, 5), ("v", 6, 4), (None, 1, None)]
    s = spark.createDataFrame(random.Random(1).sample(chain, len(chain)), "trace_id string, span_no int, parent_no int").repartition(4)
    got = {(r.trace_id, r.span_no): r.depth for r in joins.span_depths(s).collect()}
    want = {("t", i): i for i in range(1000)} | {("v", 0): 0, ("v", 1): 1, ("v", 2): 2, ("v", 3): 1, ("v", 4): 2, ("v", 6): 3, ("v", 5): 4, (None, 1): 0}
    assert got == want and len(rounds) <= 13


def test_seasonal_mean_counts_days_without_rows(spark):
    rows = [(T0 + timedelta(days=1, minutes=i),) for i in range(6)] + [(T0 + timedelta(days=2, hours=9),)]
    got = {r.hour: r.observed for r in rollups.seasonal_profile(spark.createDataFrame(rows, "start_ts timestamp_ntz")).collect()}
    assert got[(T0 + timedelta(days=1)).hour] == 3.0


def test_referential_check_is_full_without_refs(spark):
    facts = spark.createDataFrame([("T1",)], "txn_id string")
    spans = facts.where("false")
    calls = spark.createDataFrame([("",), (None,)], "ref string")
    assert tuple(joins.span_referential_check(spans, calls, facts).first()) == (100.0, 100.0)


def test_alert_quality_counts_overlapping_windows(spark):
    w = spark.createDataFrame([(1, T0, T0 + timedelta(hours=1)), (2, T0, T0 + timedelta(hours=2)), (3, T0 + timedelta(hours=8), T0 + timedelta(hours=9))],
                              "window_id int, w0 timestamp_ntz, w1 timestamp_ntz")
    a = spark.createDataFrame([(T0 + timedelta(minutes=5),), (T0 + timedelta(hours=5),)], "ts timestamp_ntz")
    assert rollups.alert_quality(a, w).first().asDict() == {"tp": 1, "fp": 1, "fn": 1}


def test_long_sequence_numbers_are_not_cut(spark):
    e = spark.createDataFrame([(T0, 1)], "ts timestamp_ntz, seq bigint")
    assert windows.event_numbering(e).first().event_key == "EVT-000000"
    f = spark.createDataFrame([("TX-20240101000000-123456789", 123456789, T0)], "txn_id string, seq bigint, start_ts timestamp_ntz")
    assert shape.txn_key_build_parse(f).first().agrees


def test_incident_circuit_keeps_its_own_severity(spark):
    ev = spark.createDataFrame(
        [(1, "K", "packet_loss_burst", "warning"), (2, "K", "reroute", "warning"), (3, "K", "flap", "critical"), (4, "X", "reroute", "info"),
         (5, None, "packet_loss_burst", "critical")], "n int, circuit_id string, event_type string, reported_severity string")
    got = shape.severity_normalise(ev, "K").orderBy("n").collect()
    assert [r.severity for r in got] == ["critical", "info", "warning", "warning", "warning"]
    assert got[0].description != got[4].description and got[1].description != got[3].description


def test_routes_outside_the_region_list_stay(spark):
    facts = spark.createDataFrame([("a", "b"), ("x", "a"), ("a", None)], "region string, dep_region string")
    regions = spark.createDataFrame([("a",), ("b",)], "region string")
    got = {(r.src, r.dst): r.calls for r in shape.route_matrix(facts, regions).collect()}
    assert got == {("a", "b"): 1, ("b", "a"): 0, ("x", "a"): 1}


def test_spine_over_several_arrays(spark):
    df = spark.createDataFrame([("e", "2024-01-02 00:00:03")], "e string, ts string").selectExpr("e", "cast(ts as timestamp_ntz) ts", "1.0D v")
    got = shape.time_spine_densify(df, df, "e", "ts", "v", "2024-01-01", "2024-01-03", 3)
    assert got.count() == got.select("ts").distinct().count() == 2 * 86_400 // 3
    assert str(got.where("v = 1").first().ts) == "2024-01-02 00:00:03"
    assert shape.time_spine_densify(df, df, "e", "ts", "v", "2024-01-01", "2024-01-01", 3).count() == 0
