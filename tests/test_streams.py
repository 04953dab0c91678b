"""Streams over several micro-batches equal their batch twins."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslens.session import scratch_path
from opslens.streaming import streams

T0 = datetime(2024, 1, 1)


def in_files(spark, rows, schema, parts):
    """Rows written in order as one file per part, so that one file makes one batch."""
    path = scratch_path(spark, "in")
    size = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    return streams.read_stream(spark, spark.createDataFrame(rows[:1], schema), path, max_files=1)


def test_counters_keep_the_latest_total_over_batches(spark):
    rows = [("r", "clean" if i % 3 else "missing") for i in range(90)]
    got = streams.run_noise_counters(in_files(spark, rows, "region string, noise_type string", 3))
    assert {r.noise_type: r.calls for r in got.collect()} == {"clean": 60, "missing": 30}


def test_late_rows_carry_the_newest_time_over_batches(spark):
    minutes = [0, 10, 100, 60, 65, 71, 40, 200, 199, 100, 201, 90]
    rows = [(i, T0 + timedelta(minutes=m)) for i, m in enumerate(minutes)]
    peak, late = None, 0
    for m in minutes:
        late += peak is not None and m < peak - 30
        peak = m if peak is None else max(peak, m)
    for parts in (1, 3):
        got = streams.run_late_rows(in_files(spark, rows, "seq bigint, ts timestamp_ntz", parts), "seq", "ts", 1800).first()
        assert (got.on_time, got.late) == (len(minutes) - late, late)


def test_dedup_over_batches(spark):
    rows = [(f"C{i % 20}", T0 + timedelta(minutes=i % 20)) for i in range(40)]
    got = streams.run_append(streams.stream_dedup(in_files(spark, rows, "call_id string, call_ts timestamp_ntz", 2), ["call_id"], lateness="1 hour"), "d")
    assert got.count() == 20 and got.select("call_id").distinct().count() == 20


def test_a_second_run_goes_on(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        spark.createDataFrame([(i,)], "n int").write.mode("append").parquet(folder)
        got = streams.run_append(spark.readStream.schema("n int").parquet(folder), "again", out)
        assert sorted(r.n for r in got.collect()) == list(range(i + 1))


def test_kpi_windows_close_with_the_watermark(spark):
    rows = [(T0 + timedelta(seconds=20 * i), "r", "t", "timeout" if i % 5 == 0 else "success", i % 2, float(i)) for i in range(180)]
    schema = "start_ts timestamp_ntz, region string, txn_type string, status string, retry_count int, latency_ms double"
    got = streams.run_append(streams.stream_service_kpi(in_files(spark, rows, schema, 3)), "k").orderBy("ts").collect()
    closed = [m for m in range(60) if (m + 1) * 60 <= 179 * 20 - 600]
    assert len(got) == len(closed) and all(r.n == 3 for r in got)
    assert sum(r.errors for r in got) == sum(1 for i in range(3 * len(closed)) if i % 5 == 0)


def test_call_link_needs_same_customer_and_horizon(spark):
    txns = [("T1", 1, T0), ("T2", 2, T0), ("T3", 3, T0)]
    calls = [("C1", "T1", 1, T0 + timedelta(minutes=30)), ("C2", "T2", 9, T0 + timedelta(minutes=30)), ("C3", "T3", 3, T0 + timedelta(hours=3)),
             ("C4", "", 1, T0 + timedelta(minutes=30))]
    c = in_files(spark, calls, "call_id string, ref string, customer_id bigint, call_ts timestamp_ntz", 1)
    t = in_files(spark, txns, "txn_id string, customer_id bigint, end_ts timestamp_ntz", 1)
    assert [tuple(r) for r in streams.run_append(streams.stream_call_link(c, t), "l").collect()] == [("C1", "T1", 30)]


def test_only_hot_transactions_are_copied(spark):
    txns = [(f"T{i}", i, T0) for i in range(200)]
    calls = [(f"C{i}", f"T{i % 200 if i % 3 else 7}", i % 200 if i % 3 else 7, T0 + timedelta(minutes=30)) for i in range(1200)]
    schema = "call_id string, ref string, customer_id bigint, call_ts timestamp_ntz"
    hot = streams.hot_references(spark.createDataFrame(calls, schema).repartition(4), share=0.1)
    assert "T7" in hot and len(hot) <= 10
    c, t = in_files(spark, calls, schema, 2), in_files(spark, txns, "txn_id string, customer_id bigint, end_ts timestamp_ntz", 2)
    progress = scratch_path(spark, "p")
    got = streams.run_append(streams.stream_call_link(c, t, hot=["T7"], salts=16), "l", checkpoint=progress)
    assert got.count() == len(calls) and got.where("txn_id = 'T7'").count() == sum(1 for x in calls if x[1] == "T7")
    held = spark.read.format("statestore").option("joinSide", "right").load(progress)
    assert held.count() == len(txns) + 15


def test_sessions_and_sliding_counts(spark):
    rows = [("k", T0 + timedelta(minutes=m), v) for m, v in [(0, 9.0), (5, 8.0), (7, 1.0), (30, 9.0), (400, 9.0)]]
    got = streams.run_append(
        streams.stream_burst_sessions(in_files(spark, rows, "circuit_id string, ts timestamp_ntz, value double", 1), "circuit_id", "10 minutes", 5.0), "s"
    ).orderBy("start_ts").collect()
    assert [(r.n, r.peak) for r in got] == [(2, 9.0), (1, 9.0)]
    facts = [(T0 + timedelta(minutes=m), "r") for m in (0, 5, 119, 600)]
    counts = streams.run_append(streams.stream_sliding_lookback(in_files(spark, facts, "start_ts timestamp_ntz, region string", 1)), "w")
    at = {r.ts: r.n for r in counts.withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect()}
    assert at[T0] == 3 and at[T0 - timedelta(minutes=110)] == 2


def test_a_bounded_run_keeps_open_windows_and_counts_late_rows(spark):
    rows = [(T0 + timedelta(seconds=20 * i), "r", "t", "timeout" if i % 5 == 0 else "success", i % 2, float(i)) for i in range(180)]
    schema = "start_ts timestamp_ntz, region string, txn_type string, status string, retry_count int, latency_ms double"
    counts = {}
    keys = ["ts", "region", "txn_type"]
    got = streams.run_closed(streams.stream_service_kpi(in_files(spark, rows, schema, 4)), "k", keys, counts=counts).collect()
    assert len(got) == 60 and all(r.n == 3 for r in got) and counts == {"dropped": 0}
    late = rows[120:] + rows[:60] + rows[60:120]
    got = streams.run_closed(streams.stream_service_kpi(in_files(spark, late, schema, 3)), "k", keys, counts=counts)
    kept = got.selectExpr("sum(n)").first()[0]
    assert kept < 180 and counts["dropped"] > 0
    appended = {}
    streams.run_append(streams.stream_service_kpi(in_files(spark, late, schema, 3)), "k", counts=appended)
    assert appended["dropped"] > 0


def test_a_bounded_run_keeps_open_sessions(spark):
    rows = [("k", T0 + timedelta(minutes=m), 9.0 + m / 1000) for m in (0, 5, 30, 34, 400)] + [("j", T0 + timedelta(minutes=399), 7.0)]
    counts, schema = {}, "circuit_id string, ts timestamp_ntz, value double"
    df = streams.stream_burst_sessions(in_files(spark, rows, schema, 2), "circuit_id", "10 minutes", 5.0)
    got = streams.run_sessions(df, "s", lambda state: streams.open_burst_sessions(state, "circuit_id"), counts)
    got = streams.as_zone_free(got).orderBy("start_ts").collect()
    assert [(r.circuit_id, r.n, r.peak) for r in got] == [("k", 2, 9.005), ("k", 2, 9.034), ("j", 1, 7.0), ("k", 1, 9.4)]
    assert got[3].end_ts - got[3].start_ts == timedelta(minutes=10) and counts == {"dropped": 0}


def test_session_state_is_bounded_by_the_watermark(spark):
    """300 sessions in 30 batches; never more of them in state than a batch and the lateness hold."""
    rows = [("k", T0 + timedelta(hours=i), 9.0) for i in range(300)]
    path = scratch_path(spark, "many")
    spark.createDataFrame(rows, "circuit_id string, ts timestamp_ntz, value double").repartitionByRange(10, "ts").sortWithinPartitions("ts").write.parquet(path)
    source = streams.read_stream(spark, spark.read.parquet(path), path, max_files=1)
    df = streams.stream_burst_sessions(source, "circuit_id", "10 minutes", 5.0)
    progress = scratch_path(spark, "p")
    q = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", progress).start(scratch_path(spark, "o"))
    q.awaitTermination()
    held = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert max(held) < 100 and streams.open_burst_sessions(spark.read.format("statestore").load(progress), "circuit_id").count() == held[-1] <= 2


def test_folded_state_is_two_versions_of_few_files(spark):
    rows = [(i, "r", "a" if i % 2 else "b") for i in range(40)]
    source = in_files(spark, rows, "i int, region string, noise_type string", 20)
    seen = []

    def fold(batch, before, no):
        seen.append((no, len(before.inputFiles()), before.count()))
        both = before.unionByName(batch.groupBy("noise_type").agg(F.count(F.lit(1)).alias("n")))
        return both.groupBy("noise_type").agg(F.sum("n").alias("n"))

    got = streams.run_folded(source, "f", "append", "noise_type string, n bigint", fold)
    assert {r.noise_type: r.n for r in got.collect()} == {"a": 20, "b": 20}
    assert [s[0] for s in seen] == list(range(20)) and max(s[1] for s in seen) <= 2
    home = got.inputFiles()[0].rsplit("/", 2)[0]
    from opslens.session import file_system

    fs, at = file_system(spark, home)
    assert sorted(f.getPath().getName() for f in fs.listStatus(at)) == ["v18", "v19"]


def test_an_out_of_another_checkpoint_is_refused(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1,)], "n int").write.parquet(folder)
    source = spark.readStream.schema("n int").parquet(folder)
    streams.run_append(source, "a", out, checkpoint=str(tmp_path / "one"))
    with pytest.raises(ValueError, match="another checkpoint"):
        streams.run_append(source, "a", out, checkpoint=str(tmp_path / "two"))
    assert streams.run_append(source, "a", out, checkpoint=str(tmp_path / "one")).count() == 1
