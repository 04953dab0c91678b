"""The rollups, joins and sessions over Structured Streaming.

Every operator takes and returns a streaming DataFrame with bounded state. The
runners write to the shared folder, never to the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from opslens.functions.running import running
from opslens.functions.scalars import micros
from opslens.session import path_exists, put_text, remove_path, scratch_path, small_text

#: Batches whose progress Spark keeps while a bounded run is watched; far more than can end between two looks.
WATCHED, LOOK_SECONDS = 5000, 2


def read_stream(spark: SparkSession, like: DataFrame, path: str, max_files: int | None = None) -> DataFrame:
    """Stream a Parquet folder; zone-free times become instants, which watermarks require."""
    reader = spark.readStream.schema(like.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return as_instants(reader.parquet(path))


def as_instants(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def as_zone_free(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def run_append(
    df: DataFrame, name: str, out: str | None = None, partition_by: Sequence[str] = (), checkpoint: str | None = None,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Run an append stream over all available input into Parquet and read it back.

    A later run with the same ``out`` goes on where the last one ended: its progress is kept in ``checkpoint``, by default
    in a folder beside ``out``. One ``out`` belongs to one checkpoint; an ``out`` that another one has written is refused,
    because the sink would take this one's batches for done.
    ``counts``, if given, receives under "dropped" the rows that came behind the watermark and were left out.
    """
    spark = df.sparkSession
    checkpoint = checkpoint or (f"{out.rstrip('/')}-progress" if out else scratch_path(spark, f"{name}-progress"))
    out = out or scratch_path(spark, name)
    own = claim(spark, out, checkpoint)
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with _watched(spark):
        query = writer.option("checkpointLocation", checkpoint).start(out)
        if not own:
            put_text(spark, f"{out}/_owner", query.id)
        dropped = _finish(query)
    if counts is not None:
        counts["dropped"] = dropped
    return spark.read.schema(df.schema).parquet(out)


def claim(spark: SparkSession, out: str, checkpoint: str) -> bool:
    """True if ``out`` is marked as written from ``checkpoint``, False if nothing has written it; else an error."""
    known = small_text(spark, f"{checkpoint}/metadata")
    mine = json.loads(known)["id"] if known else None
    owner = small_text(spark, f"{out}/_owner")
    if owner is None and path_exists(spark, f"{out}/_spark_metadata") and mine is None or owner is not None and owner != mine:
        raise ValueError(f"{out} was written from another checkpoint than {checkpoint}")
    return owner is not None


@contextmanager
def _watched(spark: SparkSession) -> Iterator[None]:
    """While it holds, queries that start keep the progress of so many batches that none is missed between two looks."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, WATCHED)
    try:
        yield
    finally:
        spark.conf.set(kept, before)


def _finish(query) -> int:
    """Wait for the end of a bounded run; returns the rows that its watermarks dropped."""
    dropped, done = {}, False
    while not done:
        done = query.awaitTermination(LOOK_SECONDS)
        for p in query.recentProgress:
            dropped[p["batchId"]] = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    return sum(dropped.values())


def run_closed(df: DataFrame, name: str, keys: Sequence[str], counts: dict[str, int] | None = None) -> DataFrame:
    """Run over all available input as ``run_append``, but keep the windows that are still open at its end.

    Each batch writes the windows it changed; the latest row per ``keys`` counts.
    """
    def write(batch, no, out):
        batch.withColumn("batch", F.lit(no).cast("bigint")).write.mode("overwrite").parquet(f"{out}/no={no}")

    out = run_batches(df, name, "update", write, counts)
    schema = StructType([*df.schema.fields, StructField("batch", LongType())])
    rows = df.sparkSession.read.schema(schema).option("recursiveFileLookup", True).parquet(out)
    values = [c for c in df.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*keys, "v.*").select(*df.columns)


def run_sessions(
    df: DataFrame, name: str, still_open: Callable[[DataFrame], DataFrame], counts: dict[str, int] | None = None
) -> DataFrame:
    """Run session windows over all available input, those still open at its end included.

    The run is in append mode, so state holds only sessions that the watermark has not passed; closed ones are written
    once. Those left in the state store at the end are read from there; ``still_open`` turns its rows (key, value)
    into rows of ``df``.
    """
    spark, progress = df.sparkSession, scratch_path(df.sparkSession, f"{name}-progress")
    closed = run_append(df, name, checkpoint=progress, counts=counts)
    if not path_exists(spark, f"{progress}/state"):
        return closed  # nothing came
    return closed.unionByName(still_open(spark.read.format("statestore").load(progress)).select(*df.columns))


def run_folded(
    df: DataFrame, name: str, mode: str, schema: str, fold: Callable[[DataFrame, DataFrame, int], DataFrame],
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Run a stream whose batches are folded one by one into a small table, and return the table as it is at the end.

    ``fold(batch, before, number)`` returns the table after a batch. Each version is written beside the one before, so a
    repeated batch starts from the same version; older ones are removed, so a batch reads no more than one version.
    """
    spark = df.sparkSession
    newest = {"no": -1}

    def write(batch, no, out):
        before = spark.read.schema(schema).parquet(f"{out}/v{no - 1}") if no else spark.createDataFrame([], schema)
        fold(batch, before, no).write.mode("overwrite").parquet(f"{out}/v{no}")
        newest["no"] = no
        if no > 1:
            remove_path(spark, f"{out}/v{no - 2}")

    out = run_batches(df, name, mode, write, counts)
    return spark.read.schema(schema).parquet(f"{out}/v{newest['no']}") if newest["no"] >= 0 else spark.createDataFrame([], schema)


def run_batches(
    df: DataFrame, name: str, mode: str, write: Callable[[DataFrame, int, str], None], counts: dict[str, int] | None = None,
    out: str | None = None, checkpoint: str | None = None,
) -> str:
    """Run a stream batch by batch; ``write`` must overwrite its batch, so a repeat is harmless.

    With ``out`` and ``checkpoint`` a later run goes on where this one ended; the two belong together as in ``run_append``.
    """
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"{name}-progress")
    own = not out or claim(spark, out, checkpoint)  # nothing else can have written a fresh folder
    out = out or scratch_path(spark, name)
    with _watched(spark):
        q = (
            df.writeStream.outputMode(mode).trigger(availableNow=True)
            .foreachBatch(lambda batch, no: write(batch, no, out)).option("checkpointLocation", checkpoint).start()
        )
        if not own:
            put_text(spark, f"{out}/_owner", q.id)
        dropped = _finish(q)
    if counts is not None:
        counts["dropped"] = dropped
    return out


def stream_service_kpi(facts: DataFrame, step: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    windowed = facts.withWatermark("start_ts", lateness).groupBy(F.window("start_ts", step), "region", "txn_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "timeout").alias("errors"),
        F.count_if(F.col("retry_count") > 0).alias("retries"), F.percentile_approx("latency_ms", 0.95, 10_000).alias("p95_ms"),
    )
    return windowed.select(F.col("window.start").alias("ts"), "region", "txn_type", "n", "errors", "retries", "p95_ms")


def hot_references(calls: DataFrame, share: float = 0.001) -> list[str]:
    """References that may hold more than ``share`` of all rows of a batch table: every one that does, 1 / share at most.

    A frequent-items sketch of that size is kept and merged in the tasks; rarer ids in it do no harm.
    """
    return sorted(calls.where(F.col("ref") != "").stat.freqItems(["ref"], share).first()[0] or [])


def stream_call_link(
    calls: DataFrame, txns: DataFrame, horizon: str = "2 hours", lateness: str = "10 minutes", hot: Sequence[str] = (), salts: int = 16
) -> DataFrame:
    """Calls joined to the transaction they name, if the same customer's and ended within the horizon.

    Calls of the ``hot`` transactions (``hot_references`` of what is known of the calls) are spread over ``salts`` copies of
    them; every other transaction is held once. An id that becomes hot later is joined right, in one task.
    """
    def is_hot(c: str):
        return F.col(c).isin(*hot) if hot else F.lit(False)

    salt = F.when(is_hot("ref"), F.pmod(F.xxhash64("call_id"), F.lit(salts)).cast("int")).otherwise(0).alias("c_salt")
    copies = F.explode(F.sequence(F.lit(0), F.when(is_hot("txn_id"), salts - 1).otherwise(0))).alias("t_salt")
    c = calls.where(F.col("ref") != "").select("call_id", "ref", "customer_id", "call_ts", salt).withWatermark("call_ts", lateness)
    t = txns.select("txn_id", F.col("customer_id").alias("txn_customer"), "end_ts", copies).withWatermark("end_ts", lateness)
    on = F.expr(
        f"ref = txn_id AND customer_id = txn_customer AND c_salt = t_salt AND call_ts >= end_ts AND call_ts <= end_ts + INTERVAL {horizon}"
    )
    delay = F.floor((micros("call_ts") - micros("end_ts")) / 60_000_000)
    return c.join(t, on).select("call_id", "txn_id", delay.alias("delay_min"))


def stream_dedup(calls: DataFrame, keys: Sequence[str], ts: str = "call_ts", lateness: str = "10 minutes", salts: int = 64) -> DataFrame:
    """One row per key within the watermark.

    Copies of a hot key are first reduced within the input splits' salts, so that at most
    ``salts`` of them meet in one task.
    """
    salted = calls.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))).withWatermark(ts, lateness)
    return salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(list(keys))


def stream_noise_counters(calls: DataFrame) -> DataFrame:
    """Running counts in update mode; state is one number per region and class."""
    return calls.groupBy("region", "noise_type").agg(F.count(F.lit(1)).alias("calls"))


def run_noise_counters(calls: DataFrame) -> DataFrame:
    """Keep the latest value of each counter, folded batch by batch into one table of counters."""
    def fold(batch, before, no):
        both = before.withColumn("no", F.lit(no - 1)).unionByName(batch.withColumn("no", F.lit(no)))
        return both.groupBy("region", "noise_type").agg(F.max_by("calls", "no").alias("calls"))

    counters = stream_noise_counters(calls)
    return run_folded(counters, "noise-counters", "update", "region string, noise_type string, calls bigint", fold)


def stream_sliding_lookback(
    facts: DataFrame, width: str = "2 hours", slide: str = "10 minutes", lateness: str = "10 minutes"
) -> DataFrame:
    counted = facts.withWatermark("start_ts", lateness).groupBy(F.window("start_ts", width, slide), "region").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("ts"), "region", "n")


def stream_burst_sessions(
    metrics: DataFrame, key: str, gap: str, threshold: float, lateness: str = "10 minutes"
) -> DataFrame:
    """Degraded rows closer than ``gap`` form one session."""
    high = metrics.where(F.col("value") > threshold).withWatermark("ts", lateness)
    sessions = high.groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("peak"))
    return sessions.select(key, F.col("session_window.start").alias("start_ts"), F.col("session_window.end").alias("end_ts"), "n", "peak")


def open_burst_sessions(state: DataFrame, key: str) -> DataFrame:
    """Sessions in the state of ``stream_burst_sessions`` as its rows."""
    window, v = F.col("value.session_window"), "value"
    return state.select(
        F.col(f"{v}.{key}").alias(key), window["start"].alias("start_ts"), window["end"].alias("end_ts"), F.col(f"{v}.count").alias("n"),
        F.col(f"{v}.max").alias("peak"))


def run_late_rows(rows: DataFrame, seq: str, ts: str, lateness_seconds: int) -> DataFrame:
    """Count rows that lie more than ``lateness`` behind the newest row seen before them.

    The counts and the newest time so far are one row, folded batch by batch.
    """
    def fold(batch, before, no):
        base = batch.select(F.col(seq).alias("seq"), micros(ts).alias("t"))
        numbered = running(base, [], ["seq"], max_before={"before": F.col("t")})
        so_far = before.first()
        newest = F.greatest(F.col("before"), F.lit(so_far.peak if so_far else None).cast("bigint"))
        late = F.coalesce(F.col("t") < newest - lateness_seconds * 1_000_000, F.lit(False))
        seen = numbered.agg(F.count_if(~late).alias("on_time"), F.count_if(late).alias("late"), F.max("t").alias("peak"))
        return before.unionByName(seen).agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"), F.max("peak").alias("peak"))

    done = run_folded(rows, "late-rows", "append", "on_time bigint, late bigint, peak bigint", fold)
    return done.agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"))
