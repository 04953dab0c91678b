"""Writing tables, CSV files and the truth document."""

from __future__ import annotations

import json
from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.scalars import micros

# Noise classes in the order of the truth document.
NOISE_TYPES = ("clean", "missing", "fabricated", "wrong_customer")


def sink_partitioned_table(
    df: DataFrame, out: str, day_col: str, sort_keys: Sequence[str], bloom_cols: Sequence[str] = (), mode: str = "errorifexists"
) -> DataFrame:
    """Parquet partitioned by day, each file sorted by the table's key, bloom filters on the ids.

    Rows are range partitioned by day and key, so a large day is written by many
    tasks and each file holds a narrow key range that min/max statistics can skip.
    """
    writer = by_day_and_key(df, day_col, sort_keys).write.mode(mode).partitionBy(day_col)
    writer.options(**bloom_options(bloom_cols)).parquet(out)
    return df.sparkSession.read.parquet(out)


def by_day_and_key(df: DataFrame, day_col: str, sort_keys: Sequence[str]) -> DataFrame:
    order = [day_col, *sort_keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def bloom_options(cols: Sequence[str]) -> dict[str, str]:
    return {k: v for c in cols for k, v in ((f"parquet.bloom.filter.enabled#{c}", "true"), (f"parquet.bloom.filter.fpp#{c}", "0.01"))}


def sink_csv_header(df: DataFrame, out: str, compression: str | None = None, max_rows: int | None = None) -> None:
    """Headered CSV with empty fields for absent values.

    ``compression`` names a codec, of which the fastest level is used. A compressed file is read by one task, whatever its size;
    ``max_rows`` bounds the rows of each.
    """
    writer = df.write.option("header", True).option("emptyValue", "").option("nullValue", "").option("escape", '"')
    if compression:
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.csv(out)


def sink_truth(calls: DataFrame, confounders: Sequence[dict], incident: dict, out: str, per_part: int = 5000, about: dict | None = None) -> None:
    """The truth document, one JSON object per line: what is said once in the first, then parts of about ``per_part`` calls.

    ``calls`` has (call_id, true_txn, ref, noise_type, call_ts, txn_end_ts). Parts are spread by a hash of the call id,
    so no part grows with the table. ``about`` holds further sections: dataset_name, time_range, generation.
    """
    spark = calls.sparkSession
    found = {r.noise_type: r["count"] for r in calls.groupBy("noise_type").count().collect()}
    counts, total = {k: found.get(k, 0) for k in NOISE_TYPES}, sum(found.values())
    noise = {"total_calls": total, "noise_counts": counts, "noise_rates": {k: round(n / max(1, total), 4) for k, n in counts.items()}}
    once = json.dumps({**(about or {}), "primary_incident": incident, "confounders": list(confounders), "tso_noise": noise}, separators=(",", ":"))
    parts = max(1, ceil(total / per_part))
    delay = F.greatest(F.lit(0), F.floor((micros("call_ts") - micros("txn_end_ts")) / 60_000_000))
    detail = F.struct(
        "call_id", F.col("true_txn").alias("true_transaction_id"), F.col("ref").alias("emitted_transaction_id"), "noise_type",
        delay.cast("bigint").alias("delay_minutes"),
    )
    part = F.pmod(F.xxhash64("call_id"), F.lit(parts)).alias("part")
    one = calls.select(part, detail.alias("d")).groupBy("part").agg(F.struct(F.collect_list("d").alias("call_details")).alias("tso_noise"))
    lines = spark.createDataFrame([(once,)], "value string").unionByName(one.select(F.to_json(F.struct("tso_noise")).alias("value")))
    lines.write.text(out)
