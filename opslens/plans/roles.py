"""Telemetry roles built from the star-schema tables (formulas: FIXTURES.md, part 2).

Each role is a lazy DataFrame over whole tables. ``calls`` are placed for every
transaction that did not succeed at the first attempt.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslens.functions.scalars import plus_micros
from opslens.operators import shape

# The incident, its bursts and the decoy windows of the bound data.
INCIDENT_START = "2024-01-10 12:20:00"
INCIDENT_END = "2024-01-15 18:10:00"
FIX_TIME = "2024-01-15 18:15:00"
FOCUS_REGION = "ASIA"
FOCUS_TYPES = ("type_0", "type_1")
SPLIT_DATE = "1998-06-01 00:00:00"
SPLIT_END = "2000-01-01 00:00:00"
INCIDENT_CIRCUIT = "CKT-ASI-EUR-0"
REGION_WEIGHTS = {"AFRICA": 0.35, "AMERICA": 0.25, "ASIA": 0.20, "EUROPE": 0.10, "MIDDLE EAST": 0.10}
CONFOUNDERS = (
    ("cpu_spike", "ASIA", "2024-01-05 09:00:00", "2024-01-06 11:00:00", 1),
    ("deploy_blip", "EUROPE", "2024-01-20 17:00:00", "2024-01-21 18:00:00", 2),
    ("any_maint", "*", "2024-01-06 00:00:00", "2024-01-06 18:00:00", 3),
)

#: Tasks a core that spread rows are dealt to at least.
TASKS_PER_CORE = 3

_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A Parquet table; its schema is inferred once per path."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def region_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> its region and the next region in key order."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read(spark, sf_dir, "region")
    following = region.select(
        F.pmod(F.col("r_regionkey") + 4, F.lit(5)).alias("n_regionkey"), F.col("r_name").alias("next_region")
    )
    here = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return nation.join(here, "n_regionkey").join(following, "n_regionkey").drop("n_regionkey")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names of all regions, as (region)."""
    return read(spark, sf_dir, "region").select(F.col("r_name").alias("region"))


def facts(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One row per transaction; ``spread`` deals them out evenly, for writers that make much text of few small files."""
    people = (
        read(spark, sf_dir, "customer")
        .join(region_of(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("customer_id"), "region", "next_region")
    )
    events = read(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("customer_id"), F.col("ts").alias("start_ts"),
        "event_type", F.col("value").alias("latency_ms"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    f = events.join(people, "customer_id")
    if spread:
        f = f.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    f = f.withColumns({
        "txn_id": F.format_string("TX-%s-%07d", F.date_format("start_ts", "yyyyMMddHHmmss"), F.col("seq")),
        "txn_type": F.concat(F.lit("type_"), (F.col("k") % 7).cast("string")),
        "impacted_type": F.col("k") % 7 < 2,
        "end_ts": plus_micros("start_ts", F.floor(F.col("latency_ms") * 1000)),
        "retry_count": F.when(F.col("event_type").isin("error", "purchase"), F.col("k") % 4).otherwise(F.lit(0)),
        "status": F.expr("""
            CASE WHEN event_type = 'error' THEN 'timeout' WHEN event_type = 'signup' THEN 'retry'
                 WHEN event_type = 'purchase' AND k % 4 > 0 THEN 'completed_after_retry' ELSE 'success' END"""),
        "skew_ms": (F.col("seq") % 1001 - 500).cast("int"),
    })
    f = f.withColumn(
        "dep_region",
        F.when((F.col("impacted_type") & (F.col("region") == FOCUS_REGION)) | (F.col("seq") % 12 == 0),
               F.col("next_region")),
    )
    return f.withColumns({
        "dep_latency_ms": F.when(F.col("dep_region").isNotNull(), F.col("latency_ms") * 0.9),
        "circuit_id": F.expr("""
            CASE WHEN dep_region IS NULL OR seq % 211 = 0 THEN NULL
                 WHEN seq % 223 = 0 THEN 'CKT-UNKNOWN'
                 WHEN seq % 227 = 0 THEN concat('CKT-', upper(left(dep_region, 3)), '-', upper(left(region, 3)),
                                                '-', customer_id % 7)
                 ELSE concat('CKT-', upper(left(region, 3)), '-', upper(left(dep_region, 3)), '-', customer_id % 7)
            END"""),
    })


def windows(spark: SparkSession) -> DataFrame:
    first = datetime.fromisoformat(INCIDENT_START)
    spans_ = []
    for i in range(20):
        start = first + timedelta(hours=6 * i)
        spans_.append((i, start, start + timedelta(minutes=60 + 37 * i % 120)))
    rows = ", ".join(f"({i}, timestamp_ntz '{a}', timestamp_ntz '{b}')" for i, a, b in spans_)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(window_id, w0, w1)")


def confounders(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{n}', '{r}', timestamp_ntz '{a}', timestamp_ntz '{b}', {p})" for n, r, a, b, p in CONFOUNDERS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, c_region, c0, c1, priority)")


def flagged(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """facts with the incident and decoy flags."""
    return shape.impacted_flags(facts(spark, sf_dir, spread), windows(spark), confounders(spark), FOCUS_REGION)


def logs(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return shape.lifecycle_explode(flagged(spark, sf_dir, spread))


def spans(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return shape.span_explode(facts(spark, sf_dir, spread))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = facts(spark, sf_dir)
    placed = f.where(F.col("status") != "success").select(
        F.format_string("C-%09d", F.col("seq")).alias("call_id"),
        "seq", "customer_id", "region", F.col("end_ts").alias("txn_end_ts"),
        plus_micros("end_ts", (F.col("seq") * 7 % 116 + 5) * 60_000_000).alias("call_ts"),
        F.col("txn_id").alias("true_txn"),
        F.expr("""CASE WHEN seq % 37 = 0 THEN 'missing' WHEN seq % 101 = 0 THEN 'fabricated'
                       WHEN seq % 53 = 0 THEN 'wrong_customer' ELSE 'clean' END""").alias("noise_type"),
        F.expr("CASE seq % 3 WHEN 0 THEN 'slow_provisioning' WHEN 1 THEN 'timeout' ELSE 'failure' END").alias("issue_category"),
        (F.col("seq") % 4 == 0).alias("escalated"),
        (F.col("seq") % 171 + 10).cast("int").alias("resolution_min"),
    )
    neighbour = f.select((F.col("seq") + 1).alias("seq"), F.col("txn_id").alias("other_txn"))
    return placed.join(neighbour, "seq", "left").select(
        "call_id", "seq", "customer_id", "region", "call_ts", "txn_end_ts", "true_txn",
        F.expr("""CASE noise_type WHEN 'missing' THEN '' WHEN 'fabricated' THEN concat('FAKE-', true_txn)
                  WHEN 'wrong_customer' THEN coalesce(other_txn, true_txn) ELSE true_txn END""").alias("ref"),
        "noise_type", "issue_category", "escalated", "resolution_min",
    )


def circuit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments read as samples of the circuit from the supplier's to the customer's region."""
    place = region_of(spark, sf_dir).drop("next_region")
    src = (
        read(spark, sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("region").alias("src"))
    )
    dst = (
        read(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("region").alias("dst"))
    )
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("value"),
    )
    # Orders meet their customers first, so that the many shipments are shuffled once.
    rows = items.join(orders.join(dst, "o_custkey"), "l_orderkey").join(src, "l_suppkey")
    return rows.where(F.col("src") != F.col("dst")).select(
        "src", "dst", circuit_name(F.col("src"), F.col("dst"), F.col("l_suppkey") % 7).alias("circuit_id"), "ts", "value",
        "l_orderkey", "l_linenumber", "l_partkey",
    )


def circuit_name(src, dst, number):
    return F.concat(
        F.lit("CKT-"), F.upper(F.substring(src, 1, 3)), F.lit("-"), F.upper(F.substring(dst, 1, 3)),
        F.lit("-"), number.cast("string"),
    )


def circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circuit_metrics(spark, sf_dir).select("circuit_id", "src", "dst").distinct()


def circuit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round-trip sample per cross-region transaction."""
    return facts(spark, sf_dir).where(F.col("circuit_id").isNotNull()).select(
        F.col("seq").alias("sample_id"), "circuit_id", F.col("region").alias("src"), F.col("dep_region").alias("dst"),
        F.col("start_ts").alias("ts"), F.col("dep_latency_ms").alias("value"),
    )


def host_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select(
        F.col("start_ts").alias("ts"), "region", F.col("customer_id").alias("host"), F.col("latency_ms").alias("cpu")
    )


def net_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One circuit event per transaction, on another circuit of the same route than the transaction's own."""
    return facts(spark, sf_dir).select(
        "seq", F.col("start_ts").alias("ts"),
        F.expr("""CASE k % 4 WHEN 0 THEN 'flap' WHEN 1 THEN 'maintenance' WHEN 2 THEN 'reroute'
                  ELSE 'packet_loss_burst' END""").alias("event_type"),
        F.col("region").alias("src"), F.col("next_region").alias("dst"),
        circuit_name(F.col("region"), F.col("next_region"), (F.col("customer_id") + 1) % 7).alias("circuit_id"),
        F.expr("CASE WHEN k >= 85 THEN 'critical' WHEN k >= 40 THEN 'warning' ELSE 'info' END").alias("reported_severity"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slow transactions raise an alert at their start."""
    return facts(spark, sf_dir).where(F.col("latency_ms") > 150).select(F.col("seq").alias("alert_id"), F.col("start_ts").alias("ts"))
