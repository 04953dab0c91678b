"""Session construction and the shared folder used for frozen intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


PARTITION_BYTES = 128 * 1024 * 1024


def partitions_for(input_bytes: int, parallelism: int = 8) -> int:
    """Shuffle partitions that keep one partition near 128 MB; AQE merges those that turn out small."""
    return max(parallelism, -(-input_bytes // PARTITION_BYTES))


def open_session(app: str = "opslens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` overrides any of them (``a__b`` for ``a.b``)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session that names none (tests, a laptop) gets a folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if sc.applicationId not in _own_dirs:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _own_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="opslens-")
    sc.setCheckpointDir(_own_dirs[sc.applicationId])
    return _own_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one folder per application so that it can be cleared as a whole."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frozen(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so every later read sees the same rows.

    Unlike a checkpointed RDD the written table is columnar: readers prune columns,
    and its file size gives the planner a true size for join choices.
    """
    return staged(df, "frozen")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While it holds, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.

    For several large writes one after the other, whose shuffles would else lie on the disks side by side. A DataFrame that
    is run again meanwhile computes its shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def within(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; reads no more than one row past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after the row count was checked; otherwise leave a shuffle join."""
    return F.broadcast(df) if within(df, max_rows) else df


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path; works for any store that Spark can write to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def small_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, such as a marker; None if there is none."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, compressed or not; None if it has none. The rest is not read."""
    fs, at = file_system(spark, path)
    jvm = spark._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(at)
    source = fs.open(at)
    try:
        text = codec.createInputStream(source) if codec is not None else source
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
        return line and line.removeprefix("\ufeff")
    finally:
        source.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = file_system(spark, path)
    to = fs.create(at, True)
    to.write(bytearray(text.encode()))
    to.close()
