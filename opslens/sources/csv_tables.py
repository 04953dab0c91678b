"""Reading headered CSV tables: one file or folder, a whole directory, or a stream of arriving files.

Loading is strict. Where a bad record must not end a load, it goes to quarantine, with its text and the reason.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions.scalars import number_or_zero
from opslens.session import first_line, shuffles_freed
from opslens.sources.schemas import FILE_PREFIX, TABLES, TableSpec
from opslens.sources.sinks import bloom_options, by_day_and_key
from opslens.streaming.streams import run_batches

#: Tables that a directory load writes at the same time, files of a micro-batch of a stream load, and files opened for their header at a time.
AT_ONCE, FILES, LOOKS = 4, 1000, 16
MALFORMED = "fields do not match the header"


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def ingest_csv_typed(spark: SparkSession, path: str, ddl: str, line_breaks: bool = False, by_file: bool = False) -> DataFrame:
    """A headered CSV as the declared columns, matched by header name.

    Columns the file lacks are an error, extra ones are ignored. Absent text stays '', an absent number is null.
    Numbers that cannot be read, lines with too few or too many fields, and a file of the folder whose header differs
    from the first one's are errors when the rows are read. With ``by_file`` each file is matched by its own header,
    which takes one more pass over the text. ``line_breaks`` allows them inside quoted text, at the price of unsplit files.
    """
    declared = _schema(ddl)

    def reader():
        return spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)

    def rows(files: str | list[str], names: list[str]) -> DataFrame:
        strict = reader().option("mode", "FAILFAST").option("enforceSchema", False).option("columnPruning", False)
        return _typed(strict.schema(_text_schema(names)).csv(files), declared)

    if not by_file:
        return rows(path, reader().csv(path).columns)
    groups = _files_by_header(spark, path).values()
    return reduce(DataFrame.unionByName, [rows(files, reader().csv(files[0]).columns) for files in groups])


def _files_by_header(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Header line -> files; only these lines and the file names reach the driver, and nothing behind the lines is read."""
    jvm = spark._jvm
    files = sorted(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in spark.read.text(path).inputFiles())
    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(LOOKS) as pool:
        for file, header in zip(files, pool.map(lambda f: first_line(spark, f), files), strict=True):
            if header is not None:
                found.setdefault(header.rstrip("\r"), []).append(file)
    if not found:
        raise ValueError(f"no CSV text under {path}")
    return found


def _typed(raw: DataFrame, declared: T.StructType) -> DataFrame:
    missing = [f.name for f in declared if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in the header: {', '.join(missing)}")
    cols = []
    for f in declared:
        if isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(F.col(f.name), F.lit("")).alias(f.name))
        else:
            cols.append(_strict(F.col(f.name), F.col(f.name).try_cast(f.dataType), f.name).alias(f.name))
    return raw.select(*cols)


def _unread(text: Column, read: Column, name: str) -> Column:
    """What is wrong where there is text that could not be read, else null."""
    return F.when(text.isNotNull() & (text != "") & read.isNull(), F.concat(F.lit(f"unreadable {name}: "), text))


def _strict(text: Column, read: Column, name: str) -> Column:
    """``read``, or an error where there is text that could not be read."""
    said = _unread(text, read, name)
    return F.when(said.isNotNull(), F.raise_error(said)).otherwise(read)


def read_marked(spark: SparkSession, path: str | list[str], table: str, line_breaks: bool = False) -> DataFrame:
    """The rows of ``read_table``, each file matched by its own header, with ``_file``, ``_line`` and ``_reason``.

    ``_reason`` says why a record cannot be loaded and is null for good ones: a number of fields other than the header's,
    an unreadable number or time, or a header without a declared column, which rejects the whole file. ``_line`` is the
    text of such a record.
    """
    spec, declared = spec_of(table), _schema(spec_of(table).columns)

    def rows(files: list[str]) -> DataFrame:
        reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
        names = reader.csv(files[0]).columns
        schema = _text_schema(names).add("_broken", "string")
        lenient = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken").option("enforceSchema", False)
        raw = lenient.option("columnPruning", False).schema(schema).csv(files)
        missing = [f.name for f in declared if f.name not in names]
        text = {f.name: F.col(f.name) if f.name in names else F.lit(None).cast("string") for f in declared}
        read = {
            f.name: F.coalesce(text[f.name], F.lit("")) if isinstance(f.dataType, T.StringType) else text[f.name].try_cast(f.dataType) for f in declared}
        # Said of a file's every row by way of its name: a constant would let the optimizer drop the rows, and their count.
        lacks = F.when(F.length("_metadata.file_path") > 0, f"columns missing in the header: {', '.join(missing)}")
        wrong = [lacks if missing else F.lit(None).cast("string")]
        wrong.append(F.when(F.col("_broken").isNotNull(), MALFORMED))
        wrong += [_unread(text[f.name], read[f.name], f.name) for f in declared if f.name in names and not isinstance(f.dataType, T.StringType)]
        wrong += [_unread(text[c], text[c].try_cast("timestamp"), c) for c in spec.times if c in names]
        line = F.coalesce(F.col("_broken"), F.to_csv(F.struct(*[F.col(c) for c in names])))
        reason = F.coalesce(*wrong)
        marked = raw.select(
            *[c.alias(n) for n, c in read.items()], F.col("_metadata.file_path").alias("_file"),
            F.when(reason.isNotNull(), line).alias("_line"), reason.alias("_reason"))
        return derive_ingest_columns(marked, spec.times, spec.numbers)

    return reduce(DataFrame.unionByName, [rows(files) for files in _files_by_header(spark, path).values()])


def load_stream(
    spark: SparkSession, folder: str, table: str, out: str, quarantine: str | None = None, max_files: int = FILES,
    checkpoint: str | None = None, line_breaks: bool = False, counts: dict[str, int] | None = None,
) -> DataFrame:
    """Load the CSV files that have arrived in ``folder`` since the last run into ``out``, partitioned by day; returns ``out``.

    The stream is one of file names. Each micro-batch of at most ``max_files`` is read as ``read_table`` reads a folder, with
    each file's own header, so columns may come in any order. Without ``quarantine`` a bad record ends the load and
    its batch is not written; with it such records go there as (file, line, reason). ``counts`` receives rows and
    quarantined of this run. A repeated batch overwrites itself; ``out`` belongs to one checkpoint.
    """
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    arriving = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", max_files).load(folder).select("path")
    total = {"rows": 0, "quarantined": 0}

    def write(batch, no, _):
        files = [r.path for r in batch.collect()]  # at most max_files
        if not files:
            return
        if quarantine is None:
            groups = _files_by_header(spark, files).values()
            marked = reduce(DataFrame.unionByName, [read_table(spark, g, table, line_breaks) for g in groups]).withColumn("_reason", F.lit(None).cast("string"))
        else:
            marked = read_marked(spark, files, table, line_breaks)
        seen = Observation()
        watched = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count("_reason").alias("bad"))
        good = watched.where("_reason IS NULL").drop("_file", "_line", "_reason")
        with_day(good, table).write.mode("overwrite").partitionBy("day").parquet(f"{out}/batch={no}")
        found = seen.get
        wrong = found.get("bad", 0)
        if wrong:  # most loads have none, and then the text is read once
            marked.where("_reason IS NOT NULL").select(
                F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason")
            ).write.mode("overwrite").parquet(f"{quarantine}/batch={no}")
        total["rows"] += found.get("n", 0) - wrong
        total["quarantined"] += wrong

    run_batches(arriving, f"load-{table}", "append", write, out=out, checkpoint=checkpoint or f"{out.rstrip('/')}-progress")
    if counts is not None:
        counts |= total
    schema = with_day(with_derived(spark.createDataFrame([], _schema(spec_of(table).columns)), table), table).schema
    return spark.read.schema(schema).option("basePath", out).parquet(out)


def iso_time(c: str):
    """ISO text, with or without fraction and zone, as a zone-free UTC timestamp; unreadable text is null."""
    return F.col(c).try_cast("timestamp").cast("timestamp_ntz")


def derive_ingest_columns(df: DataFrame, times: Mapping[str, str], numbers: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Add a timestamp per text time, and ``<n>_f64`` (0 when empty or unreadable) per text number.

    An unreadable time is null; with ``strict`` it is an error when the rows are read.
    """
    derived = {out: _strict(F.col(src), iso_time(src), src) if strict else iso_time(src) for src, out in times.items()}
    derived |= {f"{n}_f64": number_or_zero(n) for n in numbers}
    return df.withColumns(derived)


def with_derived(df: DataFrame, table: str) -> DataFrame:
    spec = spec_of(table)
    return derive_ingest_columns(df, spec.times, spec.numbers, strict=True)


def spec_of(table: str) -> TableSpec:
    if table not in TABLES:
        raise ValueError(f"unknown table: {table}")
    return TABLES[table]


def read_table(spark: SparkSession, path: str | list[str], table: str, line_breaks: bool = False, by_file: bool = False) -> DataFrame:
    return with_derived(ingest_csv_typed(spark, path, spec_of(table).columns, line_breaks, by_file), table)


def tables_in(spark: SparkSession, folder: str, prefix: str = FILE_PREFIX) -> list[str]:
    """Names of the tables whose files lie in ``folder``; reads paths only, no content."""
    try:
        files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{prefix}*.csv").select("path")
    except Exception as e:  # the path check of the reader
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise ValueError(f"no CSV files under {folder}") from e
    name = F.regexp_extract("path", rf"/{prefix}([^/]+)\.csv(?:/|$)", 1)
    names = sorted(r[0] for r in files.select(name.alias("t")).distinct().collect())
    if not names:
        raise ValueError(f"no CSV files under {folder}")
    return names


def ingest_directory(
    spark: SparkSession, folder: str, database: str, location: str, insert_only: bool = False, prefix: str = FILE_PREFIX,
    line_breaks: bool = False, by_file: bool = False,
) -> DataFrame:
    """Append every ``<prefix><table>.csv`` of a folder to the table it names; returns (table_name, rows) of this load.

    Rows are counted while they are written. A few tables are written at the same time; the shuffle files of each go when it is done.

    A name without a declared schema is an error before anything is written. With
    ``insert_only`` each table must exist; else it is created below ``location``.
    Tables are partitioned by ``day`` and each file is sorted by the table's key. ``line_breaks`` and ``by_file`` are
    those of ``ingest_csv_typed``.
    """
    names = tables_in(spark, folder, prefix)
    for n in names:
        spec_of(n)
    for n in names:
        if insert_only and not spark.catalog.tableExists(f"{database}.{n}"):
            raise ValueError(f"missing table (insert-only mode): {database}.{n}")
    def load(n: str) -> tuple[str, int]:
        df = with_day(read_table(spark, f"{folder.rstrip('/')}/{prefix}{n}.csv", n, line_breaks, by_file), n)
        target, seen = f"{database}.{n}", Observation()
        if not spark.catalog.tableExists(target):
            create_table(spark, df.schema, n, target, f"{location.rstrip('/')}/{n}")
        # Observed behind the shuffle, whose bounds are sampled from what lies before it.
        ordered = by_day_and_key(df, "day", spec_of(n).sort_keys).observe(seen, F.count(F.lit(1)).alias("rows"))
        ordered.select(*spark.table(target).columns).write.insertInto(target)
        return n, seen.get.get("rows", 0)

    with shuffles_freed(spark), ThreadPoolExecutor(AT_ONCE) as pool:
        counts = list(pool.map(load, names))
    return spark.createDataFrame(counts, "table_name string, rows bigint")


def with_day(df: DataFrame, table: str) -> DataFrame:
    """Add the day of the table's leading time column."""
    return df.withColumn("day", F.to_date(next(iter(spec_of(table).times.values()))))


def create_table(spark: SparkSession, schema: T.StructType, table: str, target: str, path: str) -> None:
    """An empty table partitioned by day with bloom filters on its ids."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    options = ", ".join(f"'{k}' = '{v}'" for k, v in bloom_options(spec_of(table).bloom).items())
    with_options = f"OPTIONS ({options})" if options else ""
    spark.sql(f"CREATE TABLE {target} ({columns}) USING parquet {with_options} PARTITIONED BY (day) LOCATION '{path}'")


def csv_stream(spark: SparkSession, folder: str, table: str, max_files: int | None = None) -> DataFrame:
    """The same typed and derived columns as files arrive, as a stream that other streams can be built on.

    Files must have the declared columns in declared order; another header, a line with too few or too many fields and
    unreadable values are errors that end the query. ``load_stream`` takes any order and can set bad records aside.
    """
    declared = _schema(spec_of(table).columns)
    reader = spark.readStream.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("columnPruning", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_derived(_typed(reader.option("escape", '"').schema(_text_schema(declared.names)).csv(folder), declared), table)
