"""Sources and sinks: round trips, layout, and the errors a loader must raise."""

import json
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from opslens.operators import views
from opslens.plans import catalog, exports, io_catalog, report, roles
from opslens.session import scratch_path, shuffles_freed
from opslens.sources import csv_tables, sinks, truth
from opslens.sources.schemas import TABLES
from opslens.streaming import streams


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_columns_match_by_header_name_and_absent_text_is_empty(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'extra,latency,name\nx,1.5,"a,""b"""\ny,,\n')
    got = csv_tables.ingest_csv_typed(spark, path, "name string, latency double").collect()
    assert [tuple(r) for r in got] == [('a,"b"', 1.5), ("", None)]
    with pytest.raises(ValueError, match="missing in the header: gone"):
        csv_tables.ingest_csv_typed(spark, path, "gone string")


def test_derived_columns(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:01.5Z", "7"), ("2024-01-01T00:00:01Z", ""), ("bad", "x")], "timestamp string, n string")
    got = csv_tables.derive_ingest_columns(df, {"timestamp": "ts"}, ("n",)).collect()
    assert [str(r.ts) for r in got] == ["2024-01-01 00:00:01.500000", "2024-01-01 00:00:01", "None"]
    assert [r.n_f64 for r in got] == [7.0, 0.0, 0.0]


def test_directory_rules(spark, tmp_path):
    db = "d" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    home = scratch_path(spark, "t")
    with pytest.raises(ValueError, match="no CSV files"):
        csv_tables.ingest_directory(spark, str(tmp_path), db, home)
    calls = ",".join(c.split()[0] for c in TABLES["tso_calls"].columns.split(", "))
    write(tmp_path / "clickhouse-tso_calls.csv", calls + "\nC1,2024-01-01T00:00:00Z,9,east,timeout,d,s,,12,true,r\n")
    with pytest.raises(ValueError, match="missing table"):
        csv_tables.ingest_directory(spark, str(tmp_path), db, home, insert_only=True)
    for present in (1, 2):
        got = csv_tables.ingest_directory(spark, str(tmp_path), db, home, insert_only=present == 2).collect()
        assert [tuple(r) for r in got] == [("tso_calls", 1)]  # of this load, not of the table
        assert spark.table(f"{db}.tso_calls").count() == present
    row = spark.table(f"{db}.tso_calls").first()
    assert row.transaction_id == "" and row.resolution_time_minutes == 12 and str(row.ts) == "2024-01-01 00:00:00"
    write(tmp_path / "clickhouse-nonsense.csv", "a\n1\n")
    with pytest.raises(ValueError, match="unknown table: nonsense"):
        csv_tables.ingest_directory(spark, str(tmp_path), db, home)


@pytest.mark.parametrize("table", sorted(TABLES))
def test_csv_round_trip_equals_input(spark, sf_dir, table):
    df = exports.EXPORTS[table](spark, sf_dir)
    path = scratch_path(spark, "rt")
    sinks.sink_csv_header(df, path)
    back = csv_tables.ingest_csv_typed(spark, path, TABLES[table].columns)
    assert back.columns == df.columns
    assert back.count() == df.count()
    assert back.exceptAll(df).count() == 0


def test_table_layout_sorted_files_and_pruned_days(spark, sf_dir):
    table = io_catalog.partitioned_logs(spark, sf_dir)
    keys = ["region", "txn_type", "event", "ts", "txn_id"]
    rows = table.select("day", *keys, F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    from pyspark.sql import Window as W

    w = W.partitionBy("f").orderBy("i")
    here, prior = F.struct(*keys), F.lag(F.struct(*keys)).over(w)
    assert rows.withColumn("prior", prior).where(F.col("prior") > here).count() == 0
    plan = table.where("day = DATE '2024-01-12'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_whole_truth_document(spark, tmp_path):
    doc = {
        "dataset_name": "x", "primary_incident": {"circuit_id": "K", "start": "2024-01-01T00:00:00Z", "end": "2024-01-02T00:00:00Z", "fix_time": "2024-01-02T00:05:00Z"},
        "confounders": [{"name": "b", "region": "*", "start": "2024-01-01T00:00:00Z", "end": "2024-01-01T01:00:00Z"},
                        {"name": "a", "region": "r", "start": "2024-01-01T00:00:00Z", "end": "2024-01-01T01:00:00Z"}],
        "tso_noise": {"total_calls": 1, "noise_counts": {"clean": 1, "missing": 0},
                      "call_details": [{"call_id": "C", "true_transaction_id": "T", "emitted_transaction_id": "", "noise_type": "missing", "delay_minutes": 4}]},
    }
    t = truth.read_truth(spark, write(tmp_path / "t.json", json.dumps(doc, indent=2)))
    assert truth.incident(t).first().circuit_id == "K" and str(truth.incident(t).first().fix_time) == "2024-01-02 00:05:00"
    assert [(r.name, r.priority) for r in truth.confounders(t).orderBy("priority").collect()] == [("b", 1), ("a", 2)]
    assert {r.noise_type: r.calls for r in truth.noise_counts(t).collect()} == {"clean": 1, "missing": 0}
    assert tuple(truth.call_details(t).first()) == ("C", "T", "", "missing", 4)


def test_split_truth_document_keeps_all_calls(spark, sf_dir):
    calls = roles.calls(spark, sf_dir)
    out = scratch_path(spark, "truth")
    sinks.sink_truth(calls, io_catalog._confounder_docs(), io_catalog._incident_doc(), out, per_part=100)
    t = truth.read_truth(spark, out, lines=True)
    assert t.count() > 3
    assert truth.call_details(t).count() == calls.count() and truth.incident(t).count() == 1
    assert truth.confounders(t).count() == 3
    assert truth.noise_counts(t).agg(F.sum("calls")).first()[0] == calls.count()


def test_flatten_any_document(spark, tmp_path):
    docs = [{"name": "d", "at": {"a": 1, "b": None}, "deep": {"m": {"x": [1, 2], "y": []}, "l": [{"id": "p", "v": [{"w": True}]}, {"id": None, "v": None}]}, "none": None},
            {"name": None, "at": None, "deep": {"m": None, "l": [{"id": "q", "v": []}]}}]
    path = write(tmp_path / "d.json", "\n".join(map(json.dumps, docs)))
    schema = ("name string, at struct<a: int, b: int>, deep struct<m: map<string, array<int>>, l: array<struct<id: string, v: array<struct<w: boolean>>>>>, "
              "none array<map<string, int>>")
    got = sorted(map(tuple, truth.flatten(spark.read.schema(schema).json(path), {"deep.l": "id"}).collect()))
    assert got == [
        ("at", "a", "1"), ("deep", "l[p].id", "p"), ("deep", "l[p].v[0].w", "true"), ("deep", "l[q].id", "q"), ("deep", "m.x[0]", "1"),
        ("deep", "m.x[1]", "2"), ("name", "", "d")]


def test_views(spark, sf_dir):
    logs = roles.logs(spark, sf_dir)
    assert views.preferred_database(spark) == "default"
    names = views.region_views(logs, ["ASIA", "MIDDLE EAST"], prefix="v_logs")
    assert names == {"ASIA": "v_logs_asia", "MIDDLE EAST": "v_logs_middle_east"}
    assert spark.table("v_logs_asia").select("region").distinct().count() == 1
    got = views.table_presence_rows(spark, ["v_logs_asia", "no_such_table"]).collect()
    assert (got[0].present, got[1].present, got[1].rows) == (True, False, 0) and got[0].rows > 0


def test_old_names_in_the_preferred_database(spark):
    mark = uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE new_{mark}")
    spark.range(3).write.saveAsTable(f"new_{mark}.a")
    assert views.compat_views(spark, {f"old_{mark}": f"new_{mark}.a"}, wanted=f"logs_{mark}") == {f"old_{mark}": f"default.old_{mark}"}
    spark.sql(f"CREATE DATABASE logs_{mark}")
    found = views.compat_views(spark, {"a": f"new_{mark}.a"}, wanted=f"logs_{mark}")
    assert found == {"a": f"logs_{mark}.a"} and spark.table(found["a"]).count() == 3
    with pytest.raises(ValueError, match="no table"):
        views.compat_views(spark, {"b": f"new_{mark}.b"})
    spark.sql(f"DROP VIEW default.old_{mark}")
    for database in (f"new_{mark}", f"logs_{mark}"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_reports_of_too_many_rows_are_refused(spark, monkeypatch):
    monkeypatch.setattr(report, "MAX_ROWS", 5)
    with pytest.raises(ValueError, match="more than 5 rows"):
        report.write_json_report({"big": (spark.range(1000), ["id"])}, scratch_path(spark, "report"))


def test_ingested_tables_are_partitioned_by_day(spark, sf_dir):
    io_catalog.ingest_directory(spark, sf_dir).collect()
    database = max((d.name for d in spark.catalog.listDatabases() if d.name.startswith("ops_")))
    table = spark.table(f"{database}.app_logs")
    plan = table.where("day = DATE '2024-01-12'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert table.where("day <> to_date(ts)").count() == 0


def test_day_queries_open_one_partition(spark, sf_dir):
    plan = catalog.day_slice(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_daily_shards_and_views_on_demand(spark):
    rows = [("A", date(2024, 1, 1)), ("A", date(2024, 1, 3)), ("new", date(2024, 1, 3))]
    table = spark.createDataFrame(rows, "region string, day date")
    regions = spark.createDataFrame([("A",), ("B",)], "region string")
    got = {(r.region, r.day.day): r.rows for r in views.daily_shards(table, regions).collect()}
    assert got == {("A", 1): 1, ("A", 2): 0, ("A", 3): 1, ("B", 1): 0, ("B", 2): 0, ("B", 3): 0, ("new", 3): 1}
    name = views.daily_view(table, "A", date(2024, 1, 3), prefix="shard")
    assert name == "shard_a_20240103" and spark.table(name).count() == 1
    per = {r.region: tuple(r)[1:] for r in views.shard_inventory(table, regions).collect()}
    assert per == {"A": (3, 2, 2), "B": (3, 0, 0), "new": (3, 1, 1)}
    assert views.daily_shards(table.limit(0), regions).count() == 0


def test_report_keeps_the_order_and_nests(spark):
    top = spark.createDataFrame([("b", 1.1), ("a", 9.9), ("c", 10.5)], "id string, x double")
    one = spark.createDataFrame([(3, None)], "n int, s string")
    out = scratch_path(spark, "report")
    got = report.write_json_report({"top": (top, [F.col("x").desc()]), "t.one": (one, []), "t.two": (one, [])}, out).collect()
    assert [r.value for r in sorted((r for r in got if r.section == "top" and r.key == "id"), key=lambda r: r.row_no)] == ["c", "a", "b"]
    doc = json.loads(spark.read.text(out).first()[0])
    assert doc["t"] == {"one": [{"n": 3, "s": None}], "two": [{"n": 3, "s": None}]} and doc["top"][0] == {"id": "c", "x": 10.5}


def test_loading_fails_loudly(spark, tmp_path):
    def read(name, text, **how):
        return csv_tables.ingest_csv_typed(spark, write(tmp_path / f"{name}.csv", text), "a string, n double", **how).collect()

    for name, text in [("number", "a,n\nx,1.5x\n"), ("short", "a,n\nx\n"), ("long", "a,n\nx,1,2\n")]:
        with pytest.raises(Exception):
            read(name, text)
    with pytest.raises(Exception, match="unreadable at: bad"):
        df = spark.createDataFrame([("bad",)], "at string")
        csv_tables.derive_ingest_columns(df, {"at": "ts"}, strict=True).collect()
    assert [tuple(r) for r in read("breaks", 'a,n\n"x\ny",1\nz,\n', line_breaks=True)] == [("x\ny", 1.0), ("z", None)]
    assert read("header_only", "a,n\n") == []


def test_each_file_has_its_own_header(spark, tmp_path):
    write(tmp_path / "t" / "1.csv", "a,n\nx,1\n")
    write(tmp_path / "t" / "2.csv", "n,extra,a\n2,e,y\n")
    write(tmp_path / "t" / "3.csv", "a,n\nz,3\n")
    folder = str(tmp_path / "t")
    got = csv_tables.ingest_csv_typed(spark, folder, "a string, n double", by_file=True)
    assert sorted(map(tuple, got.collect())) == [("x", 1.0), ("y", 2.0), ("z", 3.0)]
    with pytest.raises(Exception):
        csv_tables.ingest_csv_typed(spark, folder, "a string, n double").collect()


def calls_csv(rows, names=None):
    """tso_calls text: rows are dicts of what differs; ``names`` gives the order of columns."""
    own = [c.split()[0] for c in TABLES["tso_calls"].columns.split(", ")]
    plain = dict.fromkeys(own, "x") | {"timestamp": "2024-01-01T00:00:00Z", "resolution_time_minutes": "5"}
    return "\n".join([",".join(names or own), *[",".join((plain | r)[c] for c in names or own) for r in rows]]) + "\n"


def test_stream_load_with_quarantine_and_any_order(spark, tmp_path):
    own = [c.split()[0] for c in TABLES["tso_calls"].columns.split(", ")]
    folder, out, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    write(folder / "1.csv", calls_csv([{"call_id": "a"}, {"call_id": "b", "resolution_time_minutes": "5x"}]) + "too,few\n" + ",".join("y" * 12) + "\n")
    write(folder / "2.csv", calls_csv([{"call_id": "c"}, {"call_id": "d", "timestamp": "never"}], own[::-1] ))
    write(folder / "3.csv", "call_id,other\ne,1\n")

    def load(counts):
        done = csv_tables.load_stream(spark, str(folder), "tso_calls", out, quarantine=bad, max_files=2, counts=counts)
        return sorted(r.call_id for r in done.collect())

    counts = {}
    assert load(counts) == ["a", "c"] and counts == {"rows": 2, "quarantined": 5}
    wrong = {(r.file.rsplit("/", 1)[1], r.reason): r.line for r in spark.read.parquet(bad).collect()}
    assert set(wrong) == {
        ("1.csv", "unreadable resolution_time_minutes: 5x"), ("1.csv", csv_tables.MALFORMED), ("2.csv", "unreadable timestamp: never"),
        ("3.csv", "columns missing in the header: " + ", ".join(c for c in own if c != "call_id"))}
    assert wrong[("3.csv", "columns missing in the header: " + ", ".join(c for c in own if c != "call_id"))] == "e,1"
    write(folder / "4.csv", calls_csv([{"call_id": "f"}]))
    assert load(counts) == ["a", "c", "f"] and counts == {"rows": 1, "quarantined": 0}
    row = spark.read.parquet(out).where("call_id = 'c'").first()
    assert row.resolution_time_minutes == 5 and str(row.ts) == "2024-01-01 00:00:00" and row.day == date(2024, 1, 1)
    with pytest.raises(ValueError, match="another checkpoint"):
        csv_tables.load_stream(spark, str(folder), "tso_calls", out, quarantine=bad, checkpoint=str(tmp_path / "else"))


@pytest.mark.parametrize("text", ["too,few\n", ",".join("y" * 12) + "\n", calls_csv([{"resolution_time_minutes": "5x"}]).split("\n")[1] + "\n"])
def test_strict_streams_end_at_a_bad_record(spark, tmp_path, text):
    folder = tmp_path / "in"
    write(folder / "1.csv", calls_csv([{"call_id": "a"}]) + text)
    with pytest.raises(Exception):
        csv_tables.load_stream(spark, str(folder), "tso_calls", str(tmp_path / "out"))
    with pytest.raises(Exception):
        streams.run_append(csv_tables.csv_stream(spark, str(folder), "tso_calls"), "strict").count()


def test_a_directory_load_reads_each_table_once(spark, tmp_path, monkeypatch):
    plans, listed = [], csv_tables.by_day_and_key
    monkeypatch.setattr(csv_tables, "by_day_and_key", lambda df, *a: plans.append(df) or listed(df, *a))
    write(tmp_path / "clickhouse-tso_calls.csv", calls_csv([{"call_id": "a"}, {"call_id": "b"}]))
    db = "d" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    got = csv_tables.ingest_directory(spark, str(tmp_path), db, scratch_path(spark, "once")).collect()
    assert [tuple(r) for r in got] == [("tso_calls", 2)]
    assert len(plans) == 1 and plans[0]._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_headers_are_read_without_a_job_over_the_text(spark, tmp_path):
    import gzip

    write(tmp_path / "t" / "1 a.csv", "a,n\r\nx,1\r\n")
    write(tmp_path / "t" / "2.csv", "\ufeffa,n\nx,1\n")
    write(tmp_path / "t" / "3.csv", "n,a")
    write(tmp_path / "t" / "4.csv", "")
    (tmp_path / "t" / "5.csv.gz").write_bytes(gzip.compress(b"n,a\n2,y\n"))
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        found = csv_tables._files_by_header(spark, str(tmp_path / "t"))
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    assert {h: [f.rsplit("/", 1)[1] for f in files] for h, files in found.items()} == {"a,n": ["1 a.csv", "2.csv"], "n,a": ["3.csv", "5.csv.gz"]}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    with pytest.raises(ValueError, match="no CSV text"):
        csv_tables._files_by_header(spark, str(tmp_path / "t" / "4.csv"))


def test_empty_numbers_are_not_cast(spark):
    df = spark.createDataFrame([("",), (None,), ("x",), (" 7 ",)], "n string").repartition(1)
    out = csv_tables.derive_ingest_columns(df, {}, ("n",))
    assert [r.n_f64 for r in out.orderBy("n").collect()] == [0.0, 0.0, 7.0, 0.0]
    assert "CASE WHEN" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("table", ["app_logs", "trace_spans"])
def test_text_of_small_input_is_written_by_many_tasks(spark, sf_dir, table):
    assert exports.EXPORTS[table](spark, sf_dir).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_compressed_text_is_bounded_by_file_and_read_back(spark, tmp_path):
    rows = [(f"c{i}", "" if i % 3 else 'a,"b"', i) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, note string, n int").repartition(1)
    sinks.sink_csv_header(df, str(tmp_path / "t"), compression="gzip", max_rows=4)
    files = [f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    back = csv_tables.ingest_csv_typed(spark, str(tmp_path / "t"), "id string, note string, n int")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_the_text_of_a_directory_load_is_compressed(spark, tmp_path, monkeypatch):
    def small(table):
        names = [f.name for f in csv_tables._schema(TABLES[table].columns)]
        of_time = set(TABLES[table].times)
        return spark.createDataFrame([tuple("2024-01-01T00:00:00Z" if n in of_time else "7" for n in names)] * 2, names)

    monkeypatch.setattr(io_catalog.exports, "EXPORTS", {t: lambda s, d, t=t: small(t) for t in TABLES})
    monkeypatch.setattr(io_catalog, "scratch_path", lambda s, name: str(tmp_path / f"{name}-{uuid.uuid4().hex[:12]}"))
    got = io_catalog.ingest_directory(spark, "none").collect()
    assert {tuple(r) for r in got} == {(t, 2) for t in TABLES}
    (inbox,) = tmp_path.glob("inbox-*")
    for table in TABLES:
        parts = [f.name for f in (inbox / f"clickhouse-{table}.csv").iterdir() if f.name.startswith("part-")]
        assert parts and all(f.endswith(".csv.gz") for f in parts)


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffle_files_go_when_a_write_ends(spark, tmp_path):
    import glob
    import time

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}

    before = files()
    with shuffles_freed(spark):
        spark.range(1000).repartition(7).write.csv(str(tmp_path / "freed"))
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(FREED, None) is None
    assert spark.read.csv(str(tmp_path / "freed")).count() == 1000


def test_a_directory_load_frees_its_shuffles(spark, tmp_path, monkeypatch):
    seen, ordered = [], csv_tables.by_day_and_key
    monkeypatch.setattr(csv_tables, "by_day_and_key", lambda df, *a: seen.append(spark.conf.get(FREED, None)) or ordered(df, *a))
    write(tmp_path / "clickhouse-tso_calls.csv", calls_csv([{"call_id": "a"}]))
    db = "d" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    csv_tables.ingest_directory(spark, str(tmp_path), db, scratch_path(spark, "freed"))
    assert seen == ["true"] and spark.conf.get(FREED, None) is None


def test_shipments_are_joined_to_orders_that_have_met_their_customers(spark, sf_dir):
    joins = [x for x in roles.circuit_metrics(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x]
    of_order, of_customer = (next(i for i, x in enumerate(joins) if key in x) for key in ("l_orderkey", "o_custkey"))
    assert of_order < of_customer  # outer joins come first: no shipment takes part in the customers' join
