"""Named views over tables: aliases, region and region-day shards, inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def view_alias(df: DataFrame, old_name: str) -> DataFrame:
    """Make ``df`` readable under an old name."""
    df.createOrReplaceTempView(old_name)
    return df.sparkSession.table(old_name)


def preferred_database(spark: SparkSession, wanted: str = "logs", otherwise: str = "default") -> str:
    return wanted if spark.catalog.databaseExists(wanted) else otherwise


def compat_views(spark: SparkSession, sources: Mapping[str, str], wanted: str = "logs", otherwise: str = "default") -> dict[str, str]:
    """A view of every table under its old name (``sources``: old name -> table), in database ``wanted`` if there is one.

    Returns old name -> full view name, which is what readers of the old names should take as their source.
    """
    database = preferred_database(spark, wanted, otherwise)
    found = {}
    for old, table in sources.items():
        if not spark.catalog.tableExists(table):
            raise ValueError(f"no table {table} for the view {old}")
        found[old] = f"{database}.{old}"
        spark.sql(f"CREATE OR REPLACE VIEW {found[old]} AS SELECT * FROM {table}")
    return found


def _slugs(regions: Sequence[str]) -> dict[str, str]:
    """Region -> its part of a view name; an error if two regions would share one."""
    slugs = {r: r.lower().replace(" ", "_").replace("-", "_") for r in regions}
    if len(set(slugs.values())) < len(slugs):
        raise ValueError(f"regions whose view names are alike: {sorted(slugs)}")
    return slugs


def region_views(df: DataFrame, regions: Sequence[str], prefix: str = "app_logs", region_col: str = "region") -> dict[str, str]:
    """One view per region; returns region -> view name."""
    names = {}
    for r, slug in _slugs(regions).items():
        names[r] = f"{prefix}_{slug}"
        df.where(F.col(region_col) == r).createOrReplaceTempView(names[r])
    return names


def daily_view(table: DataFrame, region: str, day: date, prefix: str = "app_logs", region_col: str = "region", day_col: str = "day") -> str:
    """The view of one region and day, made when it is asked for; returns its name (suffix yyyyMMdd).

    ``table`` is partitioned by ``day_col``; the view filters on that column, so a read through it opens one partition.
    """
    name = f"{prefix}_{_slugs([region])[region]}_{day:%Y%m%d}"
    table.where((F.col(day_col) == F.lit(day)) & (F.col(region_col) == region)).createOrReplaceTempView(name)
    return name


def daily_shards(table: DataFrame, regions: DataFrame, region_col: str = "region", day_col: str = "day") -> DataFrame:
    """(region, day, rows) of every shard: each region on each day from the first to the last, 0 for an empty one.

    One grouped scan of the two columns, whatever the number of shards. Regions come from ``regions`` (column
    ``region``); those only found in the rows are kept, with the days they have.
    """
    counts = table.groupBy(F.col(region_col).alias("region"), F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    bounds = table.agg(F.min(day_col).alias("a"), F.max(day_col).alias("b"))
    both = regions.select("region").unionByName(bounds, allowMissingColumns=True).agg(
        F.collect_set("region").alias("names"), F.max("a").alias("a"), F.max("b").alias("b"))
    days = both.where("a IS NOT NULL").select("names", F.explode(F.sequence("a", "b")).alias("day"))
    spine = days.select("day", F.explode("names").alias("region"))
    return spine.join(counts, ["region", "day"], "full").select("region", "day", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


def rows_through_views(spark: SparkSession, names: dict, columns: Sequence[str]) -> DataFrame:
    """Rows read through each view, 0 for an empty one; ``names`` maps a shard's labels to its view.

    One statement over all views, then one aggregate, so the plan is analysed once and the scans share a stage.
    """
    def quoted(key):
        values = key if isinstance(key, tuple) else (key,)
        return ["'" + v.replace("'", "''") + "'" for v in values]

    through = [
        f"SELECT {', '.join(f'{v} AS {c}' for v, c in zip(quoted(k), columns))}, 1 AS n FROM `{view}`" for k, view in names.items()
    ]
    every = ", ".join(f"({', '.join(quoted(k))}, 0)" for k in names)
    shards = f"SELECT * FROM VALUES {every} AS t({', '.join(columns)}, n)"
    return spark.sql(" UNION ALL ".join([*through, shards])).groupBy(*columns).agg(F.sum("n").alias("rows"))


def rows_through_region_views(spark: SparkSession, names: dict[str, str]) -> DataFrame:
    return rows_through_views(spark, names, ["region"])


def shard_inventory(df: DataFrame, regions: DataFrame, region_col: str = "region", day_col: str = "day") -> DataFrame:
    """Shards per region over the whole day span, how many hold rows, and the rows in all of them.

    Every region of ``regions`` (column ``region``) has a line, also without rows.
    """
    counts = df.groupBy(F.col(region_col).alias("region"), F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    per_region = counts.groupBy("region").agg(
        F.min("day").alias("a"), F.max("day").alias("b"), F.count(F.lit(1)).alias("non_empty_shards"), F.sum("rows").alias("rows")
    )
    per_region = regions.select("region").distinct().join(per_region, "region", "full")
    every = W.partitionBy(F.lit(1))
    expected = F.date_diff(F.max("b").over(every), F.min("a").over(every)) + 1
    none = F.lit(0).cast("bigint")
    return per_region.select("region", F.coalesce(expected.cast("bigint"), none).alias("expected_shards"),
                             *[F.coalesce(c, none).alias(c) for c in ("non_empty_shards", "rows")])


def table_presence_rows(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Whether each optional table exists, and its counted rows (0 when absent)."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            parts.append(spark.table(n).agg(F.lit(n).alias("table_name"), F.lit(True).alias("present"), F.count(F.lit(1)).alias("rows")))
        else:
            parts.append(spark.range(1).select(F.lit(n).alias("table_name"), F.lit(False).alias("present"), F.lit(0).cast("bigint").alias("rows")))
    return reduce(DataFrame.unionByName, parts)
