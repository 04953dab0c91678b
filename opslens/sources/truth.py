"""Reading the nested truth document: one JSON document, or one per line in many files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions.scalars import text_or_empty
from opslens.sources.csv_tables import iso_time
from opslens.sources.schemas import TRUTH_SCHEMA


#: Lists of the document whose elements are known by a field rather than by their place.
IDS = {"confounders": "name", "tso_noise.call_details": "call_id"}


def flatten(docs: DataFrame, ids: Mapping[str, str] | None = None) -> DataFrame:
    """(section, key, value) of every value in nested documents, whatever their schema; absent values give no row.

    Fields and map keys are joined by dots, list elements are numbered from [0] or, for lists in ``ids`` (by their path
    of field names), named by a field of theirs. A plain top-level value has an empty key. Values are text.
    """
    empty = F.array().cast("array<struct<key: string, value: string>>")

    def below(path: Column | None, name: str | Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return name if path is None else F.concat(path, F.lit("."), name)

    def entries(col: Column, kind: T.DataType, path: Column | None, where: str) -> Column:
        if isinstance(kind, T.StructType):
            found = F.concat(*[entries(col[f.name], f.dataType, below(path, f.name), f"{where}.{f.name}") for f in kind])
        elif isinstance(kind, T.MapType):
            found = F.flatten(F.transform(F.map_entries(col), lambda e: entries(e["value"], kind.valueType, below(path, e["key"].cast("string")), where)))
        elif isinstance(kind, T.ArrayType):
            start, known = F.lit("") if path is None else path, (ids or {}).get(where)

            def element(x: Column, i: Column) -> Column:
                name = F.coalesce(x[known].cast("string"), i.cast("string")) if known else i.cast("string")
                return entries(x, kind.elementType, F.concat(start, F.lit("["), name, F.lit("]")), where)

            found = F.flatten(F.transform(col, element))
        else:
            found = F.array(F.struct((F.lit("") if path is None else path).alias("key"), col.cast("string").alias("value")))
        return F.when(col.isNotNull(), found).otherwise(empty)

    def section(f: T.StructField) -> Column:
        named = lambda e: F.struct(F.lit(f.name).alias("section"), e["key"].alias("key"), e["value"].alias("value"))
        return F.filter(F.transform(entries(F.col(f.name), f.dataType, None, f.name), named), lambda e: e["value"].isNotNull())

    sections = F.concat(*[section(f) for f in docs.schema])
    return docs.select(F.explode(sections).alias("e")).select("e.*")


def read_truth(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``lines=False`` reads whole-file documents; ``lines=True`` reads a split document, one part per line."""
    return spark.read.schema(TRUTH_SCHEMA).option("multiLine", not lines).json(path)


def incident(truth: DataFrame) -> DataFrame:
    rows = truth.where("primary_incident IS NOT NULL").select("primary_incident.*").distinct()
    return rows.withColumns({c: iso_time(c) for c in ("start", "end", "fix_time")})


def confounders(truth: DataFrame) -> DataFrame:
    """Confounder windows with ``priority`` in document order."""
    rows = truth.select(F.posexplode("confounders").alias("pos", "c")).select("c.*", (F.col("pos") + 1).alias("priority")).distinct()
    return rows.withColumns({c: iso_time(c) for c in ("start", "end")})


def noise_counts(truth: DataFrame) -> DataFrame:
    part = truth.select(F.explode("tso_noise.noise_counts").alias("noise_type", "calls"))
    total = part.groupBy("noise_type").agg(F.sum("calls").alias("calls"))
    return total


def call_details(truth: DataFrame) -> DataFrame:
    return truth.select(F.explode("tso_noise.call_details").alias("d")).select(
        "d.call_id", F.col("d.true_transaction_id").alias("true_id"), text_or_empty("d.emitted_transaction_id").alias("emitted_id"),
        "d.noise_type", "d.delay_minutes",
    )
