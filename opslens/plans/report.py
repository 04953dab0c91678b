"""Combined reports over the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.operators.rollups import one_row
from opslens.session import frozen, within


def validation_summary(*parts: DataFrame) -> DataFrame:
    """One row with the columns of all one-row checks."""
    return one_row(*parts)


#: Rows that all sections of a report may have together; one document is written by one task.
MAX_ROWS = 10_000

Sections = Mapping[str, tuple[DataFrame, Sequence[str | Column]]]


def report_rows(sections: Sections) -> DataFrame:
    """Each small result as (section, rank, body): the row as JSON, ranked by the section's order, then by its text."""
    parts = []
    for name, (df, order) in sections.items():
        body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        # One row past the bound is enough to refuse the report, so no more are ordered in one task.
        first = df.orderBy(*order, body).limit(MAX_ROWS + 1)
        rank = F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order, body))
        parts.append(first.select(F.lit(name).alias("section"), rank.alias("rank"), body.alias("body")))
    return reduce(DataFrame.unionByName, parts)


def _parser(schema):
    return lambda r: F.from_json(r["body"], schema)


def write_json_report(sections: Sections, out: str) -> DataFrame:
    """Write one nested document, one array per section, and return it as (section, row_no, key, value) rows.

    A section named ``a.b`` becomes field b of object a. Sections are report results of a few rows each, kept in
    their order; more than ``MAX_ROWS`` rows in all are an error.
    """
    rows = frozen(report_rows(sections))
    if not within(rows, MAX_ROWS):
        raise ValueError(f"a report of more than {MAX_ROWS} rows")
    spark = rows.sparkSession
    arrays = {n: F.array_sort(F.collect_list(F.when(F.col("section") == n, F.struct("rank", "body")))) for n in sections}
    doc = rows.groupBy().agg(*[arrays[n].alias(f"s{i}") for i, n in enumerate(sections)])
    fields: dict[str, list[Column]] = {}
    for i, (n, (df, _)) in enumerate(sections.items()):
        top, _, inner = n.partition(".")
        fields.setdefault(top, []).append(F.transform(f"s{i}", _parser(df.schema)).alias(inner or top))
    plain = {n for n in sections if "." not in n}
    typed = doc.select(*[cs[0] if top in plain else F.struct(*cs).alias(top) for top, cs in fields.items()])
    typed.coalesce(1).write.json(out, ignoreNullFields=False)
    back = spark.read.schema(typed.schema).json(out)
    parts = []
    for n, (df, _) in sections.items():
        cells = F.map_entries(F.create_map(*[
            x for f in df.schema.fields for x in (F.lit(f.name), F.col(f"r.{f.name}").cast("string"))
        ]))
        one = back.select(F.posexplode(n).alias("pos", "r")).select(
            F.lit(n).alias("section"), (F.col("pos") + 1).alias("row_no"), F.explode(cells).alias("e")
        )
        parts.append(one.select("section", "row_no", F.col("e.key").alias("key"), F.col("e.value").alias("value")))
    return reduce(DataFrame.unionByName, parts)
