"""Corpus pipeline: language filter, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and reads it again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.llm import langid, mixing, packing, simhash
from opslens.llm.common import with_copies
from opslens.session import staged


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the language filters on the documents and drops those in no learned language: null text, texts without a
    letter, and texts of which hardly any n-gram is known. A null lang is kept as it is."""
    model = langid.fit(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return langid.predict(rows, model).filter(~langid.rejected()).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group that SimHash links."""
    return with_copies(docs, simhash.decisions(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents as the mix of sources asks: a document is there once for each copy taken."""
    mixed = mixing.mix(docs).select("_d", "_k", F.lit(1).alias("rows"), "copies")
    return with_copies(docs, mixed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    packed = packing.pack(docs)
    rows = packed.pieces.select("uid", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return rows.join(packed.places, "uid").drop("uid")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Language filters, token ids and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
