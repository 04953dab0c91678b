"""Helpers shared by the operators: row keys, text kernels on Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.session import frozen

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(c, UPPER, LOWER)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null stays null."""
    return F.pmod(F.crc32(F.encode(col.cast("string"), "UTF-8")), F.lit(n))


def row_key(text: str = "text", doc_id: str = "doc_id") -> tuple[Column, Column]:
    """Two columns that tell rows apart by (doc_id, text); null-safe, never null."""
    return F.coalesce(F.col(doc_id), F.lit(-(2**63))).alias("_d"), F.xxhash64(doc_id, text).alias("_k")


def with_copies(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as decided: ``decided`` has _d, _k, rows (of ``docs`` that it speaks for), copies.

    Rows with the same doc_id and text cannot be told apart: together they get the sum of their copies.
    Columns of ``docs`` stay as they are; those without copies go.
    """
    keys = decided.groupBy("_d", "_k").agg(F.sum("rows").alias("_m"), F.sum("copies").alias("_c"))
    keys = frozen(keys.filter("_c > 0"))
    joined = docs.select(F.struct(*docs.columns).alias("_row"), *row_key()).join(keys, ["_d", "_k"])
    if not keys.filter("_m > 1").isEmpty():
        joined = joined.filter("_m = 1").unionByName(joined.filter("_m > 1").dropDuplicates(["_d", "_k"]))
    if not keys.filter("_c > 1").isEmpty():
        joined = joined.withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_c"))))
    return joined.select("_row.*")


def runs(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        end = np.cumsum(size)
        lo = 0
        while lo < batch.num_rows:
            base = end[lo] - size[lo]
            hi = max(lo + 1, int(np.searchsorted(end, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def chunked(text: bytes, limit: int) -> Iterator[bytes]:
    """A text in pieces of about ``limit`` bytes, cut before white space (or before the character if there is none)."""
    lo = 0
    while len(text) - lo > limit:
        hi = max(text.rfind(b" ", lo + 1, lo + limit), text.rfind(b"\n", lo + 1, lo + limit))
        if hi <= lo:
            hi = lo + limit
            while text[hi] & 0xC0 == 0x80 and hi > lo + 1:
                hi -= 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of 0..n-1 reaches over the edges a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as join the same nodes as the edges a-b do: (node, smallest node it reaches)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = roots(at[: len(a)], at[len(a):], len(nodes))
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _stars(edges: DataFrame) -> DataFrame:
    """One round of large-star, then small-star, over edges with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(low, "a").filter("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b): the smallest node it can reach.

    Alternates the two star operations until nothing changes; each round is written to the shared folder.
    Nodes without an edge, and edges from a node to itself, give no row.
    """
    edges = frozen(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        edges = frozen(_stars(edges))
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
