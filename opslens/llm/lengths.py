"""Exact histogram of encoded lengths, with suffix sums that answer every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.llm.common import runs
from opslens.llm.tokens import VOCABULARY, encoder
from opslens.session import frozen

BATCH_BYTES = 4 << 20
#: Lengths that one task sums up in order.
BLOCK = 4096


def histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(length, docs): number of rows of ``docs`` (text) of each encoded length; null and empty text has length 0.

    Each task counts its own rows, so only (length, count) is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in runs(batches, "text", BATCH_BYTES):
            n = [len(x) // 4 for x in enc.ids([t or "" for t in batch.column("text").to_pylist()])]
            length, times = np.unique(np.array(n, np.int64), return_counts=True)
            yield pa.record_batch({"length": pa.array(length), "docs": pa.array(times.astype(np.int64))})

    counted = docs.select("text").mapInArrow(count, "length long, docs long")
    return counted.groupBy("length").agg(F.sum("docs").alias("docs"))


def by_limit(lengths: DataFrame) -> DataFrame:
    """For each length that occurs, as a context limit: length, docs, tokens (of documents of just that length),
    docs_over and tokens_over (longer documents), docs_total, tokens_total, tokens_kept (total when every document is
    cut to the limit), share_fit (share of documents no longer: the length is the quantile of each share up to it).

    Between two lengths L < M nothing changes but the cut: tokens kept at a limit x in between are those at L plus
    (x - L) * docs_over at L. Suffix sums run inside blocks of lengths; the few block totals are carried over.
    An empty table gives no rows.
    """
    rows = frozen(lengths.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"),
                                 F.floor(F.col("length") / BLOCK).alias("_block")))
    per = rows.groupBy("_block").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    down = W.orderBy(F.col("_block").desc())
    above, whole = down.rowsBetween(W.unboundedPreceding, -1), down.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    zero = F.lit(0).cast("long")
    per = per.select("_block", F.coalesce(F.sum("_docs").over(above), zero).alias("_docs"),
                     F.coalesce(F.sum("_tokens").over(above), zero).alias("_tokens"),
                     F.sum("_docs").over(whole).alias("docs_total"), F.sum("_tokens").over(whole).alias("tokens_total"))
    inside = W.partitionBy("_block").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({
        "_in_docs": F.coalesce(F.sum("docs").over(inside), zero), "_in_tokens": F.coalesce(F.sum("tokens").over(inside), zero),
    }).join(per, "_block")
    over, tokens_over = F.col("_docs") + F.col("_in_docs"), F.col("_tokens") + F.col("_in_tokens")
    return rows.select(
        "length", "docs", "tokens", over.alias("docs_over"), tokens_over.alias("tokens_over"), "docs_total", "tokens_total",
        (F.col("tokens_total") - tokens_over + F.col("length") * over).alias("tokens_kept"),
        ((F.col("docs_total") - over) / F.col("docs_total")).alias("share_fit"),
    )
