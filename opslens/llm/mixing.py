"""Mixing sources to target weights as a time-varying curriculum.

Each source gets a demand in words. Its documents, in hash order, form a stream of words that is read again from the
start when it ends; what lies before the demand is taken. Each source has a schedule, the rate at which training asks
for its words over training time 0..1. The integral of the schedule, scaled to the demand, is the cumulative demand;
its inverse at a document's place in the stream is the document's training position. The training set is range-sorted
by position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.llm.common import row_key
from opslens.session import frozen

WORD = r"[^\x20\x09-\x0D]+"

#: Schedules as (time, rate) knots from time 0 to 1, dealt to the sources in turn like the weights: an even one, one
#: that falls off, one that rises.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.2), (1.0, 0.1)), ((0.0, 0.1), (0.5, 0.8), (1.0, 1.5)))

#: Documents of a source that one task puts in order, about.
BLOCK_ROWS = 2000


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with nth, weight and target.

    Sources by code point, null last, get the weights in turn. Targets share ``share`` times all words by weight;
    none is above ``most`` times its source's words: the excess goes to the others by weight until none is above.
    In closed form: in the order of size / weight, the sources whose full allowance fits under the level of the rest
    are the ones cut off. One row per source, in one task.
    """
    whole = W.orderBy(F.col("source").asc_nulls_last())
    ws = F.array(*(F.lit(w) for w in weights))
    nth = F.row_number().over(whole) - 1
    rows = sizes.withColumn("nth", nth).withColumn("weight", F.element_at(ws, F.pmod("nth", F.lit(len(weights))) + 1))
    by_fill = W.orderBy((F.col("source_size") / F.col("weight")).asc(), "nth")
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    here = by_fill.rowsBetween(0, W.unboundedFollowing)
    everything = by_fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumns({
        "left": F.lit(share) * F.sum("source_size").over(everything) - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
        "open": F.sum("weight").over(here),
    })
    full = F.lit(most) * F.col("source_size") * F.col("open") <= F.col("weight") * F.col("left")
    rows = rows.withColumn("full", full)
    # The first source that is not cut off sets the level for itself and all after it.
    first = F.first(F.when(~F.col("full"), F.struct("left", "open")), ignorenulls=True).over(everything)
    rows = rows.withColumn("level", first)
    cut = F.col("level").isNull() | F.col("full")
    target = F.when(cut, F.lit(most) * F.col("source_size")).otherwise(F.col("weight") * F.col("level.left") / F.col("level.open"))
    return rows.select("source", "source_size", "nth", "weight", target.cast("double").alias("target"))


def position(share: Column, nth: Column, schedules=SCHEDULES) -> Column:
    """Training time at which ``share`` of a source's demand is met: the inverse of its schedule's integral.

    Rates are linear between knots, so the integral is quadratic there and is inverted in closed form.
    """
    found = None
    for which, knots in enumerate(schedules):
        areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        total, done, pieces = sum(areas), 0.0, []
        for area, (t0, r0), (t1, r1) in zip(areas, knots, knots[1:]):
            need = share * total - F.lit(done)
            slope = (r1 - r0) / (t1 - t0)
            root = F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * need, F.lit(0.0)))
            pieces.append(((done + area) / total, F.lit(t0) + F.lit(2.0) * need / (F.lit(r0) + root)))
            done += area
        at = pieces[-1][1]
        for end, inverse in reversed(pieces[:-1]):
            at = F.when(share <= end, inverse).otherwise(at)
        mine = F.pmod(nth, F.lit(len(schedules))) == which
        found = F.when(mine, at) if found is None else found.when(mine, at)
    return F.least(F.greatest(found, F.lit(0.0)), F.lit(1.0))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0, schedules=SCHEDULES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, source), range-sorted by first position; those left out last.

    doc_id, _d and _k (the row's key, see ``common.row_key``), size, source, source_size, target, copies (how often
    the document is taken: 0, 1, 2), taken (copies * size), positions (training time of each copy).
    Order in a source's stream: md5 of doc_id as text, then doc_id, null first; so a rerun on the same rows agrees,
    and repeated rows, which cannot be told apart, share one place after the other. A copy is taken if its middle word
    lies before the demand: a source's words are off its target by half a document at most. Null text has no words and
    is never taken; null source is a source; an empty table gives no rows.
    """
    light = frozen(docs.select("doc_id", *row_key(), "source", words(F.col("text")).alias("size")))
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    n = sizes.agg(F.max("n")).first()[0] or 0
    blocks = max(1, -(-n // BLOCK_ROWS))
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # The first 8 hex digits in even ranges: blocks follow the order of the whole digest.
    block = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * F.lit(blocks) / F.lit(2**32)).cast("int")
    light = light.withColumns({"_order": order, "_block": block})
    goals = targets(sizes.select("source", "source_size"), weights, share, most)
    ahead = W.partitionBy("source").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    per_block = light.groupBy("source", "_block").agg(F.sum("size").alias("_sum"))
    per_block = per_block.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    placed = per_block.alias("p").join(goals.alias("g"), F.expr("p.source <=> g.source"))
    placed = placed.select(F.col("p.source").alias("_source"), F.col("p._block").alias("_at"), "_ahead", "source_size", "nth", "target")
    inside = W.partitionBy("source", "_block").orderBy("_order", F.col("doc_id").asc_nulls_first(), "_k", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = light.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(placed, F.expr("source <=> _source and _block = _at"))
    start = F.col("_ahead") + F.col("_in")

    def middle(k):
        return F.lit(k) * F.col("source_size") + start + F.col("size") / 2

    reads = int(-(-most // 1))
    rounds = F.array(*(F.when((F.col("size") > 0) & (middle(k) <= F.col("target")), middle(k) / F.col("target")) for k in range(reads)))
    rows = rows.withColumn("_met", F.filter(rounds, lambda m: m.isNotNull()))
    rows = rows.withColumn("positions", F.transform("_met", lambda m: position(m, F.col("nth"), schedules)))
    rows = rows.withColumn("copies", F.size("positions"))
    out = rows.select("doc_id", "_d", "_k", "size", "source", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"), "positions")
    first = F.coalesce(F.try_element_at("positions", F.lit(1)), F.lit(2.0))
    out = out.withColumn("_first", first)
    return out.repartitionByRange("_first", "_k").sortWithinPartitions("_first", "_k").drop("_first")


def training_order(mixed: DataFrame) -> DataFrame:
    """The copies of a mix, one row each, range-sorted by training position: position, doc_id, copy (from 0), size."""
    copies = mixed.select("doc_id", "size", F.posexplode("positions").alias("copy", "position"))
    return copies.repartitionByRange("position").sortWithinPartitions("position", "doc_id", "copy")
