"""Attach intervals to rows by time without comparing every row with every interval.

Overlapping intervals are cut at each other's bounds into disjoint elementary ones, each with the first interval (by
priority) that covers it. A row lies in at most one of these, so it is joined without lists and without copies.

A few intervals (SMALL, counted first) are swept on the driver with a stack of open ones, and their pieces are joined by
broadcast over even time slots. Any larger number is cut by Spark: bounds are numbered, an interval is laid over the few aligned
blocks of numbers that make it up, each block keeps its first interval, and a piece takes the first of the blocks it lies
in. The pieces then meet the rows in one sorted order, in which the last piece begun is carried forward.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslens.functions.running import running
from opslens.functions.scalars import join_null_safe, micros
from opslens.session import frozen

#: Intervals that are swept on the driver, and time slots their pieces are laid over, about.
SMALL, SLOTS = 1000, 4096


def first_interval(
    df: DataFrame,
    ts: str,
    windows: DataFrame,
    take: str,
    out: str,
    start: str,
    end: str,
    priority: str,
    region: str | None = None,
    window_region: str | None = None,
    piece: str | None = None,
) -> DataFrame:
    """Add ``out``: the ``take`` value of the first interval by ``priority`` (then start, end and value) with start <= ts < end.

    ``window_region`` may hold ``*`` for any region, also an absent one. ``piece``, if given, receives the start of the
    elementary interval the row lies in, in microseconds; null outside all intervals, or if regions are asked for.
    """
    rows = windows.where(F.col(start) < F.col(end)).select(
        *([F.col(window_region).alias("_r")] if window_region else []),
        F.struct(F.col(priority).alias("p"), micros(start).alias("a"), micros(end).alias("b"), F.col(take).alias("v")).alias("_w"))
    tagged = df.select(F.struct(*df.columns).alias("_row"), micros(ts).alias("_t"), *([F.col(region).alias("_r")] if window_region else []))
    few = rows.limit(SMALL + 1).collect()
    if len(few) <= SMALL:
        few.sort(key=lambda r: [(v is not None, v) for v in r["_w"]])
        layers = [([r for r in few if r["_r"] not in (None, "*")], ["_r"]), ([(r["_w"],) for r in few if r["_r"] == "*"], [])] if window_region else [(few, [])]
        tag = _tag_by_slot
    else:
        layers = [(rows.where("_r <> '*'"), ["_r"]), (rows.where("_r = '*'").drop("_r"), [])] if window_region else [(rows, [])]
        tag = _tag_in_order
    for n, (layer, by) in enumerate(layers):
        tagged = tag(tagged, layer, by, f"_best{n}", rows.schema)
    best = F.least("_best0.w", "_best1.w") if window_region else F.col("_best0.w")
    extra = [F.col("_best0.a").alias(piece)] if piece and not window_region else [F.lit(None).cast("long").alias(piece)] if piece else []
    return tagged.select("_row.*", best["v"].alias(out), *extra)


def _sweep(windows: Sequence[tuple], by: int) -> Iterator[tuple]:
    """(key..., start, end, first interval) of the pieces of intervals given as (key..., struct), first by priority first."""
    edges: dict[tuple, dict[int, list[int]]] = {}
    for nth, row in enumerate(windows):
        starts = edges.setdefault(tuple(row[:by]), {})
        starts.setdefault(row[by].a, []).append(nth)
        starts.setdefault(row[by].b, [])
    for key, starts in edges.items():
        times, open_ = sorted(starts), []
        for lo, hi in zip(times, times[1:]):
            for nth in starts[lo]:
                heappush(open_, nth)
            # An interval that ended stays below the top until it would come first.
            while open_ and windows[open_[0]][by].b <= lo:
                heappop(open_)
            if open_:
                yield (*key, lo, hi, windows[open_[0]][by])


def _tag_by_slot(rows: DataFrame, windows: Sequence[tuple], by: list[str], name: str, schema: T.StructType) -> DataFrame:
    """``rows`` (_row, _t, by) with ``name``: struct of the piece's start ``a``, end ``b`` and first interval ``w``, or null."""
    spark = rows.sparkSession
    found = list(_sweep(windows, len(by)))
    long = T.LongType()
    schema = T.StructType([*[schema[c] for c in by], T.StructField("_a", long), T.StructField("_b", long), schema["_w"]])
    step = max(1, sum(p[-2] - p[-3] for p in found) // SLOTS)
    slot = F.floor(F.col("_a") / F.lit(step)), F.floor((F.col("_b") - 1) / F.lit(step))
    small = spark.createDataFrame(found, schema).select(
        *[F.col(c).alias(f"_of{c}") for c in by], F.explode(F.sequence(*slot)).alias("_of"), F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_w").alias("w")).alias(name))
    t = F.col("_t")
    same = (F.floor(t / F.lit(step)) == F.col("_of")) & (t >= F.col(f"{name}.a")) & (t < F.col(f"{name}.b"))
    for c in by:
        same = same & (F.col(c) == F.col(f"_of{c}"))
    return rows.join(F.broadcast(small), same, "left").drop("_of", *[f"_of{c}" for c in by])


def _blocks(first: str, last: str) -> Column:
    """Aligned blocks (level, number) that make up the numbers from ``first`` up to, not including, ``last``."""
    level = (
        f"transform(sequence(0L, cast(length(bin({last})) as bigint)), k -> named_struct('k', k, "
        f"'l', shiftright({first} + shiftleft(1L, cast(k as int)) - 1, cast(k as int)), 'r', shiftright({last}, cast(k as int))))"
    )
    left = "if(x.l < x.r and x.l % 2 = 1, array(named_struct('k', x.k, 'n', x.l)), array())"
    right = "if(x.l < x.r and x.r % 2 = 1, array(named_struct('k', x.k, 'n', x.r - 1)), array())"
    return F.expr(f"flatten(transform({level}, x -> concat({left}, {right})))")


def pieces(windows: DataFrame, by: list[str]) -> DataFrame:
    """by, _a, _b, _w of the elementary intervals of any number of intervals (by, _w), one row for each piece covered."""
    edges = windows.select(*by, F.explode(F.array("_w.a", "_w.b")).alias("_t")).distinct()
    bounds = frozen(running(edges, by, ["_t"], sums={"_n": F.lit(1).cast("long")}, next_after={"_next": F.col("_t")}))

    def number(df: DataFrame, at: str, out: str) -> DataFrame:
        return join_null_safe(df.withColumn("_t", F.col(f"_w.{at}")), bounds.select(*by, "_t", F.col("_n").alias(out)), [*by, "_t"]).drop("_t")

    laid = number(number(windows, "a", "_first"), "b", "_last").select(*by, "_w", F.explode(_blocks("_first", "_last")).alias("_block"))
    first = frozen(laid.groupBy(*by, "_block").agg(F.min("_w").alias("_w")))
    top = first.agg(F.max("_block.k")).first()[0] or 0
    over = F.expr(f"transform(sequence(0L, {top}L), k -> named_struct('k', k, 'n', shiftright(_n, cast(k as int))))")
    cells = bounds.where("_next IS NOT NULL").select(*by, "_t", "_next", F.explode(over).alias("_block"))
    return join_null_safe(cells, first, [*by, "_block"]).groupBy(*by, F.col("_t").alias("_a"), F.col("_next").alias("_b")).agg(F.min("_w").alias("_w"))


def _tag_in_order(rows: DataFrame, windows: DataFrame, by: list[str], name: str, schema: T.StructType) -> DataFrame:
    """As ``_tag_by_slot``, for any number of windows."""
    starts = frozen(pieces(windows, by)).select(*by, F.col("_a").alias("_t"), F.lit(0).alias("_k"), F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_w").alias("w")).alias(name))
    both = rows.withColumns({"_k": F.lit(1), "_id": F.monotonically_increasing_id()}).unionByName(starts, allowMissingColumns=True)
    carried = running(both, by, ["_t", "_k", "_id"], last={"_seen": F.col(name)}).where("_k = 1")
    return carried.withColumn(name, F.when(F.col("_seen.b") > F.col("_t"), F.col("_seen"))).drop("_k", "_id", "_seen")
