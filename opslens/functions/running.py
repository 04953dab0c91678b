"""Running computations over one global or per-key order, without one task per key.

A plain window puts all rows of a key into one task. Here rows are range
partitioned by (key, order), so a hot key spans many slices of even size. The
slices are frozen in the shared folder. Each slice computes its local running
values, one small row per (slice, key) carries its totals, and the totals of the
other slices are added back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.functions.scalars import join_null_safe
from opslens.session import frozen


@dataclass(frozen=True)
class _Kind:
    """How one running value is computed in a slice, summed up per slice, carried, and combined."""

    forward: bool
    inclusive: bool
    fold: Callable[[Column], Column]
    total: Callable[[Column, Column], Column]
    combine: Callable[[Column, Column], Column]


def _latest(c: Column) -> Column:
    return F.last(c, ignorenulls=True)


def _only_known(c: Column, at: Column) -> Column:
    return F.when(c.isNotNull(), at)


_KINDS = {
    "sums": _Kind(True, True, F.sum, lambda c, at: F.sum(c), lambda w, c: w + F.coalesce(c, F.lit(0))),
    "max_before": _Kind(True, False, F.max, lambda c, at: F.max(c), lambda w, c: F.greatest(w, c)),
    "last": _Kind(True, True, _latest, lambda c, at: F.max_by(c, _only_known(c, at)), F.coalesce),
    "last_before": _Kind(True, False, _latest, lambda c, at: F.max_by(c, _only_known(c, at)), F.coalesce),
    "next": _Kind(False, True, _latest, lambda c, at: F.min_by(c, _only_known(c, at)), F.coalesce),
    "next_after": _Kind(False, False, _latest, lambda c, at: F.min_by(c, _only_known(c, at)), F.coalesce),
}


def sliced(df: DataFrame, part: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Frozen range partitions of ``df`` with their number in ``_slice``; ``order`` must be unique per key."""
    ranged = df.repartitionByRange(slices, *part, *order) if slices else df.repartitionByRange(*part, *order)
    return frozen(ranged.withColumn("_slice", F.spark_partition_id()))


def _across(base: DataFrame, part: Sequence[str]) -> DataFrame:
    """Keys that lie in more than one slice. Such a key is the last of one slice and the first of another, so there
    are fewer of them than slices."""
    this = F.struct(*part)
    edges = base.groupBy("_slice").agg(F.array_distinct(F.array(F.min(this), F.max(this))).alias("_edge"))
    return edges.select(F.explode("_edge").alias("_e")).groupBy("_e").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_e.*")


def running(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    keep_slices: bool = False,
    two_last: Mapping[str, tuple[Column, Column]] | None = None,
    two_next: Mapping[str, tuple[Column, Column]] | None = None,
    slices: int | None = None,
    **specs: Mapping[str, Column],
) -> DataFrame:
    """Add running columns, given as ``kind={name: column}``; ``df`` keeps its columns.

    sums: running sum up to this row. max_before: maximum over earlier rows.
    last / next: nearest non-null value at or before / at or after this row.
    last_before / next_after: the same without this row.
    two_last / two_next, given as ``{name: (value, key)}``: struct(a, b), the nearest non-null value at or before / after this
    row and the nearest one with another key than that.
    A ``df`` that still has ``_slice`` (``keep_slices``, with the same ``part``) is not sliced again.
    ``slices`` sets their number and that of the tasks; without it both follow the shuffled bytes, and tasks of narrow rows,
    which are much larger in memory, sort on disk.
    Totals are carried only for keys that lie across a slice edge, at most two for each slice.
    """
    part, order = list(part), list(order)
    unknown = set(specs) - set(_KINDS)
    if unknown:
        raise ValueError(f"unknown running kind: {', '.join(sorted(unknown))}")
    items = [(name, _KINDS[kind], col) for kind, cols in specs.items() for name, col in cols.items()]
    pairs = [(name, forward, v, k) for forward, given in ((True, two_last), (False, two_next)) for name, (v, k) in (given or {}).items()]
    base = df if "_slice" in df.columns else sliced(df, part, order, slices)
    base = base.withColumns({f"_i_{n}": c for n, _, c in items})
    base = base.withColumns({f"_i_{n}": F.when(v.isNotNull(), F.struct(v.alias("v"), k.alias("k"))) for n, _, v, k in pairs})
    key = ["_slice", *part]
    up, down = [F.col(c).asc() for c in order], [F.col(c).desc() for c in order]

    def frame(by, ordering, inclusive):
        return W.partitionBy(*by).orderBy(*ordering).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)

    dealt = base.repartition(slices, *key) if slices else base
    rows = dealt.withColumns({
        f"_w_{n}": k.fold(F.col(f"_i_{n}")).over(frame(key, up if k.forward else down, k.inclusive)) for n, k, _ in items
    })
    for n, forward, _, _ in pairs:
        way = up if forward else down
        rows = rows.withColumn(f"_p_{n}", _latest(F.col(f"_i_{n}")).over(frame(key, way, False)))
        other = F.when(F.col(f"_p_{n}.k") != F.col(f"_i_{n}.k"), F.col(f"_p_{n}"))
        rows = rows.withColumns({f"_a_{n}": _latest(F.col(f"_i_{n}")).over(frame(key, way, True)), f"_b_{n}": _latest(other).over(frame(key, way, True))})
    at = F.struct(*order)
    crossing = join_null_safe(base, F.broadcast(_across(base, part)), part, "left_semi") if part else base
    per_slice = crossing.groupBy(*key).agg(*[k.total(F.col(f"_i_{n}"), at).alias(f"_t_{n}") for n, k, _ in items], F.lit(1).alias("_one"))
    by = part or [F.lit(1)]
    slices_up, slices_down = [F.col("_slice").asc()], [F.col("_slice").desc()]
    carried = per_slice.select(*key, *[
        k.fold(F.col(f"_t_{n}")).over(frame(by, slices_up if k.forward else slices_down, False)).alias(f"_c_{n}") for n, k, _ in items
    ])
    for n, forward, _, _ in pairs:
        carried = join_null_safe(carried, _two_carried(crossing, per_slice.select(*key), n, forward, part, at), key, "left")
    joined = join_null_safe(rows, F.broadcast(carried), key, "left")
    kept = [c for c in df.columns if c != "_slice"] + (["_slice"] if keep_slices else [])
    return joined.select(*kept, *[k.combine(F.col(f"_w_{n}"), F.col(f"_c_{n}")).alias(n) for n, k, _ in items], *[_two(n).alias(n) for n, *_ in pairs])


def _two(n: str) -> Column:
    """The slice's own two values, completed by the two carried into it."""
    a, b, ca, cb = (F.col(f"_{x}_{n}") for x in ("a", "b", "ca", "cb"))
    # Without a second value the slice's own ones all have the key of the first.
    second = F.when(a.isNull(), cb).when(b.isNotNull(), b).when(ca["k"] != a["k"], ca).otherwise(cb)
    return F.struct(F.coalesce(a, ca)["v"].alias("a"), second["v"].alias("b"))


def _two_carried(base: DataFrame, slices: DataFrame, n: str, forward: bool, part: list[str], at: Column) -> DataFrame:
    """(slice, part) with the two values that the slices before hand on: the nearest, and the nearest of another key."""
    key, value, by = ["_slice", *part], F.col(f"_i_{n}"), part or [F.lit(1)]
    of_key = base.where(value.isNotNull()).groupBy(*key, value["k"].alias("_k")).agg(
        (F.max_by if forward else F.min_by)(value, at).alias("_v"), (F.max if forward else F.min)(at).alias("_at"))
    rank = F.row_number().over(W.partitionBy(*key).orderBy(F.col("_at").desc() if forward else F.col("_at").asc()))
    ends = of_key.withColumn("_nth", rank).where("_nth <= 2").groupBy(*key).agg(
        *[F.max_by("_v", F.when(F.col("_nth") == i, 1)).alias(f"_t{i}") for i in (1, 2)])
    # Also the slices without a value, which hand on what they got.
    ends = join_null_safe(slices, ends, key, "left")
    before = W.partitionBy(*by).orderBy(F.col("_slice").asc() if forward else F.col("_slice").desc()).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("_got", _latest(F.col("_t1")).over(before))
    left = F.coalesce(F.col("_t2"), F.when(F.col("_got.k") != F.col("_t1.k"), F.col("_got")))
    return ends.withColumn("_left", left).select(*key, F.col("_got").alias(f"_ca_{n}"), _latest(F.col("_left")).over(before).alias(f"_cb_{n}"))
