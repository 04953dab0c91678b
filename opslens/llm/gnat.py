"""Vector code compression: product codes whose nearest codebook entries are found with a tree of split points.

Components become integers and vectors are cut into equal parts; each part position has a codebook of its own. The
entries of a codebook are kept in a geometric near-neighbour access tree: a node's split points are far from each other,
every other entry hangs below its nearest one, and for each split point and each child the node keeps the least and the
greatest distance between them. One distance from a query to a split point then rules out every child whose range lies
strictly beyond the best distance found so far. Ranges and bounds are widened by more than rounding can change, and only
squared distances in integers decide, ties to the lower index, so the codes are those of a full search.

Codebooks hold at most ``entries`` vectors of integers whatever the table holds; they are the only thing that goes to the
tasks and back to the driver. Sums for the next codebooks are added up in each task before they are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.functions.scalars import join_null_safe
from opslens.llm.vectors import lengths_agree, matrix, rows_of
from opslens.session import broadcast_if_small, frozen

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a tree node; a node with no more entries than this is a leaf.
SPLITS = 8
#: Integers beyond this could overflow exact squared distances.
LARGEST = 1 << 26
#: Components a task compares at a time.
SLICE = 1 << 18
#: Factors that widen a distance by more than its rounding errors (about 4e-16).
UP, DOWN = 1 + 1e-12, 1 - 1e-12


@dataclass(frozen=True)
class Node:
    """Split points (indexes into the codebook) with, for split i and child j, the range of distances from point i to
    the entries of child j, its split point included; children are nodes or None."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: tuple["Node | None", ...]


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def grow(entries: np.ndarray, members: np.ndarray | None = None, splits: int = SPLITS) -> Node:
    """The tree over the rows of ``entries`` (integers) that ``members`` names. Split points: the first member, then
    always the member farthest from those chosen."""
    members = np.arange(len(entries)) if members is None else members
    chosen, near = [0], _squares(entries[members], entries[members[0]])
    while len(chosen) < min(splits, len(members)):
        # A copy of a chosen point has distance 0 and is chosen only when nothing else is left.
        rest = near.copy()
        rest[chosen] = -1
        chosen.append(int(rest.argmax()))
        near = np.minimum(near, _squares(entries[members], entries[members[chosen[-1]]]))
    points = members[chosen]
    far = _squares(entries[members][:, None], entries[points][None])
    home = far.argmin(axis=1)
    home[chosen] = np.arange(len(chosen))
    distance = np.sqrt(far.astype(np.float64))
    low = np.array([[distance[home == j, i].min() for j in range(len(points))] for i in range(len(points))])
    high = np.array([[distance[home == j, i].max() for j in range(len(points))] for i in range(len(points))])
    below = [np.setdiff1d(members[home == j], points) for j in range(len(points))]
    return Node(points, low * DOWN, high * UP, tuple(grow(entries, m, splits) if len(m) else None for m in below))


class Search:
    """Nearest entry of each query row; ``compared`` counts the distances computed."""

    def __init__(self, entries: np.ndarray, tree: Node):
        self.entries, self.tree, self.compared = entries, tree, 0

    def __call__(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row, ties to the lower index."""
        n = len(queries)
        self.queries = queries
        self.best, self.at = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.entries))
        self._node(self.tree, np.arange(n))
        return self.at, self.best

    def _node(self, node: Node, rows: np.ndarray) -> None:
        alive = np.ones((len(rows), len(node.points)), bool)
        for i, point in enumerate(node.points):
            here = np.flatnonzero(alive[:, i])
            at = rows[here]
            square = _squares(self.queries[at], self.entries[point])
            self.compared += len(at)
            best, holder = self.best[at], self.at[at]
            wins = (square < best) | ((square == best) & (point < holder))
            self.best[at] = np.where(wins, square, best)
            self.at[at] = np.where(wins, point, holder)
            distance = np.sqrt(square.astype(np.float64))[:, None]
            radius = np.sqrt(self.best[at].astype(np.float64))[:, None] * UP
            # Strictly beyond the best distance: an entry that ties is never ruled out.
            out = (distance * UP + radius < node.low[i]) | (distance * DOWN > node.high[i] + radius)
            alive[here] &= ~out
            alive[here, i] &= node.children[i] is not None
        for j, child in enumerate(node.children):
            if child is not None:
                here = rows[alive[:, j]]
                if len(here):
                    self._node(child, here)


@dataclass(frozen=True)
class Codebooks:
    """entries: parts x entries x components of a part, integers; empty if there were no vectors."""

    entries: np.ndarray

    def searches(self) -> list[Search]:
        return [Search(e, grow(e)) for e in self.entries]

    def digest(self) -> str:
        """SHA-256 of all components as decimal integers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def quantised(rows: DataFrame, vec: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``rows`` with v, the components as integers floor(scale * x), in place of ``vec``.

    Rows whose vector is null or holds null, NaN or infinite components go. Vectors must have the same length, a multiple
    of ``parts``, and integers no larger than LARGEST; else an error is raised.
    """
    x = F.col(vec)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = rows.filter(x.isNotNull() & ~bad)
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    large = F.raise_error(F.lit(f"a component times {scale} is larger than {LARGEST}"))
    safe = F.when(F.exists(whole, lambda c: F.abs(c) > LARGEST), large.cast("array<int>")).otherwise(whole.cast("array<int>"))
    out = frozen(kept.withColumn("v", safe).drop(vec))
    n = lengths_agree(out)
    if n % parts:
        raise ValueError(f"vectors of {n} components cannot be cut into {parts} equal parts")
    return out


def _slices(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches of about SLICE components, with their vectors as rows x parts x components."""
    for batch in batches:
        width = max(1, len(batch.column("v")[0])) if batch.num_rows else 1
        step = max(1, SLICE // width)
        for lo in range(0, batch.num_rows, step):
            part = batch.slice(lo, step)
            yield part, matrix(part.column("v"), np.int64).reshape(part.num_rows, parts, -1)


def _sums(books: Codebooks) -> Callable:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, searches = books.entries.shape, books.searches()
        total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
        for _, x in _slices(batches, shape[0]):
            for p, search in enumerate(searches):
                at, _ = search(x[:, p])
                np.add.at(total[p], at, x[:, p])
                count[p] += np.bincount(at, minlength=shape[1])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.record_batch({
                "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(count[part, entry]),
                "total": rows_of(total[part, entry], pa.int64())})

    return add


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, vec_id: str = "vec_id") -> Codebooks:
    """Codebooks for rows (vec_id, v): at first the parts of the ``entries`` smallest vec_ids (null ids last, ties by
    vector), then ``rounds`` times the floored means of the parts nearest to each entry; unused entries stay."""
    first = rows.orderBy(F.col(vec_id).asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first or not first[0].v:
        return Codebooks(np.zeros((parts, len(first), 0), np.int64))
    start = np.array([r.v for r in first], np.int64)
    books = Codebooks(start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy())
    width = books.entries.shape[2]
    for _ in range(rounds):
        found = rows.select("v").mapInArrow(_sums(books), "part int, entry int, n long, total array<long>")
        sums = found.groupBy("part", "entry").agg(F.sum("n"), *[F.sum(F.col("total")[i]) for i in range(width)])
        new = books.entries.copy()
        # At most parts x entries rows.
        for part, entry, n, *total in sums.collect():
            new[part, entry] = np.array(total, np.int64) // n
        books = Codebooks(new)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (with v) with code (two hex digits a part) and error (the squared distances of its parts) in place of v."""
    kept = [c for c in rows.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches() if books.entries.size else []
        for batch, x in _slices(batches, len(books.entries)):
            codes, error = np.zeros(x.shape[:2], np.uint8), np.zeros(len(x), np.int64)
            for p, search in enumerate(searches):
                codes[:, p], d = search(x[:, p])
                error += d
            yield pa.record_batch({
                **{c: batch.column(c) for c in kept}, "code": pa.array([c.tobytes().hex() for c in codes], pa.string()), "error": pa.array(error)})

    schema = rows.select(*kept).schema.add("code", "string").add("error", "long")
    return rows.select(*kept, "v").mapInArrow(run, schema)


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Codes of all usable rows (vec_id, label, embedding): vec_id, label, code, error, label_error; and the codebooks.

    label_error is the error summed over all rows with the same label, rows without one together. Repeated rows count
    as often as they are there; without any usable vector there are no rows and the codebooks are empty.
    """
    whole = quantised(rows.select("vec_id", "label", "embedding"), parts=parts)
    books = train(whole, parts, entries, rounds)
    coded = frozen(encode(whole, books))
    # Labels can be as many as rows; a label that holds most rows is one row of the totals.
    totals = broadcast_if_small(frozen(coded.groupBy("label").agg(F.sum("error").alias("label_error"))))
    return join_null_safe(coded, totals, ["label"]).select("vec_id", "label", "code", "error", "label_error"), books
