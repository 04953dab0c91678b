"""Approximate nearest neighbours: random-projection trees under one priority queue.

The trees are fitted on a bounded sample: each node splits its sample vectors at the median of their projections on
the difference of two of them. Every row is filed in one leaf of each tree. A query walks all trees through one
priority queue ordered by how far it is from being cut off, until the leaves it has popped hold enough sample vectors.
Leaves meet their queries in a shuffle; there every filed vector is compared exactly.

Largest inner product becomes smallest angle by one more component: sqrt(M^2 - |x|^2) for rows, 0 for queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opslens.llm.vectors import lengths_agree, matrix, representatives, rows_of, usable
from opslens.session import frozen

TREES, SAMPLE, LEAF = 6, 20_000, 100
#: Share of the sample that a query's leaves of all trees together must hold, tried in order until the recall is met.
SHARES = (0.02, 0.06, 0.15, 0.35, 0.7, 1.4, 3.0, float(TREES))
AUDIT, RECALL = 200, 0.95


@dataclass(frozen=True)
class Tree:
    """Nodes by number: the normal and offset of a split and its two children; a leaf has a negative child ~leaf."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    leaf_sizes: np.ndarray

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(x), np.int64)
        if not len(self.normals):
            return at
        live = np.arange(len(x))
        while len(live):
            node = at[live]
            side = (np.einsum("ij,ij->i", x[live], self.normals[node]) > self.offsets[node]).astype(int)
            at[live] = self.children[node, side]
            live = live[at[live] >= 0]
        return ~at


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """A tree over the sample; vectors that no split tells apart stay together."""
    normals, offsets, children, sizes = [], [], [], []

    def build(rows: np.ndarray) -> int:
        if len(rows) > leaf:
            for _ in range(4):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                normal = a - b
                p = sample[rows] @ normal
                cut = np.median(p)
                right = p > cut
                if 0 < right.sum() < len(rows):
                    at = len(normals)
                    normals.append(normal / np.linalg.norm(normal))
                    offsets.append(cut / np.linalg.norm(normal))
                    children.append([0, 0])
                    children[at] = [build(rows[~right]), build(rows[right])]
                    return at
        sizes.append(len(rows))
        return ~(len(sizes) - 1)

    top = build(np.arange(len(sample)))
    if top < 0:
        return Tree(np.empty((0, sample.shape[1])), np.empty(0), np.empty((0, 2), int), np.array(sizes))
    return Tree(np.array(normals), np.array(offsets), np.array(children), np.array(sizes))


def search(trees: list[Tree], query: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one priority queue over all trees, until the leaves hold ``enough`` sample vectors."""
    margins = [t.normals @ query - t.offsets if len(t.normals) else None for t in trees]
    queue = [(-np.inf, i, 0 if m is not None else -1) for i, m in enumerate(margins)]
    heapq.heapify(queue)
    found, held = [], 0
    while queue and held < enough:
        cost, i, node = heapq.heappop(queue)
        tree = trees[i]
        while node >= 0:
            m = margins[i][node]
            near = int(m > 0)
            heapq.heappush(queue, (max(cost, abs(m)), i, int(tree.children[node, 1 - near])))
            node = int(tree.children[node, near])
        found.append((i, ~node))
        held += tree.leaf_sizes[~node]
    return found


def lift(x: np.ndarray, norm: float) -> np.ndarray:
    """Rows with the component that makes the largest inner product the smallest angle."""
    return np.column_stack([x, np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", x, x), 0))]) / (norm or 1)


def sample_share(trees: list[Tree], sample: np.ndarray, plain: np.ndarray, k: int, recall: float) -> int:
    """Number of the first entry of ``SHARES`` that finds enough of the sample's own neighbours in the sample."""
    asked = plain[:: max(1, len(plain) // 100)]
    score = asked @ plain.T
    best = np.argpartition(-score, min(k, score.shape[1] - 1), axis=1)[:, :k]
    leaves = [t.route(sample) for t in trees]
    for number, share in enumerate(SHARES):
        hit = 0
        for q, want in zip(asked, best):
            q = np.append(q, 0) / (np.linalg.norm(q) or 1)
            inside = [np.zeros(len(t.leaf_sizes), bool) for t in trees]
            for i, leaf in search(trees, q, share * len(sample)):
                inside[i][leaf] = True
            hit += sum(any(inside[i][leaves[i][w]] for i in range(len(trees))) for w in want)
        if hit >= recall * best.size:
            return number
    return len(SHARES) - 1


def _file(trees, norm):
    """Rows under their leaf of each tree."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = lift(matrix(part.column("v")), norm)
                for i, t in enumerate(trees.value):
                    yield pa.record_batch({
                        "leaf": pa.array(i * np.int64(2**40) + t.route(x)), "kind": pa.array(np.zeros(len(x), np.int32)),
                        "id": part.column("vec_id"), "v": part.column("v")})

    return file


def _probe(trees, enough):
    """Queries under each leaf they visit."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                x = matrix(part.column("v"))
                ids = np.asarray(part.column("vec_id"))
                row, leaf = [], []
                for n, q in enumerate(x):
                    for i, at in search(trees.value, np.append(q, 0) / np.linalg.norm(q), enough):
                        row.append(n)
                        leaf.append(i * 2**40 + at)
                row = np.array(row, np.int64)
                yield pa.record_batch({
                    "leaf": pa.array(leaf, pa.int64()), "kind": pa.array(np.ones(len(row), np.int32)), "id": pa.array(ids[row]),
                    "v": part.column("v").take(pa.array(row))})

    return probe


class _Best:
    """The best ``k`` (score, id) of each query so far; compares a block of rows with a block of queries at a time."""

    def __init__(self, k: int):
        self.k, self.q, self.i, self.s, self.rows = k, [], [], [], 0

    def add(self, queries: np.ndarray, qx: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        for lo in range(0, len(x), 8192):
            score = qx @ x[lo:lo + 8192].T
            k = min(self.k, score.shape[1])
            # Everything that ties with the k-th score stays; the ranking by id comes later.
            least = -np.partition(-score, k - 1, axis=1)[:, k - 1:k]
            a, b = np.nonzero(score >= least)
            self.q.append(queries[a])
            self.i.append(ids[lo + b])
            self.s.append(score[a, b])
            self.rows += len(a)
        if self.rows > 1 << 21:
            self.reduce()

    def reduce(self) -> None:
        if not self.q:
            return
        q, i, s = np.concatenate(self.q), np.concatenate(self.i), np.concatenate(self.s)
        order = np.lexsort([i, -s, q])
        q, i, s = q[order], i[order], s[order]
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (i[1:] != i[:-1])])
        q, i, s = q[new], i[new], s[new]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        keep = rank < self.k
        self.q, self.i, self.s = [q[keep]], [i[keep]], [s[keep]]
        self.rows = int(keep.sum())

    def take(self) -> pa.RecordBatch:
        self.reduce()
        if not self.q:
            return pa.record_batch({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        out = pa.record_batch({"query_id": pa.array(self.q[0]), "id": pa.array(self.i[0]), "score": pa.array(self.s[0])})
        self.q, self.i, self.s, self.rows = [], [], [], 0
        return out


def _rerank(k: int):
    """Rows sorted by leaf, filed vectors before queries: exact scores, the best of each query over the task's leaves."""

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, leaf, ids, x = _Best(k), None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            at, kind = np.asarray(batch.column("leaf")), np.asarray(batch.column("kind"))
            number, v = np.asarray(batch.column("id")), matrix(batch.column("v"))
            cut = np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(at)]):
                if at[lo] != leaf:
                    leaf, ids, x = at[lo], [], []
                if kind[lo] == 0:
                    ids.append(number[lo:hi])
                    x.append(v[lo:hi])
                elif ids:
                    ids, x = [np.concatenate(ids)], [np.concatenate(x)]
                    for b in range(lo, hi, 1024):
                        e = min(hi, b + 1024)
                        best.add(number[b:e], v[b:e], ids[0], x[0])
        yield best.take()

    return rerank


def _exact(k: int, asked):
    """The best of a bounded set of queries over the rows of a task, by brute force."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k)
        for batch in batches:
            if batch.num_rows:
                best.add(asked.value[0], asked.value[1], np.asarray(batch.column("vec_id")), matrix(batch.column("v")))
        yield best.take()

    return exact


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "id"))
    distinct = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return distinct.withColumn("rank", rank).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF,
            recall: float = RECALL, seed: int = 9) -> DataFrame:
    """The ``k`` rows of largest inner product for each query: query_id, rank, vec_id, score.

    ``rows`` and ``queries`` have vec_id and embedding; a row with the query's own vec_id is no candidate. Scores are inner
    products of the original vectors in double precision; ties go to the smaller vec_id. Vectors that are null, zero, or hold null
    or non-finite components take no part; vectors of different lengths are an error; an empty table gives no rows.
    Rows that repeat a vec_id and its vector count once.
    Bounds: the trees are fitted on at most about ``sample`` distinct vectors, those whose hashes are lowest; all rows are
    filed. Recall is measured on up to ``AUDIT`` queries against all rows by brute force; while it is below ``recall``,
    the search is repeated with leaves that hold more of the sample; the last step visits every leaf.
    """
    spark = rows.sparkSession
    held = rows.filter(F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("v")).distinct()
    asked = queries.filter(F.col("vec_id").isNotNull() & usable("embedding")).select("vec_id", F.col("embedding").cast("array<double>").alias("v")).distinct()
    # k others and the query itself may share one vector.
    reps = frozen(representatives(held, k + 1))
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths_agree(reps):
        return spark.createDataFrame([], schema)
    total, norm = reps.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()
    draw = F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = reps.filter(draw < sample / total).select("v").toArrow()
    plain = matrix(drawn.column("v"))
    if not len(plain):
        plain = matrix(reps.select("v").limit(1).toArrow().column("v"))
    plain = plain[np.lexsort(plain.T)]
    lifted = lift(plain, norm)
    rng = np.random.default_rng(seed)
    grown = [grow(lifted, leaf, rng) for _ in range(trees)]
    step = sample_share(grown, lifted, plain, k, recall)
    forest = spark.sparkContext.broadcast(grown)
    filed = frozen(reps.mapInArrow(_file(forest, norm), "leaf long, kind int, id long, v array<double>"))
    audit = asked.orderBy(F.xxhash64("vec_id")).limit(AUDIT).toArrow()
    truth = None
    if audit.num_rows:
        block = spark.sparkContext.broadcast((np.asarray(audit.column("vec_id")), matrix(audit.column("v"))))
        truth = frozen(_top(reps.mapInArrow(_exact(k + 1, block), "query_id long, id long, score double"), k + 1))
    while True:
        probes = asked.mapInArrow(_probe(forest, SHARES[step] * len(plain)), "leaf long, kind int, id long, v array<double>")
        met = filed.unionByName(probes).repartition("leaf").sortWithinPartitions("leaf", "kind")
        found = frozen(_top(met.mapInArrow(_rerank(k + 1), "query_id long, id long, score double"), k + 1))
        if truth is None or step == len(SHARES) - 1:
            break
        both = truth.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left").agg(F.count("hit"), F.count(F.lit(1))).first()
        if both[0] >= recall * both[1]:
            break
        step += 1
    members = found.join(reps.select(F.col("vec_id").alias("id"), "members"), "id").select(
        "query_id", F.explode("members").alias("vec_id"), "score").filter("vec_id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")).cast("int")
    return members.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
