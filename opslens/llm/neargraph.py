"""Embedding near-duplicates by range search in a robust-pruned flat graph.

Vectors are dealt into overlapping shards, those of their nearest centres. In each shard every vector is given
neighbours by robust pruning: of its candidates, nearest first, one is kept unless a kept one is closer to it by a
factor. The adjacency lists of a vector from all its shards are united. Then each shard searches its part of the united graph: from
the medoid and the vector's own node a greedy search walks to the vector's surroundings, and as long as nodes in range
turn up, their neighbours are looked at too. What is found is verified with the original vectors in double precision.
A pair that meets in several shards counts in the first of them. Recall is audited by brute force on a bounded set of
vectors, each of which counts once; while too few have all their links, the search is repeated with more overlap. Links
may be too rare to be among those, so the overlap starts where probes made at just the limit share a shard with the
vectors they are made from. If recall stays too low (a dense group spread over many shards), all vectors are compared
with each other, slice by slice.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import components, forest
from opslens.llm.vectors import lengths_agree, matrix, representatives, rows_of, usable
from opslens.session import frozen

#: Vectors of a shard, about, whatever the overlap, and the largest number of centres (broadcast in single precision: at
#: most MAX_CENTRES vectors). Beyond MAX_CENTRES * SHARD / overlap vectors the shards grow.
SHARD, MAX_CENTRES = 1500, 32_768
#: Shards of each vector, tried in order.
OVERLAPS = (3, 6, 12)
#: Kept neighbours of a vector and shard, its nearest and its random candidates, and the pruning factor.
DEGREE, NEAREST, RANDOM, ALPHA = 16, 48, 8, 1.2
#: Nodes of the greedy search's list, and by how much nodes may miss the range and still be walked over.
WIDTH, SLACK = 12, 0.08
AUDIT, RECALL = 256, 0.99
#: Probes for each audited vector: vectors made at just the limit from it, which must share a shard with it.
PROBES = 16
#: Rows searched together, and pairs whose vectors are held at a time.
_BLOCK, _PAIRS = 256, 50_000
#: What building, uniting and searching cost for a pair of a shard, against a pair of the full comparison, about.
WORK = 8
#: Bytes of vectors that are compared with all others at a time, and the rows of both sides of one product.
SLICE_BYTES, _LEFT, _RIGHT = 32 << 20, 512, 4096


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def prune(u: np.ndarray, seed: int) -> np.ndarray:
    """Robust-pruned neighbours of each of the unit vectors, as a matrix of row numbers filled up with -1."""
    n = len(u)
    near, extra = min(NEAREST, n - 1), min(RANDOM, n - 1)
    out = np.full((n, min(DEGREE, max(n - 1, 0))), -1, np.int64)
    if n < 2:
        return out
    rng = np.random.default_rng(seed)
    for lo in range(0, n, _BLOCK):
        x = u[lo:lo + _BLOCK]
        sim = x @ u.T
        own = np.arange(len(x))
        sim[own, lo + own] = -np.inf
        pool = np.argpartition(-sim, near - 1, axis=1)[:, :near]
        pool = np.concatenate([pool, rng.integers(0, n, (len(x), extra))], axis=1)
        pool.sort(axis=1)
        again = np.concatenate([np.zeros((len(x), 1), bool), pool[:, 1:] == pool[:, :-1]], axis=1)
        score = np.where(again, -np.inf, np.take_along_axis(sim, pool, 1))
        order = np.argsort(-score, axis=1, kind="stable")
        pool, score = np.take_along_axis(pool, order, 1), np.take_along_axis(score, order, 1)
        alive = np.isfinite(score)
        far = 1 - score
        vectors = u[pool]
        for k in range(out.shape[1]):
            has = alive.any(1)
            if not has.any():
                break
            first = alive.argmax(1)
            out[lo + own[has], k] = pool[own, first][has]
            between = 1 - np.einsum("bpd,bd->bp", vectors, vectors[own, first])
            alive &= ALPHA * between > far
            alive[own, first] = False
    return out


def _dots(u: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of the rows x with the rows y, some at a time: every row of a block may look at the same hub's neighbours."""
    out = np.empty(len(x))
    for lo in range(0, len(x), _PAIRS):
        at = slice(lo, lo + _PAIRS)
        out[at] = np.einsum("ij,ij->i", u[x[at]], u[y[at]])
    return out


class Graph:
    """Adjacency lists end to end; a hub with very many neighbours makes no other list longer."""

    def __init__(self, n: int, of: np.ndarray, to: np.ndarray):
        self.count = np.bincount(of, minlength=n)
        self.start = np.concatenate([[0], np.cumsum(self.count)])
        self.to = to

    def rows(self, nodes: np.ndarray) -> np.ndarray:
        """The lists of some nodes as a matrix filled up with -1."""
        place = np.arange(max(int(self.count[nodes].max(initial=0)), 1))
        at = np.minimum(self.start[nodes][:, None] + place, max(len(self.to) - 1, 0))
        has = place < self.count[nodes][:, None]
        return np.where(has, self.to[at], -1) if len(self.to) else np.full(has.shape, -1)

    def each(self, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in ``nodes``, neighbour) of all of them, about a million at a time."""
        done = np.cumsum(self.count[nodes])
        lo = 0
        while lo < len(nodes):
            base = done[lo] - self.count[nodes[lo]]
            hi = max(lo + 1, int(np.searchsorted(done, base + (1 << 20), side="right")))
            n = self.count[nodes[lo:hi]]
            shift = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(np.arange(lo, hi), n), self.to[np.repeat(self.start[nodes[lo:hi]], n) + shift]
            lo = hi


def search(u: np.ndarray, graph: Graph, limit: float) -> np.ndarray:
    """For each row the rows found within ``limit``, one bit each: greedy from medoid and own node, then on while in range.

    A dense group of n rows takes n * n / 8 bytes; its pairs are listed for a block of rows at a time.
    """
    n = len(u)
    medoid = int((u @ u.mean(0)).argmax())
    found = np.zeros((n, -(-n // 8)), np.uint8)
    for lo in range(0, n, _BLOCK):
        q = np.arange(lo, min(n, lo + _BLOCK))
        m = len(q)
        seen = np.zeros((m, n), bool)
        own = np.arange(m)
        beam = np.stack([q, np.full(m, medoid)], axis=1)
        score = np.stack([np.ones(m), u[q] @ u[medoid]], axis=1)
        score[q == medoid, 1] = -np.inf
        seen[own, q] = seen[own, medoid] = True
        done = np.zeros(beam.shape, bool)
        pairs_q, pairs_v, pairs_s = [], [], []
        for _ in range(3 * WIDTH):
            open_score = np.where(done | ~np.isfinite(score), -np.inf, score)
            at = open_score.argmax(1)
            busy = np.isfinite(open_score[own, at])
            if not busy.any():
                break
            done[own, at] = True
            step = np.where(busy[:, None], graph.rows(beam[own, at]), -1)
            fresh = (step >= 0) & ~seen[own[:, None], step]
            a, b = np.nonzero(fresh)
            node = step[a, b]
            seen[a, node] = True
            sim = np.full(step.shape, -np.inf)
            sim[a, b] = _dots(u, q[a], node)
            hit = sim[a, b] >= limit - SLACK
            pairs_q.append(a[hit])
            pairs_v.append(node[hit])
            pairs_s.append(sim[a, b][hit])
            beam, score = np.concatenate([beam, step], 1), np.concatenate([score, sim], 1)
            done = np.concatenate([done, np.zeros(step.shape, bool)], 1)
            keep = np.argsort(-score, axis=1, kind="stable")[:, :WIDTH]
            beam, score, done = (np.take_along_axis(x, keep, 1) for x in (beam, score, done))
        a = np.concatenate(pairs_q) if pairs_q else np.empty(0, int)
        v = np.concatenate(pairs_v) if pairs_v else np.empty(0, int)
        s = np.concatenate(pairs_s) if pairs_s else np.empty(0)
        # In range (or nearly): look at their neighbours as long as new ones turn up.
        hits = np.zeros((m, n), bool)
        while len(a):
            good = s >= limit
            hits[a[good], v[good]] = True
            next_a, next_v, next_s = [], [], []
            for of, to in graph.each(v):
                x = a[of]
                new = ~seen[x, to]
                flat = np.unique(x[new] * n + to[new])
                x, y = flat // n, flat % n
                seen[x, y] = True
                sim = _dots(u, q[x], y)
                hit = sim >= limit - SLACK
                next_a.append(x[hit])
                next_v.append(y[hit])
                next_s.append(sim[hit])
            a, v, s = np.concatenate(next_a), np.concatenate(next_v), np.concatenate(next_s)
        found[q] = np.packbits(hits, axis=1)
    return found


def _either(found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs (row, other row) that one of the two has found, both ways, for a block of rows at a time."""
    n = len(found)
    for lo in range(0, n, _BLOCK):
        hi = min(n, lo + _BLOCK)
        mine = np.unpackbits(found[lo:hi], axis=1, count=n).view(bool)
        theirs = np.unpackbits(found[:, lo // 8:-(-hi // 8)], axis=1, count=hi - lo).view(bool).T
        a, b = np.nonzero(mine | theirs)
        yield a + lo, b


def meeting(u: np.ndarray, centres: np.ndarray, limit: float, overlap: int) -> float:
    """Share of the probes, made at cosine ``limit`` from the unit vectors in random directions, that share a shard with
    the vector they are made from if each has the shards of its ``overlap`` nearest centres."""
    if overlap >= len(centres):
        return 1.0
    rng = np.random.default_rng(11)
    met = 0
    own = np.argpartition(-(u @ centres.T), overlap - 1, axis=1)[:, :overlap]
    for _ in range(PROBES):
        side = rng.normal(size=u.shape)
        side -= np.einsum("ij,ij->i", side, u)[:, None] * u
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
        probes = limit * u + np.sqrt(max(1 - limit * limit, 0)) * side
        theirs = np.argpartition(-(probes @ centres.T), overlap - 1, axis=1)[:, :overlap]
        met += int((own[:, :, None] == theirs[:, None, :]).any((1, 2)).sum())
    return met / (PROBES * len(u))


def centres_for(overlap: int, total: int, shard: int) -> int:
    """How many centres give shards of about ``shard`` rows when each vector lies in ``overlap`` of them."""
    return 1 if total <= shard else min(MAX_CENTRES, -(-overlap * total // shard))


def _steps(overlaps, total: int, shard: int) -> list[int]:
    """The overlaps to try: the given ones, then doubled as long as the shards cost less than comparing all vectors does."""
    steps = list(overlaps)

    def cost(k: int) -> float:
        return WORK * k * max(shard, k * total / centres_for(k, total, shard))

    while steps[-1] < centres_for(steps[-1], total, shard) and cost(2 * steps[-1]) < total:
        steps.append(2 * steps[-1])
    return steps


def _assign(centres, overlap: int):
    """Rows once for each of the shards of their nearest centres, which they all name, in order."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        k = min(overlap, len(c))
        step = max(1, min(2048, (1 << 23) // len(c)))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                sim = _unit(matrix(part.column("v"))).astype(c.dtype) @ c.T
                shards = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1)
                row = pa.array(np.repeat(np.arange(len(sim)), k))
                yield pa.record_batch({
                    "shard": pa.array(shards.ravel().astype(np.int64)),
                    "shards": rows_of(np.repeat(shards, k, axis=0).astype(np.int32), pa.int32()),
                    **{n: part.column(n).take(row) for n in ("vec_id", "copies", "v")}})

    return assign


def _build(rows: pa.Table) -> pa.Table:
    ids = np.asarray(rows.column("vec_id"))
    order = np.argsort(ids)
    ids = ids[order]
    graph = prune(_unit(matrix(rows.column("v")))[order], int(rows.column("shard")[0].as_py()))
    keep = graph >= 0
    start = np.concatenate([[0], np.cumsum(keep.sum(1))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(start), pa.array(ids[graph[keep]]))
    return pa.table({"vec_id": pa.array(ids), "near": lists})


def _walk(limit: float):
    """Of a shard: for each vector the copies of the vectors it links to, and edges that join what is linked."""

    def walk(rows: pa.Table) -> pa.Table:
        ids = np.asarray(rows.column("vec_id"))
        order = np.argsort(ids)
        rows = rows.take(pa.array(order))
        ids, copies = ids[order], np.asarray(rows.column("copies"))
        v, shards = matrix(rows.column("v")), matrix(rows.column("shards"), np.int64)
        near = rows.column("near").combine_chunks()
        of = np.repeat(np.arange(len(ids)), np.diff(np.asarray(near.offsets)))
        to = np.asarray(near.flatten())
        at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
        inside = ids[at] == to
        # Both ways: an edge kept at one end can be walked from the other.
        of, at = np.concatenate([of[inside], at[inside]]), np.concatenate([at[inside], of[inside]])
        pairs = np.unique(of * len(ids) + at)
        of, at = pairs // len(ids), pairs % len(ids)
        norms = np.sqrt(np.einsum("ij,ij->i", v, v))
        links = np.zeros(len(ids), np.int64)
        here = rows.column("shard")[0].as_py()
        fa = fb = np.empty(0, np.int64)
        for a, b in _either(search(_unit(v), Graph(len(ids), of, at), limit - 1e-6)):
            for lo in range(0, len(a), _PAIRS):
                x, y = a[lo:lo + _PAIRS], b[lo:lo + _PAIRS]
                ok = (x != y) & (np.einsum("ij,ij->i", v[x], v[y]) / (norms[x] * norms[y]) >= limit)
                x, y = x[ok], y[ok]
                if not len(x):
                    continue
                common = (shards[x][:, :, None] == shards[y][:, None, :]).any(2)
                first = np.where(common, shards[x], np.iinfo(np.int64).max).min(1)
                mine = first == here
                links += np.bincount(x[mine], weights=copies[y[mine]], minlength=len(ids)).astype(np.int64)
                fa, fb = forest(np.concatenate([fa, ids[x]]), np.concatenate([fb, ids[y]]))
        some = links > 0
        none = pa.nulls(len(fa), pa.int64())
        return pa.table({
            "vec_id": pa.chunked_array([pa.array(ids[some]), none]), "links": pa.chunked_array([pa.array(links[some]), none]),
            "a": pa.chunked_array([pa.nulls(int(some.sum()), pa.int64()), pa.array(fa)]),
            "b": pa.chunked_array([pa.nulls(int(some.sum()), pa.int64()), pa.array(fb)])})

    return walk


def _exact(asked, limit: float):
    """For a bounded set of vectors, the copies of the others in range among the rows of a task."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = asked.value
        n = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"))
                own, theirs = np.linalg.norm(x, axis=1), np.linalg.norm(v, axis=1)
                sim = x @ v.T / (own[:, None] * theirs)
                hit = sim >= limit
                i, j = np.nonzero(np.abs(sim - limit) < 1e-12)  # decided by the sum over one pair, as in the search
                hit[i, j] = np.einsum("ij,ij->i", x[i], v[j]) / (own[i] * theirs[j]) >= limit
                hit &= ids[:, None] != np.asarray(batch.column("vec_id"))[None, :]
                n += hit @ np.asarray(batch.column("copies"))
        yield pa.record_batch({"vec_id": pa.array(ids), "true": pa.array(n)})

    return exact


def _joined(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each column of a matrix of links, the smallest column it reaches; the number of columns if none."""
    none = hit.shape[1]
    columns = np.where(hit.any(0), np.arange(none), none)
    while True:
        rows = np.where(hit, columns[None, :], none).min(1)
        low = np.minimum(columns, np.where(hit, rows[:, None], none).min(0))
        if np.array_equal(low, columns):
            return rows, columns
        columns = low


def _against(asked, limit: float):
    """For each vector of a slice the copies of those it links to among the rows of a task, and edges that join what is linked."""

    def against(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = asked.value
        norms, links = np.linalg.norm(x, axis=1), np.zeros(len(ids), np.int64)
        fa, fb, held = [], [], 0
        for batch in batches:
            others, copies = np.asarray(batch.column("vec_id")), np.asarray(batch.column("copies"))
            v = matrix(batch.column("v")) if batch.num_rows else np.empty((0, x.shape[1]))
            lengths = np.linalg.norm(v, axis=1)
            for lo in range(0, len(v), _LEFT):
                a = slice(lo, lo + _LEFT)
                for at in range(0, len(x), _RIGHT):
                    b = slice(at, at + _RIGHT)
                    sim = v[a] @ x[b].T / (lengths[a, None] * norms[None, b])
                    hit = sim >= limit
                    # A product may round otherwise than the sum over one pair does.
                    i, j = np.nonzero(np.abs(sim - limit) < 1e-12)
                    hit[i, j] = np.einsum("ij,ij->i", v[a][i], x[b][j]) / (lengths[a][i] * norms[b][j]) >= limit
                    hit &= others[a, None] != ids[None, b]
                    if not hit.any():
                        continue
                    links[b] += copies[a] @ hit
                    row, column = _joined(hit)
                    for own, top in ((others[a], row), (ids[b], column)):
                        some = top < hit.shape[1]
                        fa.append(own[some])
                        fb.append(ids[b][top[some]])
                        held += len(fa[-1])
                    if held > 1 << 20:
                        fa, fb = ([z] for z in forest(np.concatenate(fa), np.concatenate(fb)))
                        held = len(fa[0])
        some = links > 0
        fa, fb = forest(np.concatenate(fa), np.concatenate(fb)) if fa else (ids[:0], ids[:0])
        yield pa.record_batch({
            "vec_id": pa.concat_arrays([pa.array(ids[some]), pa.nulls(len(fa), pa.int64())]),
            "links": pa.concat_arrays([pa.array(links[some]), pa.nulls(len(fa), pa.int64())]),
            "a": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(fa)]),
            "b": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(fb)])})

    return against


def compare_all(reps: DataFrame, total: int, limit: float) -> DataFrame:
    """vec_id, links, a, b as the search in the shards finds them, from all ``total`` vectors compared with all."""
    slices = -(-total * lengths_agree(reps) * 8 // SLICE_BYTES)
    cut = frozen(reps.select("vec_id", "copies", "v", F.pmod(F.xxhash64("v", F.lit(3)), F.lit(slices)).alias("slice")))
    found = []
    for k in range(slices):
        part = cut.filter(F.col("slice") == k).select("vec_id", "v").toArrow()
        if part.num_rows:
            asked = reps.sparkSession.sparkContext.broadcast((np.asarray(part.column("vec_id")), matrix(part.column("v"))))
            found.append(frozen(cut.select("vec_id", "copies", "v").mapInArrow(_against(asked, limit), "vec_id long, links long, a long, b long")))
            asked.destroy()
    return reduce(DataFrame.unionByName, found)


def near_duplicates(rows: DataFrame, limit: float = 0.9, recall: float = RECALL, shard: int = SHARD, overlaps=OVERLAPS) -> DataFrame:
    """One row for each row of ``rows`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors of cosine >= ``limit`` are linked. n_links: other vectors linked directly; component_id: the smallest vec_id reachable,
    itself included; kept: it is its own. Vectors that are null, zero, or hold null or non-finite components link
    with nothing and are their own class; vectors of different lengths are an error; copies of a vector are linked
    to each other; rows with a null vec_id have a null component and are not kept; an empty table gives no rows.
    If fewer than ``recall`` of the audited vectors have all their links, or of the probes share a shard, after the last of
    ``overlaps`` and of those that cost less than every pair, there is a warning and every pair is compared: the result is exact then, at a cost that grows with the square of the number of distinct vectors.
    """
    spark = rows.sparkSession
    base = rows.select("vec_id", F.when(F.col("vec_id").isNotNull() & usable("embedding"), F.col("embedding").cast("array<double>")).alias("v"))
    held = base.filter("v is not null")
    reps = frozen(representatives(held))
    total = reps.count() if lengths_agree(reps) else 0
    alone = base.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not total:
        return alone.withColumn("kept", F.col("vec_id").isNotNull())
    steps = _steps(overlaps, total, shard)
    wanted = max(centres_for(k, total, shard) for k in steps)
    draw = F.pmod(F.xxhash64("v", F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A tenth more, since the draw's number varies; the centres of a smaller overlap are the first of those of a larger one.
    drawn = reps.withColumn("draw", draw).filter(F.col("draw") < (1.1 * wanted + 20) / total).select("draw", "vec_id", "v").toArrow()
    drawn = drawn.sort_by([("draw", "ascending"), ("vec_id", "ascending")])
    every = _unit(matrix(drawn.column("v"))) if drawn.num_rows else np.ones((1, lengths_agree(reps)))
    sample = reps.orderBy(F.xxhash64("vec_id")).limit(AUDIT).toArrow()
    asked = spark.sparkContext.broadcast((np.asarray(sample.column("vec_id")), matrix(sample.column("v"))))
    truth = frozen(reps.mapInArrow(_exact(asked, limit), "vec_id long, true long").groupBy("vec_id").agg(F.sum("true").alias("true")))
    found = None
    for overlap in steps:
        chosen = every[:centres_for(overlap, total, shard)]
        if meeting(_unit(asked.value[1]), chosen, limit, overlap) < recall:
            continue
        centres = spark.sparkContext.broadcast(chosen.astype(np.float32))
        placed = frozen(reps.select("vec_id", "copies", "v").mapInArrow(
            _assign(centres, overlap), "shard long, shards array<int>, vec_id long, copies long, v array<double>"))
        graph = placed.groupBy("shard").applyInArrow(_build, "vec_id long, near array<long>")
        united = graph.groupBy("vec_id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        found = frozen(placed.join(united, "vec_id").groupBy("shard").applyInArrow(_walk(limit), "vec_id long, links long, a long, b long"))
        links = found.filter("vec_id is not null").groupBy("vec_id").agg(F.sum("links").alias("links"))
        true, hit = truth.filter(F.col("true") > 0).join(links, "vec_id", "left").agg(
            F.count(F.lit(1)), F.count_if(F.coalesce("links", F.lit(0)) >= F.col("true"))).first()
        if hit >= recall * true or len(chosen) <= overlap:
            break
    if found is None or hit < recall * true:
        said = f"{hit} of {true} vectors had all their links with {overlap}" if found is not None else f"probes are lost with {max(overlaps)}"
        warnings.warn(f"audit: {said} shards for each vector; all are compared instead", stacklevel=2)
        found = compare_all(reps, total, limit)
        links = found.filter("vec_id is not null").groupBy("vec_id").agg(F.sum("links").alias("links"))
    joined = components(found.filter("a is not null").select("a", "b"))
    known = reps.join(links, "vec_id", "left").join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    linked = held.join(known, "v").select("vec_id", "n_links", "component_id")
    out = linked.unionByName(base.filter("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
