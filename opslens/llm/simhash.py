"""SimHash near-duplicates found through pivot distance tables.

Reference fingerprints (pivots): a base and, for each block of bits, the base with that block inverted; and a set of
random ones. The table holds each fingerprint's Hamming distance to every pivot. Two fingerprints that differ in at
most 2 bits have distances to any pivot that differ by at most 2.

Where a candidate can be: the distances to the base and to a block's pivot give the distance to the base inside the
block, and 2 differing bits change that in 2 blocks at most. With the blocks in 6 groups, at least 4 groups show equal
distances, so every pair meets in a cell of one of the 15 choices of 4 groups. In a cell, pairs whose largest
difference over all coordinates is above the limit are discarded; the Hamming distance of the rest is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import components, forest, row_key
from opslens.session import frozen

BITS, SEED, SHINGLE, LIMIT = 64, 42, 3, 2
#: Shingles hashed at a time, so that a long text needs no more memory.
SLICE = 200_000
#: Blocks of bits with a pivot each; groups of blocks; groups that must agree.
BLOCKS, GROUPS, AGREE = 32, 6, 4
RANDOM_PIVOTS = 31
#: Members of a cell that one task compares; larger cells are cut into parts and the parts compared two by two.
CELL_ROWS = 4096

_base = np.uint64(0x5851F42D4C957F2D)
_block_masks = np.array([((1 << (BITS // BLOCKS)) - 1) << (i * BITS // BLOCKS) for i in range(BLOCKS)], np.uint64)
_random = np.random.default_rng(8).integers(0, 2**64, RANDOM_PIVOTS, np.uint64, endpoint=False)
#: The reference fingerprints.
PIVOTS = np.concatenate([[_base], _base ^ _block_masks, _random]).astype(np.uint64)
CHOICES = list(combinations(range(GROUPS), AGREE))


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of a text given as UTF-8: A-Z lower-cased, words, shingles of three with repeats."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    k = min(SHINGLE, len(words))
    start, end = start[: len(words) - k + 1].tolist(), end[k - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, len(start), SLICE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(start[lo:lo + SLICE], end[lo:lo + SLICE])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = ones * 2 > len(start)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """_d, _k (row key), doc_id and fp (the fingerprint as a signed long) of each row, written once."""

    @F.pandas_udf("long")
    def all_of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return frozen(docs.select("doc_id", *row_key(), all_of(F.col("text").cast("binary")).alias("fp")))


def table(fps: np.ndarray) -> np.ndarray:
    """Pivot distance table: Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :])


def cell_keys(distances: np.ndarray) -> np.ndarray:
    """For each row of a table, its cell in each choice of groups, as a 64-bit hash of the agreeing coordinates."""
    width = BITS // BLOCKS
    inside = (distances[:, :1].astype(np.int64) - distances[:, 1:BLOCKS + 1] + width) // 2
    groups = np.array_split(np.arange(BLOCKS), GROUPS)
    coded = np.stack([inside[:, g] @ (np.int64(width + 1) ** np.arange(len(g))) for g in groups], axis=1).astype(np.uint64)
    keys = []
    for number, choice in enumerate(CHOICES):
        h = np.full(len(distances), number + 1, np.uint64)
        for g in choice:
            h = (h ^ coded[:, g]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        keys.append(h)
    return np.stack(keys, axis=1)


def near(x: np.ndarray, y: np.ndarray, tx: np.ndarray, ty: np.ndarray) -> np.ndarray:
    """Which pairs x[i], y[i] survive the largest coordinate difference and then the Hamming distance."""
    differ = np.abs(tx.astype(np.int8) - ty.astype(np.int8)).max(1) <= LIMIT
    ok = np.flatnonzero(differ)
    return ok[np.bitwise_count(x[ok] ^ y[ok]) <= LIMIT]


def _to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 20_000):
            fps = np.asarray(batch.column("fp")[lo:lo + 20_000]).view(np.uint64)
            keys = cell_keys(table(fps))
            yield pa.record_batch({
                "cell": pa.array(keys.ravel().view(np.int64)), "fp": pa.array(np.repeat(fps, keys.shape[1]).view(np.int64))})


def _links(x: np.ndarray, cells: np.ndarray, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal cells, as few as join the same fingerprints. left: if given, a pair counts only
    where one of its two is left and the other is not."""
    end = np.flatnonzero(np.r_[cells[1:] != cells[:-1], True])
    stop = end[np.searchsorted(end, np.arange(len(x)))] + 1
    alive = np.flatnonzero(stop - np.arange(len(x)) > 1)
    t = table(x) if len(alive) else None
    out_a, out_b, held, step = [], [], 0, 1

    def pack():
        nonlocal out_a, out_b, held
        if out_a:
            a, b = forest(np.concatenate(out_a), np.concatenate(out_b))
            out_a, out_b, held = [a], [b], len(a)

    while len(alive):
        for lo in range(0, len(alive), 1 << 17):
            i = alive[lo:lo + (1 << 17)]
            if left is not None:
                i = i[left[i] != left[i + step]]
            # The first coordinates alone discard most pairs; the whole table is compared for what is left.
            i = i[np.abs(t[i, :4].astype(np.int8) - t[i + step, :4].astype(np.int8)).max(1) <= LIMIT] if len(i) else i
            ok = i[near(x[i], x[i + step], t[i], t[i + step])] if len(i) else i
            if len(ok):
                out_a.append(x[ok].view(np.int64))
                out_b.append(x[ok + step].view(np.int64))
                held += len(ok)
        if held > 1 << 20:
            pack()
        step += 1
        alive = alive[stop[alive] - alive > step]
    pack()
    return (out_a[0], out_b[0]) if out_a else (np.empty(0, np.int64), np.empty(0, np.int64))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows sorted by cell; holds a bounded number of rows and never splits a cell between two looks."""
    rest_c, rest_x = np.empty(0, np.int64), np.empty(0, np.uint64)

    def emit(c, x):
        a, b = _links(x, c)
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    for batch in batches:
        c = np.concatenate([rest_c, np.asarray(batch.column("cell"))])
        x = np.concatenate([rest_x, np.asarray(batch.column("fp")).view(np.uint64)])
        if not len(c):
            continue
        cut = int(np.searchsorted(c == c[-1], True)) if c[0] != c[-1] else 0
        if len(c) > 1 << 18 and cut:
            yield emit(c[:cut], x[:cut])
            c, x = c[cut:], x[cut:]
        rest_c, rest_x = c, x
    if len(rest_c):
        yield emit(rest_c, rest_x)


def _search_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Like ``_search`` for rows of one (cell, part, part) after the other; a pair counts across the two parts, or
    inside if both are the same."""
    held: dict[str, list[np.ndarray]] = {}
    key = None

    def emit():
        x = np.concatenate(held["fp"]).view(np.uint64)
        part = np.concatenate(held["part"])
        left = part == part.min() if key[1] != key[2] else None
        a, b = _links(x, np.zeros(len(x), np.int64), left)
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b)})

    for batch in batches:
        cols = {n: np.asarray(batch.column(n)) for n in ("cell", "p", "q", "part", "fp")}
        change = np.flatnonzero((np.diff(cols["cell"]) != 0) | (np.diff(cols["p"]) != 0) | (np.diff(cols["q"]) != 0)) + 1
        for lo, hi in zip(np.r_[0, change], np.r_[change, batch.num_rows]):
            if lo == hi:
                continue
            this = tuple(cols[n][lo] for n in ("cell", "p", "q"))
            if key is not None and this != key:
                yield emit()
                held = {}
            key = this
            for n in ("fp", "part"):
                held.setdefault(n, []).append(cols[n][lo:hi])
    if key is not None:
        yield emit()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints fp of Hamming distance up to 2, as few as join the same groups.

    All pairs of a cell are looked at, but each task gives back a spanning forest of what it finds.
    """
    cells = frozen(fps.mapInArrow(_to_cells, "cell long, fp long"))
    full = frozen(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL_ROWS))
    usual = cells
    found = []
    if not full.isEmpty():
        usual = cells.join(full, "cell", "left_anti")
        parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        cut = cells.join(full, "cell").withColumn("parts", parts).withColumn("part", part)
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        cut = cut.withColumn("other", other).select(
            "cell", "part", "fp", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"))
        cut = cut.repartition("cell", "p", "q").sortWithinPartitions("cell", "p", "q")
        found.append(cut.mapInArrow(_search_parts, "a long, b long"))
    found.append(usual.repartition("cell").sortWithinPartitions("cell").mapInArrow(_search, "a long, b long"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def groups(prints: DataFrame) -> DataFrame:
    """(fp, group): of each fingerprint, the smallest fingerprint it reaches over links; alone in its group, itself."""
    distinct = frozen(prints.select("fp").distinct())
    joined = components(links(distinct))
    return distinct.join(joined, distinct.fp == joined.node, "left").select("fp", F.coalesce("component", "fp").alias("group"))


def classes(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, _d, _k, fp, component_id.

    component_id is the smallest doc_id (nulls left out) of the documents reachable over links; null if there is none.
    Null text, empty text and text without words have the fingerprint zero and link like any other; fewer than three
    words are one shingle; repeated rows are linked to each other; an empty table gives no rows. Other columns are not
    looked at.
    """
    prints = fingerprints(docs)
    per = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    known = groups(prints).join(per, "fp")
    lows = known.groupBy("group").agg(F.min("low").alias("component_id"))
    known = known.join(lows, "group").select("fp", "component_id")
    return prints.join(known, "fp").select("doc_id", "_d", "_k", "fp", "component_id")


def hex_digits(fp: str = "fp"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def decisions(docs: DataFrame) -> DataFrame:
    """_d, _k, rows, copies for ``common.with_copies``: one document of each group stays, the one with the smallest doc_id.

    Nulls come last, ties go to the smaller text hash; of rows that repeat both doc_id and text one stays.
    """
    prints = fingerprints(docs)
    rows = prints.groupBy("fp", "_d", "_k").agg(F.count(F.lit(1)).alias("rows"), F.first("doc_id").isNull().alias("none"))
    low = F.min(F.struct("none", "_d", "_k", "rows")).alias("low")
    best = groups(prints).join(rows.groupBy("fp").agg(low), "fp").groupBy("group").agg(F.min("low").alias("low"))
    return best.select("low._d", "low._k", "low.rows", F.lit(1).alias("copies"))
