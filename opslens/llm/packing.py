"""Best-fit packing of token sequences by hierarchical residual packing.

Documents are encoded once and cut into pieces; the pieces, with their ids, are written to the shared folder. Then
only (number, length) is packed. Round one: each task packs its items best-fit, longest first. Nearly full bins are
done. The others, all of them, become items of the next round, whole, in fewer tasks, until one task has packed what is left
or hardly any two of them go together any more. The bins of a later round are few, so the rounds are joined back from the last to the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import row_key, runs
from opslens.llm.tokens import VOCABULARY, encoder
from opslens.session import broadcast_if_small, frozen

LENGTH, END = 2048, 0
#: A bin with at most so much room left is done.
SLACK = 8
#: Items that one task packs at first, about. All open bins of a round are items of the next one; a tree node takes those of
#: FAN_IN tasks, or fewer if these have more than NODE times TASK_ITEMS.
TASK_ITEMS, FAN_IN, NODE = 50_000, 16, 4
#: A round that merges a smaller share of its items is the last one.
LEAST_MERGED = 0.01
BATCH_BYTES = 4 << 20


@dataclass(frozen=True)
class Packed:
    """pieces: uid, doc_id, _d, _k, piece, start, length, ids (unsigned 32-bit, little-endian). places: uid,
    sequence_id, offset, one for each piece."""

    pieces: DataFrame
    places: DataFrame

    def sequences(self) -> DataFrame:
        """sequence_id and its ids, the pieces joined in order of offset."""
        rows = self.pieces.join(self.places, "uid").select("sequence_id", F.struct("offset", "ids").alias("at"))
        # A sequence holds at most ``length`` pieces.
        parts = F.transform(F.sort_array(F.collect_list("at")), lambda p: F.hex(p.ids))
        return rows.groupBy("sequence_id").agg(F.unhex(F.array_join(parts, "")).alias("ids"))


def cut(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of each row of ``docs`` (doc_id, text): its ids and the end id, cut from the end in ``length`` tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        last = np.array([end], np.uint32).tobytes()
        for batch in runs(batches, "text", BATCH_BYTES):
            ids = [x + last for x in enc.ids([t or "" for t in batch.column("text").to_pylist()])]
            row, number, start, size, out = [], [], [], [], []
            for i, x in enumerate(ids):
                n = len(x) // 4
                at = [0, *range(n % length or min(n, length), n, length)]
                for k, (lo, hi) in enumerate(zip(at, [*at[1:], n])):
                    row.append(i)
                    number.append(k)
                    start.append(lo)
                    size.append(hi - lo)
                    out.append(x[4 * lo:4 * hi])
            row = pa.array(row, pa.int64())
            yield pa.record_batch({
                **{c: batch.column(c).take(row) for c in ("doc_id", "_d", "_k")}, "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()), "ids": pa.array(out, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text")
    schema = "doc_id long, _d long, _k long, piece int, start long, length long, ids binary"
    return frozen(rows.mapInArrow(encode, schema).withColumn("uid", F.monotonically_increasing_id()))


def best_fit(sizes: list[int], length: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each item, and the fill of each bin; items come longest first.

    Best fit: the bin with the least room that still holds the item. One bit per amount of room says whether there is
    such a bin, so the search is one shift and one lowest bit.
    """
    room: list[list[int]] = [[] for _ in range(length + 1)]
    mask, fill, bins, offsets = 0, [], [], []
    for size in sizes:
        above = mask >> size
        if above:
            left = size + (above & -above).bit_length() - 1
            at = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
        else:
            at, left = len(fill), length
            fill.append(0)
        bins.append(at)
        offsets.append(fill[at])
        fill[at] += size
        left -= size
        if left:
            room[left].append(at)
            mask |= 1 << left
    return bins, offsets, fill


def _round(number: int, length: int, slack: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        ids = np.concatenate([np.asarray(b.column("item")) for b in held])
        sizes = np.concatenate([np.asarray(b.column("size")) for b in held])
        order = np.lexsort([ids, -sizes])
        ids, sizes = ids[order], sizes[order]
        bins, offsets, fill = best_fit(sizes.tolist(), length)
        fill = np.array(fill)
        done = fill >= length - slack
        name = (np.int64(number) << np.int64(56)) | (np.int64(TaskContext.get().partitionId()) << np.int64(32))
        bins = np.array(bins)
        for lo in range(0, len(ids), 100_000):
            b = bins[lo:lo + 100_000]
            yield pa.record_batch({
                "item": pa.array(ids[lo:lo + 100_000]), "bin": pa.array(name | b.astype(np.int64)),
                "offset": pa.array(np.array(offsets[lo:lo + 100_000], np.int64)), "fill": pa.array(fill[b].astype(np.int64)),
                "done": pa.array(done[b])})

    return pack


def places(items: DataFrame, length: int = LENGTH, slack: int = SLACK) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid, length), none longer than ``length``.

    Items that fill a sequence are one. The packing of a row set depends on its rows and partition count alone.
    """
    full = items.filter(F.col("length") >= length).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.filter(F.col("length") < length).select(F.col("uid").alias("item"), F.col("length").alias("size"))
    n = rest.count()
    rounds, number = [], 1
    tasks = max(1, -(-n // TASK_ITEMS))
    schema = "item long, bin long, offset long, fill long, done boolean"
    while True:
        dealt = rest.repartition(tasks, "item") if tasks > 1 else rest.coalesce(1)
        packed = frozen(dealt.mapInArrow(_round(number, length, slack), schema))
        rounds.append(packed)
        still = packed.filter("not done").groupBy("bin").agg(F.max("fill").alias("fill")).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        left = still.count() if tasks > 1 else 0
        if not left or left > (1 - LEAST_MERGED) * n:
            break
        rest, n, tasks, number = still, left, max(-(-tasks // FAN_IN), -(-left // (NODE * TASK_ITEMS))), number + 1
    out = rounds.pop().select("item", F.col("bin").alias("sequence_id"), "offset")
    while rounds:
        below = rounds.pop()
        outer = broadcast_if_small(out.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("base")))
        out = below.join(outer, "bin", "left").select(
            "item", F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
    return full.unionByName(out.withColumnRenamed("item", "uid"))


def pack(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = VOCABULARY) -> Packed:
    """Packs all rows of ``docs`` (doc_id, text; other columns are not looked at) into sequences of ``length`` tokens.

    Null and empty text is the end id alone. Rows with a null or repeated doc_id are documents of their own; an empty
    table gives no pieces.
    """
    pieces = cut(docs, length, end, vocabulary)
    return Packed(pieces, places(pieces.select("uid", "length"), length))
