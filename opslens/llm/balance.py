"""Cost-balanced packing of documents into token sequences.

A sequence of n tokens costs a model a linear part (its layers) and, for each document in it, a part that is quadratic
in that document's tokens (attention does not cross documents). Documents are assigned in descending order of that cost,
each to the sequence of lowest cost that still has room for its tokens. A document for which no sequence has room is cut:
the cheapest open sequence takes as much as it holds, the rest is assigned later, in its place of the order.

Packing is done where the texts are encoded, in windows of a bounded number of tokens: no shuffle, nothing staged, and
a lost task is simply run again. Each window gets exactly as many sequences as its tokens fill; what is left of it goes
into sequences whose lengths are powers of two (the bits of the rest), which are not padded. So no token is padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import runs
from opslens.llm.tokens import VOCABULARY, encoder

LENGTH, END = 1024, 0
#: Width of the model the costs are estimated for: a token costs 24 width^2 in a layer's matrices and 4 width for each
#: token it attends to, which is 6 width to 1.
WIDTH = 1024
#: Tokens packed together, about; a longer document is a window of its own. 16 MB of ids, some 25,000 documents.
WINDOW = 4_000_000
BATCH_BYTES, OUT_TOKENS = 4 << 20, 1_000_000


@dataclass(frozen=True)
class Cost:
    """Estimated cost of a piece of n tokens, in units of one attended token."""

    width: int = WIDTH

    def __call__(self, n):
        return 6 * self.width * n + n * n


class _Open:
    """Sequences with room, found by least cost among those with at least a given room.

    One heap of (cost, sequence) for each amount of room; a tree over the amounts keeps the least entry of each range.
    """

    NONE = 1 << 200

    def __init__(self, rooms: list[int], length: int):
        self.half = 1 << length.bit_length()
        self.heaps: list[list[int]] = [[] for _ in range(length + 1)]
        self.least = [self.NONE] * (2 * self.half)
        for at, room in enumerate(rooms):
            self.heaps[room].append(at)
        for room, heap in enumerate(self.heaps):
            heapify(heap)
            if heap:
                self._lift(room)

    def _lift(self, room: int) -> None:
        heap, least, node = self.heaps[room], self.least, room + self.half
        least[node] = heap[0] if heap else self.NONE
        while node > 1:
            node >>= 1
            a, b = least[2 * node], least[2 * node + 1]
            low = a if a < b else b
            if least[node] == low:
                break
            least[node] = low

    def take(self, room: int) -> int | None:
        """The cheapest sequence with at least ``room`` left, as cost << 32 | sequence."""
        node, found = room + self.half, self.least[room + self.half]
        while node > 1:
            if not node & 1 and self.least[node + 1] < found:
                found = self.least[node + 1]
            node >>= 1
        return None if found == self.NONE else found

    def move(self, entry: int, room: int, new_entry: int, new_room: int) -> None:
        heappop(self.heaps[room])
        self._lift(room)
        if new_room:
            heappush(self.heaps[new_room], new_entry)
            self._lift(new_room)


def assign(sizes: list[int], length: int = LENGTH, cost: Cost = Cost()) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (item, start, length, sequence, offset) of items no longer than ``length``, and the cost of each sequence.

    There are as many sequences of ``length`` as the sizes fill, then one for each bit of the rest. All get full.
    """
    whole, rest = divmod(sum(sizes), length)
    rooms = [length] * whole + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    room, costs, seqs = list(rooms), [0] * len(rooms), _Open(rooms, length)
    waiting = [(-n, item, 0) for item, n in enumerate(sizes) if n]
    heapify(waiting)
    out = []
    while waiting:
        n, item, start = heappop(waiting)
        entry = seqs.take(-n)
        if entry is None:
            entry = seqs.take(1)
            left = -n - room[entry & 0xFFFFFFFF]
            n += left
            heappush(waiting, (-left, item, start - n))
        at = entry & 0xFFFFFFFF
        out.append((item, start, -n, at, rooms[at] - room[at]))
        costs[at] += cost(-n)
        seqs.move(entry, room[at], costs[at] << 32 | at, room[at] + n)
        room[at] += n
    return out, costs


def _window(ids: list[bytes], length: int, cost: Cost) -> tuple[np.ndarray, np.ndarray]:
    """Columns row, start, length, sequence, offset of all pieces of the window, and the cost of each sequence.

    Pieces of full length come first in descending order and fill a sequence each; what is left of the documents follows.
    """
    total = np.array([len(x) // 4 for x in ids], np.int64)
    full = total // length
    row = np.repeat(np.arange(len(ids)), full)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
    out = np.stack([row, nth * length, np.full(len(row), length), np.arange(len(row)), np.zeros(len(row), np.int64)], axis=1)
    pieces, costs = assign((total % length).tolist(), length, cost)
    if pieces:
        more = np.array(pieces, np.int64)
        more[:, 1] += full[more[:, 0]] * length
        more[:, 3] += len(row)
        out = np.concatenate([out, more])
    return out, np.array([cost(length)] * len(row) + costs, np.int64)


def pack(docs: DataFrame, length: int = LENGTH, end: int = END, vocabulary: str = VOCABULARY, width: int = WIDTH, window: int = WINDOW) -> DataFrame:
    """Pieces of all rows of ``docs`` (doc_id, text; other columns are not looked at) in sequences of at most ``length``.

    doc_id, start, length, ids (unsigned 32-bit, little-endian), doc_tokens, sequence_id, offset, sequence_cost. Null
    and empty text is the end id alone. Rows with a null or repeated doc_id are documents of their own; an empty table
    gives no pieces. The result follows the order of ``docs`` in its partitions, which a written table keeps.
    """
    cost = Cost(width)
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_cost long"

    def packed(doc_ids: list, ids: list[bytes], first: int) -> Iterator[pa.RecordBatch]:
        at, costs = _window(ids, length, cost)
        for part in np.array_split(at, max(1, at[:, 2].sum() // OUT_TOKENS)):
            row, start, size, seq, offset = part.T
            cut = [ids[r][4 * s:4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), size.tolist())]
            yield pa.record_batch({
                "doc_id": pa.array([doc_ids[r] for r in row.tolist()], pa.int64()), "start": pa.array(start), "length": pa.array(size),
                "ids": pa.array(cut, pa.binary()), "doc_tokens": pa.array([len(ids[r]) // 4 for r in row.tolist()], pa.int64()),
                "sequence_id": pa.array(seq + first), "offset": pa.array(offset), "sequence_cost": pa.array(costs[seq])})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        last = np.array([end], np.uint32).tobytes()
        first = TaskContext.get().partitionId() << 40
        doc_ids, ids, held = [], [], 0
        for batch in runs(batches, "text", BATCH_BYTES):
            doc_ids += batch.column("doc_id").to_pylist()
            ids += [x + last for x in enc.ids([t or "" for t in batch.column("text").to_pylist()])]
            held += sum(map(len, ids[-batch.num_rows:])) // 4
            if held >= window:
                yield from packed(doc_ids, ids, first)
                first += held
                doc_ids, ids, held = [], [], 0
        if ids:
            yield from packed(doc_ids, ids, first)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)
