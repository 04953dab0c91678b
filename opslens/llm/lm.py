"""Language-model scoring with a weighted backoff automaton over word pairs.

States are the words seen as context (and the start of a text). An arc leads from state v over word w to state w. If
the pair (v, w) was seen in training, the arc has the probability l * c(v,w) / c(v) + (1 - l) * P(w). If not, the
failure arc of v is taken: weight 1 - l to the state without context, and from there P(w), the base distribution.
l depends on how often v was seen, in classes of c(v); it is the value of a grid under which the training texts are
most likely when each token is left out of the counts that predict it (l = 0 leaves the base distribution alone).

Texts are dealt into chunks by hash. Each chunk sends the counts of its words and pairs, as sorted hashes, to hash
buckets that hold the sum over the corpus, and gets back the sum for each of them: its own part of the automaton. No
task holds the whole model, and what is exchanged, in bytes and in rows, grows with the distinct pairs of the chunks: a
chunk writes to a bucket only if it has words or pairs there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import runs
from opslens.session import frozen

#: Bytes of text of a chunk and of the texts whose grams share a bucket, about.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
#: Weights tried for a seen pair, and the classes of context counts: 1-3, 4-15, ..., 4^7 and more.
GRID = (0.0, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9)
CLASSES = 8
#: Stand for the end and the start of a text.
END, START = np.uint64(0x7F4A7C159E3779B9), np.uint64(0x1CE4E5B9BF58476D)

_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_bytes = np.random.default_rng(7).integers(1, 2**64 - 1, 256, np.uint64)
_white = np.zeros(256, bool)
_white[[0x20, *range(0x09, 0x0E)]] = True
_gap = re.compile(rb"[\x20\x09-\x0D]")
_powers: list[np.ndarray] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 4096)
        inverse = np.uint64(pow(int(_STEP), -1, 2**64))
        _powers[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64))]) for x in (_STEP, inverse)]
    return _powers[0], _powers[1]


def _hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a piece of text, in order."""
    raw = np.frombuffer(text, np.uint8)
    solid = ~_white[raw]
    edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _power_table(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_bytes[raw] * up[: len(raw)], dtype=np.uint64)])
    h = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, index of its text): A-Z lower-cased words, then the end, text after text."""
    out, owner = [], []
    for i, text in enumerate(texts):
        low, at, n = (text or b"").lower(), 0, 0
        while at < len(low):
            cut = len(low)
            if len(low) - at > CHUNK_BYTES and (gap := _gap.search(low, at + CHUNK_BYTES)):
                cut = gap.start()
            h = _hashes(low[at:cut])
            out.append(h)
            n += len(h)
            at = cut
        out.append(np.array([END]))
        owner.append(n + 1)
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out), np.repeat(np.arange(len(texts)), owner)


class _Grams:
    """The words and word pairs of a chunk, each sorted and cut to the bits that are exchanged."""

    def __init__(self, texts: list[bytes | None], log2_buckets: int):
        self.drop = np.uint64(max(0, 16 - log2_buckets))
        word, self.of = tokens(texts)
        first = np.concatenate([[True], self.of[1:] != self.of[:-1]]) if len(word) else np.empty(0, bool)
        before = np.concatenate([[START], word[:-1]]) if len(word) else word
        before = np.where(first, START, before)
        pair = (before * _STEP + word) * _MIX
        pair = (pair ^ (pair >> np.uint64(31))) * _STEP
        self.first, self.is_end = first, word == END
        self.words, self.word_at = np.unique(word >> self.drop, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair >> self.drop, return_inverse=True)

    def buckets(self, kind: np.ndarray, log2_buckets: int) -> np.ndarray:
        """The bucket of each, by its highest bits; in order, as the array is."""
        return kind >> np.uint64(64 - log2_buckets - int(self.drop))


def _pack(h: np.ndarray) -> bytes:
    """The low 48 bits of each; the bits above are the bucket's."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _pack_counts(n: np.ndarray) -> bytes:
    """Counts in a byte each; those from 255 on follow in four bytes each, those beyond four bytes in eight more."""
    small = np.minimum(n, 255).astype(np.uint8)
    large = n[small == 255]
    middle = np.minimum(large, 2**32 - 1)
    return b"".join([np.array([len(n)], "<u8").tobytes(), small.tobytes(), middle.astype("<u4").tobytes(),
                     large[middle == 2**32 - 1].astype("<u8").tobytes()])


def _unpack_counts(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, "<u8", 1)[0])
    counts = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
    large = np.flatnonzero(counts == 255)
    counts[large] = np.frombuffer(raw, "<u4", len(large), 8 + n)
    huge = large[counts[large] == 2**32 - 1]
    counts[huge] = np.frombuffer(raw, "<u8", len(huge), 8 + n + 4 * len(large))
    return counts


def train_totals(docs: DataFrame) -> tuple[int, int]:
    """(tokens, distinct tokens) of the rows of ``docs`` (text) that are not held out: a word count of hashes, summed up in
    each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", CHUNK_BYTES):
            word, n = np.unique(tokens(batch.column("text").to_pylist())[0], return_counts=True)
            yield pa.record_batch({"word": pa.array(word.view(np.int64)), "n": pa.array(n.astype(np.int64))})

    counted = docs.filter("not held_out").select("text").mapInArrow(count, "word long, n long")
    n, v = counted.groupBy("word").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first()
    return n or 0, v


def _ask(log2_buckets: int):
    """Of a chunk: for each bucket in which it has any, its words and pairs with their counts in its training texts."""

    def ask(rows: pa.Table) -> pa.Table:
        g = _Grams(rows.column("text").to_pylist(), log2_buckets)
        train = ~np.asarray(rows.column("held_out"))[g.of]
        parts = {}
        buckets = np.union1d(g.buckets(g.words, log2_buckets), g.buckets(g.pairs, log2_buckets))
        for name, kind, at in (("word", g.words, g.word_at), ("pair", g.pairs, g.pair_at)):
            n = np.bincount(at, weights=train, minlength=len(kind)).astype(np.int64)
            of = g.buckets(kind, log2_buckets)
            cut = list(zip(np.searchsorted(of, buckets), np.searchsorted(of, buckets, side="right")))
            parts[name] = [_pack(kind[a:b]) for a, b in cut]
            parts[name + "_n"] = [_pack_counts(n[a:b]) for a, b in cut]
        return pa.table({
            "chunk": pa.array([rows.column("chunk")[0].as_py()] * len(buckets), pa.int64()), "bucket": pa.array(buckets.astype(np.int64)),
            **{k: pa.array(v, pa.binary()) for k, v in parts.items()}})

    return ask


def _answer(rows: pa.Table) -> pa.Table:
    """Of a bucket: for each chunk, the corpus counts of what it asked for, in its order."""
    out = {"chunk": rows.column("chunk").combine_chunks(), "bucket": rows.column("bucket").combine_chunks()}
    for name in ("word", "pair"):
        asked = [_unpack(x) for x in rows.column(name).to_pylist()]
        counts = np.concatenate([_unpack_counts(x) for x in rows.column(name + "_n").to_pylist()])
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=counts, minlength=len(distinct)) if len(at) else np.empty(0)
        found = np.split(total.astype(np.int64)[at], np.cumsum([len(a) for a in asked])[:-1])
        out[name + "_n"] = pa.array([_pack_counts(f) for f in found], pa.binary())
    return pa.table(out)


def _score(log2_buckets: int, n: int, v: int):
    """Of a chunk: walks its texts through its part of the automaton, once for each weight of the grid."""

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return OUT.empty_table()
        answers = answers.sort_by("bucket")
        word_n = np.concatenate([_unpack_counts(x) for x in answers.column("word_n").to_pylist()]).astype(float)
        pair_n = np.concatenate([_unpack_counts(x) for x in answers.column("pair_n").to_pylist()]).astype(float)
        g = _Grams(rows.column("text").to_pylist(), log2_buckets)
        docs = rows.num_rows
        train = ~np.asarray(rows.column("held_out"))[g.of]
        c = word_n[g.word_at]
        joint = pair_n[g.pair_at]
        # Each training text ends once and starts once.
        ends = c[g.is_end][0]
        context = np.concatenate([[ends], c[:-1]])
        context[g.first] = ends
        floor = 0.5 * (v + 1)
        plain = (c + 0.5) / (n + floor)

        def walk(joint, context, plain):
            """Log-probabilities by text, class and grid value, as one array each of the sums and of what has no class."""
            seen = context > 0
            kind = np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) // 2, CLASSES - 1)
            arc = np.where(seen, joint / np.maximum(context, 1), 0)
            slot = (g.of * CLASSES + kind)[seen]
            sums = np.stack([
                np.bincount(slot, weights=np.log10(w * arc[seen] + (1 - w) * plain[seen]), minlength=docs * CLASSES) for w in GRID
            ], axis=1).reshape(docs, CLASSES * len(GRID))
            rest = np.bincount(g.of[~seen], weights=np.log10(plain[~seen]), minlength=docs)
            return sums, rest

        sums, rest = walk(joint, context, plain)
        base = np.bincount(g.of, weights=np.log10(plain), minlength=docs)
        # Each training token left out of the counts that predict it.
        out = train.astype(float)
        left, _ = walk(np.maximum(joint - out, 0), np.maximum(context - out, 0), np.maximum(c - out + 0.5, 0.5) / max(n - 1 + floor, 1))
        left = left[~np.asarray(rows.column("held_out"))].sum(0)
        return pa.table({
            "doc_id": rows.column("doc_id").combine_chunks(), "held_out": rows.column("held_out").combine_chunks(),
            "n_tokens": pa.array(np.bincount(g.of, minlength=docs)), "n_known": pa.array(np.bincount(g.of, weights=c > 0, minlength=docs).astype(np.int64)),
            "train_tokens": pa.array([n] * docs, pa.int64()), "base_score": pa.array(base), "rest": pa.array(rest),
            "sums": pa.array(list(sums), pa.list_(pa.float64())),
            "left_out": pa.array([left.tolist()] + [None] * (docs - 1), pa.list_(pa.float64()))}, schema=OUT)

    return score


OUT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("rest", pa.float64()), ("sums", pa.list_(pa.float64())), ("left_out", pa.list_(pa.float64()))])
_OUT_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, rest double, "
            "sums array<double>, left_out array<double>")


def score(docs: DataFrame) -> DataFrame:
    """Scores each row of ``docs`` (doc_id, text, held_out); rows that are not held out are learned from.

    doc_id, held_out, n_tokens (words and the end), n_known (seen in training), train_tokens, base_score and score (log10
    probability of the text under the base distribution and under the automaton). Null and empty text is the end alone;
    null held_out counts as false; repeated rows are learned from each and scored alike; without training texts both
    scores are those of the base distribution; an empty table gives no rows. Words and pairs are told apart by
    48 bits and the bucket's (54 at 64 buckets, 60 at 4096).
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        F.coalesce("held_out", F.lit(False)).alias("held_out"), F.xxhash64("doc_id", "text").alias("_hash"))
    size = rows.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    log2_buckets = max(0, int(-(-size // BUCKET_BYTES) - 1).bit_length()) if size else 0
    n, v = train_totals(rows)
    rows = rows.withColumn("chunk", F.pmod("_hash", F.lit(chunks))).drop("_hash").repartition("chunk")
    asked = rows.groupBy("chunk").applyInArrow(
        _ask(log2_buckets), "chunk long, bucket long, word binary, word_n binary, pair binary, pair_n binary")
    answers = asked.groupBy("bucket").applyInArrow(
        _answer, "chunk long, bucket long, word_n binary, pair_n binary")
    walked = frozen(rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(log2_buckets, n, v), _OUT_DDL))
    likely = walked.filter("left_out is not null").agg(
        *[F.coalesce(F.sum(F.element_at("left_out", i + 1)), F.lit(0.0)) for i in range(CLASSES * len(GRID))]).first()
    likely = np.array(likely, float).reshape(CLASSES, len(GRID))
    chosen = likely.argmax(1)
    total = F.col("rest")
    for k, g in enumerate(chosen):
        total = total + F.element_at("sums", int(k * len(GRID) + g + 1))
    return walked.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", total.alias("score"))
