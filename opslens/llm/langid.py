"""Language identification with bit-sliced Bloom filters over character n-grams.

One row of the filter table holds, for one hash slot, a bit for each language. The AND of the slots of an n-gram
is the bit mask of all languages whose filter may hold it. A text's n-grams are counted per language bit, the
expected number of false positives is taken off, and the language with the most n-grams left wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslens.llm.common import chunked, runs
from opslens.session import frozen

BATCH_BYTES = 1 << 18
SPACE = np.uint32(32)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(texts: list[bytes], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, index of text) of the n-grams, for each size.

    Texts are lower-cased; what is no letter separates words. An n-gram lies in one word with its two ends.
    """
    codes, owner = [], []
    for i, text in enumerate(texts):
        low = text.decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass")
        codes.append(np.concatenate([[SPACE], np.frombuffer(low, np.uint32), [SPACE]]))
        owner.append(len(codes[-1]))
    if not codes:
        return
    at = np.concatenate(codes).astype(np.uint32)
    who = np.repeat(np.arange(len(owner)), owner)
    word = letters()[np.minimum(at, 0x10FFFF)]
    at = np.where(word, at, SPACE)
    wide = at.astype(np.uint64)
    for n in sizes:
        if len(at) < n:
            continue
        m = len(at) - n + 1
        ok = word[0:m].copy() if n == 1 else word[0:m] | word[1:m + 1]
        for j in range(1, n - 1):
            ok &= word[j:m + j]
        pick = np.flatnonzero(ok & (who[:m] == who[n - 1:]))
        h = np.full(len(pick), n, np.uint64)
        for j in range(n):
            h = (h ^ wide[pick + j]) * _MIX[0]
            h ^= h >> np.uint64(29)
        yield h * _MIX[1], who[pick]


@dataclass(frozen=True)
class Model:
    """Fitted filters. table: slots x languages, one bit each, in the smallest unsigned type that holds them."""

    langs: tuple[str, ...]
    sizes: tuple[int, ...]
    hashes: int
    table: np.ndarray = field(repr=False)

    def masks(self, h: np.ndarray) -> np.ndarray:
        bits = np.uint64(int(self.table.shape[0]).bit_length() - 1)
        step = (h >> np.uint64(32)) | np.uint64(1)
        found = None
        for j in range(self.hashes):
            slot = ((h + np.uint64(j) * step) * _MIX[0]) >> (np.uint64(64) - bits)
            row = self.table[slot]
            found = row if found is None else found & row
        return found

    def false_rate(self) -> np.ndarray:
        """For each language, the chance that an n-gram outside its filter is found in it."""
        width = self.table.dtype.itemsize * 8
        fill = [((self.table[:, i // width] >> self.table.dtype.type(i % width)) & self.table.dtype.type(1)).mean() for i in range(len(self.langs))]
        return np.asarray(fill) ** self.hashes

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and how many of them each language's filter finds."""
        total = np.zeros(len(texts), np.int64)
        found = np.zeros((len(texts), len(self.langs)), np.int64)
        width = self.table.dtype.itemsize * 8
        for h, who in grams(texts, self.sizes):
            mask = self.masks(h)
            total += np.bincount(who, minlength=len(texts))
            for i in range(len(self.langs)):
                bit = (mask[:, i // width] >> mask.dtype.type(i % width)) & mask.dtype.type(1)
                found[:, i] += np.bincount(who, weights=bit, minlength=len(texts)).astype(np.int64)
        return total, found

    def predict(self, texts: list[bytes]) -> pd.DataFrame:
        total, found = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.langs)), np.int64)
        part, of, size = [], [], 0

        def count():
            t, f = self.counts(part)
            np.add.at(total, of, t)
            np.add.at(found, of, f)

        for i, text in enumerate(texts):
            for piece in chunked(text, BATCH_BYTES) if text else ():
                part.append(piece)
                of.append(i)
                size += len(piece)
                if size >= BATCH_BYTES:
                    count()
                    part, of, size = [], [], 0
        if part:
            count()
        rate = self.false_rate()
        if not self.langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "coverage": 0.0})
        left = np.maximum((found - total[:, None] * rate) / np.maximum(1 - rate, 1e-9), 0)
        best = left.argmax(1)
        rows = np.arange(len(texts))
        top = left[rows, best]
        left[rows, best] = 0
        second = left.max(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(top + second > 0, top / (top + second), 1 / len(self.langs))
            cover = np.where(total > 0, top / total, 0)
        und = total == 0
        return pd.DataFrame({
            "lang_pred": np.where(und, "und", np.asarray(self.langs, object)[best]),
            "score": np.clip(np.where(und, 0, score), 0, 1), "coverage": np.clip(cover, 0, 1),
        })


def fit(
    docs: DataFrame, lang: str = "lang", text: str = "text", per_lang: int = 2000, sizes: tuple[int, ...] = (2, 3, 4),
    least_share: float = 2e-5, least_ratio: float = 0.25, log2_slots: int = 21, hashes: int = 3,
) -> Model:
    """Filters of each language from a sample of labelled rows.

    Bound: about ``per_lang`` rows of each language, those whose text hashes lowest; all rows if there are fewer. An
    n-gram enters a language's filter if it is at least ``least_share`` of the language's n-grams of the sample
    (so at most 1 / least_share of each language) and at least ``least_ratio`` of its largest such share in any
    language, which keeps out what strays in from foreign or mislabelled text. Rows without text or label are left
    out; without any labelled row the model knows no language and predicts ``und``.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes_of = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = tuple(sorted(sizes_of))
    width = next(w for w in (8, 16, 32, 64) if len(langs) <= w or w == 64)
    kind = np.dtype(f"uint{width}")
    table = np.zeros((1 << log2_slots, max(1, -(-len(langs) // width))), kind)
    if not langs:
        return Model(langs, sizes, hashes, table)
    number = F.element_at(F.create_map(*(F.lit(x) for i, l in enumerate(langs) for x in (l, i))), F.col("lang"))
    share = F.element_at(F.create_map(*(F.lit(x) for l in langs for x in (l, min(1.0, per_lang / sizes_of[l])))), F.col("lang"))
    draw = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < share).select(number.alias("lang"), F.col("text").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 16 * BATCH_BYTES):
            of = np.asarray(batch.column("lang"))
            texts = batch.column("text").to_pylist()
            for at in np.unique(of):
                pieces = [p for i in np.flatnonzero(of == at) for p in chunked(texts[i], BATCH_BYTES)]
                for h, _ in grams(pieces, sizes):
                    seen, n = np.unique(h, return_counts=True)
                    yield pa.record_batch({
                        "lang": pa.array(np.full(len(seen), at, np.int32)), "gram": pa.array(seen.view(np.int64)),
                        "n": pa.array(n.astype(np.int64))})

    counted = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = frozen(counted)
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if totals:
        whole = F.element_at(F.create_map(*(F.lit(x) for l, n in totals.items() for x in (l, n))), F.col("lang"))
        shares = counted.withColumn("p", F.col("n") / whole).filter(F.col("p") >= least_share)
        top = shares.groupBy("gram").agg(F.max("p").alias("top"))
        kept = shares.join(top, "gram").filter(F.col("p") >= least_ratio * F.col("top")).select("lang", "gram").toPandas()
        model = Model(langs, sizes, hashes, table)
        bits = np.uint64(log2_slots)
        h = kept["gram"].to_numpy(np.int64).view(np.uint64)
        of = kept["lang"].to_numpy(np.int64)
        step = (h >> np.uint64(32)) | np.uint64(1)
        for j in range(hashes):
            slot = ((h + np.uint64(j) * step) * _MIX[0]) >> (np.uint64(64) - bits)
            np.bitwise_or.at(table, (slot, of // width), (np.uint64(1) << (of % width).astype(np.uint64)).astype(kind))
        return model
    return Model(langs, sizes, hashes, table)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and coverage (columns of these names are replaced), from the text alone.

    lang_pred: the language, ``und`` for null text and text without a letter. score: n-grams of the best language as a
    share of those of the best two, 0 for ``und``, in doubt 1 / number of languages. coverage: share of the text's
    n-grams that the best language holds. Ties go to the language that comes first by name. Repeated rows get equal
    values; an empty table gives no rows. Long texts are counted in pieces, whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, coverage double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in texts:
            yield held.value.predict([bytes(t) if t is not None else b"" for t in s])

    cols = [docs[c] for c in docs.columns if c not in ("lang_pred", "score", "coverage")]
    return docs.select(*cols, judged(F.col(text).cast("binary")).alias("_judged")).select(
        *[c for c in docs.columns if c not in ("lang_pred", "score", "coverage")], "_judged.*")


def rejected(coverage: float = 0.15) -> Column:
    """Of predicted rows, those in no learned language: ``und``, or hardly any n-gram of the best language."""
    return (F.col("lang_pred") == "und") | (F.col("coverage") < coverage)
