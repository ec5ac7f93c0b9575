"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over hashed byte n-grams says how much the
text looks like the languages whose bit is 1 rather than those whose bit is 0. Loss-weighted decoding compares the
bits' answers with every codeword, weighing each bit by how well it separated held-back training texts, takes the
nearest word and flags a text whose second word is almost as near.

Training counts n-grams with one distributed aggregation over at most about ``SAMPLE_PER_LANGUAGE`` texts of each
language, drawn by a hash of the row (the documented bound of the fit). A null or letterless text is ``und`` with score
0; rows are judged one by one, so ties, repeats and other columns change nothing; with no training row all is ``und``.
Long texts are read whole, piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
ORDERS = (2, 3, 4)
BUCKET_BITS = 15
SAMPLE_PER_LANGUAGE = 3_000
#: Two codewords whose losses differ by less than this share of a bit make a text ambiguous.
AMBIGUITY = 0.1
PIECE = 1 << 19
#: Up to this many languages every split of the languages is a bit; beyond, random bits are drawn.
EXHAUSTIVE_UP_TO = 6
RANDOM_BITS_PER_DOUBLING = 10

_LOWER = bytes(range(256)).lower()
#: Control characters, digits and ASCII punctuation count as one space-like byte.
_FOLD = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in _LOWER)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """Codewords as a matrix of 0 and 1 with n different rows, no constant column and no column twice or inverted."""
    if n <= 1:
        return np.zeros((n, 1), dtype=np.int8)
    if n <= EXHAUSTIVE_UP_TO:
        # every way to split the languages in two, the first language always on the side of ones
        return np.array([[1 if i == 0 else (c >> (i - 1)) & 1 for c in range(2 ** (n - 1) - 1)] for i in range(n)], dtype=np.int8)
    rng, width = np.random.default_rng(seed), RANDOM_BITS_PER_DOUBLING * int(np.ceil(np.log2(n)))
    best, distance = None, -1
    for _ in range(200):
        drawn = rng.integers(0, 2, (n, width), dtype=np.int8)
        drawn = drawn[:, (drawn.min(0) == 0) & (drawn.max(0) == 1)]
        apart = (drawn[:, None, :] != drawn[None, :, :]).sum(2) + np.eye(n, dtype=int) * width
        if apart.min() > distance:
            best, distance = drawn, apart.min()
    return best


def buckets(text: bytes) -> np.ndarray:
    """Hash buckets of all byte n-grams of ``text``, folded to lower case with space for anything but letters."""
    b = np.frombuffer(text.translate(_FOLD), dtype=np.uint8).astype(np.uint32)
    found = []
    for order in ORDERS:
        if len(b) < order:
            continue
        code = np.full(len(b) - order + 1, order, dtype=np.uint32)
        for k in range(order):
            code = code * np.uint32(0x01000193) + b[k : len(b) - order + 1 + k]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x85EBCA6B)
        found.append(code >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


def pieces(text: str) -> Iterator[bytes]:
    """The whole text as UTF-8 in pieces that overlap by what the longest n-gram needs."""
    for at in range(0, max(1, len(text)), PIECE):
        yield (" " + text[at : at + PIECE + max(ORDERS) - 1] + " ").encode("utf-8", "replace")


def counts_of(text: str) -> np.ndarray:
    total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for piece in pieces(text):
        total += np.bincount(buckets(piece), minlength=1 << BUCKET_BITS)
    return total


@dataclass
class Model:
    """Languages, their codewords, log-odds per bucket and bit, and per bit its offset, scale and decoding weight."""

    languages: list[str]
    words: np.ndarray
    odds: np.ndarray
    offset: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds per n-gram and bit, centred and scaled on the training texts."""
        total, n = np.zeros(self.odds.shape[1]), 0
        for piece in pieces(text):
            at = buckets(piece)
            total += np.take(self.odds, at, axis=0).sum(0, dtype=np.float64)
            n += len(at)
        return (total / max(1, n) - self.offset) / self.scale

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """Language of the nearest codeword, score and ambiguity, with a logistic loss per bit."""
        signs = 2.0 * self.words - 1.0
        losses = (np.logaddexp(0.0, -signs * margins) * self.weight).sum(1) / self.weight.sum()
        order = np.argsort(losses, kind="stable")
        near = np.exp(-(losses - losses[order[0]]) * len(self.weight))
        ambiguous = len(order) > 1 and losses[order[1]] - losses[order[0]] < AMBIGUITY
        return self.languages[order[0]], float(1.0 / near.sum()), bool(ambiguous)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not has_letter(text):
            return UNDETERMINED, 0.0, False
        return self.decode(self.margins(text))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on ``labelled`` (text, lang), rows without either left out.

    Only sums leave the cluster: per language and fold one count vector of fixed length.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], codewords(0), np.zeros((1 << BUCKET_BITS, 1)), np.zeros(1), np.ones(1), np.ones(1))
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("text", "lang"), F.lit(1_000_000)) / 1_000_000.0
    sample = rows.filter(draw < share).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(4)) == 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                own = counts_of(text)
                sums[lang] = sums.get(lang, 0) + own
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    parts = sample.filter(~F.col("fold")).mapInPandas(count, "lang string, bucket int, n long")
    place = {lang: i for i, lang in enumerate(languages)}
    table = np.zeros((len(languages), 1 << BUCKET_BITS))
    # at most languages x buckets rows, whatever the corpus holds
    for r in parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False):
        table[place[r.lang], r.bucket] = r.n
    smooth = table + 0.5
    probability = smooth / smooth.sum(1, keepdims=True)
    words = codewords(len(languages))
    ones = words.T[:, :, None] == 1
    mean = lambda side: np.where(side, probability[None], 0).sum(1) / np.maximum(1, side.sum(1))
    odds = np.ascontiguousarray((np.log(mean(ones) + 1e-12) - np.log(mean(~ones) + 1e-12)).T.astype(np.float32))
    if len(languages) == 1:
        odds = np.zeros((1 << BUCKET_BITS, 1), dtype=np.float32)
    raw = Model(languages, words, odds, np.zeros(words.shape[1]), np.ones(words.shape[1]), np.ones(words.shape[1]))
    return _calibrated(raw, sample.filter("fold"))


def _calibrated(raw: Model, held: DataFrame) -> Model:
    """Centre, scale and weigh the bits on the fold that was not counted; again only sums are gathered."""
    place = {lang: i for i, lang in enumerate(raw.languages)}
    shared = held.sparkSession.sparkContext.broadcast(raw)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, rows = shared.value, []
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                for bit, margin in enumerate(model.margins(text)):
                    rows.append((bit, int(model.words[place[lang], bit]), float(margin)))
        yield pd.DataFrame(rows, columns=["bit", "side", "margin"])

    stats = held.mapInPandas(moments, "bit int, side int, margin double").groupBy("bit", "side").agg(
        F.count(F.lit(1)).alias("n"), F.avg("margin").alias("mean"), F.stddev_pop("margin").alias("deviation")
    )
    found = {(r["bit"], r["side"]): (r["mean"], r["deviation"]) for r in stats.collect()}
    offset, scale, weight = raw.offset.copy(), raw.scale.copy(), raw.weight.copy()
    for bit in range(len(offset)):
        low, high = found.get((bit, 0)), found.get((bit, 1))
        if low and high and high[0] > low[0]:
            offset[bit] = (low[0] + high[0]) / 2
            scale[bit] = max(1e-6, (high[0] - low[0]) / 8)
            weight[bit] = 1 / (1 + (low[1] + high[1]) / (high[0] - low[0]))
    return Model(raw.languages, raw.words, raw.odds, offset, scale, weight)


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every document; only ``text`` is looked at."""
    # a model is languages x bits numbers plus 2^15 x bits log-odds: bounded by the code, a few MB
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            told = [shared.value.predict(text) for text in batch["text"]]
            found = pd.DataFrame(told, columns=["lang_pred", "score", "ambiguous"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), found], axis=1)

    # ids travel as strings, so that nulls leave whole numbers whole
    chosen = documents.select(F.col("doc_id").cast("string"), "text")
    found = chosen.mapInPandas(predict, "doc_id string, lang_pred string, score double, ambiguous boolean")
    return found.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))
