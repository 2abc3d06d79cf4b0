"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1; each bit has a binary n-gram
classifier (mean log odds of hashed byte n-grams between the languages with +1
and those with -1). Decoding adds up, for every codeword, the logistic losses
of the calibrated bits, weighted by how reliably the bit is predicted for that
language, and takes the codeword of the least loss; a small lead over the next
flags the text as ambiguous.

All fits are sums over all training rows: n-gram counts by language in one
pass, means and variances of the margins by language in a second.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read
from .nptext import U64, Block, blocks, texts_of

BUCKETS, ORDERS = 1 << 14, (2, 3, 4)
SMOOTH, WEIGHT_CAP = 0.5, 4096.0       # added to a bucket's count; n-grams a text counts for at most
FOLDS, HELD = 3, 1
AMBIGUOUS = 0.2                        # lead of the best score over the next below which a text is ambiguous
EXHAUSTIVE = 6                         # up to so many languages all possible bits are used

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def ngram_counts(b: Block) -> np.ndarray:
    """(documents, BUCKETS) counts of hashed byte n-grams; anything but letters is a space."""
    x = _LETTERS[b.buf].astype(np.uint64)
    doc = np.repeat(np.arange(b.n), b.len + 1)
    codes, total = x.copy(), np.zeros(b.n * BUCKETS, np.int64)
    for k in range(2, max(ORDERS) + 1):
        codes = codes[:-1] * U64(257) + x[k - 1:]
        if k in ORDERS:
            inside = doc[:-(k - 1)] == doc[k - 1:]        # an n-gram may end in the space after a text
            h = (codes + U64(k)) * U64(0x9E3779B97F4A7C15) >> U64(50)
            total += np.bincount((doc[:-(k - 1)] * BUCKETS + h.astype(np.int64))[inside], minlength=len(total))
    return total.reshape(b.n, BUCKETS)


def _frequencies(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, frequencies, n-grams) of at most 64 documents at a time."""
    texts = texts_of(batch)
    for b in blocks(texts, 1 << 18):
        for lo in range(0, b.n, 64):
            part = Block(b.lo + lo, texts[b.lo + lo:b.lo + min(lo + 64, b.n)])
            c = ngram_counts(part).astype(np.float32)
            n = c.sum(1)
            yield part.lo, c / np.maximum(n, 1)[:, None], n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo, f, n in _frequencies(batch):
            w = f * np.minimum(n, WEIGHT_CAP)[:, None]
            for lang in set(langs[lo:lo + len(n)]):
                rows = [i for i in range(len(n)) if langs[lo + i] == lang]
                total[lang] = total.get(lang, 0) + w[rows].sum(0, dtype=np.float64)
    yield _count_rows(total)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, c in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
            total[lang] = total.get(lang, 0) + np.frombuffer(c)
    yield _count_rows(total)


def _count_rows(total: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                       pa.array([c.tobytes() for c in total.values()], pa.binary())],
                                      ["lang", "counts"])


def codewords(n: int) -> np.ndarray:
    """(n, bits) codewords: all distinct splits up to EXHAUSTIVE languages, else the best of
    200 seeded random codes of 10 * log2(n) bits by smallest distance of two codewords."""
    if n < 2:
        return np.ones((n, 0))
    if n <= EXHAUSTIVE:
        bits = [[1 if i == n - 1 or not (c >> i) & 1 else -1 for i in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(bits, float).T
    size, best, far = int(np.ceil(10 * np.log2(n))), None, -1
    rng = np.random.default_rng(7)
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (n, size))
        d = (size - m @ m.T) / 2 + np.eye(n) * size
        if d.min() > far and (np.abs(m.sum(0)) < n).all():
            best, far = m, d.min()
    return best


class LanguageModel:
    """Codewords, bit classifiers, their calibration and reliability."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        self.code = codewords(len(self.langs))
        c = np.array([counts[x] for x in self.langs]).reshape(len(self.langs), BUCKETS)
        pos, neg = (self.code.T > 0) @ c + SMOOTH, (self.code.T < 0) @ c + SMOOTH
        self.weights = (np.log(pos / pos.sum(1, keepdims=True)) - np.log(neg / neg.sum(1, keepdims=True))).T \
            .astype(np.float32)

    def calibrate(self, mean: np.ndarray, sd: np.ndarray) -> None:
        """From the margins' mean and deviation by (language, bit): the middle between the nearest
        means of either sign, the slope, and the chance that a language's text gets the bit right."""
        plus = np.where(self.code > 0, mean, np.inf).min(0)
        minus = np.where(self.code < 0, mean, -np.inf).max(0)
        self.mid = (plus + minus) / 2
        spread = np.sqrt((sd ** 2).mean(0)) + 1e-4
        self.slope = np.clip(np.abs(plus - minus) / spread ** 2, 1.0, 1e4)
        lead = self.code * (mean - self.mid) / (sd + 1e-4)
        hit = 1 / (1 + np.exp(-1.702 * np.clip(lead, -20, 20)))       # normal distribution, logistic form
        self.reliable = hit / hit.sum(1, keepdims=True)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) of rows of margins."""
        k = len(self.langs)
        if k == 1:
            return np.zeros(len(margins), int), np.ones(len(margins)), np.zeros(len(margins), bool)
        f = np.clip(self.slope * (margins - self.mid), -30, 30)
        loss = np.stack([(np.logaddexp(0, -f * self.code[c]) * self.reliable[c]).sum(1) for c in range(k)], 1)
        p = np.exp(-(loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        order = np.sort(p, 1)
        return p.argmax(1), order[:, -1], order[:, -1] - order[:, -2] < AMBIGUOUS


def _margins(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [f @ weights for _, f, _ in _frequencies(batch)]
            m = np.concatenate(got).astype(float) if got else np.zeros((0, weights.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "lang", "held_out", "letters")), pa.array(list(m), pa.list_(pa.float64()))],
                ["doc_id", "lang", "held_out", "letters", "margins"])
    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang) -> doc_id, held_out, lang_pred, score, ambiguous.

    Learns from text and non-null lang of rows with an id outside the held-out
    fold (crc32 of the id as text mod 3 is 1). ``und`` with score 0 for texts
    that are null, empty or without a letter, and for all if there is nothing to
    learn from; one learnt language is always predicted. A null id is not held
    out and not learnt from; repeated rows are predicted alike; equal losses go
    to the first language by name; an empty table gives no rows; extra columns
    are ignored. Whole texts are counted, 64 documents at a time."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
                       F.when(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")), F.col("lang")).alias("lang"),
                       held_out(F.col("doc_id")).alias("held_out"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    train = rows.filter("lang IS NOT NULL AND letters").select("lang", "text")
    # a row a task and language, then one a language: BUCKETS numbers each, whatever the input
    counts = (train.mapInArrow(_count, "lang string, counts binary").repartition("lang")
              .mapInArrow(_add, "lang string, counts binary").collect())
    model = LanguageModel({r.lang: np.frombuffer(r.counts) for r in counts})
    if not model.langs:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("ambiguous"))
    seen = keep(rows.mapInArrow(_margins(model.weights), "doc_id long, lang string, held_out boolean, letters boolean, "
                                "margins array<double>"), "margins")
    bits = range(model.code.shape[1])
    if bits:
        stats = {r["lang"]: r for r in seen.filter("lang IS NOT NULL AND letters").groupBy("lang").agg(
            *[F.avg(F.col("margins")[j]).alias(f"m{j}") for j in bits],
            *[F.stddev_pop(F.col("margins")[j]).alias(f"s{j}") for j in bits]).collect()}
        model.calibrate(*(np.array([[stats[x][f"{c}{j}"] for j in bits] for x in model.langs]) for c in "ms"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.array(b.column("margins").to_pylist(), float).reshape(b.num_rows, len(bits))
            which, score, unsure = model.decode(m)
            ok = b.column("letters").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"),
                 pa.array([model.langs[i] if y else "und" for i, y in zip(which.tolist(), ok)]),
                 pa.array([float(s) if y else 0.0 for s, y in zip(score.tolist(), ok)]),
                 pa.array([bool(u and y) for u, y in zip(unsure.tolist(), ok)])],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return seen.mapInArrow(decode, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the documents outside the held-out fold."""
    return identify_languages(read(spark, sf_dir, "documents"))
