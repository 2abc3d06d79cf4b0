"""Toxicity by weak supervision.

Voters (a fixed lexicon, text patterns, and words and word beginnings mined from
a bounded sample of labelled rows) fire or abstain on every document; one more voter fires when
no word voter does. A generative label
model with a hidden class estimates by EM how often each voter fires in either
class, how reliable the given labels are (they are one more, noisy voter) and
how voters correlate inside a class; a voter that repeats others counts less.
A linear classifier over the voters is then fitted to the posterior labels.

Both fits see all documents: rows are first counted by vote pattern, and each
iteration adds up fixed-size sums over the patterns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read, thrifty
from .nptext import ALNUM, U64, Block, Spans, blocks, shingle_sets, texts_of

# Insults that count as lexicon voters.
LEXICON = ("arrogant", "clown", "coward", "creep", "cretin", "degenerate", "disgusting", "dumb", "dummkopf", "estupido",
           "filth", "filthy", "fool", "garbage", "hate", "idiot", "idiota", "idiots", "imbecile", "jerk", "kill",
           "liar", "loser", "losers", "moron", "morons", "parasite", "pathetic", "pig", "scum", "shut", "stupid",
           "subhuman", "trash", "ugly", "vermin", "worthless")
PATTERNS = ("shouting", "exclaiming", "masked", "you_are", "silent")
SILENT = len(LEXICON) + PATTERNS.index("silent")      # the voter that speaks for clean texts
MINED, MIN_DF, MIN_Z, MIN_LIFT = 20, 12, 6.0, 30.0
BEGINNINGS = (3, 4, 5, 6, 7, 8)      # bytes of word beginnings that are mined besides whole words
SAMPLE = 3_000             # labelled rows of each class (lowest hashes) from which voters are mined
CANDIDATES = 2_000         # of the mined features, those with the best z-scores enter the covering
EM_STEPS, FIT_STEPS, RIDGE = 6, 10, 0.05
FOLDS, HELD = 5, 0


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def word_hash(words: list[str]) -> np.ndarray:
    b = Block(0, [" ".join(words).encode()])
    return b.words(ALNUM)[0]


_YOU, _ARE, _RE, _A = word_hash(["you", "are", "re", "a"])


class Vocabulary:
    """Mined and fixed word voters: sorted hashes by kind (0: whole word, k: first k bytes)."""

    def __init__(self, kinds: list[int], hashes: np.ndarray, bits: list[int]):
        self.by_kind = {}
        for k in sorted(set(kinds)):
            pick = [i for i, x in enumerate(kinds) if x == k]
            h, b = hashes[pick], np.array(bits, np.int64)[pick]
            order = np.argsort(h)
            self.by_kind[k] = (h[order], b[order])


def features(spans: Spans, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(which words, hashes) of kind k."""
    if k:
        return spans.prefixes(k)
    h = spans.hashes()
    return np.arange(len(h)), h


def votes(b: Block, vocab: Vocabulary) -> np.ndarray:
    """A bit mask per document."""
    spans = b.spans(ALNUM)
    masks = np.zeros(b.n, np.int64)
    doc = np.repeat(np.arange(b.n), np.diff(spans.bounds))
    for k, (known, bit) in vocab.by_kind.items():
        w, h = features(spans, k)
        at = np.minimum(np.searchsorted(known, h & ~U64(15)), len(known) - 1)
        hit = known[at] == h & ~U64(15)
        np.bitwise_or.at(masks, doc[w[hit]], np.int64(1) << bit[at[hit]])
        if k == 0:
            pair = np.flatnonzero((h[:-1] == _YOU) & ((h[1:] == _ARE) | (h[1:] == _RE)))
            pair = pair[doc[pair] == doc[pair + 1]]
            np.bitwise_or.at(masks, doc[pair], np.int64(1) << np.int64(len(LEXICON) + 3))
    up = np.add.reduceat((b.buf >= 65) & (b.buf <= 90), b.off, dtype=np.int64)
    low = np.add.reduceat((b.buf >= 97) & (b.buf <= 122), b.off, dtype=np.int64)
    twice = lambda c: np.append((b.buf[1:] == c) & (b.buf[:-1] == c), False)
    exclaim = np.add.reduceat(twice(33), b.off, dtype=np.int64)
    stars = np.add.reduceat(twice(42), b.off, dtype=np.int64)
    for k, on in enumerate(((up > 0.6 * (up + low)) & (up + low >= 20), exclaim >= 3, stars >= 3)):
        masks |= on.astype(np.int64) << np.int64(len(LEXICON) + k)
    word_voters = ((1 << len(LEXICON)) - 1) | (-1 << (len(LEXICON) + len(PATTERNS)))
    masks |= ((masks & word_voters) == 0).astype(np.int64) << np.int64(len(LEXICON) + 4)
    return masks


def _voter(vocab: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [votes(b, vocab) for b in blocks(texts_of(batch))]
            masks = np.concatenate(masks) if masks else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(masks)], ["doc_id", "mask"])
    return run


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each document and a signature that near copies share. The
    low four bits of a feature are its kind."""
    for batch in batches:
        toxic = batch.column("toxic").to_pylist()
        for b in blocks(texts_of(batch)):
            spans = b.spans(ALNUM)
            doc = np.repeat(np.arange(b.n), np.diff(spans.bounds))
            found = [features(spans, k) for k in (0, *BEGINNINGS)]
            who = np.concatenate([doc[w] for w, _ in found])
            what = np.concatenate([(h & ~U64(15)) | U64(k) for k, (_, h) in zip((0, *BEGINNINGS), found)])
            order = np.argsort(who, kind="stable")
            who, what = who[order], what[order]
            cut = np.searchsorted(who, np.arange(b.n + 1))
            for i, sh in enumerate(shingle_sets(found[0][1], spans.bounds)):
                if len(sh):
                    f = np.unique(what[cut[i]:cut[i + 1]]).astype("<u8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(sh[0].astype(np.int64))]), pa.array([toxic[b.lo + i]], pa.int32()),
                         pa.array([f.tobytes()], pa.binary())], ["sign", "toxic", "features"])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class with each feature, added up in the task (rows of a bounded sample)."""
    by_class: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for batch in batches:
        for y, f in zip(batch.column("toxic").to_pylist(), batch.column("features").to_pylist()):
            by_class[int(y == 1)].append(np.frombuffer(f, "<u8"))
    for y, lists in by_class.items():
        if lists:
            f, n = np.unique(np.concatenate(lists), return_counts=True)
            for lo in range(0, len(f), 50_000):
                m = n[lo:lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[lo:lo + 50_000].astype(np.int64)), pa.array(m if y else 0 * m), pa.array(0 * m if y else m)],
                    ["feature", "d1", "d0"])


def mine_voters(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[int]:
    """At most MINED features (words and word beginnings) that lean to toxic rows.

    From at most ``sample`` labelled rows of each class, near copies counted
    once. Features with a z-score of MIN_Z and MIN_DF documents or more, and
    MIN_LIFT times as frequent in toxic rows, enter a covering: the best on the
    toxic rows that none yet covers comes next."""
    chosen = labels.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).unionAll(
        labels.filter("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic")     # at most 2 * ``sample`` ids
    rows = keep(rows.mapInArrow(thrifty(_feature_rows), "sign long, toxic int, features binary")
                .dropDuplicates(["sign", "toxic"]), "mined")
    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        return []
    df = (rows.select("toxic", "features").mapInArrow(thrifty(_feature_counts), "feature long, d1 long, d0 long")
          .groupBy("feature").agg(F.sum("d1").alias("d1"), F.sum("d0").alias("d0")))
    p = (F.col("d1") + F.col("d0")) / (n0 + n1)
    z = (F.col("d1") / n1 - F.col("d0") / n0) / F.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))
    top = (df.filter((F.col("d1") + F.col("d0") >= MIN_DF) & (F.col("d1") + F.col("d0") < n0 + n1))
           .withColumn("z", z).filter(F.col("z") >= MIN_Z)
           .filter(F.col("d1") / n1 >= MIN_LIFT * (F.col("d0") + 0.25) / n0)
           .orderBy(F.desc("z"), "feature").limit(CANDIDATES).collect())
    if not top:
        return []
    names = np.array([r["feature"] for r in top], np.int64)

    def has(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = [np.packbits(np.isin(names.astype(U64), np.frombuffer(f, "<u8"))).tobytes()
                    for f in b.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(bits, pa.binary())], ["toxic", "bits"])
    got = rows.select("toxic", "features").mapInArrow(thrifty(has), "toxic int, bits binary").collect()
    x = np.stack([np.unpackbits(np.frombuffer(r.bits, np.uint8))[:len(names)] for r in got]).astype(bool)
    return [int(names[j]) for j in cover(x, np.array([r.toxic for r in got]) == 1, names)]


def cover(x: np.ndarray, toxic: np.ndarray, names: np.ndarray) -> list[int]:
    """Greedy covering of toxic rows by columns of ``x`` (ties: the shorter beginning, then the name)."""
    chosen: list[int] = []
    open_, n0 = toxic.copy(), max(1, int((~toxic).sum()))
    d0 = x[~toxic].sum(0)
    while len(chosen) < MINED and open_.any():
        d1, n1 = x[open_].sum(0), int(open_.sum())
        p = (d1 + d0) / (n0 + n1)
        z = (d1 / n1 - d0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
        kind = names & 15
        j = int(np.lexsort((names, np.where(kind == 0, 99, kind), -np.round(z, 6)))[0])
        if z[j] < MIN_Z or d1[j] < MIN_DF // 2:
            break
        chosen.append(j)
        open_ &= ~x[:, j]
    return chosen


def _bits(mask: np.ndarray, m: int) -> np.ndarray:
    return ((mask[:, None] >> np.arange(m)) & 1).astype(float)


class LabelModel:
    """Hidden class, voters that fire with class-dependent rates, discounts for correlated voters."""

    def __init__(self, m: int, clean: Sequence[int] = ()):
        self.m = m
        self.prior = 0.1
        self.rate = np.stack([np.full(m, 0.01), np.full(m, 0.2)])     # P(fires | class)
        self.rate[:, list(clean)] = self.rate[::-1, list(clean)]      # voters that speak for class 0
        self.pseudo = np.where(self.rate > 0.1, 0.2, 0.02)            # fires in two made-up texts of each class
        self.label = np.array([0.03, 0.9])                            # P(label is 1 | class)
        self.weight = np.ones(m)

    def posterior(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """P(toxic | votes, label); an abstaining voter says nothing, label -1 is none."""
        r = self.rate
        s = np.log(self.prior / (1 - self.prior)) + x @ (self.weight * np.log(r[1] / r[0]))
        said = np.log(self.label[1] / self.label[0]) * (label == 1) \
            + np.log((1 - self.label[1]) / (1 - self.label[0])) * (label == 0)
        return 1 / (1 + np.exp(-np.clip(s + said, -40, 40)))

    def update(self, s: np.ndarray) -> None:
        """M step from the sums of ``moments`` (class, 1 + m + m * m + 2)."""
        n = s[:, 0]
        if n.sum() == 0:
            return
        self.prior = float(np.clip((n[1] + 1) / (n.sum() + 10), 1e-3, 0.5))
        fired = s[:, 1:1 + self.m]
        self.rate = np.clip((fired + self.pseudo) / (n[:, None] + 2.0), 1e-5, 1 - 1e-5)
        yes, all_ = s[:, -2], s[:, -1]
        self.label = np.clip((yes + np.array([3.0, 90.0])) / (all_ + 100.0), [1e-3, 0.6], [0.2, 0.999])
        # within-class correlations, mean over the classes by size of class 1
        rho = np.zeros((self.m, self.m))
        for y in (0, 1):
            if n[y] > 0:
                mean = fired[y] / n[y]
                cov = s[y, 1 + self.m:-2].reshape(self.m, self.m) / n[y] - np.outer(mean, mean)
                sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
                rho += 0.5 * np.where(np.minimum.outer(fired[y], fired[y]) >= 5, cov / np.outer(sd, sd), 0)
        np.fill_diagonal(rho, 0)
        self.rho = rho
        self.weight = 1 / (1 + np.where(rho > 0.3, rho, 0).sum(1))


def _sums(patterns: DataFrame, fn, shape: tuple) -> np.ndarray:
    """Sum over all vote patterns of fn(bits mask, label, count); every task sends one array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            total = total + fn(b.column("mask").to_numpy(), b.column("label").to_numpy(), b.column("n").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])
    rows = patterns.mapInArrow(thrifty(run), "total binary").collect()
    return sum((np.frombuffer(r.total).reshape(shape) for r in rows), np.zeros(shape))


def _moments(model: LabelModel, first: bool):
    m = model.m

    def fn(mask, label, n):
        x = _bits(mask, m)
        q = np.where(label >= 0, label, 0.0) if first else model.posterior(x, label)
        use = (label >= 0) if first else np.ones(len(n), bool)
        out = np.zeros((2, 1 + m + m * m + 2))
        for y, w in ((0, (1 - q) * n * use), (1, q * n * use)):
            out[y, 0] = w.sum()
            out[y, 1:1 + m] = w @ x
            out[y, 1 + m:-2] = ((x * w[:, None]).T @ x).ravel()
            out[y, -2:] = (w * (label == 1)).sum(), (w * (label >= 0)).sum()
        return out
    return fn


def fit_label_model(patterns: DataFrame, m: int, steps: int = EM_STEPS, clean: Sequence[int] = ()) -> LabelModel:
    model = LabelModel(m, clean)
    shape = (2, 1 + m + m * m + 2)
    start = _sums(patterns, _moments(model, True), shape)
    if start[:, 0].min() > 0:
        start[:, -2:] = 0                 # the labels' own reliability is not read from themselves
        model.update(start)
    for _ in range(steps):
        model.update(_sums(patterns, _moments(model, False), shape))
    return model


def fit_linear(patterns: DataFrame, model: LabelModel, steps: int = FIT_STEPS) -> np.ndarray:
    """Weights (bias last) of a logistic regression on the posterior labels, by Newton steps."""
    m = model.m
    w = np.zeros(m + 1)
    w[-1] = np.log(model.prior / (1 - model.prior))
    for _ in range(steps):
        def fn(mask, label, n, w=w):
            x = np.hstack([_bits(mask, m), np.ones((len(mask), 1))])
            q = model.posterior(x[:, :m], label)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            h = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
            return np.vstack([h, (n * (q - p)) @ x])
        s = _sums(patterns, fn, (m + 2, m + 1))
        ridge = RIDGE * np.eye(m + 1)
        ridge[-1, -1] = 0
        step = np.linalg.solve(s[:-1] + ridge + 1e-6 * np.eye(m + 1), s[-1] - ridge @ w)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return w


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic of the rows that may be learnt from (crc32 of the id as text mod 5 is not 0).

    Null labels and ids are left out; of several labels of an id the larger counts."""
    return (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
            .filter(fold(F.col("doc_id"), FOLDS) != HELD))


class ToxicityModel:
    """The fitted voters and weights, and the votes of the documents they were fitted on."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        docs = docs.select(F.col("doc_id").cast("long"), "text")
        known = training_labels(labels)
        mined = mine_voters(docs, known)
        kinds = [0] * len(LEXICON) + [h & 15 for h in mined]
        # the low four bits hold the kind of a mined feature; hashes are compared without them
        hashes = np.concatenate([word_hash(list(LEXICON)), np.array(mined, np.int64).astype(U64)]) & ~U64(15)
        bits = [*range(len(LEXICON)), *(len(LEXICON) + len(PATTERNS) + i for i in range(len(mined)))]
        self.vocab, self.m = Vocabulary(kinds, hashes, bits), len(LEXICON) + len(PATTERNS) + len(mined)
        self.votes = keep(docs.mapInArrow(thrifty(_voter(self.vocab)), "doc_id long, mask long"), "votes")
        patterns = keep(self.votes.join(known, "doc_id", "left")
                        .groupBy("mask", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n")),
                        "patterns")
        self.weights = fit_linear(patterns, fit_label_model(patterns, self.m, clean=[SILENT]))


def _score(mask: np.ndarray, m: int, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_bits(mask, m) @ weights[:-1] + weights[-1], -40, 40)))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text), labels (doc_id, toxic) -> doc_id, held_out, score, predicted.

    Labels are read only from rows outside the held-out fold; no label,
    language, source or id is an input of a score. Null and empty texts have no
    word votes and get the score of none. A null id is not held out and has no
    label; repeated rows are scored alike; without labels of both classes the label
    model starts from fixed rates, the silent voter's the other way round; tied and very long texts are scored
    whole and alike; an empty table gives no rows; extra columns are ignored."""
    model = ToxicityModel(docs, labels)
    m, weights = model.m, model.weights

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_score(b.column("mask").to_numpy(), m, weights))], ["doc_id", "score"])
    out = model.votes.mapInArrow(thrifty(score), "doc_id long, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns unchanged, nothing is joined or shuffled.

    Null and empty texts stay, as no word voter fires on them; repeated rows share their fate; an empty
    table stays empty. Any other column, whatever its name, passes through."""
    model = ToxicityModel(docs, labels)
    vocab, m, weights = model.vocab, model.m, model.weights

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [votes(b, vocab) for b in blocks(texts_of(batch))]
            if masks:
                yield batch.filter(pa.array(_score(np.concatenate(masks), m, weights) < 0.5))
    return docs.mapInArrow(thrifty(clean), docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from weak voters and the labels outside the held-out fold."""
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
