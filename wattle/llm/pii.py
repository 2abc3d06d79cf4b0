"""Personal data: candidate spans scored by gradient-boosted trees.

The base rules always count. Besides them, generators of high recall propose
overlapping spans (written-out or bracketed "at" and "dot", numbers without a
plus, spaced addresses, other separators). Boosted trees per kind, trained here
on a bounded sample of the texts that hold the kind, score each proposal from
its format and its context; thresholds, one for each form that a kind is written
in, calibrated for precision on the scores of all texts outside the training
select what is added. The trees learn from the base spans, from the same spans
disguised in their own sentences, and from corrupted and wrongly cut ones as
negatives. A proposal that no base span touches may be right or wrong: the trees
take it as a negative of little weight, the thresholds do not count it, so much
disguised data in a table does not speak against itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_kept, keep, read

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 4_000                 # distinct texts a kind (lowest hashes of those with its base spans); half of them train
NATURAL = 64                   # proposals a kind and text that train
STEPS = 64                     # score bins a unit of the logit
ROUNDS, RATE, DEPTH, BINS = 30, 0.3, 3, 16
UNSURE = 0.1                   # weight in the training of a proposal that no base span touches
PRECISION, LEAST = 0.99, 20    # a form adds nothing unless LEAST proposals outside the training reach this precision

_LOCAL = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) <= 3 and int(s or "0") <= 255


def find_emails(t: str) -> list[Span]:
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = t.find("@", max(at + 1, end))
    return out


def find_ips(t: str) -> list[Span]:
    out = []
    for m in _NUMBERS.finditer(t):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):            # leftmost, not overlapping: four numbers each
            four = parts[i:i + 4]
            size = sum(map(len, four)) + 3
            if all(map(_octet, four)):
                out.append((at, at + size))
            at += size + 1
    return out


def find_cards(t: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(t)
            if len(m[0]) >= 16 and 16 <= len(d := only_digits(m[0])) <= 19 and luhn(d)]


def find_phones(t: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(t) if 8 <= len(only_digits(m[0])) <= 15]


FINDERS = {"email": find_emails, "ip": find_ips, "card": find_cards, "phone": find_phones}


def base_spans(t: str) -> dict[str, list[Span]]:
    return {k: f(t) for k, f in FINDERS.items()}


# --- proposals

_RUN = re.compile(r"[0-9][0-9 ().,/\-]{5,}[0-9]")
_GROUP = re.compile(r"[0-9]+")
_AT = re.compile(r"@|[(\[{<]\s?at\s?[)\]}>]|(?<=\s)at(?=\s)", re.I)
_DOT = r"\s?(?:\.|[(\[{<]\s?dot\s?[)\]}>]|(?<=\s)dot(?=\s))\s?"
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_LABELS = re.compile(rf"(?:{_DOT})([A-Za-z0-9-]+)", re.I)
_GAP = re.compile(r"[ ().,/\-]{0,3}(?=[0-9])")
MOST_DIGITS = 21                                          # of a card number
LABELS = 127                                              # a domain name has no more labels


def propose_emails(t: str) -> Iterator[Span]:
    """Every mark, written in any case, with the local part before it and each run of labels after it.
    The word "at" needs a dot of some form after it."""
    for m in _AT.finditer(t):
        s, e = m.span()
        while s and t[s - 1].isspace():
            s -= 1
        while e < len(t) and t[e].isspace():
            e += 1
        start = s
        while start and t[start - 1] in _LOCAL:
            start -= 1
        label = _LABEL.match(t, e) if start < s else None
        for n in range(LABELS):
            if not label:
                break
            if n or len(m[0]) != 2:
                yield start, label.end()
            label = _LABELS.match(t, label.end())


def propose(t: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of everything that may be personal data; spans may overlap. Of a run of
    numbers each stretch of neighbouring groups counts whose digits fit the kind."""
    found = [("email", s, e) for s, e in propose_emails(t)]
    for m in _RUN.finditer(t):
        groups = [g.span() for g in _GROUP.finditer(t, *m.span())]
        for i, (s, _) in enumerate(groups):
            s0, d = s, 0
            while s0 and t[s0 - 1] in "+(" and s - s0 < 2:
                s0 -= 1
            for n, (at, e) in enumerate(groups[i:], 1):
                d += e - at
                if d > MOST_DIGITS:
                    break
                if 7 <= d <= 17:
                    found.append(("phone", s0, e))
                if 13 <= d:
                    found.append(("card", s, e))
                if n == 4 and d <= 12:
                    found.append(("ip", s, e))
    return found


# Words whose presence shortly before a span is a feature.
CONTEXT = {"email": ("mail", "contact", "write", "e-mail", "email"), "ip": ("ip", "address", "host", "server"),
           "card": ("card", "visa", "credit", "account", "payment"), "phone": ("tel", "phone", "call", "fax", "mobile")}


def features(t: str, kind: str, s: int, e: int) -> list[float]:
    x, before, after = t[s:e], t[max(0, s - 24):s].lower(), t[e:e + 1]
    d, groups = only_digits(x), [g for g in re.split(r"[^0-9]+", x) if g]
    seps = re.findall(r"[^A-Za-z0-9]+", x)
    edge = before[-1:]
    return [len(x), len(d), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
            sum(c.isalpha() for c in x), x.count("."), x.count("-"), x.count(" "), x.count("/") + x.count(","),
            x.count("(") - x.count(")"), float(x[:1] == "+" or edge == "+"), float(d[:1] == "0"),
            float(len(set(seps)) <= 1), float(luhn(d)) if 13 <= len(d) <= 19 else -1.0,
            float(all(map(_octet, groups))) if len(groups) == 4 else -1.0,
            float(edge.isalnum()) + 2 * float(edge in "\"'=#$_:"), float(after.isalnum()) + 2 * float(after in "\"'=%$_:"),
            float(any(w in before for w in CONTEXT[kind])), float("@" in x) + 2 * float("at" in x.lower()),
            float(len(re.split(r"\W+", x)[-1])), float(len(set(d))) / max(1, len(d)),
            _gap(before[::-1], 0), _gap(t, e), float(_LABELS.match(t, e) is not None),
            float(x.count(". ") + x.count(" ."))]


def _gap(t: str, at: int) -> float:
    """1 + places to the next digit if only separators stand between, else 0."""
    m = _GAP.match(t, at)
    return 1.0 + len(m[0]) if m else 0.0


def _same(t: str, a: Span, b: Span) -> bool:
    """The same span, but for a leading plus or bracket."""
    return a[1] == b[1] and t[a[0]:a[1]].lstrip("+(") == t[b[0]:b[1]].lstrip("+(")


def form_of(kind: str, x: str) -> str:
    """How a span is written, one of a few forms a kind; each has its own threshold."""
    if kind == "email":
        return "mark" if "@" in x else "word"
    if kind == "phone":
        return "plus" if x.lstrip("(")[:1] == "+" else "zero" if only_digits(x)[:1] == "0" else "bare"
    seps = {c for c in x if not "0" <= c <= "9" and c != " "}
    return "plain" if not seps else min(seps) if len(seps) == 1 else "mixed"


def _national(x: str) -> str | None:
    """A phone number with a zero in place of its country's digits."""
    m = re.match(r"\+[0-9]{1,3}[ .-]+(?=[0-9])", x)
    return "0" + x[m.end():] if m else None


def _disguise(kind: str, x: str) -> tuple[list[str], list[str]]:
    """(disguised forms, corrupted forms) of a base span."""
    d = only_digits(x)
    if kind == "email":
        local, _, domain = x.partition("@")
        return ([f"{local} at {domain.replace('.', ' dot ')}", f"{local} (at) {domain}", f"{local}[at]{domain}",
                 f"{local} @ {domain}", f"{local} at {domain}", f"{local} AT {domain.replace('.', ' DOT ')}",
                 f"{local} at {domain.replace('.', ' [dot] ')}", f"{local} (at) {domain.replace('.', ' (dot) ')}"], [f"{local}@", f"{local} at {domain.split('.')[0]}", f"{local} @ {domain.split('.')[0]}",
                                                         f"{local} at {domain.replace('.', '. ')}"])
    if kind == "ip":
        p = x.split(".")
        return [" . ".join(p), ". ".join(p), "-".join(p)], [".".join(str(int(y) + 256) for y in p), ", ".join(f"{y}0" for y in p),
                                                            "/".join(f"{y}{y}" for y in p)]
    if kind == "card":
        four = [d[i:i + 4] for i in range(0, len(d), 4)]
        wrong = d[:-1] + str((int(d[-1]) + 1 + int(d[0]) % 8) % 10)
        return [".".join(four), "/".join(four), "  ".join(four)], [wrong, ".".join(wrong[i:i + 4] for i in range(0, len(d), 4))]
    home = _national(x)
    return ([x.lstrip("+"), "00" + x.lstrip("+"), x.lstrip("+").replace(" ", "."), *([home] if home else [])], [d[:6], d[:3] + "," + d[3:6] + "," + d[6:9], d[:4] + "/" + d[4:8]])


class Taken:
    """Places already taken, as disjoint spans in order."""

    def __init__(self, spans: list[Span]):
        self.spans: list[Span] = []
        for s, e in sorted(spans):
            if self.spans and s < self.spans[-1][1]:
                self.spans[-1] = (self.spans[-1][0], max(e, self.spans[-1][1]))
            else:
                self.spans.append((s, e))

    def overlaps(self, s: int, e: int) -> bool:
        i = bisect_left(self.spans, (e,))
        return i > 0 and self.spans[i - 1][1] > s

    def add(self, s: int, e: int) -> None:
        insort(self.spans, (s, e))


def proposals(t: str, base: dict[str, list[Span]]) -> Iterator[tuple[str, int, int, bool, bool]]:
    """(kind, start, end, is a base span of its kind, overlaps no base span) of every proposal; those
    that overlap base spans of other kinds alone are left out."""
    taken, own = Taken([z for v in base.values() for z in v]), {k: Taken(v) for k, v in base.items()}
    ends = {k: {z[1]: z for z in v} for k, v in base.items()}
    for k, s, e in propose(t):
        free = not taken.overlaps(s, e)
        if free or own[k].overlaps(s, e):
            yield k, s, e, e in ends[k] and _same(t, (s, e), ends[k][e]), free


def disguised(t: str, base: dict[str, list[Span]], most: int | None = None) -> Iterator[tuple[str, bool, str, list[float]]]:
    """(kind, is right, form, features) of what is proposed where base spans stand disguised or corrupted in their sentences."""
    for k, spans in base.items():
        for s, e in spans[:most]:
            left, right = t[max(0, s - 60):s], t[e:e + 60]
            good, bad = _disguise(k, t[s:e])
            texts = [(x, "", True) for x in good] + [(x, "", False) for x in bad]
            if k != "email":                              # two numbers side by side
                texts += [(x, mid + x, True) for x, mid in zip(good, (", ", " / ", " "))]
            for form, more, right_form in texts:
                text, at = left + form + more + right, (len(left), len(left) + len(form))
                for kind, s1, e1 in propose(text):
                    if kind == k and s1 < at[1] and e1 > at[0]:
                        yield k, right_form and _same(text, (s1, e1), at), form_of(k, text[s1:e1]), features(text, k, s1, e1)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[dict] = []
        for t in batch.column("text").to_pylist():
            base = base_spans(t)
            found: dict[str, list] = {k: [] for k in KINDS}
            for k, s, e, right, free in proposals(t, base):
                found[k].append((s, e, right, UNSURE if free else 1.0))
            for k, v in found.items():                    # examples of a text are bounded; this only feeds the training
                rows += [{"kind": k, "positive": int(right), "weight": w, "x": features(t, k, s, e)}
                         for s, e, right, w in v[::-(-len(v) // NATURAL) or 1]]
            rows += [{"kind": k, "positive": int(right), "weight": 1.0, "x": x} for k, right, _, x in disguised(t, base, 3)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.string()), ("positive", pa.int32()),
                                                          ("weight", pa.float64()), ("x", pa.list_(pa.float64()))]))


class Boosted:
    """Gradient-boosted depth-3 trees on binned features (logistic loss, Newton leaves)."""

    def __init__(self, trees: list | None = None, start: float = 0.0):
        self.trees, self.start = trees or [], start

    def fit(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None) -> "Boosted":
        w = np.ones(len(y)) if w is None else w
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], 1)
        p = np.clip((w * y).sum() / max(w.sum(), 1e-9), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.start)
        for _ in range(ROUNDS):
            q = 1 / (1 + np.exp(-score))
            g, h = w * (y - q), w * q * (1 - q)
            split, leaf, node = [], [], np.zeros(len(y), np.int64)
            for depth in range(DEPTH):
                for i in range(1 << depth):
                    split.append(self._best(binned, g, h, node == i, edges))
                level = split[(1 << depth) - 1:]
                node = 2 * node + np.array([x[:, f] > v for f, v in level])[node, np.arange(len(y))] if len(y) else node
            for i in range(1 << DEPTH):
                m = node == i
                leaf.append(float(RATE * g[m].sum() / (h[m].sum() + 1.0)))
            self.trees.append([split, leaf])
            score = score + np.array(leaf)[node]
        return self

    @staticmethod
    def _best(binned, g, h, rows, edges) -> tuple[int, float]:
        best = (0.0, 0, np.inf)
        gr, hr = g[rows], h[rows]
        total = gr.sum() ** 2 / (hr.sum() + 1)
        for j, e in enumerate(edges):
            if not len(e) or not len(gr):
                continue
            b = binned[rows, j]
            gl, hl = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (gr, hr))
            gain = gl ** 2 / (hl + 1) + (gr.sum() - gl) ** 2 / (hr.sum() - hl + 1) - total
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), j, float(e[k]))
        return best[1], best[2]

    def logit(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for split, leaf in self.trees:
            node, first = np.zeros(len(x), np.int64), 0
            for depth in range(DEPTH):
                f = np.array([s[0] for s in split[first:first + (1 << depth)]])
                v = np.array([s[1] for s in split[first:first + (1 << depth)]])
                node, first = 2 * node + (x[np.arange(len(x)), f[node]] > v[node]), first + (1 << depth)
            score += np.array(leaf)[node]
        return np.clip(score, -40, 40)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def lowest_cut(score: np.ndarray, y: np.ndarray, n: np.ndarray) -> float | None:
    """The lowest score from which on PRECISION of the proposals are right; ``n`` of them have a score and an answer."""
    order = np.argsort(-score, kind="stable")
    hits, all_ = np.cumsum((y * n)[order]), np.cumsum(n[order])
    last = np.append(score[order][1:] != score[order][:-1], True)   # only between different scores
    ok = np.flatnonzero(last & (hits >= PRECISION * all_) & (hits >= LEAST))
    return float(score[order][ok[-1]]) if len(ok) else None


def calibrate(p: np.ndarray, y: np.ndarray) -> float:
    """``lowest_cut`` of likelihoods, 0.5 at least (2: there is none)."""
    cut = lowest_cut(p, y, np.ones(len(p)))
    return 2.0 if cut is None else max(0.5, cut)


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    x, y, w = np.array(rows["x"].tolist(), float), rows["positive"].to_numpy(float), rows["weight"].to_numpy(float)
    if y.sum() < LEAST or (1 - y).sum() < 1:
        return pd.DataFrame({"kind": [rows["kind"].iloc[0]], "trees": ["[]"], "start": [0.0]})
    order = np.lexsort((*x.T, w, y))                                # the same rows in any order give the same trees
    model = Boosted().fit(x[order], y[order], w[order])
    return pd.DataFrame({"kind": [rows["kind"].iloc[0]], "trees": [json.dumps(model.trees)], "start": [model.start]})


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for h, t in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
            rows += [{"kind": k, "h": h} for k, v in base_spans(t).items() if v]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", pa.string()), ("h", pa.int64())]))


def draw(rows: DataFrame, sample: int = SAMPLE) -> dict[str, set[int]]:
    """A kind's hashes: the lowest ``sample`` of all distinct texts that hold a base span of it, and those in one step
    of the logarithm with the last."""
    step = F.floor(F.log2(F.shiftrightunsigned("h", 1).cast("double") + 1) * 16).alias("step")
    hits = keep(rows.mapInArrow(_kinds, "kind string, h long").distinct(), "personal-kinds")
    counts = sorted(hits.groupBy("kind", step).count().collect())   # at most 1,009 steps a kind
    out: dict[str, set[int]] = {}
    for kind in {r[0] for r in counts}:
        total, last = 0, 0
        for _, last, n in (r for r in counts if r[0] == kind):
            total += n
            if total >= sample:
                break
        out[kind] = {r.h for r in hits.filter((F.col("kind") == kind) & (step <= last)).select("h").collect()}
    drop_kept(hits)
    return out


def train(rows: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, Boosted], frozenset[int]]:
    """A model a kind, and the hashes of the texts it is from: half of those drawn, so that the others can calibrate."""
    hashes = frozenset(h for v in draw(rows, sample).values() for h in v if h % 2 == 0)
    if not hashes:
        return {}, hashes
    ids = rows.sparkSession.createDataFrame([(h,) for h in sorted(hashes)], "h long")
    examples = (rows.select("h", "text").join(F.broadcast(ids), "h", "left_semi").dropDuplicates(["h"])
                .repartition(16, "h").mapInArrow(_training_rows, "kind string, positive int, weight double, x array<double>"))
    got = examples.groupBy("kind").applyInPandas(_fit, "kind string, trees string, start double").collect()
    return {r.kind: Boosted(json.loads(r.trees), r.start) for r in got if r.trees != "[]"}, hashes


def scores(models: dict[str, Boosted], items: Iterator[tuple]) -> Iterator[tuple]:
    """(kind, features, *more) -> (kind, score, *more) of those that are rather right than wrong, in batches."""
    waiting: dict[str, list] = {k: [] for k in models}

    def flush(k: str) -> Iterator[tuple]:
        got, waiting[k] = waiting[k], []
        z = np.floor(models[k].logit(np.array([i[1] for i in got])) * STEPS).astype(int) if got else []
        return ((k, int(q), *i[2:]) for q, i in zip(z, got) if q >= 0)
    for i in items:
        if i[0] in waiting:
            waiting[i[0]].append(i)
            if len(waiting[i[0]]) >= 4096:
                yield from flush(i[0])
    for k in waiting:
        yield from flush(k)


def _items(batch: pa.RecordBatch, bases: list[dict], trained: frozenset[int]) -> Iterator[tuple]:
    """(kind, features, row, form, span or None, answer or None): the spans to choose from, and the answers to
    calibrate by. What no base span touches has no answer."""
    for i, (h, t) in enumerate(zip(batch.column("h").to_pylist(), batch.column("text").to_pylist())):
        held = h not in trained
        for k, s, e, right, free in proposals(t, bases[i]):
            if free or held:
                yield k, features(t, k, s, e), i, form_of(k, t[s:e]), (s, e) if free else None, None if free else int(right)
        if held:
            for k, right, form, x in disguised(t, bases[i]):
                yield k, x, i, form, None, int(right)


def cuts_of(scored: DataFrame) -> dict[tuple[str, str], int]:
    """The lowest score to accept for each form of a kind, from the histogram over all texts that the trees were
    not made from (a few forms, at most 5,121 scores)."""
    counts = (scored.select(F.explode("answers").alias("a")).groupBy("a.kind", "a.form", "a.score", "a.good").count().collect())
    out = {}
    for key in {(r[0], r[1]) for r in counts}:
        q, y, n = np.array([r[2:] for r in counts if (r[0], r[1]) == key], float).T
        cut = lowest_cut(q, y, n)
        if cut is not None:
            out[key] = int(cut)
    return out


def choose(scored: list[tuple[str, str, int, int, int]], base: dict[str, list[Span]],
           cuts: dict[tuple[str, str], int]) -> dict[str, list[Span]]:
    """Accepted of the scored proposals (kind, form, start, end, score), which overlap no base span; of overlapping ones the
    likelier, then the earlier and longer."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    taken = Taken([z for v in base.values() for z in v])
    for _, s, e, kind in sorted((-q, s, -e, k) for k, f, s, e, q in scored if (k, f) in cuts and q >= cuts[k, f]):
        if not taken.overlaps(s, -e):
            taken.add(s, -e)
            out[kind].append((s, -e))
    return out


def join_spans(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


def _spans_of(joined: str) -> dict[str, list[Span]]:
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    for k, s, e in (x.split(":") for x in joined.split(",") if x):
        out[k].append((int(s), int(e)))
    return out


def find_personal_data(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    Counts and digest are of the base spans; ``spans`` also holds what the trees
    add. Places are code points, end exclusive. Null and empty texts have no
    spans; null ids and repeated rows are rows like others; an empty table gives
    no rows; without enough examples of a kind nothing of it is added; of tied
    proposals the earlier and longer counts; texts of any length are searched
    whole; extra columns are ignored. Hashes and the bounded training sample are shuffled,
    not the texts; spans and scores are written to the shared folder once."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("h"))
    models, trained = train(rows, sample)
    part = pa.struct([("kind", pa.string()), ("form", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())])
    answer = pa.struct([("kind", pa.string()), ("form", pa.string()), ("score", pa.int32()), ("good", pa.int32())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [base_spans(t) for t in batch.column("text").to_pylist()]
            free: list[list] = [[] for _ in bases]
            answers: list[list] = [[] for _ in bases]
            for k, q, i, form, span, good in scores(models, _items(batch, bases, trained)):
                if span:
                    free[i].append({"kind": k, "form": form, "start": span[0], "end": span[1], "score": q})
                if good is not None:
                    answers[i].append({"kind": k, "form": form, "score": q, "good": good})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(map(join_spans, bases)), pa.string()),
                 pa.array(free, pa.list_(part)), pa.array(answers, pa.list_(answer))], ["doc_id", "base", "free", "answers"])
    scored = keep(rows.mapInArrow(score, "doc_id long, base string, free array<struct<kind:string,form:string,start:int,end:int,score:int>>, "
                                         "answers array<struct<kind:string,form:string,score:int,good:int>>"), "personal-data")
    cuts = cuts_of(scored)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for d, joined, free in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "base", "free"))):
                base = _spans_of(joined)
                more = choose([(c["kind"], c["form"], c["start"], c["end"], c["score"]) for c in free], base, cuts)
                out.append({"doc_id": d, **{f"n_{k}": len(base[k]) for k in KINDS},
                            "base_sha256": hashlib.sha256(joined.encode()).hexdigest(),
                            "spans": join_spans({k: base[k] + more[k] for k in KINDS}),
                            "n_added": sum(map(len, more.values()))})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
                ("spans", pa.string()), ("n_added", pa.int64())]))
    return scored.select("doc_id", "base", "free").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str, spans: str) -> str:
    """``text`` with every span of a ``spans`` string replaced by its kind in brackets."""
    at = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    out, end = [], 0
    for s, e, k in at:
        if s >= end:
            out += [text[end:s], f"[{k}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base rules, and proposals that the boosted trees accept."""
    return find_personal_data(read(spark, sf_dir, "documents"))
