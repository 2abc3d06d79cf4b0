"""Document fingerprints from closed syncmers.

A k-mer of a text's UTF-8 bytes is a closed syncmer when the smallest hash of
its inner s-mers is the first or the last of them. Whether it is one depends on
the k-mer alone, so equal passages have equal anchors wherever they stand. The
fingerprint keeps the anchors below a fixed hash threshold (one in ``RATE``, and
the ``LEAST`` lowest of a short text) with their places, so it grows with the
text. Likeness counts the anchors of both texts that match by place: the share
of the anchors of either that stand in a passage of both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, read, shuffle_parts
from .nptext import _BYTE, _TAG, U64, Block, _powers, blocks, mix, texts_of

K, S, RATE, LEAST = 16, 8, 16, 16


def block_anchors(b: Block, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """(byte positions in the block, hashes) of all closed syncmers; a text of fewer than k
    bytes has itself as its one anchor, an empty one none."""
    pw, inv = _powers(len(b.buf))
    pre = np.zeros(len(b.buf) + 1, U64)
    np.cumsum(_BYTE[b.buf] * pw, out=pre[1:])
    short = np.flatnonzero((b.len < k) & (b.len > 0))
    at = b.off[short]
    pos, hashes = [at], [mix((pre[at + b.len[short]] - pre[at]) * inv[at] + _TAG[63] + b.len[short].astype(U64))]
    n = len(b.buf) - k + 1
    if n > 0:
        inner = mix((pre[s:] - pre[:-s]) * inv[:len(b.buf) - s + 1])
        w = k - s + 1
        low, size = inner, 1
        while size < w:                                  # running minimum of w in log2(w) steps
            step = min(size, w - size)
            low, size = np.minimum(low[:-step], low[step:]), size + step
        low = low[:n]
        closed = np.flatnonzero((inner[:n] == low) | (inner[w - 1:w - 1 + n] == low))
        doc = np.searchsorted(b.off, closed, "right") - 1
        closed = closed[closed + k <= (b.off + b.len)[doc]]
        pos.append(closed)
        hashes.append(mix((pre[closed + k] - pre[closed]) * inv[closed] + _TAG[k]))
    pos, hashes = np.concatenate(pos), np.concatenate(hashes)
    order = np.argsort(pos, kind="stable")
    return pos[order], hashes[order]


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """(place, hash) of all anchors of every text, in text order."""
    out = []
    for b in blocks(texts):
        pos, h = block_anchors(b)
        cut = np.searchsorted(pos, np.append(b.off, len(b.buf)))
        out += [np.stack([(pos[x:y] - b.off[d]).astype(U64), h[x:y]], 1)
                for d, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist()))]
    return out


def position_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Anchors of ``a`` that match one of ``b`` by place: anchors that each text has once, and repeated
    ones at the distance of a neighbour's match."""
    if not len(a) or not len(b):
        return 0
    at, to, ha, hb = a[:, 0].astype(np.int64), b[:, 0].astype(np.int64), a[:, 1], b[:, 1]
    order_a, order_b = np.argsort(ha, kind="stable"), np.argsort(hb, kind="stable")
    sa, sb = ha[order_a], hb[order_b]
    lo, n_b = np.searchsorted(sb, ha, "left"), np.searchsorted(sb, ha, "right")
    n_b -= lo
    if not n_b.any():
        return 0
    first = np.searchsorted(sa, ha, "left")
    n_a, rank = np.searchsorted(sa, ha, "right") - first, np.empty(len(a), np.int64)
    rank[order_a] = np.arange(len(a))
    rank -= first
    i = np.flatnonzero(rank < n_b)                        # the n-th in a with the n-th in b
    j = order_b[lo[i] + rank[i]]
    gap = to[j] - at[i]
    same = gap[1:] == gap[:-1]
    sure = ((n_a[i] == 1) & (n_b[i] == 1)) | np.append(same, False) | np.append(False, same)
    i, j, gap = i[sure], j[sure], gap[sure]
    if len(i) and len(i) < len(a):
        rest = np.setdiff1d(np.flatnonzero(n_b > 0), i, assume_unique=True)
        k = np.searchsorted(i, rest)
        more_i, more_j = [i], [j]
        for near in (np.maximum(k - 1, 0), np.minimum(k, len(i) - 1)):
            goal = at[rest] + gap[near]
            x = np.minimum(np.searchsorted(to, goal), len(to) - 1)
            ok = (to[x] == goal) & (hb[x] == ha[rest])
            more_i.append(rest[ok])
            more_j.append(x[ok])
        i, j = np.unique(np.concatenate(more_i)), np.concatenate(more_j)
    return min(len(i), len(np.unique(j)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both texts that match by place; two empty ones are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    n = position_matches(a, b)
    return n / (len(a) + len(b) - n)


def chosen(sketch: np.ndarray) -> np.ndarray:
    """The fingerprint's anchors (place, hash) in text order: those below a fixed hash threshold, LEAST at least."""
    if not len(sketch):
        return sketch
    h = sketch[:, 1]
    low = h < U64(2 ** 64 // RATE)
    if low.sum() < LEAST:
        low = h <= np.partition(h, min(LEAST, len(h)) - 1)[min(LEAST, len(h)) - 1]
    return sketch[low]


def as_bytes(sketch: np.ndarray) -> bytes:
    """The fingerprint: twelve bytes an anchor, the higher first: places since the one before, hash."""
    kept = chosen(sketch)
    out = np.zeros(len(kept), [("gap", ">u4"), ("hash", ">u8")])
    if len(kept):
        out["gap"], out["hash"] = np.diff(kept[:, 0], prepend=U64(0)), kept[:, 1]
    return out.tobytes()


def from_bytes(prints: bytes) -> np.ndarray:
    """The anchors (place, hash) of a fingerprint."""
    got = np.frombuffer(prints, [("gap", ">u4"), ("hash", ">u8")])
    return np.stack([np.cumsum(got["gap"], dtype=U64), got["hash"].astype(U64)], 1)


def print_likeness(a: bytes, b: bytes) -> float:
    """Likeness of two fingerprints, from nothing but their bytes; equal ones have 1."""
    return 1.0 if a == b else likeness(from_bytes(a), from_bytes(b))


def as_text(sketch: np.ndarray) -> str:
    return as_bytes(sketch).hex()


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        pos_rows, hash_rows = [], []
        for b in blocks(texts_of(batch)):
            pos, h = block_anchors(b)
            cut = np.searchsorted(pos, np.append(b.off, len(b.buf)))
            for d, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                pos_rows.append(pos[x:y] - b.off[d])
                hash_rows.append(h[x:y].astype(np.int64))
        yield pa.RecordBatch.from_arrays([ids, pa.array(pos_rows, pa.list_(pa.int64())),
                                          pa.array(hash_rows, pa.list_(pa.int64()))], ["doc_id", "positions", "anchors"])


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, positions (bytes), anchors (hashes), in text order."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _anchor_rows, "doc_id long, positions array<bigint>, anchors array<bigint>")


def matched_passages(a: tuple, b: tuple, k: int = K) -> list[tuple[int, int, int]]:
    """Passages that two anchor lists (positions, hashes) share, as (start in a, start in b, bytes):
    equal anchors at one distance, joined where they overlap or touch. Anchors that occur more than
    once in a list are left to their neighbours."""
    def single(x):
        h, i, n = np.unique(np.asarray(x[1]), return_index=True, return_counts=True)
        return dict(zip(h[n == 1].tolist(), np.asarray(x[0])[i[n == 1]].tolist()))
    pa_, pb = single(a), single(b)
    hits = sorted((pb[h] - pa_[h], pa_[h]) for h in pa_.keys() & pb.keys())
    out: list[list[int]] = []
    for gap, at in hits:
        if out and out[-1][3] == gap and at <= out[-1][0] + out[-1][2]:
            out[-1][2] = max(out[-1][2], at + k - out[-1][0])
        else:
            out.append([at, at + gap, k, gap])
    return [tuple(x[:3]) for x in out]


_ROW = ("kind int, part int, doc_id long, text string, n_chars long, edited_sha256 string, prints binary, "
        "own int, near_edited double, near_next double")
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string()),
                     ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("prints", pa.binary()),
                     ("own", pa.int32()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    h = len(text) // 2
    return text[:len(text) - h] + following[:h]


def _compare(ids: list, texts: list[str], following: list[str], part: int) -> pa.RecordBatch:
    """Result rows of ``texts``, each with the text after it."""
    edited = [edit(t, f) for t, f in zip(texts, following)]
    raw = [e.encode() for e in edited]
    chain = len(following) > 0 and texts[1:] == following[:-1]
    own = sketches([t.encode() for t in ([*texts, following[-1]] if chain else texts)])
    nxt = own[1:] if chain else sketches([t.encode() for t in following])
    new = sketches(raw)
    prints, after, changed = ([as_bytes(x) for x in group] for group in (own[:len(texts)], nxt, new))
    return pa.RecordBatch.from_pylist([
        {"kind": 0, "part": part, "doc_id": ids[i], "text": None, "n_chars": len(texts[i]),
         "edited_sha256": hashlib.sha256(raw[i]).hexdigest(), "prints": prints[i] + changed[i],
         "own": len(prints[i]), "near_edited": print_likeness(prints[i], changed[i]),
         "near_next": print_likeness(prints[i], after[i])} for i in range(len(texts))], _SCHEMA)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows (kind 0) of all but the last document of an ordered partition; the first
    document's text (kind 1) and the last document (kind 2) go to the neighbours' step."""
    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        if not ids:
            continue
        if held is None:
            yield pa.RecordBatch.from_pylist([{"kind": 1, "part": part, "text": texts[0]}], _SCHEMA)
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = (ids[-1], texts[-1])
        for lo in range(0, len(ids) - 1, 500):
            hi = min(lo + 500, len(ids) - 1)
            yield _compare(ids[lo:hi], texts[lo:hi], texts[lo + 1:hi + 1], part)
    if held is not None:
        yield pa.RecordBatch.from_pylist([{"kind": 2, "part": part, "doc_id": held[0], "text": held[1]}], _SCHEMA)


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r = batch.to_pylist()
        if r:
            yield _compare([x["doc_id"] for x in r], [x["text"] for x in r], [x["following"] for x in r], 0)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Order: descending doc_id, null ids last, equal ids by text; the document
    after the last is the first, so a single document follows itself. Null texts
    are empty: an empty fingerprint, like another empty one (1) and unlike all
    others (0). Repeated rows follow each other; an empty table gives no rows;
    extra columns are ignored. One shuffle of the texts by ranges of ids; only
    each range's first and last document meet in a second, small step."""
    n = shuffle_parts(docs.sparkSession)
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    rows = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(n, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order))
    done = keep(rows.mapInArrow(_in_order, _ROW), "fingerprints")
    # two rows a range: as many as shuffle partitions
    first = done.filter("kind = 1").select("part", F.col("text").alias("head"))
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = first.select("part", F.coalesce(F.lead("head").over(Window.orderBy("part")), F.first("head").over(by_part))
                         .alias("following"))
    last = done.filter("kind = 2").select("part", "doc_id", "text").join(heads, "part")
    edges = last.select("doc_id", "text", "following").mapInArrow(_at_edges, _ROW)
    out = done.filter("kind = 0").unionAll(edges)
    own, edited = F.expr("substring(prints, 1, own)"), F.expr("substring(prints, own + 1)")
    return out.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex(own)).alias("fingerprint"),
                      F.lower(F.hex(edited)).alias("edited_fingerprint"), "near_edited", "near_next")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-syncmer fingerprints of every document and its edited text."""
    return fingerprint_documents(read(spark, sf_dir, "documents"))
