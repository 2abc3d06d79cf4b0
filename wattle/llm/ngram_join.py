"""N-gram Jaccard join: count-vector R-tree over exactly routed points.

A document's set of distinct 5-word shingles is a point: shingle hashes fall
into ``GROUPS`` groups and the counts by group are its coordinates. The overlap
of two sets is at most the sum over the groups of the smaller count, and at
most that sum with a node's upper corner for all points below an R-tree node.
Sets link when 100 * |A and B| >= 80 * |A or B|, that is 9 * overlap >= 4 * (|A| + |B|).

In so many dimensions the corners of a tree over a whole corpus bound nothing (any
two random documents of 300 shingles are inside each other's node), so one tree
would compare all with all. Points are therefore routed first, without loss:
in any common order linked sets share k of each other's |A| - ceil(0.8 |A|) + k
first shingles, as far as they share k at all. The order puts shingles of rarer
hash cells first (a sketch of fixed size counts them), so a passage that many
documents share routes only documents made of little else. A set that shares fewer
than ``MEET`` of its routing shingles with any others has no link and leaves before
its text moves: a few common words meet by chance, and the more so the larger the
corpus. A tree then holds the points that share a routing shingle, in blocks of at
most ``CELL`` points.

Equal sets are one point. Before the trees, in rounds, each min-hash class is
compared with one member, another one in every class; what is then known to be
connected needs no further pair, so a large group of near copies costs about
its size, not its square.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import drop_kept, keep, read, shuffle_parts, thrifty
from .components import components, contracted, labels
from .membership import may_contain, only_known, passes
from .nptext import NONSPACE, U64, blocks, mix, shingle_sets, texts_of

SHINGLE, GROUPS = 5, 256
#: routing shingles that linked sets share at least (all they share, if that is fewer)
MEET = 8
#: min-hash classes of the rounds that come before the trees
ROUNDS = (4, 8, 12)
MINS = sum(ROUNDS)
SKETCH_BITS, SKETCH_CHUNK = 22, 1 << 16
CELL, LEAF, FAN, REGION = 4096, 32, 16, 4096


def linked(common, a, b):
    """The contract's test on set sizes (works on numbers and numpy arrays)."""
    return 9 * common >= 4 * (a + b)


def set_id(s: np.ndarray) -> int:
    """64-bit identity of a shingle set (two sets share one with a chance of about 2**-64)."""
    if not len(s):
        return 0
    both = int(s.sum(dtype=U64)) ^ (3 * int(mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64)))
    return int(mix(np.array([both & (1 << 64) - 1], U64)).astype(np.int64)[0])


HUGE = 65_535


def count_vector(s: np.ndarray) -> np.ndarray:
    """Counts by group in 16 bits; a set of HUGE shingles or more has HUGE everywhere, so that
    summed minima with it are still no smaller than the overlap."""
    if len(s) >= HUGE:
        return np.full(GROUPS, HUGE, "<u2")
    return np.bincount((s >> U64(64 - GROUPS.bit_length() + 1)).astype(np.int64), minlength=GROUPS).astype("<u2")


def vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, GROUPS)


def document_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """(row of the batch, text, shingle set) of every row."""
    for b in blocks(texts_of(batch)):
        words, bounds = b.words(NONSPACE)
        raw = b.buf.tobytes()
        for i, s in enumerate(shingle_sets(words, bounds, SHINGLE)):
            yield b.lo + i, raw[b.off[i]:b.off[i] + b.len[i]], s


_MULT = mix(np.arange(71, 71 + MINS, dtype=U64)) | U64(1)
PROFILE = "kind int, doc_id long, n_shingles long, set_id long, counts binary"
ROUTED = "set_id long, n_shingles long, counts binary, mins array<bigint>, text binary"


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a row a document. Kind 1: the task's sketch in chunks (chunk number in set_id)."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()),
                        ("set_id", pa.int64()), ("counts", pa.binary())])
    sketch = np.zeros(1 << SKETCH_BITS, np.uint16)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        n, key, cells = [], [], []
        for _, _, s in document_sets(batch):
            n.append(len(s))
            key.append(set_id(s))
            cells.append((s >> U64(64 - SKETCH_BITS)).astype(np.int64))
        if cells:
            np.add.at(sketch, np.concatenate(cells), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
             pa.array(key, pa.int64()), pa.nulls(len(ids), pa.binary())], schema=schema)
    for i, c in enumerate(sketch.reshape(-1, SKETCH_CHUNK)):
        if c.any():
            small = zlib.compress(np.minimum(c, 255).astype(np.uint8).tobytes(), 1)
            yield pa.RecordBatch.from_pylist([{"kind": 1, "set_id": i, "counts": small}], schema)


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, c in zip(batch.column("set_id").to_pylist(), batch.column("counts").to_pylist()):
            total[i] = total.get(i, 0) + np.frombuffer(zlib.decompress(c), np.uint8).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()),
         pa.array([np.minimum(c, 65535).astype("<u2").tobytes() for c in total.values()], pa.binary())],
        ["set_id", "counts"])


def _sketch(profile: DataFrame) -> np.ndarray:
    """The corpus sketch: 2**SKETCH_BITS counters (8 MB), whatever the input. A task counts to 255
    a cell, the corpus to 65,535: the sketch only orders shingles, any fixed order is right."""
    n = (1 << SKETCH_BITS) // SKETCH_CHUNK
    rows = (profile.filter("kind = 1").select("set_id", "counts").repartition(min(n, shuffle_parts(profile.sparkSession)), "set_id")
            .mapInArrow(thrifty(_add_chunks), "set_id long, counts binary").collect())
    out = np.zeros(1 << SKETCH_BITS, np.uint16)
    for r in rows:
        out[r.set_id * SKETCH_CHUNK:(r.set_id + 1) * SKETCH_CHUNK] = np.frombuffer(r.counts, "<u2")
    return out


def prefix(s: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The routing shingles of a set: its first n - ceil(0.8 n) + MEET by (cell count, hash).
    Ties with the last one are all in."""
    n = len(s)
    p = n - (4 * n + 4) // 5 + MEET
    if p >= n:
        return s
    rank = (sketch[(s >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(U64) << U64(48)) | (s & U64((1 << 48) - 1))
    return s[rank <= np.partition(rank, p - 1)[p - 1]]


def _keys(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = sent.value, set()
        for batch in batches:
            keys, sets = [], []
            for _, _, s in document_sets(batch):
                d = set_id(s)
                if not len(s) or d in seen:      # a copy in the same task adds no routing row
                    continue
                if len(seen) < 200_000:
                    seen.add(d)
                keys.append(prefix(s, sketch).astype(np.int64))
                sets.append(np.full(len(keys[-1]), d))
            if keys:
                k, d = np.concatenate(keys), np.concatenate(sets)
                for lo in range(0, len(k), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(k[lo:lo + 100_000]), pa.array(d[lo:lo + 100_000])],
                                                     ["key", "set_id"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, set_id): one row a pair, without keys that have one set only."""
    held = None                                  # the last row and whether it is known to be shared
    names = ["key", "set_id"]
    for batch in batches:
        k, d = (batch.column(i).to_numpy() for i in range(2))
        if held is not None:
            k, d = np.concatenate([[held[0]], k]), np.concatenate([[held[1]], d])
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        k, d = k[new], d[new]
        if not len(k):
            continue
        same = np.zeros(len(k) + 1, bool)
        same[1:-1] = k[1:] == k[:-1]
        same[0] = held is not None and held[2]
        ok = same[:-1] | same[1:]
        yield pa.RecordBatch.from_arrays([pa.array(k[:-1][ok[:-1]]), pa.array(d[:-1][ok[:-1]])], names)
        held = (k[-1], d[-1], bool(same[-2]))
    if held is not None and held[2]:
        yield pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.int64())], names)


def _meeting(met: DataFrame, members: DataFrame) -> DataFrame:
    """Of the (key, set_id) rows of shared routing shingles, the sets with as many of them as any link needs:
    ``MEET``, or the ceil(0.8 n) shingles that a smaller set shares with each one linked to it."""
    sizes = members.filter("n_shingles > 0").groupBy("set_id").agg(F.min("n_shingles").alias("n"))
    return (met.groupBy("set_id").agg(F.count("*").alias("keys")).join(sizes, "set_id")
            .filter(f"keys >= least({MEET}, (4 * n + 4) div 5)").select("set_id"))


class CountTree:
    """Static R-tree over count vectors: points sorted by size, slabs of them by their
    fullest-varying coordinate; nodes keep the upper corner and the size range."""

    def __init__(self, vecs: np.ndarray, sizes: np.ndarray):
        m = len(sizes)
        slab = np.empty(m, np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(m) // max(LEAF, int(np.sqrt(m * LEAF)))
        axis = int(vecs.var(0).argmax()) if m else 0
        self.order = np.lexsort((sizes, vecs[:, axis], slab))
        self.vecs, self.sizes = vecs[self.order], sizes[self.order]
        self.levels = []                         # from the leaves up: (first child, high corner, min size, max size)
        high, lo, hi, step = self.vecs, self.sizes, self.sizes, LEAF
        while m and (not self.levels or len(high) > 1):
            at = np.arange(0, len(high), step)
            high, lo, hi = (np.maximum.reduceat(high, at, 0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at))
            self.levels.append((at, high, lo, hi))
            step = FAN

    def search(self, vecs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) pairs whose bound allows a link; queries one block at a time."""
        found = [self._search(vecs[lo:lo + 512], sizes[lo:lo + 512], lo) for lo in range(0, len(sizes), 512)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, vecs, sizes, base):
        if not self.levels:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, node = np.repeat(np.arange(len(sizes)), len(self.levels[-1][0])), \
            np.tile(np.arange(len(self.levels[-1][0])), len(sizes))
        for depth in range(len(self.levels) - 1, -1, -1):
            at, high, lo, hi = self.levels[depth]
            ok = (5 * hi[node] >= 4 * sizes[q]) & (4 * lo[node] <= 5 * sizes[q])
            q, node = q[ok], node[ok]
            ok = linked(overlap_bound(vecs, q, high, node), sizes[q], lo[node])
            q, node = q[ok], node[ok]
            below = len(self.levels[depth - 1][0]) if depth else len(self.sizes)
            first, last = at[node], np.append(at, below)[node + 1]
            n = last - first
            q = np.repeat(q, n)
            node = np.repeat(first, n) + np.arange(len(q)) - np.repeat(np.cumsum(n) - n, n)
        ok = (5 * self.sizes[node] >= 4 * sizes[q]) & (4 * self.sizes[node] <= 5 * sizes[q])
        q, node = q[ok], node[ok]
        ok = linked(overlap_bound(vecs, q, self.vecs, node), sizes[q], self.sizes[node])
        return q[ok] + base, self.order[node[ok]]


def overlap_bound(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of a[i] and b[j] (no bound for two huge sets)."""
    out = np.empty(len(i), np.int64)
    for lo in range(0, len(i), 1 << 12):
        s = slice(lo, lo + (1 << 12))
        out[s] = np.minimum(a[i[s]], b[j[s]]).sum(1, dtype=np.int64)
    out[out == GROUPS * HUGE] = 1 << 60
    return out


def _leaf_pairs(group: np.ndarray, vecs: np.ndarray, n: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one group that the bound lets through, for many groups of at most LEAF rows
    (each a tree of one leaf) at once: rows are compared at distance 1, 2, ... below LEAF."""
    a, b = [], []
    for d in range(1, LEAF):
        i = np.flatnonzero(group[:-d] == group[d:])
        if not len(i):
            break
        ok = (comp[i] != comp[i + d]) & (5 * n[i] >= 4 * n[i + d]) & (4 * n[i] <= 5 * n[i + d])
        a.append(i[ok])
        b.append(i[ok] + d)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _cell_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, cell): pairs of different components that a cell's tree lets through."""
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        ids, comp, part, n, key, ci, cj = (rows.column(c).to_numpy() for c in
                                           ("set_id", "comp", "part", "n_shingles", "key", "i", "j"))
        vecs = vectors(rows.column("counts"))
        new = np.append(True, (key[1:] != key[:-1]) | (ci[1:] != ci[:-1]) | (cj[1:] != cj[:-1]))
        group, at = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(key))
        size = np.diff(at)
        small = np.flatnonzero((size <= LEAF)[group] & (ci == cj))
        a, b = _leaf_pairs(group[small], vecs[small], n[small], comp[small])
        left, right = [small[a]], [small[b]]
        for g in np.flatnonzero((size > LEAF) | (ci != cj)[at[:-1]]):
            row = np.arange(at[g], at[g + 1])
            x, y = row[part[row] == ci[at[g]]], row[part[row] == cj[at[g]]]
            q, p = CountTree(vecs[y], n[y]).search(vecs[x], n[x])
            ok = comp[x[q]] != comp[y[p]]
            left.append(x[q[ok]])
            right.append(y[p[ok]])
        a, b = np.concatenate(left), np.concatenate(right)
        two, first = np.unique(np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])], 1), axis=0,
                               return_index=True)
        ok = linked(overlap_bound(vecs, a[first], vecs, b[first]), n[a[first]], n[b[first]])
        return pa.RecordBatch.from_arrays([pa.array(two[ok, 0], pa.int64()), pa.array(two[ok, 1], pa.int64())], ["a", "b"])

    def flush(found: list[np.ndarray]) -> pa.RecordBatch:
        two = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], ["a", "b"])

    def emit(rows: pa.Table, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Pairs that several routing shingles of neighbouring rows give go out once."""
        got = pairs(rows)
        found.append(np.stack([got.column(0).to_numpy(), got.column(1).to_numpy()], 1))
        if sum(map(len, found)) > 200_000:
            yield flush(found)
            found.clear()

    held: list[pa.RecordBatch] = []
    found: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[-1].as_py() for c in ("key", "i", "j")]
        same = np.ones(batch.num_rows, bool)
        for c, v in zip(("key", "i", "j"), last):
            same &= batch.column(c).to_numpy() == v
        if same.all() and (not held or [held[-1].column(c)[-1].as_py() for c in ("key", "i", "j")] == last):
            held.append(batch)                   # still inside one group
            continue
        cut = int(batch.num_rows - same.sum())   # rows are sorted: the last group is at the end
        yield from emit(pa.Table.from_batches([*held, batch.slice(0, cut)]), found)
        held = [batch.slice(cut)]
    if held:
        yield from emit(pa.Table.from_batches(held), found)
    if found:
        yield flush(found)


def _bound_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        va, vb = (vectors(batch.column(c)) for c in ("ca", "cb"))
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        every = np.arange(batch.num_rows)
        ok = linked(overlap_bound(va, every, vb, every), na, nb)
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])


def _texts(sent):
    """Points, min-hashes and texts of the sets that the sent table may contain; texts compressed: they are
    written once and shuffled in every round of verification."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=3).compress, set()
        for batch in batches:
            got = [(set_id(s), t, s) for _, t, s in document_sets(batch) if len(s)]
            ok = np.flatnonzero(passes(sent.value, np.array([g[0] for g in got], np.int64)))
            rows = []
            for d, t, s in (got[i] for i in ok):
                if d in seen:                    # a copy in the same task is the same point
                    continue
                if len(seen) < 200_000:
                    seen.add(d)
                rows.append((d, len(s), count_vector(s).tobytes(), (s[:, None] * _MULT).min(0).astype(np.int64), pack(t)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in
                 enumerate((pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary()))],
                ["set_id", "n_shingles", "counts", "mins", "text"])
    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact test on the texts' sets; the set of the previous row's first text is kept."""
    last: tuple = (None, None)
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        ok = []
        for i in range(len(a)):
            if last[0] != a[i]:
                last = (a[i], _set_of(batch.column("ta")[i].as_py()))
            other = _set_of(batch.column("tb")[i].as_py())
            common = len(np.intersect1d(last[1], other, assume_unique=True))
            ok.append(bool(linked(common, len(last[1]), len(other))))
        keep_rows = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep_rows) for c in ("a", "b")], ["a", "b"])


def _set_of(packed: bytes) -> np.ndarray:
    b = next(blocks([zstandard.ZstdDecompressor().decompress(packed)]))
    return next(shingle_sets(*b.words(NONSPACE), SHINGLE))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, written; texts of other sets are not shuffled."""
    pairs = keep(pairs, "pairs")
    ta = only_known(texts, "set_id", may_contain(pairs.select("a"))).select(F.col("set_id").alias("a"), F.col("text").alias("ta"))
    tb = only_known(texts, "set_id", may_contain(pairs.select("b"))).select(F.col("set_id").alias("b"), F.col("text").alias("tb"))
    rows = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb").sortWithinPartitions("a")
    return keep(rows.mapInArrow(thrifty(_verify), "a long, b long"), "links")


def _with_component(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    if known is None:
        return rows.withColumn("comp", F.col("set_id"))
    return (rows.join(known.withColumnRenamed("node", "set_id"), "set_id", "left")
            .withColumn("comp", F.coalesce("root", "set_id")).drop("root"))


def _star_pairs(sets: DataFrame, known: DataFrame | None, first: int, last: int) -> DataFrame:
    """Of the min-hash classes ``first:last``, pairs of a member and the class's centre that are not
    known to be connected and that the bound lets through. The centre has the smallest hash of
    (class, set), so classes of the same sets have different centres."""
    slots = _with_component(sets.select("set_id", F.posexplode(F.slice("mins", first + 1, last - first)).alias("slot", "m")), known)
    centre = slots.groupBy("slot", "m").agg(F.min_by(F.struct(F.col("set_id").alias("c"), F.col("comp").alias("cc")),
                                                     F.xxhash64("slot", "m", "set_id")).alias("centre"))
    star = (slots.join(centre, ["slot", "m"]).filter(F.col("comp") != F.col("centre.cc"))
            .select(F.least("set_id", "centre.c").alias("a"), F.greatest("set_id", "centre.c").alias("b")).distinct())
    one = sets.select(F.col("set_id").alias("a"), F.col("n_shingles").alias("na"), F.col("counts").alias("ca"))
    two = sets.select(F.col("set_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("counts").alias("cb"))
    return star.join(one, "a").join(two, "b").mapInArrow(thrifty(_bound_filter), "a long, b long")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, set_id, root: rows with one root are linked, directly or by
    others; the root of an empty set is null."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    n = shuffle_parts(spark)
    profile = keep(docs.mapInArrow(thrifty(_profile), PROFILE), "profile")
    members = keep(profile.filter("kind = 0").select("doc_id", "n_shingles", "set_id"), "members")
    sent = spark.sparkContext.broadcast(_sketch(profile))     # 8 MB, whatever the input
    drop_kept(profile)
    routed = docs.mapInArrow(thrifty(_keys(sent)), "key long, set_id long")
    met = keep(routed.repartition(n, "key").sortWithinPartitions("key", "set_id")
               .mapInArrow(thrifty(_shared), "key long, set_id long"), "met")
    ids = keep(_meeting(met, members), "ids")
    shared = keep(met.join(ids, "set_id", "left_semi").select("key", "set_id"), "shared")
    drop_kept(met)
    wanted = spark.sparkContext.broadcast(may_contain(ids))   # 2 MB
    routed = keep(docs.mapInArrow(thrifty(_texts(wanted)), ROUTED)
                  .join(ids.hint("shuffle_hash"), "set_id", "left_semi").dropDuplicates(["set_id"]), "routed")
    texts, routed_sets = routed.select("set_id", "text"), routed.drop("text")
    # the edges of a round are those of the rounds before it, contracted, and its own links: they connect
    # the same sets, though a set may not yet have its last root
    edges, known, at = None, None, 0
    for size in ROUNDS:
        found = _verified(_star_pairs(routed_sets, known, at, at + size), texts)
        edges = contracted(found if edges is None else edges.union(found))
        known, at = keep(labels(edges), "known"), at + size

    # all other pairs that share a routing shingle, through the trees
    rows = _with_component(shared, known)
    mixed = (rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("size"))
             .filter("lo <> hi").select("key", "lo", "size", F.ceil(F.col("size") / CELL).cast("int").alias("parts")))
    # shingles of one family of texts lie together, so its pairs go out once; a family of more than
    # REGION rows is dealt to as many regions as it needs
    regions = mixed.groupBy("lo").agg(F.ceil(F.sum("size") / REGION).alias("regions"))
    mixed = mixed.join(regions, "lo").withColumn("region", F.pmod(F.xxhash64("key"), F.col("regions"))).drop("size", "regions")
    rows = (rows.join(mixed, "key").join(routed_sets.select("set_id", "n_shingles", "counts"), "set_id")
            .withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other"))
            # the cells of one very common shingle are dealt out one by one
            .withColumn("region", F.when(F.col("parts") > 1, F.xxhash64("key", "i", "j")).otherwise(F.col("region"))))
    pairs = (rows.select("lo", "region", "key", "i", "j", "set_id", "comp", "part", "n_shingles", "counts")
             .repartition(n, "lo", "region").sortWithinPartitions("lo", "region", "key", "i", "j")
             .mapInArrow(thrifty(_cell_pairs), "a long, b long").distinct())
    roots = components(edges.union(_verified(pairs, texts))).withColumnRenamed("node", "set_id")
    drop_kept(routed, shared)
    return keep(members.join(roots, "set_id", "left").select(
        "doc_id", "n_shingles", "set_id",
        F.when(F.col("n_shingles") > 0, F.coalesce("root", "set_id")).alias("root")), "groups")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id; one row a row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, itself included.
    Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z. Null texts and
    texts without words have an empty set and link with nothing; repeated rows
    are equal sets and link; a null id takes part in its group but never names
    it (a null id alone has a null component); an empty table gives no rows;
    extra columns are ignored."""
    groups = jaccard_groups(docs)
    named = groups.filter("root IS NOT NULL")
    names = keep(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "names")
    out = named.join(names, "root").select("doc_id", "n_shingles", "component_id")
    return out.unionAll(groups.filter("root IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _with_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.RecordBatch.from_arrays([batch.column("row").field("text")], ["text"])
        ids = pa.array([set_id(s) for _, _, s in document_sets(texts)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "set_id"])


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id (null last), of equal ids
    that of the smallest set id. Rows without words all stay; columns unchanged."""
    groups = jaccard_groups(docs).filter("root IS NOT NULL")
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "set_id")).alias("f"))
    first = keep(first.select(F.col("f.doc_id").alias("_id"), F.col("f.set_id").alias("_kept")), "kept")
    # the row travels as one struct, so its column names cannot clash with those used here
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    named = rows.mapInArrow(thrifty(_with_set), StructType([*rows.schema.fields, StructField("set_id", LongType())]))
    one = (named.filter("set_id <> 0")
           .join(first, (F.col("set_id") == F.col("_kept")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
           .dropDuplicates(["set_id", "doc_id"]))
    return one.select("row.*").unionAll(named.filter("set_id = 0").select("row.*"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard likeness of 0.8 or more of 5-word shingles."""
    return jaccard_components(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT rid, list_slice(ws, i, i + 4) AS sh
  FROM (SELECT rid, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid
), p AS (
  SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.rid <> y.rid GROUP BY x.rid, y.rid
), l AS (
  SELECT a, b FROM p JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), r AS (
  SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (rid)
JOIN (SELECT r.a AS rid, min(e.doc_id) AS component_id FROM r JOIN d e ON e.rid = r.b GROUP BY r.a) c USING (rid)
"""
