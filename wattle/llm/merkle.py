"""Merkle manifest of a dataset by time-forward processing.

Leaves are numbered within each tree (one a language, one above them all), and
the label of a node is (level, number). Digests are messages to the parent's
label. Spark's sorted exchange is the external part of the priority queue: it
holds the messages for nodes of later rounds, by (tree, block, number). A task
drains its range in label order through a heap, the queue's head, that never
holds more than one block of ``FAN ** levels`` nodes, and sends what leaves the
block to the next round. So a tree of n leaves takes log(n) / log(FAN ** levels)
rounds, the data shrink by that factor each round, and no tree is in one task.

The reversed sweep goes from the root down: a message (tree, block, proof
suffix) comes to each block ahead of the block's own nodes, which are then given
their runs' other digests and the suffix. At the leaves a proof is whole.

A proof is a sequence of levels from the leaf up, each one byte of place in the
run, one byte of count, and the run's other digests, 32 bytes each."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_kept, keep, read, shuffle_parts

FAN, LEVELS = 8, 4
ROWS_OUT = 512
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of the fields' decimal or text values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = []
    for c in fields:
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def parent_digest(run: list[bytes]) -> bytes:
    return sha256(b"".join([d.hex().encode() for d in run])).digest()


def _level_counts(n: int) -> list[int]:
    """Nodes on each level of a tree of n leaves, up to the root."""
    counts = [n]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // FAN))
    return counts


def numbered(leaves: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``leaves`` with ``number``, the place within the tree, and ``n``, the tree's size.

    One range exchange over all trees, so a tree with a third of all rows lies in many
    tasks; numbers follow from the sizes of the (range, tree) pieces before."""
    spark = leaves.sparkSession
    order = [F.col(tree).asc_nulls_first(), *order]
    placed = keep(leaves.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "merkle-order")
    # one row for each range and tree in it: ranges plus trees rows
    pieces = placed.groupBy(tree, "_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    w = Window.partitionBy(tree).orderBy("_range")
    pieces = pieces.select(F.col(tree).alias("_tree"), F.col("_range").alias("_r"), "_first",
                           F.coalesce(F.sum("_rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           F.sum("_rows").over(Window.partitionBy(tree)).alias("n"))
    out = keep(placed.join(pieces, (F.col("_range") == F.col("_r")) & F.col(tree).eqNullSafe(F.col("_tree")))
               .withColumn("number", F.col("_at") - F.col("_first") + F.col("_before"))
               .drop("_at", "_range", "_r", "_first", "_before", "_tree"), "merkle-numbered")
    drop_kept(placed)
    return out


class Block:
    """The nodes of one block and the runs above them, in label order."""

    def __init__(self, block: int, counts: list[int], levels: int):
        self.first, self.counts, self.levels = block * FAN ** levels, counts, levels
        self.runs: list[dict[int, list[bytes]]] = []

    def climb(self, digests: list[bytes]) -> bytes:
        """Digest of the block's top node; ``runs[i][p]`` become the children of node p of level i + 1.

        ``heap`` is the queue's head: (label of the receiver, child's number, digest)."""
        heap = [((1, (self.first + i) // FAN), self.first + i, d) for i, d in enumerate(digests)]
        self.runs = [{} for _ in range(self.levels)]
        top = digests[0]
        while heap and heap[0][0][0] <= self.levels and len(self.counts) > heap[0][0][0]:
            label, run = heap[0][0], []
            while heap and heap[0][0] == label:
                run.append(heappop(heap)[2])
            level, p = label
            self.runs[level - 1][p] = run
            top = parent_digest(run)
            heappush(heap, ((level + 1, p // FAN), p, top))
        return top

    def proofs(self, suffix: bytes) -> Iterator[bytes]:
        """The reversed sweep: each entry node's proof, given the suffix of the block's top."""
        def below(level: int, p: int, rest: bytes) -> Iterator[bytes]:
            if not level:
                yield rest
                return
            run = self.runs[level - 1][p]
            for slot in range(len(run)):
                entry = bytes((slot, len(run) - 1)) + b"".join(run[:slot] + run[slot + 1:])
                yield from below(level - 1, p * FAN + slot, entry + rest)
        depth = sum(map(bool, self.runs))
        yield from below(depth, self.first // FAN ** depth, suffix)


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of each (tree, block), which come sorted."""
    key, rows = None, []
    for batch in batches:
        for tree, block, *row in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", *columns))):
            if (tree, block) != key:
                if rows:
                    yield key, rows
                key, rows = (tree, block), []
            rows.append(row)
    if rows:
        yield key, rows


def _forward(levels: int):
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["tree", "number", "n", "digest"])
        for (tree, block), rows in _blocks(batches, ("digest", "n")):
            n = rows[0][1]
            top = Block(block, _level_counts(n), levels).climb([r[0] for r in rows])
            out.append((tree, block, -(-n // FAN ** levels), top))
            if len(out) >= ROWS_OUT:
                yield flush()
                out = []
        if out:
            yield flush()
    return run


def _queue(messages: DataFrame) -> DataFrame:
    """The external queue: each block's messages in one task, in label order; a block is small, so no key is hot."""
    n = shuffle_parts(messages.sparkSession)
    return messages.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "number")


def forward(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, number, n, digest) -> the trees' roots (one row a tree) and the nodes that entered each round."""
    rounds = []
    while True:
        entered = nodes.select("tree", "number", "n", "digest")
        rounds.append(entered)
        tops = _queue(entered.withColumn("block", F.floor(F.col("number") / FAN ** levels))).select("tree", "block", "digest", "n")
        nodes = keep(tops.mapInArrow(_forward(levels), "tree string, number long, n long, digest binary"), "merkle-nodes")
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return nodes, rounds


def _backward(carry: tuple[str, ...], kinds: tuple, levels: int):
    names = ("tree", "number", "digest", *carry, "proof", "subroot", "root")
    types = (pa.string(), pa.int64(), pa.binary(), *kinds, pa.binary(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in _blocks(batches, ("number", "digest", "n", "proof", "subroot", "root", *carry)):
            head, rows = rows[0], rows[1:]                      # the suffix message comes first
            nodes = Block(block, _level_counts(rows[0][2]), levels)
            nodes.climb([r[1] for r in rows])
            for r, proof in zip(rows, nodes.proofs(head[3])):
                out.append((tree, r[0], r[1], *r[6:], proof, head[4], head[5]))
                if len(out) >= ROWS_OUT:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))
    return run


def backward(nodes: DataFrame, suffixes: DataFrame, carry: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """Proofs of the nodes that entered a round, from the proofs of the round's tops.

    ``suffixes``: (tree, number of the block, proof, subroot, root)."""
    types = {f.name: f.dataType for f in nodes.schema}
    entered = nodes.select("tree", F.floor(F.col("number") / FAN ** levels).alias("block"), "number", "digest", "n",
                           F.lit(None).cast("binary").alias("proof"), F.lit(None).cast("binary").alias("subroot"),
                           F.lit(None).cast("binary").alias("root"), *carry)
    told = suffixes.select("tree", F.col("number").alias("block"), F.lit(-1).cast("long").alias("number"),
                           F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("n"), "proof", "subroot", "root",
                           *(F.lit(None).cast(types[c]).alias(c) for c in carry))
    kinds = tuple({"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[types[c].simpleString()] for c in carry)
    schema = ", ".join(["tree string", "number long", "digest binary", *(f"{c} {types[c].simpleString()}" for c in carry), "proof binary",
                        "subroot binary", "root binary"])
    return _queue(entered.unionByName(told)).mapInArrow(_backward(carry, kinds, levels), schema)


def _descend(rounds: list[DataFrame], suffixes: DataFrame, levels: int, carry: tuple[str, ...] = ()) -> DataFrame:
    for i, nodes in enumerate(reversed(rounds)):
        last = i == len(rounds) - 1
        suffixes = backward(nodes, suffixes, carry if last else (), levels)
        if not last:
            suffixes = keep(suffixes, "merkle-suffixes")
    return suffixes


def manifest(docs: DataFrame, found_text: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Leaves of ``docs`` with their proofs: doc_id, leaf, found_leaf, proof, subroot, root (digests as 32 bytes).

    Leaves of a language ascend by doc_id (null first), then digest; languages ascend
    bytewise, null first, as a language of its own. ``found_text`` is the text as it is found
    now (that of ``docs`` by default); ``found_leaf`` is the digest of the row with it. Null
    fields and empty texts have digests of their own; texts of any length are hashed by
    Spark's expressions and not shuffled. Repeated rows are leaves each; they have equal
    digests, so their order makes no difference. An empty table gives no row. Extra
    columns are ignored. The texts are read once; 80 bytes a row go through three exchanges."""
    fields = [F.col(c) for c in LEAF_COLUMNS]
    leaf = leaf_digest(fields)
    found = leaf if found_text is None else leaf_digest([found_text if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    leaves = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("tree"),
                              leaf.alias("digest"), found.alias("found_leaf")), "merkle-leaves")
    placed = numbered(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()])
    drop_kept(leaves)
    subroots, rounds = forward(placed, levels)
    rounds[0] = placed
    # the tree above: its leaves are the languages' roots, numbered in the languages' order
    above = numbered(subroots.select("tree", "digest", F.lit("").alias("above")), "above", [F.col("tree").asc_nulls_first()])
    above = above.select(F.col("above").alias("tree"), "number", "n", "digest", F.col("tree").alias("lang"))
    root, rounds_above = forward(above, levels)
    top = root.select("tree", F.lit(0).cast("long").alias("number"), F.lit(b"").alias("proof"),
                      F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    down = _descend(rounds_above, top, levels)
    # a language's proof above meets its subroot; one row a language
    told = (down.join(above.select("number", "lang", F.col("digest").alias("_subroot")), "number")
            .select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("number"), "proof", F.col("_subroot").alias("subroot"), "root"))
    out = _descend(rounds, keep(told, "merkle-suffixes"), levels, ("doc_id", "found_leaf"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "found_leaf", "proof", "subroot", "root")


def fold(leaf: bytes, proof: bytes) -> tuple[bytes, str]:
    """The root that ``leaf`` gives with a proof, and the digest of the proof's siblings."""
    at, digest, siblings = 0, leaf.hex(), sha256()
    while at < len(proof):
        slot, n = proof[at], proof[at + 1]
        run = proof[at + 2:at + 2 + 32 * n].hex()
        siblings.update(run.encode())
        digest = sha256((run[:64 * slot] + digest + run[64 * slot:]).encode()).hexdigest()
        at += 2 + 32 * n
    return bytes.fromhex(digest), siblings.hexdigest()


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded = [fold(d, p) for d, p in zip(batch.column("found_leaf").to_pylist(), batch.column("proof").to_pylist())]
        hexed = ([d.hex() for d in batch.column(c).to_pylist()] for c in ("leaf", "subroot", "root"))
        roots = batch.column("root").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, pa.string()) for c in hexed), pa.array([s for _, s in folded], pa.string()),
             pa.array([r.hex() for r, _ in folded], pa.string()), pa.array([r == t for (r, _), t in zip(folded, roots)], pa.bool_())],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def verify(proved: DataFrame) -> DataFrame:
    """Folds each found leaf of a ``manifest`` with its proof and compares with the root; digests as hex text."""
    return proved.mapInArrow(_check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                     "folded_root string, verified boolean")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, checked against a copy in which every third document's text lost its capitals."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = F.when(third, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return verify(manifest(read(spark, sf_dir, "documents"), found))


def _sql(levels: int = 10, above: int = 6) -> str:
    """The manifest in SQL, for trees of up to 8^levels leaves and 8^above languages."""
    def value(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(value(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = ("xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT), "
           f"lambda a, b: list_reduce(range(8), lambda c, i: {step}, xor(a, b)), 4294967295::BIGINT), 4294967295)")
    low = f"CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
    out = [f"d AS MATERIALIZED (SELECT doc_id, lang, {leaf('text')} AS h, {leaf(f'({low})')} AS f FROM documents)",
           "a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS number, "
           "count(*) OVER (PARTITION BY lang) AS n, NULL::VARCHAR[] AS run FROM d)"]

    def climb(name: str, i: int) -> str:
        return (f"{name}{i} AS MATERIALIZED (SELECT lang, number, n, h, NULL::VARCHAR[] AS run FROM {name}{i - 1} WHERE n = 1 UNION ALL "
                f"SELECT lang, number // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY number)), list(h ORDER BY number) "
                f"FROM {name}{i - 1} WHERE n > 1 GROUP BY lang, number // 8, n)")

    def fold(before: str, name: str, i: int, key: str, at: str) -> str:
        slot = f"(p.{at} // {8 ** (i - 1)} % 8)"
        others = f"(t.run[1:{slot}] || t.run[{slot} + 2:])"
        return (f"p AS MATERIALIZED (SELECT p.* REPLACE (CASE WHEN t.run IS NULL THEN p.s ELSE p.s || array_to_string({others}, '') END AS s, "
                f"CASE WHEN t.run IS NULL THEN p.f ELSE sha256(array_to_string(t.run[1:{slot}] || [p.f] || t.run[{slot} + 2:], '')) END AS f) "
                f"FROM {before} p JOIN {name}{i} t ON t.lang IS NOT DISTINCT FROM p.{key} AND t.number = p.{at} // {8 ** i})")
    out += [climb("a", i) for i in range(1, levels + 1)]
    out.append("b0 AS MATERIALIZED (SELECT 0 AS lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS number, count(*) OVER () AS n, h, "
               f"NULL::VARCHAR[] AS run, lang AS tree FROM a{levels})")
    out += [climb("b", i) for i in range(1, above + 1)]
    out.append("p0 AS MATERIALIZED (SELECT a.doc_id, a.lang, a.h AS leaf, a.f, a.number, b.number AS place, b.h AS subroot, 0 AS top, '' AS s "
               "FROM a0 a JOIN b0 b ON a.lang IS NOT DISTINCT FROM b.tree)")
    k = 0
    for name, depth, key, at in (("a", levels, "lang", "number"), ("b", above, "top", "place")):
        for i in range(1, depth + 1):
            k += 1
            out.append(f"p{k} AS" + fold(f"p{k - 1}", name, i, key, at).removeprefix("p AS"))
    return ("WITH " + ",\n".join(out) + f"\nSELECT p.doc_id, p.leaf, p.subroot, r.h AS root, sha256(p.s) AS proof_sha256, p.f AS folded_root, "
            f"p.f = r.h AS verified FROM p{k} p, b{above} r")


OP12_SQL = _sql()
