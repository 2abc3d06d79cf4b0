"""Benchmark decontamination over a distributed positional inverted index.

The index is sharded by document, as search engines do it: a shard holds whole
documents of about ``SHARD_BYTES`` of text and stores, sorted by term, the
positions of every token. Test windows are matched shard by shard: windows with
a term that the shard lacks go at once; of the others the rarest term's list is
shifted by the term's offset in the window and intersected with the shifted
lists of the next rarer terms. All windows of a shard advance together, as one
sorted list of (term, position) answers every membership test.

No posting is shuffled. The test set is the query set: it is sent to the tasks
in blocks of at most ``QUERY_WORDS`` words, one pass over the index for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, read, thrifty
from .nptext import ALNUM, U64, blocks, texts_of

WINDOW = 10
SHARD_BYTES = 2 << 20
QUERY_WORDS = 1 << 20

INDEX = "shard long, doc_ids array<bigint>, text_keys array<bigint>, n_words array<bigint>, terms binary, counts binary, positions binary"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
        for b in blocks(texts_of(batch), SHARD_BYTES):
            words, bounds = b.words(ALNUM)
            order = np.argsort(words, kind="stable")       # by term, then position
            terms, counts = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "doc_ids": ids[b.lo:b.lo + b.n], "text_keys": keys[b.lo:b.lo + b.n],
                "n_words": np.diff(bounds).tolist(),
                "terms": terms.astype("<u8").tobytes(), "counts": counts.astype("<u4").tobytes(),
                "positions": order.astype("<u4").tobytes()}],
                pa.schema([("shard", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                           ("text_keys", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
                           ("terms", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary())]))
            shard += 1


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of every token of ``docs`` (doc_id, text), written to the shared folder.

    Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing
    A-Z. Null and empty texts are documents without words; null ids and repeated
    rows are kept as rows of their own; extra columns are ignored. A task holds
    one shard, or the longest document if that is longer."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return keep(rows.mapInArrow(thrifty(_index), INDEX), "postings")


class Shard:
    """One row of the index, with membership tests on (term, position)."""

    def __init__(self, row: dict):
        self.doc_ids, self.shard = row["doc_ids"], row["shard"]
        self.bounds = np.concatenate([[0], np.cumsum(row["n_words"], dtype=np.int64)])
        self.terms = np.frombuffer(row["terms"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.keys = (np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) << 32) | self.positions

    def term_index(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in ``terms``, -1 if the shard lacks it."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, term: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Does the term occur at a position in lo..hi (inclusive)?"""
        at = np.searchsorted(self.keys, (term << 32) | np.maximum(lo, 0))
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (hi >= 0) & (found <= ((term << 32) | np.maximum(hi, 0)))

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, pos, "right") - 1


class Windows:
    """The windows of a block of test items: term hashes in order (short ones padded)."""

    def __init__(self, items: list[tuple], size: int = WINDOW):
        vocab = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, U64)]))
        rows, self.item = [], []
        for n, (_, h) in enumerate(items):
            t = np.searchsorted(vocab, h)
            for s in range(max(1, len(t) - size + 1)) if len(t) else ():
                w = t[s:s + size]
                rows.append(np.concatenate([w, np.full(size - len(w), -1, w.dtype)]))
                self.item.append(n)
        self.vocab, self.items = vocab, [i for i, _ in items]
        self.terms = np.array(rows, np.int64).reshape(-1, size)
        self.item = np.array(self.item, np.int64)
        self.len = (self.terms >= 0).sum(1)

    def candidates(self, shard: Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(window, position of its rarest term) for every posting of the rarest term of
        each window whose terms the shard all has; and per window its terms' rows in
        the shard and their offsets, from rare to common."""
        at = np.append(shard.term_index(self.vocab), -1)
        local = at[self.terms]
        alive = np.flatnonzero(((local >= 0) | (self.terms < 0)).all(1))
        local, pad = local[alive], self.terms[alive] < 0
        freq = np.where(pad, np.iinfo(np.int64).max, shard.counts[local] if len(shard.counts) else 0)
        offsets = np.argsort(freq, axis=1, kind="stable")
        local = np.take_along_axis(np.where(pad, -1, local), offsets, 1)
        n = shard.counts[local[:, 0]] if len(alive) else np.zeros(0, np.int64)
        win = np.repeat(np.arange(len(alive)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pos = shard.positions[shard.first[local[win, 0]] + step] if len(win) else np.zeros(0, np.int64)
        self.alive = alive
        return win, pos, local, offsets

    def exact(self, shard: Shard) -> tuple[np.ndarray, np.ndarray]:
        """(window, first word position) of every occurrence of a window as a phrase."""
        win, pos, local, offsets = self.candidates(shard)
        start = pos - offsets[win, 0] if len(win) else pos
        for k in range(1, self.terms.shape[1]):
            if not len(win):
                break
            term = local[win, k]
            p = start + offsets[win, k]
            ok = (term < 0) | shard.has(np.maximum(term, 0), p, p)
            win, start = win[ok], start[ok]
        win = self.alive[win]
        end = start + self.len[win] - 1
        ok = (start >= 0) & (shard.doc_of(start) == shard.doc_of(end))
        return win[ok], start[ok]

    def near(self, shard: Shard, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its rarest term) where every term of the window occurs, in
        any order, within window length + ``slop`` words of that position, in the same document."""
        win, pos, local, _ = self.candidates(shard)
        for k in range(1, self.terms.shape[1]):
            if not len(win):
                break
            term, reach = local[win, k], self.len[self.alive[win]] - 1 + slop
            doc = shard.doc_of(pos)
            ok = (term < 0) | shard.has(np.maximum(term, 0), np.maximum(pos - reach, shard.bounds[doc]),
                                        np.minimum(pos + reach, shard.bounds[doc + 1] - 1))
            win, pos = win[ok], pos[ok]
        return self.alive[win], pos


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        out = []
        for b in blocks(texts_of(batch)):
            words, bounds = b.words(ALNUM)
            out += [words[a:z].astype("<u8").tobytes() for a, z in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], ["item_id", "words"])


def query_blocks(benchmark: DataFrame, words: int = QUERY_WORDS) -> Iterator[list[tuple]]:
    """The test items with their word hashes, in blocks of about ``words`` words.

    Items without words are left out. The sum of words decides how many blocks
    there are; a block is what the driver holds at a time."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
             .mapInArrow(thrifty(_item_words), "item_id string, words binary").filter(F.length("words") > 0))
    items = keep(items, "items")
    n = items.agg(F.coalesce(F.sum(F.length("words") / 8), F.lit(0))).first()[0]
    count = max(1, int(-(-n // words)))
    for b in range(count):
        rows = items.filter(F.pmod(F.xxhash64("words"), F.lit(count)) == b).collect()
        if rows:
            yield [(r.item_id, np.frombuffer(r.words, "<u8")) for r in rows]


HITS = "shard long, ord int, ranges array<struct<start:bigint,stop:bigint>>, items array<string>"


def _matcher(sent, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = Windows(sent.value)
        schema = pa.schema([("shard", pa.int64()), ("ord", pa.int32()),
                            ("ranges", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                            ("items", pa.list_(pa.string()))])
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                win, start = windows.exact(shard) if slop is None else windows.near(shard, slop)
                if not len(win):
                    continue
                size = windows.len[win] if slop is None else np.ones(len(win), np.int64)
                doc = shard.doc_of(start)
                cover = np.zeros(len(shard.positions) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + size, -1)
                on = (np.cumsum(cover) > 0).astype(np.int8)
                found = []
                for d in np.unique(doc).tolist():
                    lo, hi = shard.bounds[d], shard.bounds[d + 1]
                    edge = np.diff(on[lo:hi], prepend=np.int8(0), append=np.int8(0))
                    items = {windows.items[i] for i in np.unique(windows.item[win[doc == d]]).tolist()}
                    found.append({"shard": shard.shard, "ord": d,
                                  "ranges": [{"start": a, "stop": z} for a, z in zip(
                                      np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())],
                                  "items": sorted(i for i in items if i is not None)})
                yield pa.RecordBatch.from_pylist(found, schema)
    return run


def find_matches(index: DataFrame, benchmark: DataFrame, slop: int | None = None,
                 query_words: int = QUERY_WORDS) -> DataFrame:
    """Documents hit by ``benchmark`` (item_id, text): shard, ord, ranges of hit words, items.

    ``slop`` None: exact phrases of WINDOW consecutive item words (items of
    fewer words whole). Else proximity: all words of a window within its length
    plus ``slop`` of its rarest word in any order; ranges mark that word. A null
    item id hits but is not listed; equal ids count once; an empty benchmark or
    one without words hits nothing. One row a document and query block."""
    spark = index.sparkSession
    hits = None
    for block in query_blocks(benchmark, query_words):
        sent = spark.sparkContext.broadcast(block)
        got = index.mapInArrow(thrifty(_matcher(sent, slop)), HITS)
        hits = got if hits is None else hits.unionAll(got)
    return spark.createDataFrame([], HITS) if hits is None else hits


def documents_hit(index: DataFrame, hits: DataFrame) -> DataFrame:
    """One row a document of the index: doc_id, text_key, n_words, ranges, items (null without a hit)."""
    docs = (index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "n_words")).alias("ord", "d"))
            .select("shard", "ord", F.col("d.doc_ids").alias("doc_id"),
                    F.col("d.text_keys").alias("text_key"), F.col("d.n_words").alias("n_words")))
    merged = hits.groupBy("shard", "ord").agg(
        F.flatten(F.collect_list("ranges")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return docs.join(merged, ["shard", "ord"], "left").drop("shard", "ord")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = build_index(docs)
    out = documents_hit(index, find_matches(index, benchmark))
    # blocks of the query set may hit the same word: the covered words are counted once
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "ranges", lambda r: F.sequence(r["start"], r["stop"] - 1)))))
    return (out.withColumn("n_hit", F.when(F.col("ranges").isNull(), F.lit(0)).otherwise(covered).cast("long"))
            .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; columns unchanged.

    Hit rows are known by id and text hash, so an id that is repeated with
    another text keeps its clean rows."""
    index = build_index(docs)
    hit = documents_hit(index, find_matches(index, benchmark)).filter("ranges IS NOT NULL")
    hit = keep(hit.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "hit")
    return docs.join(hit, (F.xxhash64(docs["text"]) == hit["_key"])
                     & docs["doc_id"].cast("long").eqNullSafe(hit["_id"]), "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact benchmark windows in all documents, from a positional inverted index."""
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), w AS (
  SELECT DISTINCT item_id, list_slice(ws, s, s + 9) AS win, least(len(ws), 10) AS n
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS s FROM b WHERE len(ws) > 0)
), m AS (
  SELECT p.rid, p.s, w.n, w.item_id
  FROM (SELECT rid, n, s, list_slice(ws, s, s + n - 1) AS win
        FROM (SELECT rid, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS s
              FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)) p
  JOIN w ON w.n = p.n AND w.win = p.win
), h AS (
  SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(generate_series(s, s + n - 1)) AS pos FROM m) GROUP BY rid
), i AS (
  SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS id FROM m WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN i USING (rid)
"""
