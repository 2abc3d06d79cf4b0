"""Token-ID output: fixed-width bit packing with block offsets.

Documents are dealt by id range to shards, in ascending id order inside each.
A shard is a sequence of blocks; a block holds whole documents, at least
``BLOCK_IDS`` ids unless it is the shard's last. Ids take the minimum bits of
the vocabulary. 64 ids fill exactly ``width`` little-endian 64-bit words, so a
group of 64 starts at byte ``8 * width * (i // 64)`` and any range of ids is
unpacked with a few numpy operations, without reading what is before it.

The container is Parquet, one row a block (shard, block, first id's place in
the shard, document ids and lengths, packed bytes): written by Spark's
committer, so a lost executor leaves no half file, and readable from any store
that Spark reads. The place of a shard's first id in the whole output is the
running sum of the shards before it.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import give_back, read, running_base, shuffle_parts, thrifty

BLOCK_IDS = 1 << 16
END_ID = 1
CACHE_PIECES = 250_000      # of a worker's cache
LONG_PIECE = 64             # bytes; longer pieces are not kept in it
CALL_PIECES = 5_000         # pieces in a call of the library
GROUP_BYTES = 2 << 20       # of texts whose pieces are looked up together
SLICE_BYTES = 1 << 20       # of them that are cut at a time
LARGE = 1 << 28             # bytes of a group from which on offsets take 64 bits
TOKENIZER = "word_bpe_49k.json"

BLOCKS = ("shard int, block int, first long, n_ids long, width int, doc_ids array<bigint>, "
          "lengths array<bigint>, packed binary")


def bits_for(vocab: int) -> int:
    """Bits of the largest id of a vocabulary of that many ids."""
    return max(1, int(vocab - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids below 2**width as ``width`` 64-bit words for every 64 ids (zeros fill the last)."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} needs more than {width} bits")
    lanes = np.zeros(-(-len(ids) // 64) * 64, np.uint64)
    lanes[:len(ids)] = ids
    lanes = lanes.reshape(-1, 64)
    out = np.zeros((len(lanes), width), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(packed: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of a block; only the groups of 64 that hold them are read."""
    lo, hi = start // 64, -(-stop // 64)
    words = np.frombuffer(packed, "<u8", (hi - lo) * width, lo * width * 8).reshape(-1, width)
    out = np.empty((hi - lo, 64), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        v = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, i] = v & mask
    return out.reshape(-1)[start - lo * 64:stop - lo * 64]


# The pre-tokenizer's pieces of lower-cased Latin-1 text: runs of letters, single digits, runs of others.
_LETTERS, _DIGITS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_PIECES = re.compile(f"{_SHORT}|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+")
_NO_LETTERS = f"({_SHORT}|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+)"


class Encoder:
    """Ids of whole texts, made by the tokenizers library from each text's pieces.

    For a tokenizer that drops white space, a text's ids are those of its
    pieces in turn. Arrow cuts a group of texts into pieces, ``SLICE_BYTES`` at
    a time, and numbers the different ones of all; those that the cache does not hold go to the library's model,
    thousands in one call. Texts with characters beyond Latin-1 are cut at white
    space only; their chunks with such characters go through the whole library,
    once each. Texts with special tokens and, if a probe shows that the tokenizer does
    not work this way, all texts go through it uncut. The cache, pieces beside
    their ids in two Arrow arrays, keeps the ``CACHE_PIECES`` used last."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.vocab = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.vocab <= 1 << 16 else "<u4")
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # Arrow and Python split at these four, the library does not
        self.uncut = "|".join([*map(re.escape, added), "[\x1c-\x1f]"])
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(256) if i != 32}
        self.model = Tokenizer(self.tok.model)            # pieces in the byte-level alphabet, between spaces
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = getattr(self.tok.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.vocab, bool)            # ids that end a piece
        if suffix:
            self.last[[i for t, i in self.tok.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True
        self.forget()
        probe = "It's 12\xbd o'clock, na\xefve \xc9T\xc9!! <a@b.c> we'll\tsee\nŒuvre 你好 é x_y --\xbf"
        probes = [probe, probe.encode("latin-1", "ignore").decode("latin-1")]
        self.by_chunk = True
        self.by_chunk = all(self.encode(p) == self.whole(p) for p in probes)

    def forget(self) -> None:
        self.pieces, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())
        self.used, self.turn = np.zeros(0, np.int64), 0

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no nulls) in turn, and how many each text has."""
        if not self.by_chunk:
            each = [self.whole(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(each), self.dtype), np.array([len(e) for e in each], np.int64) // self.dtype.itemsize
        large = texts.nbytes >= LARGE or pa.types.is_large_string(texts.type)
        if large:
            texts = texts.cast(pa.large_string())
        uncut = pc.match_substring_regex(texts, self.uncut)
        alone = np.flatnonzero(uncut.to_numpy(zero_copy_only=False))
        whole = pa.array([self.whole(texts[i].as_py()) for i in alone.tolist()], pa.binary())
        begins, numbers, keys = self._numbered(pc.if_else(uncut, pa.scalar("", texts.type), texts))
        place = pc.fill_null(pc.index_in(keys, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        unseen, held = place < 0, len(self.pieces)
        new = keys.filter(pa.array(unseen))
        del keys
        new_ids = self._unseen(new.to_pylist())
        place[unseen] = held + np.arange(len(new))
        known = pa.concat_arrays([self.ids, new_ids, whole])
        if large:
            known = known.cast(pa.large_binary())
        ids, counts, row = [], [], 0
        for begin, number in zip(begins, numbers):
            pick = place[number]
            mine = np.flatnonzero((alone >= row) & (alone < row + len(begin) - 1))
            pick[begin[alone[mine] - row]] = held + len(new) + mine       # an empty text is one empty piece
            taken = known.take(pa.array(pick))
            ends = np.frombuffer(taken.buffers()[1], np.int64 if large else np.int32, len(taken) + 1)[begin].astype(np.int64)
            ids.append(np.frombuffer(taken.buffers()[2] or b"", self.dtype, ends[-1] // self.dtype.itemsize))
            counts.append(np.diff(ends) // self.dtype.itemsize)
            row += len(begin) - 1
        self._remember(place[~unseen], new, new_ids)
        return np.concatenate([np.zeros(0, self.dtype), *ids]), np.concatenate([np.zeros(0, np.int64), *counts])

    def _numbered(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], pa.Array]:
        """For each slice of the texts where each text's pieces begin, and the last's end, and the pieces'
        numbers; the different pieces of all. Only the numbers stay: pieces, spaced texts and tables are a slice's."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(size // SLICE_BYTES, prepend=0)) + 1
        cuts = np.unique(np.concatenate([[0], cuts, [len(texts)]])).tolist()
        begins, numbers, keys = [], [], []
        for lo, hi in zip(cuts, cuts[1:]):
            lists = self._cut(texts.slice(lo, hi - lo))
            found = lists.values.dictionary_encode()
            begins.append(lists.offsets.to_numpy())
            numbers.append(found.indices.to_numpy())
            keys.append(found.dictionary.cast(pa.string()))
        every = pa.concat_arrays([pa.array([], pa.string()), *keys]).dictionary_encode()
        at, of = 0, every.indices.to_numpy()
        for i, k in enumerate(keys):
            numbers[i] = of[at:at + len(k)][numbers[i]]
            at += len(k)
        return begins, numbers, every.dictionary

    def _cut(self, texts: pa.Array) -> pa.Array:
        """Lists of pieces: Latin-1 texts in lower case, with spaces about all that are not letters."""
        none = pa.scalar("", texts.type)
        wide = pc.match_substring_regex(texts, "[^\\x{00}-\\x{ff}]")
        latin = pc.replace_substring_regex(pc.utf8_lower(pc.if_else(wide, none, texts)), _NO_LETTERS, " \\1 ")
        return pc.utf8_split_whitespace(pc.if_else(wide, texts, latin))

    def _unseen(self, chunks: list[str]) -> pa.Array:
        """The ids of each chunk, as bytes."""
        pieces: list[str] = []
        counts = np.zeros(len(chunks), np.int64)
        wide = []
        for i, c in enumerate(chunks):
            if c.isascii() and c.isalpha():
                pieces.append(c.lower())
                counts[i] = 1
            elif c and max(c) >= "Ā":
                wide.append(i)
            else:
                cut = _PIECES.findall(c.lower())
                pieces += cut
                counts[i] = len(cut)
        ids, stops = self._model(pieces)
        at = stops[np.append(0, np.cumsum(counts))] * self.dtype.itemsize
        out = pa.Array.from_buffers(pa.binary(), len(chunks), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(ids)])
        if not wide:
            return out
        place = np.arange(len(chunks))
        place[wide] = len(chunks) + np.arange(len(wide))
        return pa.concat_arrays([out, pa.array([self.whole(chunks[i]) for i in wide], pa.binary())]).take(pa.array(place))

    def _model(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in turn, and where each piece's begin, and the last's end."""
        parts, stops, at = [], [np.zeros(1, np.int64)], 0
        for i in range(0, len(pieces), CALL_PIECES):
            part = pieces[i:i + CALL_PIECES]
            text = " ".join(part).translate(self.table)
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
            stop = np.flatnonzero(self.last[ids]) + 1
            if len(stop) != len(part) or stop[-1] != len(ids):            # ends cannot be told by the ids
                each = [[t.id for t in self.tok.model.tokenize(p)] for p in text.split(" ")]
                ids, stop = np.array(sum(each, []), self.dtype), np.cumsum([len(e) for e in each])
            parts.append(ids)
            stops.append(stop + at)
            at += len(ids)
        return np.concatenate(parts or [np.zeros(0, self.dtype)]), np.concatenate(stops)

    def _remember(self, seen: np.ndarray, new: pa.Array, new_ids: pa.Array) -> None:
        """Keeps the pieces used last, but none of more than ``LONG_PIECE`` bytes."""
        self.turn += 1
        self.used[seen] = self.turn
        short = pc.less_equal(pc.binary_length(new), LONG_PIECE)
        new, new_ids = new.filter(short), new_ids.filter(short)
        self.pieces, self.ids = pa.concat_arrays([self.pieces, new]), pa.concat_arrays([self.ids, new_ids])
        self.used = np.append(self.used, np.full(len(new), self.turn))
        drop = len(self.used) - CACHE_PIECES
        if drop > 0:
            stay = np.sort(np.argpartition(self.used, drop)[drop:])
            self.pieces, self.ids, self.used = self.pieces.take(pa.array(stay)), self.ids.take(pa.array(stay)), self.used[stay]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget_chunks() -> None:
    """Empty this worker's caches, whose memory other steps of the same workers need."""
    for enc in _ENCODERS.values():
        enc.forget()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts (null: empty) of rows in turn, in groups of at least ``GROUP_BYTES`` but for the last."""
    docs, texts, size = [], [], 0
    for batch in batches:
        docs.append(batch.column("doc_id"))
        texts.append(pc.fill_null(batch.column("text"), ""))
        size += texts[-1].nbytes
        if size >= GROUP_BYTES:
            yield pa.concat_arrays(docs), pa.concat_arrays(texts)
            docs, texts, size = [], [], 0
    if docs:
        yield pa.concat_arrays(docs), pa.concat_arrays(texts)


def _packer(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(path), TaskContext.get().partitionId()
        width = bits_for(max(enc.vocab, end_id + 1))
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                            ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int64())), ("packed", pa.binary())])
        block = first = held = 0
        docs: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "first": first, "n_ids": len(ids), "width": width,
                "doc_ids": docs, "lengths": lengths, "packed": pack(ids, width)}], schema)

        for names, texts in _groups(batches):
            ids, counts = enc.encode_all(texts)
            del texts
            give_back()                                   # a group takes several times its texts
            ends = np.cumsum(counts + 1)
            ids = np.insert(ids, np.cumsum(counts), np.asarray(end_id, enc.dtype))
            at = row = 0                                  # ids and rows of this group that are in a block
            names, counts = names.to_pylist(), (counts + 1).tolist()
            for i, end in enumerate(ends.tolist(), 1):
                if held + end - at >= BLOCK_IDS:
                    parts.append(ids[at:end])
                    docs += names[row:i]
                    lengths += counts[row:i]
                    held += end - at
                    yield flush()
                    block, first, held, docs, lengths, parts = block + 1, first + held, 0, [], [], []
                    at, row = end, i
            parts.append(ids[at:].copy())
            docs += names[row:]
            lengths += counts[row:]
            held += len(ids) - at
        if docs:
            yield flush()
    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write the packed shards under ``path``.

    Null and empty texts give the end id alone. Rows go by ascending doc_id,
    null ids first; equal ids by text, so repeated rows stay side by side. An
    empty table writes no block. Extra columns are ignored. One shuffle of the
    texts; a task holds one block and the longest document."""
    n = shuffle_parts(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, "doc_id")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()))
    ordered.mapInArrow(thrifty(_packer(tokenizer or tokenizer_path(), end_id)), BLOCKS).write.parquet(path)


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The blocks under ``path`` with ``start``, the place of their first id in the whole output."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    base = running_base(blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")), "shard", "n")
    # one row a shard, so as many as shuffle partitions: small whatever the input
    return blocks.join(F.broadcast(base), "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start:stop`` of the whole output; reads only the blocks that hold them."""
    rows = (open_tokens(spark, path).filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
            .orderBy("start").collect())
    got = [unpack(r.packed, r.width, max(0, start - r.start), min(r.n_ids, stop - r.start)) for r in rows]
    return np.concatenate(got) if got else np.zeros(0, np.uint32)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_chunks()                                       # all is encoded when files are read back
    for batch in batches:
        for b in batch.to_pylist():
            ids = unpack(b["packed"], b["width"], 0, b["n_ids"]).astype("<u4")
            ends = np.cumsum(b["lengths"])
            begins = ends - b["lengths"]
            crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(begins.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b["doc_ids"], pa.int64()), pa.array(begins + b["start"], pa.int64()),
                 pa.array(b["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    return (open_tokens(spark, path).select("start", "n_ids", "width", "doc_ids", "lengths", "packed")
            .mapInArrow(thrifty(_digests), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def tokenize_documents(docs: DataFrame) -> DataFrame:
    """Write ``docs`` in the packed format to the shared folder and index the files."""
    spark = docs.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/wattle-tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path)
    return document_index(spark, path)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, packed, written in id order and read back."""
    return tokenize_documents(read(spark, sf_dir, "documents"))
