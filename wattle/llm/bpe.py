"""Byte-pair encoding as a streaming transducer, and decoding as a state machine.

A text goes through in slices of ``SLICE`` characters. Two things wait for what
follows: a piece of the pre-tokenizer that the next characters may still change
(``hold`` characters at most), and inside a piece the bytes whose tokens a later
byte may still change. For the latter the merge list has a *sufficient
lookahead*: rule k = (u, v) can pull a token u, which lies left of the place up
to which a word and its longer version agree, over that place only if the place
is the word's end or an earlier rule (u', v') moved it there and v starts with
u'. The place so moves by |u| for each rule of a chain of ever later rules, and
the heaviest chain bounds how far a word's end is felt. Tokens that end so many
bytes before what has been read are stable; they are emitted and their bytes
forgotten. State is a constant number of characters and bytes whatever the
length of the text or of a single piece.

The decoder holds the bytes of one unfinished character, three at most.

Classes of characters (letter, number, space, other) are asked of the
tokenizer's own pre-tokenizer once a character, as Unicode versions differ."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .tokens import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
SLICE = 1 << 16         # characters fed at once
LONG = 1 << 12          # characters from which an unfinished piece is passed on byte by byte
STEP = 1 << 12          # bytes merged at once inside such a piece, besides the lookahead
PART_IDS = 1 << 16      # ids in one output row
CACHE_PIECES, CACHE_CHARS = 300_000, 64

_STANDINS = {"L": "a", "N": "1", "S": "\n", "O": "!"}
_RUNS = {"L": regex.compile(r"\p{L}*"), "N": regex.compile(r"\p{N}*"), "S": regex.compile(r"\s*"),
         "O": regex.compile(r"[^\s\p{L}\p{N}]*")}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1
    characters for themselves, the others in turn from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes before a word's end from which on no continuation changes the tokens.

    The heaviest chain of rules (u, v), each later than the one before and with a
    v that starts with the u before, each weighing |u|."""
    heaviest: dict[bytes, int] = {}
    for u, v in merges:
        chain = len(u) + max((heaviest.get(v[:i], 0) for i in range(1, len(v) + 1)), default=0)
        heaviest[u] = max(chain, heaviest.get(u, 0))
    return max(heaviest.values(), default=0)


class Merges:
    """A byte-level BPE vocabulary: ranks of pairs, bytes of ids, sufficient lookahead.

    Every rule must make a token that no other rule makes, of parts that are bytes
    or made by earlier rules; the lookahead is proven for such lists only, so others
    are refused, as are files with parts that this transducer does not follow."""

    def __init__(self, spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model.get("type", "BPE") == "BPE" and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                 and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                    "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        added = spec.get("added_tokens", [])
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("only plain byte-level BPE files are encoded")
        letters, vocab = byte_alphabet(), model["vocab"]
        value = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in added}
        self.tokens = {i: bytes(value[c] for c in t) for t, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.byte_ids = [vocab[c] for c in letters]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank, self.made = {}, []
        known = set(letters)
        for u, v in pairs:
            if u not in known or v not in known or u + v in known:
                raise ValueError(f"the merge {u!r} {v!r} is not proper")
            known.add(u + v)
            self.rank[vocab[u], vocab[v]] = len(self.made)
            self.made.append(vocab[u + v])
        self.lookahead = sufficient_lookahead([(self.tokens[vocab[u]], self.tokens[vocab[v]]) for u, v in pairs])
        self.longest = max(map(len, self.tokens.values()), default=1)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a whole word: the earliest rule first, leftmost place first."""
        rank, n = self.rank, len(word)
        ids = [self.byte_ids[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get((ids[i], ids[j])) != r:
                continue                                    # one of the two was merged meanwhile
            ids[i], ids[j] = self.made[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := rank.get((ids[i], ids[k]))) is not None:
                    heappush(heap, (x, i))
            h = before[i]
            if h >= 0 and (x := rank.get((ids[h], ids[i]))) is not None:
                heappush(heap, (x, h))
        return [t for t in ids if t >= 0]


class WordStream:
    """Ids of one word that comes in slices; holds ``lookahead + 2 * STEP`` bytes at most."""

    def __init__(self, merges: Merges):
        self.merges, self.held = merges, b""
        self.step = max(STEP, merges.longest)

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for i in range(0, len(data), self.step):
            self.held += data[i:i + self.step]
            stable = len(self.held) - self.merges.lookahead
            if stable < self.step:
                continue
            at = 0
            for t in self.merges.merge(self.held):
                if at + len(self.merges.tokens[t]) > stable:
                    break
                at += len(self.merges.tokens[t])
                out.append(t)
            self.held = self.held[at:]
        return out

    def finish(self) -> list[int]:
        out, self.held = self.merges.merge(self.held), b""
        return out


class Pieces:
    """Splitting rule of the pre-tokenizer, and ids of short pieces in two generations of
    a cache: when the young one is full it becomes the old one, so frequent pieces stay."""

    def __init__(self, merges: Merges, classify):
        self.merges, self.classify = merges, classify
        self.split = regex.compile(_SPLIT)
        self.seen = set(map(chr, range(128)))
        self.moved: dict[int, str] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def shape(self, text: str) -> str:
        """The text with characters of which regex thinks otherwise replaced by others of their class."""
        if text.isascii():
            return text
        for c in set(text) - self.seen:
            self.seen.add(c)
            kind = self.classify(c)
            if not (m := _RUNS[kind].match(c)) or not m.end():
                self.moved[ord(c)] = _STANDINS[kind]
        return text.translate(self.moved) if self.moved else text

    def kind(self, c: str) -> str:
        return next(k for k, run in _RUNS.items() if run.match(c).end())

    def ids(self, piece: str) -> bytes:
        got = self.young.get(piece)
        if got is None:
            got = self.old.get(piece)
            if got is None:
                got = array("I", self.merges.merge(piece.encode())).tobytes()
            if len(piece) <= CACHE_CHARS:
                if len(self.young) >= CACHE_PIECES:
                    self.old, self.young = self.young, {}
                self.young[piece] = got
        return got


class TextEncoder:
    """Ids of a text that comes in slices, as little-endian unsigned 32-bit integers.

    Any way of slicing gives the same ids. ``finish`` ends the text and makes the
    encoder ready for the next one."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.merges = pieces, pieces.merges
        special = self.merges.special
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        # a special string may lie half in the slice, and a piece needs three characters after it to be sure
        self.hold = max(map(len, special), default=0) + 3
        self.held, self.kind = "", ""
        self.word = WordStream(self.merges)

    def feed(self, text: str) -> bytes:
        out: list[bytes] = []
        self.held = self._run(self.held + text, out, False)
        return b"".join(out)

    def finish(self, text: str = "") -> bytes:
        out: list[bytes] = []
        self._run(self.held + text, out, True)
        self.held = ""
        return b"".join(out)

    def _run(self, text: str, out: list[bytes], last: bool) -> str:
        at = 0
        for m in self.special.finditer(text):
            self._segment(text[at:m.start()], out, True)
            out.append(array("I", [self.merges.special[m[0]]]).tobytes())
            at = m.end()
        return self._segment(text[at:] if at else text, out, last)

    def _pass_on(self, data: str, out: list[bytes]) -> None:
        out.append(array("I", self.word.feed(data.encode())).tobytes())

    def _segment(self, text: str, out: list[bytes], last: bool) -> str:
        """Emit what is sure; returns the rest. ``last``: nothing follows the text."""
        shape = self.pieces.shape(text)
        sure = len(text) if last else max(0, len(text) - self.hold)
        at = 0
        if self.kind:                                           # inside a long piece
            at = _RUNS[self.kind].match(shape).end()
            if not last and at >= sure:
                self._pass_on(text[:sure], out)
                return text[sure:]
            if self.kind == "S" and at < len(text):
                at -= 1                                         # the last space belongs to what follows
            self._pass_on(text[:at], out)
            out.append(array("I", self.word.finish()).tobytes())
            self.kind = ""
        found = self.pieces.split.findall(shape, at)
        n, end = len(found), len(text)
        while n and end > sure:
            n -= 1
            end -= len(found[n])
        if shape is text:
            out.extend(map(self.pieces.ids, found[:n]))
        else:
            for piece in found[:n]:
                out.append(self.pieces.ids(text[at:at + len(piece)]))
                at += len(piece)
        if not last and len(text) - end > LONG + self.hold:
            self.kind = self.pieces.kind(found[n][-1])
            self._pass_on(text[end:sure], out)
            end = sure
        return text[end:]


class TextDecoder:
    """Text of ids that come in slices; the state is the bytes of an unfinished character."""

    def __init__(self, merges: Merges):
        self.tokens, self.held = merges.tokens, b""

    def feed(self, ids: list[int]) -> str:
        data = self.held + b"".join([self.tokens.get(i, b"") for i in ids])
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b >= 0xC0:                                       # a lead byte: is its character whole?
                if back < (2 if b < 0xE0 else 3 if b < 0xF0 else 4):
                    cut = len(data) - back
                break
            if b < 0x80:
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


_LOADED: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """The vocabulary at ``path``, read once a worker."""
    if path not in _LOADED:
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            merges = Merges(json.load(f))
        level = Tokenizer.from_file(path).pre_tokenizer

        def classify(c: str) -> str:
            return next((k for k in "LNO" if len(level.pre_tokenize_str(_STANDINS[k] + c)) == 1), "S")
        _LOADED[path] = Pieces(merges, classify)
    return _LOADED[path]


PARTS = "doc_id long, part int, last boolean, ids array<int>"


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = TextEncoder(load(path))
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join([r[3] for r in rows]), "<u4").astype(np.int32)
            ends = np.concatenate([[0], np.cumsum([len(r[3]) // 4 for r in rows])]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.bool_()), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))],
                ["doc_id", "part", "last", "ids"])

        def parts(text: str) -> Iterator[bytes]:
            """Runs of at least PART_IDS ids, but for the text's last."""
            got, size = [], 0
            for i in range(0, len(text), SLICE):
                got.append(enc.feed(text[i:i + SLICE]) if i + SLICE < len(text) else enc.finish(text[i:]))
                size += len(got[-1])
                if size >= 4 * PART_IDS and i + SLICE < len(text):
                    yield b"".join(got)
                    got, size = [], 0
            yield b"".join(got)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                part, before = 0, None
                for ids in parts(text.as_py() or ""):
                    if before is not None:
                        rows.append((doc, part, False, before))
                        part += 1
                    before = ids
                    held += len(ids)
                    if held >= 4 * PART_IDS and rows:
                        yield flush()
                        rows, held = [], len(ids)
                rows.append((doc, part, True, before))
        if rows:
            yield flush()
    return run


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Ids of ``docs`` (doc_id, text) with the vocabulary file ``tokenizer``: rows
    (doc_id, part, last, ids), a document's parts in order and next to each other.

    Null and empty texts give one part without ids. A text of any length gives parts
    of some 65,536 ids each, in constant memory besides the text itself. Repeated
    rows are encoded each; ties play no part; an empty table gives no row; extra
    columns are ignored. No shuffle."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encode(tokenizer or tokenizer_path(TOKENIZER)), PARTS)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = TextDecoder(load(path).merges)
        for batch in batches:
            last = batch.column("last").to_pylist()
            texts = [dec.feed(ids) + (dec.finish() if z else "") for ids, z in zip(batch.column("ids").to_pylist(), last)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("last"),
                                              pa.array(texts, pa.string())], ["doc_id", "part", "last", "text"])
    return run


def decode_documents(parts: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Texts of the rows of ``encode_documents``, part by part; a character that two parts
    share stands in the later one. Bytes that are no UTF-8 become U+FFFD, ids that the
    vocabulary lacks nothing."""
    return parts.mapInArrow(_decode(tokenizer or tokenizer_path(TOKENIZER)), "doc_id long, part int, last boolean, text string")


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = TextDecoder(load(path).merges)
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            out: list[tuple] = []
            lists = batch.column("ids")
            flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            for i, (doc, last) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("last").to_pylist())):
                ids = flat[ends[i]:ends[i + 1]]
                n += len(ids)
                of_ids.update(ids.astype("<u4").tobytes())
                of_text.update(dec.feed(ids.tolist()).encode())
                if last:
                    of_text.update(dec.finish().encode())
                    out.append((doc, n, of_ids.hexdigest(), of_text.hexdigest()))
                    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
            doc, count, a, b = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(count, pa.int64()), pa.array(a, pa.string()),
                                              pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again, one row of digests each."""
    path = tokenizer_path(TOKENIZER)
    return (encode_documents(read(spark, sf_dir, "documents"), path)
            .mapInArrow(_digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))
