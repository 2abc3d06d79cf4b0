"""Texts encoded in groups: few calls of the library, a bounded cache, cuts as the library makes them."""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattle.llm import tokens


@pytest.fixture
def enc():
    e = tokens.Encoder(tokens.tokenizer_path())
    assert e.by_chunk
    return e


def check(e, texts):
    ids, counts = e.encode_all(pa.array(texts, pa.string()))
    each = [e.whole(t) for t in texts]
    assert ids.tobytes() == b"".join(each)
    assert counts.tolist() == [len(x) // e.dtype.itemsize for x in each]


def words(seed, n, alphabet="abcdefghij\xe9\xdf"):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(alphabet), rng.integers(3, 12))) for _ in range(n)]


class Counted:
    """The library's model that counts its calls."""

    def __init__(self, model: Tokenizer):
        self.model, self.calls, self.pieces = model, 0, 0

    def encode_batch_fast(self, texts, **kw):
        self.calls += 1
        self.pieces += sum(t.count(" ") + 1 for t in texts)
        return self.model.encode_batch_fast(texts, **kw)


def test_unseen_pieces_of_a_group_go_to_the_library_in_one_call_and_known_ones_never(enc):
    enc.forget()
    enc.model = Counted(enc.model)
    vocabulary = words(1, 3000, "abcdefghij\xe9")
    texts = [" ".join(vocabulary[i:i + 50]) + "." for i in range(0, 3000, 25)]
    check(enc, texts)
    assert enc.model.calls == 1 and enc.model.pieces == len(set(vocabulary)) + 1
    check(enc, [t.upper() + "! (" + t.replace(" ", ", ") for t in texts])
    assert enc.model.calls == 2 and enc.model.pieces <= len(set(vocabulary)) + 4        # . , ! ( and ones like .!


def test_cache_keeps_the_pieces_used_last(enc, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)
    monkeypatch.setattr(tokens, "CALL_PIECES", 7)
    enc.forget()
    for seed in range(6):
        check(enc, ["often", *words(seed, 30), "x" * 200, "often again", " ".join(words(seed, 90))])
        assert len(enc.pieces) == len(enc.ids) == len(enc.used) <= 40
        assert max(map(len, enc.pieces.to_pylist())) <= tokens.LONG_PIECE
    enc.forget()
    assert len(enc.pieces) == 0
    check(enc, ["often"])


def test_cuts_are_the_librarys(enc):
    latin = [chr(i) for i in range(256)]
    check(enc, [f"Ab{c}cD {c}1{c}{c} '{c}s {d}{c}" for c in latin for d in "'aZ9\xa0\xc9\n-"])
    check(enc, [f"a{chr(i)}b \xc9 {chr(i)}" for i in range(0x100, 0x3100)])
    check(enc, ["", " ", "\n\x85", "<|endoftext|>", "a <|startoftext|>B œ", "\x1c", "", "H̱ İ Å ΣΣ", "\x00a\x00"])
    check(enc, [])


def test_arrow_splits_and_lowers_as_python_does():
    every = [chr(i) for i in range(0x1c, sys.maxunicode + 1) if not 0xd800 <= i < 0xe000]
    got = pc.utf8_split_whitespace(pa.array([f"a{c}b" for c in every])).to_pylist()
    assert [c for c, g in zip(every, got) if g != f"a{c}b".split()] == []
    latin = [chr(i) for i in range(256)]
    assert pc.utf8_lower(pa.array(latin)).to_pylist() == [c.lower() for c in latin]


def test_offsets_of_64_bits_give_the_same(enc, monkeypatch):
    monkeypatch.setattr(tokens, "LARGE", 0)
    check(enc, ["It's 12 \xc9T\xc9", "", "你好 <|endoftext|>", *words(3, 50)])


def test_ends_that_ids_do_not_tell_are_found_piece_by_piece(enc):
    enc.forget()
    enc.last[:] = False
    check(enc, ["It's 12 o'clock, na\xefve", *words(4, 50)])


def test_blocks_do_not_depend_on_groups(monkeypatch):
    """Workers import the module themselves, so the packer's groups are made here, without Spark."""
    rows = [(i if i % 7 else None, None if i % 11 == 0 else " ".join(words(i, 60))) for i in range(300)]
    monkeypatch.setattr(tokens, "BLOCK_IDS", 4000)
    monkeypatch.setattr(tokens, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 3})())}))
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["doc_id", "text"])
    found = []
    for size in (1, 5000, 1 << 30):
        monkeypatch.setattr(tokens, "GROUP_BYTES", size)
        parts = [batch.slice(i, 13) for i in range(0, 300, 13)]
        found.append(pa.Table.from_batches(tokens._packer(tokens.tokenizer_path(), 1)(iter(parts))).to_pylist())
    assert found[0] == found[1] == found[2] and len(found[0]) > 3
    assert sum((b["doc_ids"] for b in found[0]), []) == [r[0] for r in rows]
    e = tokens.encoder(tokens.tokenizer_path())
    exp = b"".join(e.whole(t or "") + np.array([1], e.dtype).tobytes() for _, t in rows)
    assert b"".join(tokens.unpack(b["packed"], b["width"], 0, b["n_ids"]).astype(e.dtype).tobytes() for b in found[0]) == exp
    assert all(b["n_ids"] >= 4000 and b["n_ids"] - b["lengths"][-1] < 4000 for b in found[0][:-1])


def test_rows_with_equal_ids_and_null_texts(spark):
    docs = spark.createDataFrame([(2, "b c"), (2, "b c"), (2, None), (None, "d!"), (1, "")], "doc_id long, text string")
    got = tokens.tokenize_documents(docs).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).first()
    assert (got.n, got.t) == (5, 5 + 2 + 2 + 2)


def test_group_is_cut_in_slices_and_its_pieces_go_to_the_library_once(enc, monkeypatch):
    """A worker's peak is that of a slice, however many texts come in a batch."""
    monkeypatch.setattr(tokens, "SLICE_BYTES", 2000)
    cut, sizes = enc._cut, []
    monkeypatch.setattr(enc, "_cut", lambda texts: sizes.append(sum(pc.binary_length(texts).to_pylist())) or cut(texts))
    enc.forget()
    enc.model = Counted(enc.model)
    vocabulary = words(5, 400, "abcdefghij")
    texts = [" ".join(vocabulary[i:i + 40]) for i in range(0, 400, 10)] * 2
    check(enc, texts)
    assert enc.model.calls == 1 and enc.model.pieces == len(set(vocabulary))
    longest = max(map(len, texts))
    assert len(sizes) > 5 and max(sizes) < 2000 + longest and sum(sizes) == sum(map(len, texts))
    check(enc, ["", "<|endoftext|> a", "x" * 9000, "", *texts, "b<|startoftext|>", "y " * 3000, "", "œ 你好", "é" * 2500])


def test_worker_gives_back_what_a_group_took(monkeypatch):
    calls = []
    monkeypatch.setattr(tokens, "GROUP_BYTES", 1000)
    monkeypatch.setattr(tokens, "give_back", lambda: calls.append(1), raising=False)
    monkeypatch.setattr(tokens, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda s: 3})())}))
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [" ".join(words(i, 300))]}) for i in range(6)]
    out = list(tokens._packer(tokens.tokenizer_path(), 1)(iter(batches)))
    assert len(out) == 1 and len(calls) == 6
