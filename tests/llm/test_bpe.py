"""The streaming transducer and its decoder against the tokenizers library."""

import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattle.llm import bpe
from wattle.llm.common import read
from wattle.llm.tokens import tokenizer_path

PATH = tokenizer_path(bpe.TOKENIZER)
LIB = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"
PIECES = st.sampled_from(["a", "the", " the", "ing", " ", "  ", "\n", "\t", "'s", "'", "r", "re", "'re", "12", "½", "!", "--", "é", "你", "好",
                          "😀", "՘", "꟎", " ", " ", "\u0085", "<|endoftext|>", "<|endof", "text|>", "<|", "Ġ", "́", "A", "Q"])


def ids_of(text):
    return LIB.encode(text, add_special_tokens=False).ids


def streamed(text, cuts=()):
    enc, at, out = bpe.TextEncoder(bpe.load(PATH)), 0, b""
    for c in sorted(cuts):
        out += enc.feed(text[at:c])
        at = max(at, c)
    return np.frombuffer(out + enc.finish(text[at:]), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join), st.lists(st.integers(0, 120), max_size=6))
def test_any_slicing_gives_the_librarys_ids(text, cuts):
    ids = ids_of(text)
    assert streamed(text) == ids and streamed(text, cuts) == ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.lists(st.integers(0, 60), max_size=4))
def test_any_characters(text, cuts):
    assert streamed(text, cuts) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50_256), st.integers(0, 255)), max_size=40), st.lists(st.integers(0, 40), max_size=5))
def test_decoding_in_slices_is_the_librarys(ids, cuts):
    dec, at, out = bpe.TextDecoder(bpe.load(PATH).merges), 0, ""
    for c in sorted(cuts):
        out += dec.feed(ids[at:c])
        at = max(at, c)
    assert out + dec.feed(ids[at:]) + dec.finish() == LIB.decode(ids, skip_special_tokens=False)


LONG = {"one letter": "a" * 30_000, "blanks": "x" + " " * 20_000 + "y" + "\n" * 9_000, "digits": "1234567890" * 3_000,
        "marks": "=-" * 9_000 + "<|endoftext|>" + "=" * 9_000, "blanks before a special": " " * 9_000 + "<|endoftext|>" + "\t" * 9_000 + " a",
        "letters": "".join(map(chr, np.random.default_rng(1).integers(97, 123, 40_000))),
        "wide": "你好" * 6_000 + "'s" + "é" * 9_000, "joined words": "theguaranteeingofthethingsthatare" * 900}


@pytest.mark.parametrize("name", LONG)
def test_long_pieces_in_constant_memory(name):
    text, enc, most, out = LONG[name], bpe.TextEncoder(bpe.load(PATH)), 0, b""
    for i in range(0, len(text), 1_000):
        out += enc.feed(text[i:i + 1_000])
        most = max(most, len(enc.held.encode()) + len(enc.word.held))
    ids = np.frombuffer(out + enc.finish(), "<u4").tolist()
    assert ids == ids_of(text)
    assert most <= 4 * (bpe.LONG + 1_000 + 2 * enc.hold) + enc.merges.lookahead + 2 * bpe.STEP


def toy(merges):
    letters = bpe.byte_alphabet()
    tokens = letters + [u + v for u, v in merges]
    return {"model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": [list(m) for m in merges]},
            "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "added_tokens": []}


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_no_continuation_changes_a_stable_token(data):
    """Small random proper merge lists, all continuations drawn at random."""
    known, merges = ["a", "b", "c"], []
    for _ in range(data.draw(st.integers(1, 9))):
        u, v = data.draw(st.sampled_from(known)), data.draw(st.sampled_from(known))
        if u + v not in known:
            known.append(u + v)
            merges.append((u, v))
    m = bpe.Merges(toy(merges))
    word, more = (data.draw(st.text("abc", max_size=30)).encode() for _ in range(2))

    def stable(ids):
        out, at = [], 0
        for t in ids:
            at += len(m.tokens[t])
            if at > len(word) - m.lookahead:
                break
            out.append(t)
        return out
    known = stable(m.merge(word))
    assert m.merge(word + more)[:len(known)] == known


def test_lookahead_of_known_lists():
    assert bpe.sufficient_lookahead([]) == 0
    assert bpe.sufficient_lookahead([(b"a", b"b")]) == 1
    # a c after the word pulls b, bc pulls a, abc pulls x: three bytes before the end change
    assert bpe.sufficient_lookahead([(b"b", b"c"), (b"a", b"bc"), (b"x", b"abc")]) == 3
    assert bpe.load(PATH).merges.lookahead == 339


def test_other_files_are_refused():
    spec = json.load(open(PATH))
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"dropout": 0.1}}):
        with pytest.raises(ValueError):
            bpe.Merges(spec | change)
    with pytest.raises(ValueError):
        bpe.Merges(toy([("a", "bc"), ("b", "c")]))


def test_frequent_pieces_survive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    pieces = bpe.Pieces(bpe.load(PATH).merges, bpe.load(PATH).classify)
    words = ["the", "a", "the", "b", "the", "c", "the", "d", "the"] * 3
    assert [pieces.ids(w) for w in words] == [bpe.load(PATH).ids(w) for w in words]
    assert "the" in pieces.young | pieces.old and len(pieces.young) <= 3 and len(pieces.old) <= 3


def expected(text):
    ids = ids_of(text or "")
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIB.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op11_matches_the_library(spark):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op11_bpe(spark, SF).collect()}
    assert got == {r.doc_id: expected(r.text) for r in read(spark, SF, "documents").collect()}


def test_edges_and_parts(spark, monkeypatch):
    long = "one two three, " * 60_000 + "€" * 30_000
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", None), (4, "same", "x"), (4, "same", "x"), (None, "no id", "x"), (5, long, "x"),
            (6, "a<|endoftext|>b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string").withColumnRenamed("part", "last")
    parts = bpe.encode_documents(docs.coalesce(1)).collect()
    assert [r.doc_id for r in parts if r.last] == [r[0] for r in rows]
    assert [r.part for r in parts if r.doc_id == 5] == list(range(sum(r.doc_id == 5 for r in parts))) and sum(r.doc_id == 5 for r in parts) > 2
    whole = [i for r in parts if r.doc_id == 5 for i in r.ids]
    assert whole == ids_of(long)
    texts = bpe.decode_documents(bpe.encode_documents(docs.coalesce(1))).collect()
    assert "".join(r.text for r in texts if r.doc_id == 5) == long and [r.text for r in texts if r.doc_id == 6] == ["a<|endoftext|>b"]
    assert bpe.encode_documents(docs.limit(0)).count() == 0
