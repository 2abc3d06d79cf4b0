"""Operators without SQL against brute force, exact round trips and held-out accuracy."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wattle.llm import components, langid, licenses, ngram_join, nptext, pii, queries, syncmers, tokens, toxicity
from wattle.llm.common import read

SF = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in t}


def rows(df):
    return df.collect()


def test_language_held_out_accuracy(spark):
    got = rows(queries.QUERIES["op1_language_id"](spark, SF1))
    lang = {r.doc_id: r.lang for r in read(spark, SF1, "documents").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.98


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 30])
def test_codewords_differ(n):
    m = langid.codewords(n)
    assert set(np.unique(m)) == {-1.0, 1.0} and (np.abs(m.sum(0)) < n).all()
    d = (m.shape[1] - m @ m.T) / 2
    assert d[~np.eye(n, dtype=bool)].min() >= max(1, m.shape[1] // 4)


def test_a_wrong_bit_is_corrected():
    m = langid.LanguageModel({c: np.arange(langid.BUCKETS) % (i + 2) + 1.0 for i, c in enumerate("abcd")})
    m.calibrate(m.code.copy(), np.full(m.code.shape, 0.3))
    f = m.code.copy()
    f[:, 0] = -f[:, 0]
    which, score, _ = m.decode(f)
    assert which.tolist() == [0, 1, 2, 3] and (score > 0).all()
    assert m.decode(np.zeros((1, m.code.shape[1])))[2][0]               # nothing said: ambiguous


def shingles(t):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_shingle_sets_match_strings(texts):
    some = [t.encode() for t in texts.values()] + [b"", b"  ", b"a", b"a b c d", b"\xff\xfe x"]
    for b in nptext.blocks(some, 5000):
        got = list(nptext.shingle_sets(*b.words(nptext.NONSPACE)))
        exp = [shingles(t.decode(errors="surrogateescape")) for t in some[b.lo:b.lo + b.n]]
        assert [len(g) for g in got] == [len(e) for e in exp]


def test_tree_search_loses_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 6, (40, ngram_join.GROUPS))
    vecs = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape) * (rng.random(base.shape) < 0.3), 0) for _ in range(12)]).astype(np.uint16)
    n = vecs.sum(1, dtype=np.int64)
    q, p = ngram_join.CountTree(vecs, n).search(vecs, n)
    got = set(zip(q.tolist(), p.tolist()))
    low = np.minimum(vecs[:, None], vecs[None]).sum(2)
    exp = {(i, j) for i, j in zip(*np.nonzero(ngram_join.linked(low, n[:, None], n[None])))
           if 5 * n[j] >= 4 * n[i] and 4 * n[j] <= 5 * n[i]}
    assert got == exp and len(exp) > len(n)


def test_huge_sets_are_never_pruned():
    a = np.arange(70_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    va, vb, vc = (ngram_join.count_vector(x)[None] for x in (a, a[:60_000], a[:66_000]))
    one = np.array([0])
    assert ngram_join.overlap_bound(va, one, vb, one)[0] == 60_000
    assert ngram_join.overlap_bound(va, one, vc, one)[0] >= 66_000


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    sketch = rng.integers(0, 50, 1 << ngram_join.SKETCH_BITS).astype(np.uint16)
    for n in (1, 2, 5, 9, 40, 200):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        while True:
            b = np.union1d(a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, max(0, n // 30), dtype=np.uint64))
            if ngram_join.linked(len(np.intersect1d(a, b)), len(a), len(b)) and len(b):
                break
        assert len(np.intersect1d(ngram_join.prefix(a, sketch), ngram_join.prefix(b, sketch)))


def test_hot_cells_are_split_without_loss(spark, monkeypatch):
    """Many variants of one text that share routing shingles, in cells of at most 8 points."""
    monkeypatch.setattr(ngram_join, "CELL", 8)
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(60)]
    data = []
    for d in range(60):
        w = list(words)
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(0, 60)] = f"x{rng.integers(0, 1000)}"
        data.append((d, " ".join(w)))
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    sets = {d: shingles(t) for d, t in data}
    comp = {d: d for d in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == comp and len(set(comp.values())) > 1


def test_linked_sets_share_as_many_routing_shingles_as_asked():
    rng = np.random.default_rng(8)
    sketch = rng.integers(0, 50, 1 << ngram_join.SKETCH_BITS).astype(np.uint16)
    for n in (*range(1, 14), 40, 200, 1000):
        for _ in range(5):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            while True:
                b = np.union1d(a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, n // 12, dtype=np.uint64))
                if ngram_join.linked(len(np.intersect1d(a, b)), len(a), len(b)) and len(b):
                    break
            both = len(np.intersect1d(ngram_join.prefix(a, sketch), ngram_join.prefix(b, sketch)))
            assert both >= max(min(ngram_join.MEET, -(-4 * len(s) // 5)) for s in (a, b))


def test_texts_that_meet_by_chance_are_not_moved(spark, monkeypatch):
    """Each text has a passage of six words in common with the next, and no cell is rarer than another, as in
    a large corpus; only the near copies' texts are kept."""
    counts, keep = {}, ngram_join.keep

    def watched(df, name):
        out = keep(df, name)
        if "text" in out.columns:
            counts[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join, "keep", watched)
    monkeypatch.setattr(ngram_join, "_sketch", lambda profile: np.zeros(1 << ngram_join.SKETCH_BITS, np.uint16))
    words = [[f"w{d}_{i}" for i in range(60)] for d in range(40)]
    for d in range(39):
        words[d + 1][:6] = words[d][-6:]
    words.append([*words[7][:-1], "other"])
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(words)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {d: 7 if d == 40 else d for d in range(41)}
    assert list(counts.values()) == [2]


def test_short_near_copies_keep_their_links(spark):
    """Sets of fewer shingles than linked sets are asked to share."""
    rows = []
    for k in range(5, 30):                       # k words and the same with another last word: k - 4 shingles each, all but one common
        w = [f"a{k}_{i}" for i in range(k)]
        rows += [(10 * k, " ".join(w)), (10 * k + 1, " ".join([*w[:-1], "x"])), (10 * k + 2, " ".join([*w, "y"]))]
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {d: shingles(t) for d, t in rows}
    comp = {d: d for d in sets}
    for _ in range(3):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    assert got == comp and len(set(comp.values())) < len(comp)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140)) and got[201] == 200
    assert len(got) == 41 + 40 + 2


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(t):
    def ok(kind, x):
        d = re.sub("[^0-9]", "", x)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in x.split(".")),
                "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
    return {k: [m.span() for m in re.finditer(p, t) if ok(k, m[0])] for k, p in BASE.items()}


def test_base_spans_match_the_patterns(texts):
    rng = np.random.default_rng(1)
    odd = ["".join(rng.choice(list("1234567890.@ab-+ ()_%é"), 60)) for _ in range(3000)]
    odd += ["a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "+1 (017) 555-7713 4111 1111 1111 1111", "é@x.y", "x@y", "999.1.1.1 01.002.3.4"]
    for t in [*texts.values(), *odd]:
        assert pii.base_spans(t) == base(t)


def test_personal_data_rows(spark, texts):
    for r in rows(queries.QUERIES["op4_personal_data"](spark, SF)):
        b = base(texts[r.doc_id])
        digest = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in b[k])
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert set(digest.split(",")) - {""} <= set(r.spans.split(","))


def test_boosted_trees_learn_and_stay_precise(spark):
    x = np.random.default_rng(2).normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = pii.Boosted().fit(x[:500], y[:500])
    assert ((m.predict(x[500:]) > 0.5) == y[500:]).mean() > 0.9
    assert pii.calibrate(np.array([0.9] * 30 + [0.2] * 30), np.array([1.0] * 30 + [0.0] * 30)) == 0.9
    assert pii.calibrate(np.array([0.9] * 30), np.array([1.0, 0.0] * 15)) == 2.0


def test_disguised_data_is_added_and_clean_text_left_alone(spark):
    good = [(i, f"Please call +1 ({200 + i}) 555-{7000 + i} or write ann{i}@mail{i % 7}.example.com from 10.{i % 250}.4.{i % 200} today")
            for i in range(300)]
    more = [(1000, "Please write to bob at mail dot example dot org today"), (1001, "nothing at all to see here, 12 of 30")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(good + more, "doc_id long, text string")).collect()}
    assert got[1001].spans == ""
    assert got[1000].n_email == 0 and got[1000].spans.startswith("email:")
    assert "[email]" in pii.redact(more[0][1], got[1000].spans)


def test_fingerprints_match_brute_force(spark, texts):
    got = {r.doc_id: r for r in rows(queries.QUERIES["op5_fingerprints"](spark, SF))}
    order = sorted(texts, reverse=True)
    for i, d in enumerate(order):
        t, f = texts[d], texts[order[(i + 1) % len(order)]]
        e = t[:len(t) - len(t) // 2] + f[:len(t) // 2]
        a, b, c = (syncmers.sketches([x.encode()])[0] for x in (t, e, f))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (syncmers.as_text(a), syncmers.as_text(b))
        a, b, c = map(syncmers.as_bytes, (a, b, c))                     # the contract: likeness of the fingerprints alone
        assert (r.near_edited, r.near_next) == (syncmers.print_likeness(a, b), syncmers.print_likeness(a, c))


def test_anchors_are_closed_syncmers_and_match_passages():
    text = bytes(np.random.default_rng(4).integers(97, 123, 400).astype(np.uint8))
    blk = nptext.Block(0, [text])
    pos, h = syncmers.block_anchors(blk)
    one = {}
    for p in range(len(text) - syncmers.K + 1):                          # context-free: each k-mer alone
        q, g = syncmers.block_anchors(nptext.Block(0, [text[p:p + syncmers.K]]))
        if len(q):
            one[p] = int(g[0])
    assert one == dict(zip(pos.tolist(), h.tolist()))
    other = b"zz" + text[100:300] + b"yyyy"
    pos2, h2 = syncmers.block_anchors(nptext.Block(0, [other]))
    (a, b, size), *rest = sorted(syncmers.matched_passages((pos, h), (pos2, h2)), key=lambda x: -x[2])
    assert a - b == 98 and 150 < size <= 200 and text[a:a + size] == other[b:b + size]


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in rows(queries.QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1"))}
    lab = {r.doc_id: r.toxic for r in read(spark, "/root/testdata/sf0.1", "labels").collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    held = [(got[d].predicted, y) for d, y in lab.items() if d in got and got[d].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_correlated_voters_count_less():
    m = toxicity.LabelModel(3)
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    a = np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.05)
    c = np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.05)
    mask = a * 1 + a * 2 + c * 4                                         # the second repeats the first
    fn = toxicity._moments(m, True)
    m.update(fn(mask.astype(np.int64), y.astype(np.int64), np.ones(4000)))
    assert m.weight[0] < 0.7 and m.weight[1] < 0.7 and m.weight[2] == 1


def test_bits_round_trip():
    for width in (1, 7, 13, 16, 17, 31, 32):
        ids = np.random.default_rng(width).integers(0, 1 << width, 777)
        packed = tokens.pack(ids, width)
        assert len(packed) == -(-777 // 64) * width * 8
        assert (tokens.unpack(packed, width, 0, 777) == ids).all()
        assert (tokens.unpack(packed, width, 100, 411) == ids[100:411]).all()
    with pytest.raises(ValueError):
        tokens.pack(np.array([8]), 3)


def test_chunks_encode_like_whole_texts(texts):
    e = tokens.Encoder(tokens.tokenizer_path())
    assert e.by_chunk
    rng = np.random.default_rng(9)
    alphabet = list("abcXYZ 's't'ré\xc9ß\xa0\x85İΣŒ 12½².,!?<|>_-你é\n\t'\x1c")
    odd = ["".join(rng.choice(alphabet, rng.integers(0, 30))) for _ in range(3000)] + ["a<|endoftext|>b", "<|startoftext|>"]
    for t in [*odd, *list(texts.values())[:60]]:
        assert e.encode(t) == e.whole(t), t


def test_token_files(spark, texts, tmp_path):
    path = str(tmp_path / "tokens")
    tokens.write_tokens(read(spark, SF, "documents"), path)
    e = tokens.Encoder(tokens.tokenizer_path())
    ids = {d: np.append(np.frombuffer(e.whole(t), e.dtype), 1).astype("<u4") for d, t in texts.items()}
    every = np.concatenate([ids[d] for d in sorted(ids)])
    assert (tokens.read_range(spark, path, 0, len(every)) == every).all()
    assert (tokens.read_range(spark, path, 12_345, 23_456) == every[12_345:23_456]).all()
    at = 0
    got = {r.doc_id: r for r in tokens.document_index(spark, path).collect()}
    for d in sorted(ids):
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids[d]), zlib.crc32(ids[d].tobytes()))
        at += len(ids[d])


NOTICES = {"GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
           "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "MIT": "Released under the MIT License.",
           "Apache-2.0": "Licensed under the Apache License, Version 2.0."}


def test_licenses_found_where_a_notice_stands(spark, texts):
    for r in rows(queries.QUERIES["op10_license_scan"](spark, SF1)):
        pass
    got = {r.doc_id: r.licenses for r in rows(queries.QUERIES["op10_license_scan"](spark, SF))}
    for d, t in texts.items():
        assert got[d] == ",".join(sorted(k for k, n in NOTICES.items() if n in t))


def test_wording_decides_between_like_licenses():
    s = licenses.Scanner()
    names = lambda t: {x["license"] for x in s.scan(t)}
    assert names("foo bar. Licensed under CC BY 4.0. foo") == {"CC-BY-4.0"}
    assert names("foo bar. Licensed under CC BY-SA 4.0. foo") == {"CC-BY-SA-4.0"}
    assert names("under the terms of the GNU General Public License version 2 only") == {"GPL-2.0"}
    assert names("under the terms of the GNU General Public License version 9") == {None}
    assert names("Driving licence and copyright of something else entirely") == {None}
    assert names("no hint here") == set()
    assert names("Licensed under the Apache License, Version 2.0. " + "x y " * 200 + "Released under the MIT License.") == {"Apache-2.0", "MIT"}


def test_size_reduction_ranks_the_right_template_first():
    s = licenses.Scanner()
    for i, (_, notices, _) in enumerate(s.templates):
        for n in notices:
            if len(n) >= 8:
                gains = s.reductions(" ".join(n))
                assert gains[i] == max(gains)
