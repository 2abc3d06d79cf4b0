"""Fingerprints that grow with the text, and likeness from anchors matched by place."""

import numpy as np

from wattle.llm import syncmers


def text(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(chr(c) for c in rng.integers(97, 123, 5)) for _ in range(n)).encode()


def test_a_passage_of_two_long_texts_counts():
    passage = text(3, 50)
    a, b = syncmers.sketches([text(1, 10_000) + b" " + passage + b" " + text(2, 10_000),
                              text(4, 3_000) + b" " + passage + b" " + text(5, 17_000)])
    n = syncmers.position_matches(a, b)
    assert 50 <= n <= 80 and syncmers.likeness(a, b) == n / (len(a) + len(b) - n) > 0


def test_the_fingerprint_grows_with_the_text_and_holds_places():
    small, large = syncmers.sketches([text(1, 1_000), text(1, 20_000)])
    f, g = syncmers.as_bytes(small), syncmers.as_bytes(large)
    assert 15 * len(f) < len(g)
    got = np.frombuffer(f, [("gap", ">u4"), ("hash", ">u8")])
    assert set(zip(np.cumsum(got["gap"]).tolist(), got["hash"].tolist())) <= set(map(tuple, small.tolist()))
    assert all(len(syncmers.as_bytes(x)) >= 12 for x in syncmers.sketches([b"a", text(2, 10)]))


def test_unrelated_large_texts_share_nothing():
    a, b = syncmers.sketches([text(1, 300_000), text(2, 300_000)])
    assert syncmers.likeness(a, b) == 0.0


def test_repeated_anchors_match_at_their_neighbours_distance():
    line, x, y = b"the same line stands here again and again; ", text(6, 60), text(7, 60)
    a, b = syncmers.sketches([x + line + y, line + x + line + y])
    assert syncmers.position_matches(a, b) == len(a) and syncmers.likeness(a, a) == 1.0
    assert syncmers.likeness(*syncmers.sketches([b"abcdefgh" * 9] * 2)) == 1.0


def slow_anchors(t: bytes):
    """Closed syncmers by their definition: the smallest inner substring stands first or last."""
    out = []
    for i in range(len(t) - syncmers.K + 1):
        inner = [syncmers_hash(t[i + j:i + j + syncmers.S]) for j in range(syncmers.K - syncmers.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def syncmers_hash(piece: bytes) -> int:
    """Order of an inner substring: from a text that consists of it alone, so nothing around it matters."""
    from wattle.llm import nptext
    pw, inv = nptext._powers(len(piece))
    value = (nptext._BYTE[np.frombuffer(piece, np.uint8)] * pw[:len(piece)]).sum(dtype=np.uint64)
    return int(nptext.mix(np.array([value], np.uint64))[0])


def test_anchors_follow_the_definition():
    for t in (text(21, 40), b"abababababababababababab", b"x" * 40, "Größe 你好 ".encode() * 6, text(22, 3)):
        got = syncmers.sketches([t])[0][:, 0].tolist()
        assert got == (slow_anchors(t) if len(t) >= syncmers.K else [0])


def test_equal_fingerprints_are_alike_and_likeness_needs_only_the_bytes():
    base = text(11, 4_000)
    changed = base[:10] + bytes([base[10] % 25 + 97]) + base[11:]
    a, b, c = syncmers.sketches([base, changed, text(12, 4_000)])
    pa, pb, pc = map(syncmers.as_bytes, (a, b, c))
    assert np.array_equal(syncmers.from_bytes(pa), syncmers.chosen(a))
    assert syncmers.print_likeness(pa, pa) == 1.0 and syncmers.print_likeness(pa, pc) == 0.0
    if pa == pb:
        assert syncmers.print_likeness(pa, pb) == 1.0
    assert syncmers.print_likeness(b"", b"") == 1.0 and syncmers.print_likeness(b"", pa) == 0.0
    half = syncmers.as_bytes(syncmers.sketches([base[:len(base) // 2] + text(13, 2_000)])[0])
    assert 0.2 < syncmers.print_likeness(pa, half) < 0.5


def test_query_likeness_is_that_of_its_fingerprints(spark):
    rows = spark.createDataFrame([(i, text(i, 300).decode() if i % 3 else text(0, 300).decode()) for i in range(40)] + [(90, ""), (91, None)],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprint_documents(rows).collect()}
    order = sorted(got, reverse=True)
    for i, d in enumerate(order):
        mine, nxt = bytes.fromhex(got[d].fingerprint), bytes.fromhex(got[order[(i + 1) % len(order)]].fingerprint)
        assert got[d].near_next == syncmers.print_likeness(mine, nxt)
        assert got[d].near_edited == syncmers.print_likeness(mine, bytes.fromhex(got[d].edited_fingerprint))
