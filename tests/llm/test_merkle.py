"""The manifest against a recursive build in memory and the DuckDB statement."""

import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from wattle.llm import merkle
from wattle.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, number long, n long, tree string, digest string, proof int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*(field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def proofs(leaves):
    """(root, siblings of each leaf as (place, others) level by level)."""
    level, where, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for k, at in enumerate(where):
            run, slot = runs[at // 8], at % 8
            paths[k].append((slot, run[:slot] + run[slot + 1:]))
            where[k] = at // 8
        level = [h(*run) for run in runs]
    return level[0], paths


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[lang] = (mine, *proofs([leaf(r, r["text"]) for r in mine]))
    root, above = proofs([trees[x][1] for x in langs])
    out = []
    for lang, top in zip(langs, above):
        mine, subroot, paths = trees[lang]
        for r, path in zip(mine, paths):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for slot, others in path + top:
                folded = h(*others[:slot], folded, *others[slot:])
            out.append((r["doc_id"], leaf(r, r["text"]), subroot, root, h(*(x for _, o in path + top for x in o)), folded, folded == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def run(docs, levels=merkle.LEVELS):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return result(merkle.verify(merkle.manifest(docs, F.when(third, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text")), levels)))


def test_op12_matches_a_recursive_build(spark):
    docs = read(spark, SF, "documents")
    got = result(merkle.op12_merkle_manifest(spark, SF))
    assert got == brute([r.asDict() for r in docs.collect()])
    assert {r[-1] for r in got} == {True, False}


def test_op12_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    rows = con.execute(merkle.OP12_SQL)
    at = [[c[0] for c in rows.description].index(c) for c in merkle.op12_merkle_manifest(spark, SF).columns]
    assert sorted((tuple(r[i] for i in at) for r in rows.fetchall()), key=str) == result(merkle.op12_merkle_manifest(spark, SF))


@pytest.mark.parametrize("levels", [1, 2])
@pytest.mark.parametrize("sizes", [(9,), (65, 1, 7), (513, 3), tuple([2] * 70)])
def test_many_rounds(spark, levels, sizes):
    """Blocks of 8 or 64 leaves, so the queue passes several rounds in both directions."""
    rows = [(1000 * k + i, f"Text {i}", f"l{k:02d}" if k else None, "S", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert run(docs, levels) == brute([r.asDict() for r in docs.collect()])


def test_edges(spark):
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, "A" * 300_000, None, "a", 5), (4, "Ärger ÄÖ Z", "de", "b", 7),
            (4, "Ärger ÄÖ Z", "de", "b", 7), (None, "No ID", "en", "b", 1), (None, "No ID", "en", "b", 1), (None, None, None, None, None),
            (5, "-", "", "", 1), (-7, "NEGATIVE", "é", "x", -1), (9, "Zebra", "z", "x", 1)]
    docs = spark.createDataFrame([(*r, -1, -1, "t", "d", 3) for r in rows], SCHEMA)
    expect = brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert run(docs) == expect and len(expect) == len(rows)
    assert run(docs.limit(0)) == []
    one = run(docs.filter("doc_id = 9"))
    assert len(one) == 1 and one[0][1] == one[0][2] == one[0][3] and one[0][4] == h()


def test_one_changed_leaf_is_the_only_one_that_fails(spark):
    docs = read(spark, SF, "documents")
    found = F.when(F.col("doc_id") == 7, F.concat("text", F.lit("."))).otherwise(F.col("text"))
    got = merkle.verify(merkle.manifest(docs, found)).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]
