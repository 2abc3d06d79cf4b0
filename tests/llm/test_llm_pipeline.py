"""The pipeline against a plain version of its stages."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline as P
from wattle.llm import decontam, mixing, ngram_join, tokens, toxicity
from wattle.llm.common import read

SF = "/root/testdata/sf0.01"


def test_stage_names_and_operators():
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_copies", "decontamination", "mixing", "tokens"]
    assert P.ORACLE_SQL is None


def test_run_equals_plain_stages(spark):
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in P.run(spark, SF).collect())
    docs = {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    frame = read(spark, SF, "documents")
    bad = {r.doc_id for r in toxicity.score_toxicity(frame, read(spark, SF, "labels")).filter("predicted = 1").collect()}
    assert bad
    left = {d for d in docs if d not in bad}
    sub = frame.filter(frame.doc_id.isin(sorted(left)))
    comp = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(sub).collect()}
    left = {d for d in left if comp[d] == d}
    sub = frame.filter(frame.doc_id.isin(sorted(left)))
    hit = {r.doc_id for r in decontam.decontaminate(sub, read(spark, SF, "benchmark")).filter("contaminated").collect()}
    assert hit
    left -= hit
    sub = frame.filter(frame.doc_id.isin(sorted(left)))
    times = {r.doc_id: r.taken // r.size for r in mixing.mix(sub).filter("size > 0").collect()}
    assert set(times.values()) == {0, 1, 2}
    e = tokens.Encoder(tokens.tokenizer_path())
    exp, at = [], 0
    for d in sorted(left):
        ids = np.append(np.frombuffer(e.whole(docs[d]["text"]), e.dtype), 1).astype("<u4")
        for _ in range(times[d]):
            exp.append((at, d, len(ids), zlib.crc32(ids.tobytes())))
            at += len(ids)
    assert got == exp


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns_of_documents(spark, k):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    out = P.STAGES[k][1](spark, docs, "/root/testdata/sf0.001")
    assert out.schema.simpleString() == docs.schema.simpleString() and out.count() > 0
