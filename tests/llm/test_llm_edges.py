"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import pytest
from pyspark.sql import functions as F

from wattle.llm import (chat, decontam, langid, licenses, mixing, ngram_join, pii, syncmers, tokens, toxicity)

COLS = ("doc_id long, text string, lang string, source string, n_chars long, size long, _h long, set_id long, "
        "mask long, root string, target double, key string")
LONG = "alpha beta gamma delta " * 20_000
ROWS = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "a"), (4, "!!! ...", "en", "b"),
        (5, "The quick brown fox jumps over the lazy dog again", "en", "b"),
        (5, "The quick brown fox jumps over the lazy dog again", "en", "b"),
        (6, "one two", "en", "b"), (None, "The quick brown fox jumps over the lazy dog again", "en", "b"),
        (7, LONG, "en", "a"), (8, "Ärger über Größe, für die schöne Straße", "de", "a"), (9, "你好 世界", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 0, -1, -2, -3, -4, "r", 0.5, "k") for r in ROWS]
    return spark.createDataFrame(rows, COLS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, None), (7, 0, 1), (None, 1, 1), (8, None, 0)], "doc_id long, toxic int, quality int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "brown fox JUMPS"), (2, None), (3, ""), (3, "quick brown"), (None, "lazy dog again")],
                                 "item_id long, text string")


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_languages(docs, none):
    got = langid.identify_languages(docs)
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got.collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 4))
    assert by[5].lang_pred in ("de", "en") and 0 <= by[5].score <= 1
    assert by[9].lang_pred in ("de", "en")
    assert langid.identify_languages(none).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify_languages(unlabelled).collect()} == {"und"}


def test_decontamination(docs, none, bench):
    got = decontam.decontaminate(docs, bench)
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got.collect()}
    assert (by[5].n_words, by[5].n_hit, by[5].n_items) == (10, 7, 2)       # the null item hits but is not listed
    assert by[None].n_hit == 7 and by[1].n_words == 0 and by[7].n_words == 80_000 and not by[7].contaminated
    assert decontam.decontaminate(none, bench).collect() == []
    assert decontam.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and ids(kept) == [1, 2, 3, 4, 6, 7, 8, 9]


def test_query_blocks_give_the_same_hits(docs, bench):
    index = decontam.build_index(docs)
    one, many = (decontam.documents_hit(index, decontam.find_matches(index, bench, query_words=w)) for w in (1 << 20, 2))
    count = F.size(F.array_distinct(F.flatten(F.transform("ranges", lambda r: F.sequence(r["start"], r["stop"] - 1)))))
    rows = [sorted(map(str, d.select("doc_id", "items", count).collect())) for d in (one, many)]
    assert rows[0] == rows[1]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x green y blue"), (2, "blue red green"), (3, "red " + "z " * 30 + "green blue")],
                                 "doc_id long, text string")
    item = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    index = decontam.build_index(docs)
    near = decontam.documents_hit(index, decontam.find_matches(index, item, slop=3)).filter("ranges IS NOT NULL")
    assert ids(near) == [1, 2]
    assert decontam.find_matches(index, item).collect() == []


def test_near_copies(docs, none):
    got = ngram_join.jaccard_components(docs)
    assert ids(got) == ALL_IDS
    by = {r.doc_id: r for r in got.collect()}
    assert by[5].component_id == 5 and by[None].component_id == 5          # a null id never names a group
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 5, 6, 7)] == [0, 0, 0, 1, 6, 1, 4]
    assert all(by[i].component_id == i for i in (1, 2, 3, 4, 6, 7, 8, 9))
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns and ids(kept) == [1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert ngram_join.jaccard_components(none).collect() == []
    assert ngram_join.drop_near_copies(none).collect() == []


def test_personal_data(docs, none):
    got = pii.find_personal_data(docs)
    assert ids(got) == ALL_IDS and got.filter("spans <> ''").count() == 0
    assert pii.find_personal_data(none).collect() == []


def test_fingerprints(docs, none, spark):
    got = syncmers.fingerprint_documents(docs)
    assert ids(got) == ALL_IDS
    rows = {}
    for r in got.collect():
        rows.setdefault(r.doc_id, r)
    assert rows[5].fingerprint == rows[None].fingerprint
    assert rows[1].fingerprint == "" and rows[1].n_chars == 0
    assert rows[2].near_next == 1.0                                        # empty after empty
    one = syncmers.fingerprint_documents(spark.createDataFrame([(1, "abcdefgh" * 9)], "doc_id long, text string")).first()
    assert one.near_next == 1.0                                            # a single document follows itself
    assert syncmers.fingerprint_documents(none).collect() == []


def test_toxicity(docs, none, labels):
    got = toxicity.score_toxicity(docs, labels)
    assert ids(got) == ALL_IDS
    rows = got.collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in rows if r.doc_id in (1, 2, 3)} == {next(r.score for r in rows if r.doc_id == 1)}
    assert toxicity.score_toxicity(none, labels).collect() == []
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns


@pytest.mark.parametrize("known", [[], [(1, 0), (2, 0), (3, 0)], [(7, 1)]])
def test_toxicity_without_labels_of_both_classes(spark, known):
    clean = [(i, f"a walk by the river on day {i} was calm") for i in range(1, 7)] + [(10, None), (11, "")]
    toxic = [(7, "you are a stupid idiot and a moron"), (8, "shut up you pathetic loser, stupid scum")]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string")
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert max(got[i] for i, _ in clean) < 0.25 and min(got[i] for i, _ in toxic) > 0.5
    assert sorted(r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()) == [i for i, _ in clean]


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert ids(got) == ALL_IDS
    assert all(0 <= r.taken <= 2 * r.size and (r.size or r.taken == 0) for r in got.collect())
    assert mixing.mix(none).collect() == []
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    taken = {r.doc_id: r["sum(taken)"] for r in got.groupBy("doc_id").sum("taken").collect()}
    words = mixing.word_count(F.col("text"))
    out = {r.doc_id: r.w for r in rows.groupBy("doc_id").agg(F.sum(words).alias("w")).collect()}
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in out.items() if v}


def test_chats(spark):
    rows = [(1, 2, "assistant", "b", 9), (1, 1, "user", None, 9), (1, 2, "assistant", "a", 9), (1, 2, "assistant", "a", 9),
            (1, None, None, "<|im_end|>\\<|im_sep|>", 9), (None, 1, "assistant", "x[/INST]", 9), (2, 1, "user", "", 9)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted long")
    out = chat.format_chats(df)
    got = {r.conv_id: r for r in out.select("conv_id", chat.parse_chats(F.col("formatted")).alias("t"), "formatted",
                                            chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("l")).collect()}
    assert [tuple(x) for x in got[1].t] == [("", "<|im_end|>\\<|im_sep|>"), ("user", ""), ("assistant", "a"),
                                           ("assistant", "a"), ("assistant", "b")]
    assert got[1].l == "aab" and got[None].l == "x[/INST]" and got[2].l == ""
    assert "[/INST]" not in got[None].formatted
    assert chat.format_chats(df.limit(0)).collect() == []


@pytest.mark.parametrize("text", ["</s>", "<\\/s>", "<\\\\|im_end|>", "a[INST]b[/INST]", "<<SYS>>x</s", "[<|im_sep|>", "\\"])
def test_escapes_are_reversible(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(
        chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert r.u == text
    assert not any(m in r.e for m in (chat.START, chat.ROLE, chat.SEP, chat.END, "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_tokens(docs, none, spark, tmp_path):
    got = tokens.tokenize_documents(docs)
    assert ids(got) == ALL_IDS
    rows = sorted(got.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]
    assert rows[1].n_tokens == 1 and rows[8].n_tokens > 60_000
    assert tokens.tokenize_documents(none).collect() == []


def test_licenses(docs, none, spark):
    got = licenses.scan_licenses(docs)
    assert ids(got) == ALL_IDS and got.filter(F.size("found") > 0).count() == 0
    assert licenses.scan_licenses(none).collect() == []
