"""Personal data: what the generators must propose, and how samples and thresholds are made."""

import pytest

from wattle.llm import pii


def proposed(t, kind):
    return {t[s:e] for k, s, e in pii.propose(t) if k == kind}


@pytest.mark.parametrize("t, x", [
    ("ask john at example.com now", "john at example.com"),
    ("ask ann at mail [dot] com now", "ann at mail [dot] com"),
    ("ask ann at mail (dot) com now", "ann at mail (dot) com"),
    ("ask ann at mail dot com", "ann at mail dot com"),
    ("Ask ANN (AT) MAIL.COM now", "ANN (AT) MAIL.COM"),
    ("Ask ANN AT MAIL DOT COM", "ANN AT MAIL DOT COM"),
    ("ask ann [At] mail.com", "ann [At] mail.com"),
    ("ask john at example.com. Thanks", "john at example.com")])
def test_every_mark_is_proposed_whatever_else_the_text_holds(t, x):
    assert x in proposed(t, "email")
    assert x in proposed(t + " and me@other.org", "email")


def test_the_word_at_alone_is_no_address():
    assert proposed("we met at noon and sat at home", "email") == set()


def test_an_address_without_any_other_mark_is_added(spark):
    good = [(i, f"Please write to ann{i}@mail{i % 7}.example.com today") for i in range(300)]
    more = [(1000, "Please write to john at example.com today"), (1001, "Please write to ANN (AT) MAIL.COM today")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(good + more, "doc_id long, text string")).collect()}
    assert got[1000].spans == "email:16:35" and got[1001].n_added == 1


@pytest.mark.parametrize("t, kind, parts", [
    ("0171 5551234, 0171 5559876", "phone", {"0171 5551234", "0171 5559876"}),
    ("4111.1111.1111.1111 5500.0000.0000.0004", "card", {"4111.1111.1111.1111", "5500.0000.0000.0004"}),
    ("on 12/05/2024 0171 5551234", "phone", {"0171 5551234"}),
    ("10-1-2-3, 10-1-2-4", "ip", {"10-1-2-3", "10-1-2-4"}),
    ("1, 2, 3, " * 50 + "(0171) 5551234", "phone", {"(0171) 5551234"})])
def test_neighbouring_numbers_are_proposed_one_by_one(t, kind, parts):
    assert parts <= proposed(t, kind)


def test_long_lists_of_numbers_give_few_proposals_a_number():
    assert len(pii.propose("1 " * 20_000)) <= 20_000 * 2 * pii.MOST_DIGITS


def test_numbers_in_a_list_are_added(spark):
    cards = [f"4111 1111 1111 {n}" for n in range(1000, 5000) if pii.luhn(f"411111111111{n}")]
    good = [(i, f"Please call +1 ({200 + i}) 555-{7000 + i} or pay with {cards[i]} today") for i in range(400)]
    one, two = cards[3].replace(" ", "."), cards[7].replace(" ", ".")
    more = [(1000, f"Please pay with {one}, {two} today")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(good + more, "doc_id long, text string")).collect()}
    t = more[0][1]
    spans = {t[int(s):int(e)] for _, s, e in (x.split(":") for x in got[1000].spans.split(",") if x)}
    assert spans == {one, two}


def test_a_rare_kind_in_a_large_table_is_learnt(spark):
    many = [(i, f"Write to ann{i}@mail{i % 7}.example.com on day {i}") for i in range(1200)]
    rare = [(10_000 + i, f"The server at 10.{i}.4.{200 - i} is up") for i in range(30)]
    more = [(20_000, "The server at 10-7-4-9 is up")]
    docs = spark.createDataFrame(many + rare + more, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs, sample=100).collect()}
    assert got[20_000].spans == "ip:14:22"


def test_each_kind_is_drawn_by_itself_and_copies_count_once(spark):
    rows = [(i, f"Write to a{i}@b.org", i) for i in range(500)] + [(0, "Write to a0@b.org", 0)] * 500
    rows += [(1000 + i, f"from 10.0.0.{i}", 1000 + i) for i in range(50)]
    got = pii.draw(spark.createDataFrame(rows, "doc_id long, text string, h long"), 80)
    assert got["ip"] == set(range(1000, 1050)) and 80 <= len(got["email"]) <= 120


def test_the_cut_counts_every_text():
    import numpy as np
    score, y, n = np.array([9.0, 5.0, 5.0, 1.0]), np.array([1.0, 1.0, 0.0, 0.0]), np.array([1000, 2000, 20, 500])
    assert pii.lowest_cut(score, y, n) == 5.0
    assert pii.lowest_cut(score, y, np.array([1000, 2000, 200, 500])) == 9.0


HIDDEN = {"email": ("Please write to ann{i}@mail{j}.example.com today", "Please write to bob{i} (at) post{j}.example.com today"),
          "phone": ("Please call +49 171 555{n} today", "Please call 0171 556{n} today"),
          "ip": ("The server at 10.{j}.4.{j} is up", "The server at 10-{j}-7-{j} is up"),
          "card": ("Please pay with {card} today", "Please pay with {dots} today")}
CLEAN = ["On 12/05/2024 we paid 1,250 and 3,400 in 17 parts", "Chapters 1.2.3 and 4.5 hold 120 tables", "we met at noon. It sat at home",
         "In 2019 2020 2021 the yield was 12.5, 13.75 and 14.25", "", "plain words alone"]


@pytest.mark.parametrize("many", [1, 40, 400])
def test_the_more_is_hidden_the_more_is_found(spark, many):
    cards = [f"4111 1111 {a} {n}" for a in range(1000, 1020) for n in range(1000, 1999) if pii.luhn(f"41111111{a}{n}")]

    def text(form, i):
        return form.format(i=i, j=i % 250, n=1000 + i, card=cards[i], dots=cards[i].replace(" ", "."))
    rows, want = [], {}
    for k, (plain, hidden) in enumerate(HIDDEN.values()):
        rows += [(10_000 * k + i, text(plain, i)) for i in range(400)]
        want.update({10_000 * k + 1_000 + i: text(hidden, 500 + i) for i in range(many)})
    clean = [(90_000 + i, t) for i, t in enumerate(CLEAN)]
    docs = spark.createDataFrame(rows + list(want.items()) + clean, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    for k, kind in enumerate(HIDDEN):
        found = [got[d].n_added == 1 and got[d].spans.startswith(kind) for d in want if d // 10_000 == k]
        assert sum(found) >= 0.9 * len(found), kind
    assert all(got[d].n_added == 0 for d, _ in clean + rows)
