"""Steps of the component search and the dealing of the join's rows."""

import numpy as np
import pytest

from wattle.llm import components, ngram_join


def _written(monkeypatch, *modules):
    names = []
    for module in modules:
        def watched(df, name, keep=module.keep):
            names.append(name)
            return keep(df, name)
        monkeypatch.setattr(module, "keep", watched)
    return names


def _find(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_links_that_are_stars_after_a_step_are_written_once(spark, monkeypatch):
    names = _written(monkeypatch, components)
    links = [(1, x) for x in range(2, 40)] + [(100, x) for x in range(90, 99)] + [(7, 7), (1, 2)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: r for x, r in _find(links).items() if x != 100} | {100: 90}
    assert names == ["edges"]


@pytest.mark.parametrize("seed", range(3))
def test_rounds_of_contracted_links_keep_the_components(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(-60, 60, (90, 2))] + [(i, i + 1) for i in range(200, 230)]
    rng.shuffle(links)
    exp, edges = _find([tuple(map(int, x)) for x in links]), None
    for lo in range(0, len(links), 40):
        some = spark.createDataFrame([tuple(map(int, x)) for x in links[lo:lo + 40]], "a long, b long")
        edges = components.contracted(some if edges is None else edges.union(some))
        assert all(exp[r.node] == exp[r.root] for r in components.labels(edges).collect())
    got = {r.node: r.root for r in components.components(edges.toDF("a", "b")).collect()}
    linked = {x for a, b in links for x in (int(a), int(b)) if a != b}
    assert got == {x: exp[x] for x in linked}


def test_near_copies_need_few_written_edges(spark, monkeypatch):
    """A round adds its links to the contracted ones instead of beginning anew with all links so far."""
    names = _written(monkeypatch, components, ngram_join)
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[:i % 60] + [f"x{i}"] + words[i % 60 + 1:])) for i in range(60)],
                                 "doc_id long, text string")
    got = {r.component_id for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {0}
    assert names.count("edges") <= 8


def test_a_large_family_of_texts_is_dealt_to_many_tasks():
    assert ngram_join.REGION <= ngram_join.CELL
