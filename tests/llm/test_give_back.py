"""Python workers give freed memory back between the pipeline's steps."""

import re
from pathlib import Path

import pyarrow as pa
import pytest

from wattle.llm import common


def test_step_passes_all_batches_and_gives_back_now_and_then_and_at_its_end(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(common, "GIVE_BACK_EVERY", 4)
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(10)]
    assert list(common.thrifty(iter)(batches)) == batches
    assert len(calls) == 3
    assert list(common.thrifty(iter)([])) == []
    assert len(calls) == 4


def test_step_that_fails_or_is_left_gives_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))

    def broken(batches):
        yield 1
        raise ValueError("bad row")
    with pytest.raises(ValueError, match="bad row"):
        list(common.thrifty(broken)([]))
    left = common.thrifty(iter)([1, 2])
    next(left)
    left.close()
    assert len(calls) == 2


def test_give_back_empties_the_pool():
    pa.array(range(1_000_000))
    common.give_back()
    assert pa.array([1]).to_pylist() == [1]


def test_every_python_step_of_the_pipeline_is_thrifty():
    folder = Path(common.__file__).parent
    for name in ("toxicity", "ngram_join", "membership", "decontam", "tokens"):
        text = (folder / f"{name}.py").read_text()
        assert re.findall(r"\.mapInArrow\((?!thrifty\()", text) == [], name
