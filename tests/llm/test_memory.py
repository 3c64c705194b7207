"""Python tasks give their memory back: workers live on between stages and count in the executor."""

import pandas as pd
import pytest

from riskloom.llm import common, simhash, similar


def test_memory_arrow_keeps_is_given_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(True)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    common.give_back_memory()
    assert released


@pytest.mark.parametrize(
    "module, make, rows",
    [
        (similar, lambda: similar._codes("x"), ["a b", None]),
        (similar, lambda: similar._nearest("x", 0.8), [[]]),
        (similar, lambda: similar._unsettled("x", 0.8), [[]]),
        (similar, lambda: similar._stars("x", 0.8), [[]]),
        (similar, lambda: similar._similar("x", "y", 0.8), []),
        (simhash, lambda: simhash._stars("x", 4), []),
    ],
)
def test_tasks_of_near_duplicates_end_by_giving_memory_back(monkeypatch, module, make, rows):
    ended = []
    monkeypatch.setattr(module, "give_back_memory", lambda: ended.append(True))
    monkeypatch.setattr(module, "pandas_udf", lambda kind: lambda task: lambda *columns: task)
    task = make()
    list(task(iter([pd.Series(rows, dtype=object)] if rows == ["a b", None] else [])))
    assert ended == [True]
