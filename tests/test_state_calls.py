"""What a word costs in a batch: calls to the state store, and no grouping of its few rows."""

import json

import pandas as pd
import pytest

from skewkit.streaming.keyed_state import RunningCounter
from skewkit.streaming.stateful import _per_record_fn


class Store:
    """A value state that counts the calls; there is no other kind of state."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def frame(offsets):
    return pd.DataFrame({"word": "w", "at": [f"t-{o % 4}" for o in offsets], "offset": offsets})


def test_a_word_reads_and_writes_its_state_once_a_batch():
    store, counter = Store(), RunningCounter()
    counter.init(store)
    out = [list(counter.handleInputRows(("w",), iter([frame(range(0, 8)), frame(range(8, 12))]), None)),
           list(counter.handleInputRows(("w",), iter([frame(range(12, 20))]), None))]
    assert [n for frames in out for f in frames for n in f["running_cnt"]] == list(range(1, 21))
    assert store.calls == 4
    with pytest.raises(ValueError, match="goes back"):
        list(counter.handleInputRows(("w",), iter([frame([19])]), None))


class State:
    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_rows_of_a_word_are_not_grouped(monkeypatch):
    monkeypatch.setattr(pd.DataFrame, "groupby", None)
    fn, state = _per_record_fn("word", "offset", "n"), State()
    rows = frame(range(8)).rename(columns={"at": "_at"})
    assert [n for f in fn(("w",), iter([rows]), state) for n in f["n"]] == list(range(1, 9))
    assert json.loads(state.get[1]) == {f"t-{i}": 4 + i for i in range(4)}
    with pytest.raises(ValueError, match="goes back"):
        list(fn(("w",), iter([rows]), state))
