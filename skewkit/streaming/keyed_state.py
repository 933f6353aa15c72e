"""Running counts kept in keyed state: numbered as they arrive, with idle words timed out and a starting state from a table.

:class:`RunningCounter` is the state function of the reference's running count in the second state interface: a word's
total, and for each topic partition the last offset counted, in one value: a word costs two calls to the state store a batch,
however many partitions it comes from. A word's rows of a batch are numbered frame by frame as Spark
hands them over, so no list of them is held. With ``idle`` each word has a timer, renewed whenever it occurs; when it runs out the
word's total is emitted once more, marked ``idle``, and its state is cleared.

:func:`read_state_counts` reads the counts of a running (or stopped) query from its checkpoint's state store, with no log
of updates in between.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skewkit.streaming.files import names

OUTPUT = "word string, running_cnt long, idle boolean"


class RunningCounter(StatefulProcessor):
    """Numbers a word's occurrences across batches. ``idle_ms``: how long a word may stay away before its state goes; None: for ever."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "total long, positions string")

    def _read(self) -> tuple[int, dict[str, int]]:
        found = self.state.get()
        return (int(found[0]), json.loads(found[1])) if found else (0, {})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total, passed = self._read()       # as the batch found them: frames of one batch come in any order
        ends = dict(passed)
        for frame in rows:
            for at, offset in zip(frame["at"].tolist(), frame["offset"].tolist(), strict=True):
                if offset <= passed.get(at, offset - 1):
                    raise ValueError(f"a batch goes back: {key[0]!r} has offset {offset} of {at} after {passed[at]} was counted")
                if offset > ends.setdefault(at, -1):
                    ends[at] = offset
            n = len(frame)
            yield pd.DataFrame({"word": pd.Series(key[0], index=range(n), dtype=object),
                                "running_cnt": np.arange(total + 1, total + n + 1, dtype=np.int64), "idle": np.zeros(n, bool)})
            total += n
        self.state.update((total, json.dumps(ends)))
        self._renew(timerValues)

    def _renew(self, timerValues) -> None:
        if self.idle_ms is not None:
            for (old,) in [(t,) if isinstance(t, int) else t for t in self.handle.listTimers()]:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, _ = self._read()
        self.state.clear()
        yield pd.DataFrame({"word": pd.Series([key[0]], dtype=object), "running_cnt": np.array([total], np.int64), "idle": np.array([True])})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((int(initialState["cnt"].iloc[0]), "{}"))
        self._renew(timerValues)

    def close(self) -> None:
        pass


def running_count_with_state(words: DataFrame, idle_ms: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """``word, running_cnt, idle`` for each occurrence of a stream of ``word, topic, partition, offset``, in order of arrival.

    ``initial``: a table ``word, cnt`` (one row per word) that the first batch starts from; later starts from the same checkpoint
    have the state already. Needs the RocksDB state store (see :func:`skewkit.streaming.apps.start_running_counts_with_state`).
    """
    at = F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"))
    rows = words.select(F.col("word").cast("string").alias("word"), at.alias("at"), F.coalesce("offset", F.lit(-1)).cast("long").alias("offset"))
    options = {} if initial is None else {"initialState": initial.select("word", F.col("cnt").cast("long").alias("cnt")).groupBy("word")}
    return rows.groupBy("word").transformWithStateInPandas(
        RunningCounter(idle_ms), OUTPUT, "Append", "None" if idle_ms is None else "ProcessingTime", **options)


def read_state_counts(spark: SparkSession, checkpoint: str, key: str = "word", name: str = "cnt") -> DataFrame:
    """``key, name``: the counts that the aggregate of a query (:func:`skewkit.streaming.stateful.running_count`) holds
    after its last committed batch. Empty if it has not committed any."""
    if not [n for n in names(spark, f"{checkpoint}/commits") if n.isdigit()]:
        return spark.createDataFrame([], f"{key} string, {name} long")
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.fields[0].name
    return state.select(F.col(f"key.`{key}`").alias(key), F.col(f"value.`{value}`").cast("long").alias(name))
