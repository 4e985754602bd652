"""The stateful processor of the streaming jobs. State is in the state store, so it outlives executors and restarts."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.folds import Step

TIME = "event_time"


class OrderedFold(StatefulProcessor):
    """A batch fold's step over a key's rows of a stream, in order of event time across batches.

    Rows wait in the state until the watermark has passed them; then no earlier row can come, as Spark drops those
    that are late. What waits is what came within the watermark's delay. The fold's own state is one pickled value.
    """

    def __init__(self, init: Callable[[], Any], step: Step, order: Sequence[str], columns: Sequence[str]):
        self.start, self.step, self.order, self.columns = init, step, list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "held binary")
        self.state = handle.getValueState("state", "held binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        yield from self._due([row for batch in rows for row in _plain(batch)], timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._due([], timerValues)

    def _due(self, new: list[dict[str, Any]], timerValues: Any) -> Iterator[pd.DataFrame]:
        upto, at = timerValues.getCurrentWatermarkInMs(), self.order[0]
        rows = [pickle.loads(held) for (held,) in self.waiting.get()] + new
        later = [r for r in rows if r[at] > upto]
        due = sorted((r for r in rows if r[at] <= upto), key=lambda r: [(r[c] is not None, r[c]) for c in self.order])
        if later:
            self.waiting.put([(pickle.dumps(r),) for r in later])
            self.handle.registerTimer(int(min(r[at] for r in later)))
        else:
            self.waiting.clear()
        if due:
            state = pickle.loads(self.state.get()[0]) if self.state.exists() else self.start()
            for row in due:
                state, found = self.step(state, row)
                row.update(found)
            self.state.update((pickle.dumps(state),))
            yield pd.DataFrame([[r[c] for c in self.columns] for r in due], columns=self.columns, dtype=object).astype({TIME: "datetime64[ns]"})

    def close(self) -> None:
        return None


def _plain(batch: pd.DataFrame) -> Iterator[dict[str, Any]]:
    """A batch's rows, missing values as None."""
    columns = {c: [None if v is None or isinstance(v, float) and v != v or v is pd.NaT else v for v in batch[c].tolist()] for c in batch.columns}
    for values in zip(*columns.values(), strict=True):
        yield dict(zip(columns, values, strict=True))


def ordered(stream: DataFrame, keys: Sequence[str], order: Sequence[str], init: Callable[[], Any], step: Step, added: str) -> DataFrame:
    """A stream with the columns (a DDL string) that a fold's step adds to each row, as fold() does for a batch.

    The stream has a watermark on event_time, the first of order is the same time in milliseconds, and event_time goes
    on to what follows. Needs the RocksDB state store.
    """
    names = [x.strip().split(" ")[0] for x in added.split(",")]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema), added])
    processor = OrderedFold(init, step, order, [*stream.columns, *names])
    return stream.groupBy(*keys).transformWithStateInPandas(processor, outputStructType=kind, outputMode="append", timeMode="eventTime", eventTimeColumnName=TIME)
