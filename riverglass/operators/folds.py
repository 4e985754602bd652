"""Sequential rules over a key's rows: constant state, rows streamed in order, nothing collected.

A key's rows are read in order by one task, as the rules need; the task holds one state and one Arrow batch, so a key
may have any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

Step = Callable[[Any, dict[str, Any]], tuple[Any, dict[str, Any]]]


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], init: Callable[[], Any], step: Step, added: str, reads: Sequence[str] | None = None) -> DataFrame:
    """Add columns (a DDL string) that step gives for each row of a key in order.

    step takes the state, which starts as init(), and a row, and returns the next state and the added columns. The
    row has the keys and the columns that reads names, all if it names none; the others stay in Arrow.
    """
    names = [x.strip().split(" ")[0] for x in added.split(",")]
    columns = df.columns
    seen = list(dict.fromkeys([*keys, *(columns if reads is None else reads)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = object(), None
        types = None
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for row in batch.select(seen).to_pylist():
                here = tuple(row[k] for k in keys)
                if here != key:
                    key, state = here, init()
                state, found = step(state, row)
                for column, name in zip(out, names, strict=True):
                    column.append(found[name])
            types = types or [_ARROW[x.strip().split(" ")[1]]() for x in added.split(",")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, t) for c, t in zip(out, types, strict=True))], [*columns, *names])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, f"{kind}, {added}")


_ARROW = {"boolean": pa.bool_, "bigint": pa.int64, "double": pa.float64, "string": pa.string, "int": pa.int32}
