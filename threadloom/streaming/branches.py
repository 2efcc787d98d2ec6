"""Work that is sequential in a branch and parallel across branches."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a step is given, and what it gives: the branch, its state so far (None at first), the next rows in order; the new
#: state and rows to give out.
Step = Callable[[Any, Any, list[dict]], tuple[Any, list[dict]]]


def fold_branches(rows: DataFrame, key: str, order: list[str | Column], step: Step, schema: str, size: int = 500) -> DataFrame:
    """Takes each branch's rows in order through `step`, at most `size` at once, with the state that the step before left.

    Rows are dealt by branch and sorted by branch and order, and a task reads them as a stream: it holds the rows of one step
    and the state of one branch, however long the branch is. A null branch is a branch like others.
    """
    sorted_ = rows.repartition(F.col(key)).sortWithinPartitions(F.col(key), *order)
    out_schema = rows.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(out_schema)
        branch = state = None
        begun, held, made = False, [], []

        def work():
            nonlocal state, held
            state, new = step(branch, state, held)
            made.extend(new)
            held = []

        def flush():
            batch = pa.RecordBatch.from_pylist(made, schema=shape)
            made.clear()
            return batch

        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row[key] != branch:
                    if held:
                        work()
                    begun, branch, state = True, row[key], None
                held.append(row)
                if len(held) == size:
                    work()
            if made:
                yield flush()
        if held:
            work()
        if made:
            yield flush()

    return sorted_.mapInArrow(run, out_schema)
