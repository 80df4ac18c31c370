"""Order-dependent folds: groups come sorted and pass by, and only a small state is carried from row to row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold_sorted(df: DataFrame, group: str, order: list[Column], start: Callable[[], Any], step: Callable[[Any, tuple], tuple[Any, tuple | None]], added: str) -> DataFrame:
    """df with the columns `added`, for the rows of which `step` returns their values.

    One shuffle by the group and one sort. `step` gets the state and a row (in the order of df's columns) and returns the
    next state and the new values, or None to leave the row out. A group can be of any length: it is never gathered, and
    the state goes on from one Arrow batch to the next."""
    extra = T._parse_datatype_string(added).fields
    at = df.columns.index(group)
    kinds = [f.dataType for f in extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(k) for k in kinds]
        now, state = object(), None
        for batch in batches:
            kept, values = [], []
            for k, row in enumerate(zip(*[c.to_pylist() for c in batch.columns], strict=True)):
                if row[at] != now:
                    now, state = row[at], start()
                state, out = step(state, row)
                if out is not None:
                    kept.append(k)
                    values.append(out)
            if kept:
                some = batch if len(kept) == batch.num_rows else batch.take(pa.array(kept, pa.int64()))
                new = [pa.array(c, t) for c, t in zip(zip(*values, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns, *new], names=[*some.schema.names, *[f.name for f in extra]])

    # by a hash of the group: a union of inputs that are partitioned by the group already would otherwise keep their
    # partitions, which adaptive execution may merge differently for each input
    return df.repartition(F.xxhash64(F.col(f"`{group}`"))).sortWithinPartitions(group, *order).mapInArrow(run, T.StructType([*df.schema.fields, *extra]))
