"""The order-dependent acceptance model: one step for batch and for streaming, with stored states.

A row is accepted if its series has fewer than SEED accepted rows, or if it is within TOLERANCE of the upper median of
the last WINDOW accepted rows. Only accepted rows change the state; a null is never accepted.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandline.operators.fold import fold_sorted
from strandline.operators.ledger import config_hash, latest
from strandline.operators.versioned import Ledger

SEED, WINDOW, TOLERANCE = 5, 25, 40.0
STATE_VERSION = 1


def identity() -> str:
    """Hash of all that decides what a stored state means; a state of another identity can't be restored."""
    return config_hash({"model": "rolling-model", "version": STATE_VERSION, "seed": SEED, "window": WINDOW, "tolerance": TOLERANCE})


class RollingModel:
    """The state of one series: the accepted values of the window, in order of arrival and in order of size."""

    def __init__(self, history: list[float] = ()):
        self.window, self.order = list(history), sorted(history)

    def accept(self, value: float | None) -> bool:
        if value is None or value != value:
            return False
        if len(self.window) >= SEED and abs(value - self.order[len(self.order) // 2]) > TOLERANCE:
            return False
        self.window.append(value)
        bisect.insort(self.order, value)
        if len(self.window) > WINDOW:
            del self.order[bisect.bisect_left(self.order, self.window.pop(0))]
        return True

    def state(self) -> dict:
        return {"identity": identity(), "history": list(self.window)}

    @classmethod
    def restore(cls, state: dict) -> RollingModel:
        if state.get("identity") != identity():
            raise ValueError("the stored state belongs to another model or version")
        history = state["history"]
        if len(history) > WINDOW or any(not isinstance(v, float) or v != v for v in history):
            raise ValueError("the stored state is damaged")
        return cls(history)


def _folded(rows: DataFrame, series: str, seq: str, value: str, values, added: str) -> DataFrame:
    """Fold rows (series, seq, value, history); a row with a history sets the state and gives no result."""

    def start() -> list:
        return [RollingModel(), 0]

    def step(state: list, row: tuple) -> tuple[list, tuple | None]:
        if row[3] is not None:
            return [RollingModel(row[3]), 0], None
        state[1] += 1
        return state, values(state[0].accept(row[2]), state)

    return fold_sorted(rows, series, [F.asc(seq), F.asc_nulls_last("__history")], start, step, added).drop("__history")


def rolling_model(df: DataFrame, series: str, seq: str, value: str) -> DataFrame:
    """Batch form: (series, seq, value, accepted). Series are read in order of seq and may be of any length."""
    rows = df.select(series, seq, value).withColumn("__history", F.lit(None).cast("array<double>"))
    return _folded(rows, series, seq, value, lambda ok, state: (ok,), "accepted boolean")


def checkpoints(df: DataFrame, series: str, seq: str, value: str, every: int = 1000) -> DataFrame:
    """(series, seq, identity, history): the state after each `every`-th row of a series."""
    rows = df.select(series, seq, value).withColumn("__history", F.lit(None).cast("array<double>"))
    found = _folded(rows, series, seq, value, lambda ok, state: (list(state[0].window),) if state[1] % every == 0 else None, "history array<double>")
    return found.select(series, seq, F.lit(identity()).alias("identity"), "history")


def resumed(df: DataFrame, book: DataFrame, series: str, seq: str, value: str, first: int) -> DataFrame:
    """`rolling_model` for the rows from `first` on, without reading a series from its start: each series goes on from its
    last stored state before `first`, and only the rows after that state are read again. A series without one starts anew."""
    other = book.filter(~F.col("identity").eqNullSafe(F.lit(identity()))).limit(1).count()
    if other:
        raise ValueError("the stored state belongs to another model or version")
    last = book.filter(F.col(seq) < first).groupBy(series).agg(F.max_by(F.struct(seq, "history"), seq).alias("s")).select(series, F.col(f"s.{seq}").alias("__at"), F.col("s.history").alias("__history"))
    rows = df.select(series, seq, value).join(last.select(series, "__at"), series, "left").filter(F.col("__at").isNull() | (F.col(seq) > F.col("__at"))).drop("__at")
    rows = rows.withColumn("__history", F.lit(None).cast("array<double>"))
    states = last.select(series, F.col("__at").alias(seq), F.lit(None).cast("double").alias(value), "__history")
    return _folded(rows.unionByName(states), series, seq, value, lambda ok, state: (ok,), "accepted boolean").filter(F.col(seq) >= first)


def rolling_model_stream(df: DataFrame, series: str, seq: str, value: str) -> DataFrame:
    """Streaming form with the same results, as long as each series arrives in order: the state is the window."""
    kind = df.schema[series].dataType.simpleString()

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        model = RollingModel()
        if state.exists:
            model = RollingModel.restore(dict(zip(("identity", "history"), state.get, strict=True)))
        rows = pd.concat(list(batches)).sort_values(seq, kind="stable")
        rows["accepted"] = [model.accept(v) for v in rows[value].tolist()]
        state.update((identity(), model.window))
        yield rows[[series, seq, value, "accepted"]]

    return df.select(series, seq, value).groupBy(series).applyInPandasWithState(
        run, f"{series} {kind}, {seq} long, {value} double, accepted boolean", "identity string, history array<double>", "append", GroupStateTimeout.NoTimeout
    )


def to_ledger(path: str, key: list[str], newest):
    """A foreachBatch function that commits each micro-batch to the ledger at `path` (`versioned.Ledger`), with the batch's
    number in `batch_id`. A commit writes the batch's rows and a manifest, whatever the size of the ledger.

    A batch that the ledger holds already, and any batch before it, is not applied again: replaying changes nothing."""

    def commit(batch: DataFrame, batch_id: int) -> None:
        new = latest(batch, key, newest).withColumn("batch_id", F.lit(batch_id).cast("long"))
        Ledger(batch.sparkSession, path, new.schema, key).commit(new, "stream", batch_id)

    return commit
