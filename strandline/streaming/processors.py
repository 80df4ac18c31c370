"""Stateful stream operators with typed state variables (`transformWithState`) and the reader of their state.

rolling_stream   the acceptance model of `stateful`: its window in list state, the rest in value state with a layout
                 version; states of layout 1 are taken over key by key, and batch checkpoints can be the initial state
bracket_stream   fills a row from its two direct neighbours: a row that its neighbour could still fill is held in state and
                 released with its successor, wherever the input was cut; `held_rows` gives what waits at the end

Series must arrive in order of the key; a micro-batch's rows of a series, whose number the source's limits bound, are
sorted in one task. State is kept by RocksDB in the checkpoint and read back by the `statestore` source.

A series of a micro-batch is a handful of rows, so they are taken as rows: a frame for each of them would cost more than
the work. Each micro-batch opens and commits every part of the state, so a run with much to read takes it in few of them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strandline.streaming.stateful import RollingModel, identity

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTS = "spark.sql.shuffle.partitions"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Layouts of the rolling model's state: 1 has one value (identity, history), 2 a list and a value with the last key.
LAYOUT = 2


@contextlib.contextmanager
def state_store(spark: SparkSession, parts: int | None = None):
    """Streams that start in here keep their state in RocksDB, which state variables need, in `parts` parts."""
    wanted = {_PROVIDER: _ROCKSDB} | ({_PARTS: str(parts)} if parts else {})
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, x in wanted.items():
        spark.conf.set(name, x)
    try:
        yield
    finally:
        for name, x in before.items():
            spark.conf.set(name, x) if x else spark.conf.unset(name)


def run_available(out: DataFrame, path: str, checkpoint: str, parts: int | None = None) -> None:
    """Process what the source has into a Parquet folder, and stop. `parts`: parts of the state, if other than the session's
    shuffle partitions; a checkpoint keeps the number that it began with."""
    with state_store(out.sparkSession, parts):
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class _Rolling(StatefulProcessor):
    def __init__(self, series: str, seq: str, value: str, layout: int):
        self.names, self.layout = (series, seq, value), layout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.old = handle.getValueState("model", "identity string, history array<double>")
        if self.layout > 1:
            self.meta = handle.getValueState("meta", "version int, identity string, last_seq long")
            self.window = handle.getListState("window", "value double")

    def _load(self) -> RollingModel:
        self.stale = False
        found = self.meta.get() if self.layout > 1 else None
        if found is not None:
            version, name, _ = found
            if version != LAYOUT:
                raise ValueError(f"the stored state has layout {version}")
            return RollingModel.restore({"identity": name, "history": [float(v) for (v,) in self.window.get()]})
        found = self.old.get()
        if found is not None:
            self.stale = self.layout > 1  # taken over from layout 1
            return RollingModel.restore({"identity": found[0], "history": [float(v) for v in found[1]]})
        return RollingModel()

    def _save(self, model: RollingModel, last: int) -> None:
        if self.layout == 1:
            self.old.update((identity(), list(model.window)))
            return
        if self.stale:
            self.old.clear()
        self.meta.update((LAYOUT, identity(), last))
        if model.window:
            self.window.put([(v,) for v in model.window])

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.stale = False
        self._save(RollingModel.restore({"identity": initialState["identity"], "history": [float(v) for v in initialState["history"]]}), initialState[self.names[1]])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        given = Row(*self.names, "accepted")
        model = self._load()
        held = sorted(((r[1], r[2]) for r in rows), key=lambda x: x[0])
        found = [given(key[0], at, v, model.accept(v)) for at, v in held]
        self._save(model, held[-1][0])
        return iter(found)


def rolling_stream(df: DataFrame, series: str, seq: str, value: str, initial: DataFrame | None = None, layout: int = LAYOUT) -> DataFrame:
    """`stateful.rolling_model` as a stream. `initial`: rows of `stateful.checkpoints`, of which each series goes on from its
    last; the stream then holds what comes after. `layout` is lowered only to show the change of layouts."""
    kind = df.schema[series].dataType.simpleString()
    known = None
    if initial is not None:
        last = initial.groupBy(series).agg(F.max_by(F.struct(F.col(seq).cast("long").alias(seq), "identity", "history"), seq).alias("s"))
        known = last.select(series, "s.*").groupBy(series)
    return df.select(series, F.col(seq).cast("long").alias(seq), F.col(value).cast("double").alias(value)).groupBy(series).transformWithState(
        _Rolling(series, seq, value, layout), f"{series} {kind}, {seq} long, {value} double, accepted boolean", "Append", "None", initialState=known
    )


def _variable(spark: SparkSession, checkpoint: str, name: str, batch: int | None) -> DataFrame:
    reader = spark.read.format("statestore").option("stateVarName", name).option("flattenCollectionTypes", False)
    with state_store(spark):
        return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def stored_states(spark: SparkSession, checkpoint: str, series: str, seq: str, batch: int | None = None) -> DataFrame:
    """The states of a rolling stream in the form of `stateful.checkpoints`: (series, seq, identity, history), after its last
    micro-batch or after `batch`. `stateful.resumed` goes on from them."""
    key = F.col(f"key.{series}").alias(series)
    meta = _variable(spark, checkpoint, "meta", batch).select(key, F.col("value.last_seq").alias(seq), F.col("value.identity").alias("identity"))
    window = _variable(spark, checkpoint, "window", batch).select(key, F.transform("list_value", lambda x: x["value"]).alias("history"))
    return meta.join(window, series, "left").select(series, seq, "identity", F.coalesce("history", F.array().cast("array<double>")).alias("history"))


class _Bracket(StatefulProcessor):
    """State: the last row that was seen; if `waits`, it is not direct, its predecessor is a direct neighbour with the value
    `before`, and it has not been given out."""

    def __init__(self, series: str, seq: str, value: str):
        self.names = (series, seq, value)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq long, value double, direct boolean, waits boolean, before double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        series, seq, _ = self.names
        given = Row(series, seq, "bracketed", "source")
        last = self.last.get()
        out: list[Row] = []
        for at, v, direct in sorted(((r[1], r[2], r[3]) for r in rows), key=lambda x: x[0]):
            next_to = last is not None and last[0] == at - 1
            if last is not None and last[3]:
                filled = next_to and direct
                out.append(given(key[0], last[0], (last[4] + v) / 2 if filled else None, "interpolated" if filled else "untrusted"))
            waits = not direct and next_to and last[2]
            if direct:
                out.append(given(key[0], at, v, "direct"))
            elif not waits:
                out.append(given(key[0], at, None, "untrusted"))
            last = (at, v if direct else None, direct, waits, last[1] if waits else None)
        self.last.update(last)
        return iter(out)


def bracket_stream(df: DataFrame, series: str, seq: str, value: str, direct) -> DataFrame:
    """`sequence.bracket` as a stream: (series, seq, bracketed, source). Which micro-batch a row comes in changes nothing; a row
    whose successor may still come is held back (`held_rows`)."""
    kind = df.schema[series].dataType.simpleString()
    rows = df.select(series, F.col(seq).cast("long").alias(seq), F.col(value).cast("double").alias(value), F.coalesce(direct, F.lit(False)).alias("direct"))
    return rows.groupBy(series).transformWithState(_Bracket(series, seq, value), f"{series} {kind}, {seq} long, bracketed double, source string", "Append", "None")


def held_rows(spark: SparkSession, checkpoint: str, series: str, seq: str) -> DataFrame:
    """The rows that a bracket stream holds back: without a successor they are untrusted."""
    last = _variable(spark, checkpoint, "last", None).filter("value.waits")
    return last.select(F.col(f"key.{series}").alias(series), F.col("value.seq").alias(seq), F.lit(None).cast("double").alias("bracketed"), F.lit("untrusted").alias("source"))
