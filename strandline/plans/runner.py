"""A resumable run over ordered observations: plan segments, resolve, commit to the ledger, finalise when covered."""

from __future__ import annotations

import contextlib
import json
import os
import threading
import time
import uuid
from dataclasses import dataclass, fields, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import cascade, ledger, sequence
from strandline.operators.versioned import Ledger


@dataclass(frozen=True)
class RunConfig:
    """Validated settings; the hash of these decides whether a ledger may be resumed."""

    batch: int = 960
    limit: float = 45.0
    first: int | None = None
    last: int | None = None
    name: str = "run"
    open: bool = False  # more observations will come: an unresolved last one waits for its successor
    free_gib: float = 0.0

    def __post_init__(self):
        if isinstance(self.batch, bool) or not isinstance(self.batch, int) or self.batch < 1:
            raise ValueError("batch must be a positive whole number")
        if not self.limit > 0:
            raise ValueError("limit must be positive")
        if not self.free_gib >= 0:
            raise ValueError("free_gib can't be negative")
        if self.first is not None and self.last is not None and self.first > self.last:
            raise ValueError("first comes after last")
        if "/" in self.name or self.name in ("", ".", ".."):
            raise ValueError("name must be a plain file name")

    def settings(self) -> dict:
        return {"batch": self.batch, "limit": self.limit}

    @classmethod
    def load(cls, overrides: str | dict, defaults: RunConfig | None = None) -> RunConfig:
        """Defaults with the overrides of a JSON object: {"run": {...}, "gate": {"limit": ...}} or the plain names. Unknown
        keys are refused, and so is a setting that is given twice with different values."""
        raw = json.loads(overrides) if isinstance(overrides, str) else overrides
        if not isinstance(raw, dict):
            raise ValueError("the settings must be a JSON object")
        allowed = {"run": {f.name for f in fields(cls)} - {"limit"}, "gate": {"limit"}}
        given: dict[str, list] = {}
        for name, value in raw.items():
            part = value if name in allowed else {name: value}
            if not isinstance(part, dict):
                raise ValueError(f"{name} must be a JSON object")
            unknown = set(part) - (allowed[name] if name in allowed else set().union(*allowed.values()))
            if unknown:
                raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
            for key, v in part.items():
                given.setdefault(key, []).append(v)
        for key, values in given.items():
            if any(v != values[0] or type(v) is not type(values[0]) for v in values):
                raise ValueError(f"{key} is given twice with different values")
        return replace(defaults or cls(), **{key: values[0] for key, values in given.items()})


LEDGER = "series string, first_seq long, last_seq long, rows long, included long, counts map<string,long>, config_sha256 string, verified boolean, completed string"


def plan(observations: DataFrame, book: DataFrame, config: RunConfig) -> DataFrame:
    """Segments (series, first_seq, last_seq) of the keys that no verified segment covers; they never bridge a gap.

    Keys are compared with segments by expanding the segments, which have at most `batch` keys each."""
    done = book.filter("verified").select("series", F.explode(F.sequence("first_seq", "last_seq")).alias("seq"))
    wanted = observations
    if config.first is not None:
        wanted = wanted.filter(F.col("seq") >= config.first)
    if config.last is not None:
        wanted = wanted.filter(F.col("seq") <= config.last)
    return sequence.chunks(wanted.select("series", "seq").join(done, ["series", "seq"], "left_anti"), "series", "seq", config.batch).drop("rows")


def resolve(observations: DataFrame, config: RunConfig) -> DataFrame:
    """Measured, bracketed or excluded: value, source and disposition of every observation."""
    gated = sequence.local_median_gate(observations, "series", "seq", "v", config.limit)
    between = sequence.bracket(gated, "series", "seq", "v", F.col("accepted"), "b", "how")
    value, source = cascade.cascade([("measured", F.when(F.col("accepted"), F.col("v"))), ("bracketed", F.when(F.col("how") == "interpolated", F.col("b")))])
    return between.select("series", "seq", value.alias("value"), source.alias("source"), F.when(value.isNull(), "excluded").otherwise("included").alias("disposition"))


def deferred(resolved: DataFrame) -> DataFrame:
    """Keys of the last observation of each series, if it is unresolved: with its successor it may be bracketed yet."""
    last = resolved.groupBy("series").agg(F.max_by("disposition", "seq").alias("d"), F.max("seq").alias("seq"))
    return last.filter("d = 'excluded'").select("series", "seq")


def audit(resolved: DataFrame, order: str = "seq", jump: float = 100.0) -> DataFrame:
    """One row per series: observations by source, the included share, jumps between neighbours, and the last excluded key."""
    step = F.abs(F.col("value") - F.lag("value").over(sequence.by("series", order)))
    held = resolved.withColumn("__step", step)
    by = {s: F.count_if(F.col("source") == s).alias(s) for s in ("measured", "bracketed", "excluded")}
    return held.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), *by.values(), (100.0 * F.count("value") / F.count(F.lit(1))).alias("included_pct"), F.count_if(F.col("__step") > jump).alias("jumps"), F.max("__step").alias("largest"),
        F.max(F.when(F.col("source") == "excluded", F.col(order))).alias("last_excluded"),
    )


def segments(resolved: DataFrame, planned: DataFrame, config: RunConfig) -> DataFrame:
    """One ledger row per planned segment with counts by source."""
    keyed = planned.withColumn("seq", F.explode(F.sequence("first_seq", "last_seq")))
    n = keyed.join(resolved, ["series", "seq"]).groupBy("series", "first_seq", "last_seq").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("disposition") == "included").alias("included"), *[F.count_if(F.col("source") == s).alias(s) for s in ("measured", "bracketed", "excluded")]
    )
    counts = F.create_map(*[x for s in ("measured", "bracketed", "excluded") for x in (F.lit(s), F.col(s))])
    stamp = datetime.now(UTC).isoformat(timespec="seconds")
    return n.select(
        "series", "first_seq", "last_seq", "rows", "included", counts.alias("counts"), F.lit(ledger.config_hash(config.settings())).alias("config_sha256"),
        (F.col("rows") == F.col("last_seq") - F.col("first_seq") + 1).alias("verified"), F.lit(stamp).alias("completed"),
    )


class Events:
    """An append-only list of numbered events, and its JSON lines."""

    def __init__(self, job: str, sink=None):
        self.job, self.sink, self.rows = job, sink, []

    def emit(self, event: str, **payload) -> None:
        row = {"protocol": "strandline", "version": 1, "sequence": len(self.rows), "event": event, "job_id": self.job, "emitted_at": datetime.now(UTC).isoformat(timespec="milliseconds"), "payload": payload}
        self.rows.append(row)
        if self.sink:
            self.sink(row)

    def lines(self) -> list[str]:
        return [json.dumps(r, sort_keys=True) for r in self.rows]


def json_lines(path: str):
    """An event sink that appends one JSON line an event and flushes it, so that a crash loses none that was emitted."""

    def write(row: dict) -> None:
        with open(path, "a", encoding="utf-8") as out:
            out.write(json.dumps(row, sort_keys=True) + "\n")
            out.flush()
            os.fsync(out.fileno())

    return write


def _fs(spark: SparkSession, path: str):
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def atomic_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small JSON document so that readers see the old one or the new one, never a part."""
    fs, of = _fs(spark, path)
    temp = f"{path}.{uuid.uuid4().hex}"
    out = fs.create(of(temp), True)
    out.write(bytearray(json.dumps(value, sort_keys=True, allow_nan=False).encode()))
    out.close()
    mode = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(of(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = mode
    context.rename(of(temp), of(path), options)


#: Seconds between heartbeats of a lock, and without one after which its owner counts as gone.
BEAT, STALE = 10.0, 120.0


@contextlib.contextmanager
def exclusive(spark: SparkSession, path: str, beat: float = BEAT, stale: float = STALE):
    """One run at a time for a ledger: the lock is a file that only one process can create, and that its owner touches every
    `beat` seconds. A lock without a heartbeat for `stale` seconds was left by a process that ended, and is taken over: of
    several that try, one can rename it away. A run that only paused so long finds out at its commit, which another version
    refuses to overwrite."""
    fs, of = _fs(spark, path)
    lock, mine = of(f"{path}.lock"), uuid.uuid4().hex

    def owner() -> str | None:
        try:
            stream = fs.open(lock)
            try:
                return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
        except Exception:  # noqa: BLE001 - gone or being written: not ours
            return None

    def create() -> bool:
        try:
            out = fs.create(lock, False)
        except Exception:  # noqa: BLE001 - it exists
            return False
        out.write(bytearray(mine.encode()))
        out.close()
        return True

    if not create():
        try:
            silent = time.time() - fs.getFileStatus(lock).getModificationTime() / 1000
        except Exception:  # noqa: BLE001 - given up just now
            silent = stale
        if silent >= stale:
            aside = of(f"{path}.lock.{mine}")
            with contextlib.suppress(Exception):
                if fs.rename(lock, aside):
                    fs.delete(aside, False)
        if silent < stale or not create():
            raise RuntimeError(f"another run holds {path}.lock")
    done = threading.Event()

    def keep_alive() -> None:
        while not done.wait(beat):
            with contextlib.suppress(Exception):
                if owner() == mine:
                    now = int(time.time() * 1000)
                    fs.setTimes(lock, now, now)

    beats = threading.Thread(target=keep_alive, daemon=True)
    beats.start()
    try:
        yield
    finally:
        done.set()
        beats.join()
        if owner() == mine:
            fs.delete(lock, False)


def enough_space(spark: SparkSession, path: str, gib: float) -> None:
    fs, of = _fs(spark, path)
    free = fs.getStatus(of(path).getParent()).getRemaining() / 2**30
    if free < gib:
        raise RuntimeError(f"{free:.1f} GiB are free where {gib:.1f} are wanted")


def run(spark: SparkSession, observations: DataFrame, path: str, config: RunConfig = RunConfig(), sink=None) -> dict:
    """Process what the ledger at `path` lacks; returns status, counts and whether all keys are covered.

    observations: (series string, seq, v). The new segments are one commit to the ledger (`versioned.Ledger`), which is
    checked before it counts."""
    events = Events(config.name, sink)
    with exclusive(spark, path):
        enough_space(spark, path, config.free_gib)
        return _run(spark, observations, path, config, events)


def _run(spark: SparkSession, observations: DataFrame, path: str, config: RunConfig, events: Events) -> dict:
    log = Ledger(spark, path, LEDGER, ["series", "first_seq", "last_seq"])
    book = log.read()
    ledger.guard(book, config.settings())
    events.emit("job_started", settings=config.settings())
    try:
        resolved = resolve(observations, config)
        waiting = deferred(resolved) if config.open else spark.createDataFrame([], "series string, seq long")
        new = segments(resolved, plan(observations.join(waiting, ["series", "seq"], "left_anti"), book, config), config)
        book = log.read(log.commit(new, properties={"config_sha256": ledger.config_hash(config.settings())}))
        spans = book.filter("verified").select("series", F.explode(F.sequence("first_seq", "last_seq")).alias("seq"))
        missing = observations.select("series", "seq").join(spans, ["series", "seq"], "left_anti").count()
        total = book.agg(F.sum("rows").alias("rows"), F.sum("included").alias("included"), F.count(F.lit(1)).alias("segments")).first()
        result = {"status": "complete" if not missing else "partial", "segments": total["segments"], "rows": total["rows"] or 0, "included": total["included"] or 0, "missing": missing}
        events.emit("job_completed", **result)
        return result | {"events": events.rows}
    except Exception as error:
        events.emit("job_failed", error=type(error).__name__, message=str(error)[:500])
        atomic_json(spark, f"{path}.failure.json", {"error": type(error).__name__, "message": str(error)[:500], "at": datetime.now(UTC).isoformat(timespec="seconds")})
        raise
