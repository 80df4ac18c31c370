"""Events of running streams as a table: one numbered row for each micro-batch, written by a listener.

`watched` attaches counts to a stream with `observe`; the engine computes them as the rows pass, and they change nothing. The
listener gets them with the progress of each micro-batch and creates one small file for it, named by the number of the
batch: a batch that is reported twice, or run again after a restart, is one event. What the listener cannot write it
counts in `failed`; a stream never stops for it. `gaps` tells numbers without an event, which a driver that ended between
a batch and its report leaves.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_NAME = "engine"
SCHEMA = "query string, sequence long, run string, started string, rows long, seconds double, counts map<string,long>"


def watched(df: DataFrame, **counts: Column) -> DataFrame:
    """df with counted conditions: `rows` and one for each name."""
    return df.observe(_NAME, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])


class EventTable(StreamingQueryListener):
    """Writes an event for each micro-batch of queries with a name to <path>/<query>/<number>.json."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.failed = path.rstrip("/"), 0
        self._of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        try:
            p = event.progress
            seen = p.observedMetrics.get(_NAME)
            if p.name is None or seen is None:
                return
            counts = seen.asDict()
            row = {
                "query": p.name, "sequence": p.batchId, "run": str(p.runId), "started": p.timestamp, "rows": counts.pop("rows"),
                "seconds": p.batchDuration / 1000, "counts": counts,
            }
            target = self._of(f"{self.path}/{p.name}/{p.batchId:012d}.json")
            fs = target.getFileSystem(self._conf)
            if fs.exists(target):
                return
            out = fs.create(target, False)
            out.write(bytearray((json.dumps(row) + "\n").encode()))
            out.close()
        except Exception:  # noqa: BLE001 - an observer must not end what it observes
            self.failed += 1


def read(spark: SparkSession, path: str) -> DataFrame:
    """The events of all queries."""
    return spark.read.schema(SCHEMA).json(f"{path}/*")


def gaps(events: DataFrame) -> DataFrame:
    """(query, sequence) of the numbers up to a query's last that have no event."""
    wanted = events.groupBy("query").agg(F.max("sequence").alias("n")).select("query", F.explode(F.sequence(F.lit(0).cast("long"), "n")).alias("sequence"))
    return wanted.join(events.select("query", "sequence"), ["query", "sequence"], "left_anti")
