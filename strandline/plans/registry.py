"""Named queries, each with the SQL that checks it (or none)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        if name in QUERIES:
            raise ValueError(f"two queries have the name {name}")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a series: seq, series, and v, the value unless the event is an error."""
    e = table(spark, sf_dir, "events")
    bad = F.col("event_type") == "error"
    return e.select(F.col("event_id").alias("seq"), F.col("user_id").alias("series"), "ts", "event_type", "value", "props", bad.alias("rejected"), F.when(~bad, F.col("value")).alias("v"))


#: The same as a common table expression.
EV = "e as (select event_id as seq, user_id as series, ts, event_type, value, props, event_type = 'error' as rejected, case when event_type <> 'error' then value end as v from events)"
FIXED = "cast(floor(({0}) * {1} + 0.5) as bigint)"


def fx(expr: str, digits: int = 4) -> str:
    """SQL twin of stats.fixed."""
    return f"cast(floor(({expr}) * {float(10**digits)} + 0.5) as bigint)"
