"""Resolution cascades: ordered sources, the first that gives a value wins, with provenance."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import scratch


def cascade(stages: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(value, provenance) of the first stage whose value is not null; provenance is `excluded` if none has one."""
    value = F.coalesce(*[v for _, v in stages])
    source = None
    for name, v in stages:
        source = F.when(v.isNotNull(), name) if source is None else source.when(v.isNotNull(), name)
    return value, source.otherwise("excluded")


@dataclass(frozen=True)
class Stage:
    """A step of a cascade. `apply` gets the unresolved rows and returns their keys with `value` (null: not resolved) and
    `reasons` (array of strings, why not); rows that `eligible` does not admit are not attempted."""

    name: str
    apply: Callable[[DataFrame], DataFrame]
    eligible: Column | None = None


def resolve(rows: DataFrame, key: list[str], stages: list[Stage]) -> tuple[DataFrame, DataFrame]:
    """Costly stages, lazily: each sees only the rows that no earlier stage has resolved.

    What a stage found is written (keys, values and reasons, not the rows) and read again, so that no stage runs twice
    and a lost executor repeats one stage at most. Returns one row per key with value, source (`excluded` if no stage
    resolved it) and attempts (stage and reasons, in order), and one row per stage with attempts, successes and failures."""
    spark, rest, tables = rows.sparkSession, rows, []
    folder = f"{scratch(spark)}/cascade-{uuid.uuid4().hex}"
    for k, stage in enumerate(stages):
        taken = rest if stage.eligible is None else rest.filter(stage.eligible)
        stage.apply(taken).select(*key, "value", F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons")).write.parquet(f"{folder}/{k:02d}")
        out = spark.read.parquet(f"{folder}/{k:02d}")
        tables.append(out.withColumn("__k", F.lit(k)).withColumn("__stage", F.lit(stage.name)))
        rest = rest.join(out.filter("value is not null").select(*key), key, "left_anti")
    every = functools.reduce(DataFrame.unionByName, tables)
    tried = every.groupBy(*key).agg(
        F.max_by("value", F.when(F.col("value").isNotNull(), -F.col("__k"))).alias("value"), F.max_by("__stage", F.when(F.col("value").isNotNull(), -F.col("__k"))).alias("source"),
        F.transform(F.array_sort(F.collect_list(F.struct("__k", "__stage", "reasons"))), lambda x: F.struct(x["__stage"].alias("stage"), x["reasons"].alias("reasons"))).alias("attempts"),
    )
    none = F.array().cast(tried.schema["attempts"].dataType)
    found = rows.select(*key).join(tried, key, "left").withColumn("source", F.coalesce("source", F.lit("excluded"))).withColumn("attempts", F.coalesce("attempts", none))
    names = spark.createDataFrame([(k, s.name) for k, s in enumerate(stages)], "__k int, stage string")
    n = every.groupBy("__k").agg(F.count(F.lit(1)).alias("attempts"), F.count("value").alias("successes"))
    zero = F.lit(0).cast("long")
    counts = names.join(n, "__k", "left").select("stage", F.coalesce("attempts", zero).alias("attempts"), F.coalesce("successes", zero).alias("successes"))
    return found, counts.withColumn("failures", F.col("attempts") - F.col("successes"))
