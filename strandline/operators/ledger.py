"""Run ledger: upserts of segments, coverage, diffs between runs, verified sinks."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], newest: list[Column]) -> DataFrame:
    """One row per key: the first in the given (total) order. Idempotent: applying it again changes nothing."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*key).orderBy(*newest))).filter("__n = 1").drop("__n")


def upsert(ledger: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of `new` replace those of the ledger with the same key; other rows stay."""
    return ledger.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def coverage(segments: DataFrame, requested: DataFrame, seq: str, first: str, last: str) -> DataFrame:
    """One row: keys requested, covered by exactly one segment, missing, covered twice or not requested."""
    covered = segments.select(F.explode(F.sequence(first, last)).alias(seq)).groupBy(seq).agg(F.count(F.lit(1)).alias("n"))
    both = requested.select(seq).distinct().withColumn("wanted", F.lit(True)).join(covered, seq, "full")
    return both.agg(
        F.count_if("wanted").alias("requested"), F.count_if(F.col("wanted") & (F.col("n") == 1)).alias("covered"), F.count_if(F.col("wanted") & F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("wanted").isNull()).alias("extra"),
    )


def diff(reference: DataFrame, candidate: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer, null-safe comparison of two runs, one row per key with a verdict."""
    a = reference.select(key, F.col(value).alias("old"), F.lit(True).alias("in_old"))
    b = candidate.select(key, F.col(value).alias("new"), F.lit(True).alias("in_new"))
    verdict = F.when(F.col("in_new").isNull(), "missing").when(F.col("in_old").isNull(), "added").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return a.join(b, key, "full").select(key, "old", "new", verdict.alias("verdict"))


def config_hash(config: dict) -> str:
    """SHA-256 of the configuration in sorted, compact JSON; NaN is refused."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), allow_nan=False).encode()).hexdigest()


def guard(ledger: DataFrame, config: dict, column: str = "config_sha256") -> None:
    """Refuse to resume a ledger that was written with another configuration."""
    other = ledger.filter(~F.col(column).eqNullSafe(F.lit(config_hash(config)))).limit(1).count()
    if other:
        raise ValueError("the ledger was written with another configuration")


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    of = jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def recover(spark: SparkSession, path: str) -> bool:
    """True if there is a ledger at `path`. One that a crash left aside in the middle of `replace` is put back first."""
    fs, of = _files(spark, path)
    if fs.exists(of(path)):
        return True
    return bool(fs.exists(of(f"{path}.old")) and fs.rename(of(f"{path}.old"), of(path)))


def replace(df: DataFrame, path: str) -> DataFrame:
    """Write `df`, check what was written, and put it in the place of `path`. At every moment one whole version exists:
    the old one is renamed aside, the new one takes its name, and only then the old one goes."""
    spark = df.sparkSession
    fs, of = _files(spark, path)
    temp = f"{path}.new-{uuid.uuid4().hex}"
    write_verified(df, temp)
    if fs.exists(of(path)):
        fs.delete(of(f"{path}.old"), True)
        if not fs.rename(of(path), of(f"{path}.old")):
            raise OSError(f"{path} could not be set aside")
    if not fs.rename(of(temp), of(path)):
        recover(spark, path)
        raise OSError(f"{path} could not be replaced")
    fs.delete(of(f"{path}.old"), True)
    return spark.read.parquet(path)


def _rows_digest(df: DataFrame) -> tuple[int, int, int]:
    """Row count, and exclusive or and sum of row hashes. The sum is a decimal, so it can't overflow."""
    h = F.xxhash64(F.to_json(F.struct(*[f"`{c}`" for c in sorted(df.columns)])))
    r = df.select(h.alias("h")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(20,0)")).alias("s")).first()
    return r["n"], r["x"] or 0, int(r["s"] or 0)


def write_verified(df: DataFrame, path: str) -> DataFrame:
    """Write, read back, and compare with what was written; the committer makes the write atomic.

    `df` is evaluated once: its count and checksum are observed while it is written."""
    spark: SparkSession = df.sparkSession
    columns = sorted(df.columns)
    seen = Observation()
    h = F.xxhash64(F.to_json(F.struct(*[f"`{c}`" for c in columns])))
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(20,0)")).alias("s"))
    watched.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    got = seen.get
    if _rows_digest(back) != (got["n"], got["x"] or 0, int(got["s"] or 0)):
        raise ValueError(f"{path} does not hold what was written")
    return back
