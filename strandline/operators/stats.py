"""Exact aggregates: robust statistics, error metrics, LUT fits, least squares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.quantile import largest, quantiles


def fixed(x: Column, digits: int = 4) -> Column:
    """A double as a whole number of 10 ** -digits: stable against the order of sums."""
    return F.floor(x * float(10**digits) + 0.5).cast("long")


def with_quantile(df: DataFrame, group: str, value: str, at: float, out: str) -> DataFrame:
    """df with the exact quantile of its group; null in a group without values."""
    own = quantiles(df, group, value, [at]).select(F.col(group).alias("__own"), F.col("q")[0].alias(out))
    return df.join(own, F.col(group).eqNullSafe(F.col("__own")), "left").drop("__own")


def robust(df: DataFrame, group: str, value: str) -> DataFrame:
    """count, min, max, mean, median, MAD, p05, p95 of each group; nulls are left out. Groups of any size."""
    size = largest(df, [group], F.col(value))
    q = quantiles(df, group, value, [0.05, 0.5, 0.95], size=size).select(group, "n", "low", "high", "mean", F.col("q")[0].alias("p05"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p95"))
    mad = quantiles(df.select(group, value).join(q.select(group, "median"), group), group, F.abs(F.col(value) - F.col("median")), [0.5], size=size).select(group, F.col("q")[0].alias("mad"))
    return q.join(mad, group)


def trimmed_median(df: DataFrame, group: str, value: str, floor: float, support: int, share: float) -> DataFrame:
    """Median of the values within max(floor, 3 * MAD) of the median; null without enough support. Groups of any size."""
    size = largest(df, [group], F.col(value))
    centre = quantiles(df, group, value, [0.5], size=size).select(group, "n", F.col("q")[0].alias("median"))
    near = df.select(group, value).join(centre, group)
    mad = quantiles(near, group, F.abs(F.col(value) - F.col("median")), [0.5], size=size).select(group, F.col("q")[0].alias("mad"))
    kept = near.join(mad, group).filter(F.abs(F.col(value) - F.col("median")) <= F.greatest(F.lit(floor), 3 * F.col("mad")))
    found = quantiles(kept, group, value, [0.5], size=size).select(group, F.col("n").alias("inliers"), F.col("q")[0].alias("m")).join(centre.select(group, "n"), group)
    good = (F.col("inliers") >= support) & (F.col("inliers") >= share * F.col("n"))
    return found.select(group, "n", "inliers", F.when(good, F.col("m")).alias("consensus"))


def errors(df: DataFrame, group: str, a: str, b: str, peak: float) -> DataFrame:
    """MAE, MSE, largest error and PSNR (null stands for infinite)."""
    d = F.col(a) - F.col(b)
    found = df.groupBy(group).agg(F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"), F.max(F.abs(d)).alias("worst"))
    return found.withColumn("psnr", F.when(F.col("mse") > 0, 10 * F.log10(F.lit(peak * peak) / F.nullif("mse", F.lit(0.0)))))


def binned_lut(df: DataFrame, x: str, y: str, bins: int = 256) -> DataFrame:
    """Median of y in `bins` half-open bins of x in [0, 1); empty bins by interpolation; then the running maximum.

    The table has one row a bin whatever the input, so its window is bounded."""
    inside = df.filter((F.col(x) >= 0) & (F.col(x) < 1)).select(F.floor(F.col(x) * bins).cast("long").alias("bin"), y)
    found = quantiles(inside, "bin", y, [0.5]).select("bin", F.col("q")[0].alias("m"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin").join(found, "bin", "left")
    w = W.partitionBy(F.lit(1)).orderBy("bin")
    back, ahead = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(0, W.unboundedFollowing)
    at = F.when(F.col("m").isNotNull(), F.col("bin"))
    held = grid.withColumn("v0", F.last("m", True).over(back)).withColumn("v1", F.first("m", True).over(ahead)).withColumn("b0", F.last(at, True).over(back)).withColumn("b1", F.first(at, True).over(ahead))
    lerp = F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("bin") - F.col("b0")) / (F.col("b1") - F.col("b0"))
    value = F.when(F.col("m").isNotNull(), F.col("m")).when(F.col("v0").isNull(), F.col("v1")).when(F.col("v1").isNull(), F.col("v0")).otherwise(lerp)
    held = held.withColumn("value", value)
    return held.select("bin", F.col("m").isNotNull().alias("seen"), "value", F.max("value").over(back).alias("level"))


def lookup(df: DataFrame, lut: DataFrame, x: str, out: str, bins: int = 256) -> DataFrame:
    """Piecewise-linear value of the table (bin, level) at x * (bins - 1). The table has `bins` rows and is broadcast."""
    array = lut.groupBy().agg(F.array_sort(F.collect_list(F.struct("bin", "level"))).alias("t")).select(F.transform("t", lambda r: r["level"]).alias("t"))
    held = df.join(F.broadcast(array)).withColumn("__p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(x))) * (bins - 1)).withColumn("__i", F.floor("__p").cast("int"))
    low, high = F.element_at("t", F.col("__i") + 1), F.element_at("t", F.least(F.col("__i") + 2, F.lit(bins)))
    return held.withColumn(out, low + (high - low) * (F.col("__p") - F.col("__i"))).drop("t", "__p", "__i")
