"""Gates: named predicates, first and all failure reasons, data-driven bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.quantile import largest, quantiles


def predicates(named: dict[str, Column]) -> Column:
    """A struct of booleans; unknown counts as false."""
    return F.struct(*[F.coalesce(p, F.lit(False)).alias(n) for n, p in named.items()])


def accepted(named: dict[str, Column]) -> Column:
    out = F.lit(True)
    for p in named.values():
        out = out & F.coalesce(p, F.lit(False))
    return out


def first_failure(named: dict[str, Column]) -> Column:
    """Name of the first predicate that does not hold; null if all do."""
    out = None
    for n, p in named.items():
        fails = ~F.coalesce(p, F.lit(False))
        out = F.when(fails, n) if out is None else out.when(fails, n)
    return out


def all_failures(named: dict[str, Column]) -> Column:
    """Names of all predicates that do not hold, joined by ';'."""
    return F.array_join(F.array_compact(F.array(*[F.when(~F.coalesce(p, F.lit(False)), n) for n, p in named.items()])), ";")


def mad_band(df: DataFrame, group: str, value: str, floor: float, times: float = 4.0) -> DataFrame:
    """Adds centre, mad and in_band: within max(floor, times * MAD) of the group's median. Groups of any size; in one
    without values nothing is in the band."""
    size = largest(df, [group], F.col(value))
    centre = quantiles(df, group, value, [0.5], size=size).select(group, F.col("q")[0].alias("centre"))
    mad = quantiles(df.select(group, value).join(centre, group), group, F.abs(F.col(value) - F.col("centre")), [0.5], size=size).select(group, F.col("q")[0].alias("mad"))
    held = df.join(centre.join(mad, group), group, "left")
    return held.withColumn("in_band", F.abs(F.col(value) - F.col("centre")) <= F.greatest(F.lit(floor), times * F.col("mad")))


def with_fallback(df: DataFrame, group: str, usable: Column, least: int) -> DataFrame:
    """Keep usable rows; a group with fewer than `least` of them keeps all its rows."""
    n = F.sum(usable.cast("long")).over(W.partitionBy(group))
    return df.withColumn("__n", n).filter((F.col("__n") < least) | usable).drop("__n")
