"""Matching of templates: correlation with every window of a series, and evidence of features around candidates."""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import candidates
from strandline.operators.chunked import Cuts, halo
from strandline.operators.sequence import by


def correlate(df: DataFrame, series: str, seq: str, value: str, template: list[float], out: str = "score", cuts: Cuts | None = None) -> DataFrame:
    """Normalised cross-correlation, -1 to 1, of the template with the rows from each row on. Null where the window is
    constant, holds a null or goes beyond the end. One shuffle by the series, long series in chunks with a halo; the
    sums of a window are taken from its own values, so that nothing is lost far along a series."""
    m, mean = len(template), math.fsum(template) / len(template)
    shape = [t - mean for t in template]
    norm = math.sqrt(math.fsum(t * t for t in shape))
    if m < 2 or not norm:
        raise ValueError("a template needs two different values")

    def score(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        held = rows.withColumn("__w", F.array(*[F.lead(value, k).over(w) if k else F.col(value) for k in range(m)]))
        x = [F.col("__w")[k].cast("double") for k in range(m)]
        middle = functools.reduce(operator.add, x) / m
        held = held.withColumn("__m", middle)
        off = [v - F.col("__m") for v in x]
        dot = functools.reduce(operator.add, [v * t for v, t in zip(off, shape, strict=True)])
        size = F.sqrt(functools.reduce(operator.add, [v * v for v in off]))
        whole = ~F.exists("__w", lambda v: v.isNull()) & (F.array_max("__w") > F.array_min("__w"))
        return held.withColumn(out, F.when(whole, dot / (size * norm))).drop("__w", "__m")

    return halo(df, series, seq, 0, m - 1, score, cuts)


def peaks(df: DataFrame, series: str, seq: str, value: str, template: list[float], least: float, radius: float, most: int, cuts: Cuts | None = None) -> DataFrame:
    """(series, seq, score, rank): the best matches of each series, none within `radius` of a better one."""
    scored = correlate(df, series, seq, value, template, "score", cuts).filter(F.col("score") >= least).withColumn("__p", F.col(seq).cast("double"))
    return candidates.suppress(scored, series, seq, "__p", "score", radius, most).drop("__p")


@dataclass(frozen=True)
class Feature:
    """What a template expects `offset` from a candidate: an observation of `kind` supports it, any other contradicts it."""

    name: str
    offset: float
    kind: str
    weight: float = 1.0


def evidence(found: DataFrame, seen: DataFrame, group: str, ident: str, place: str, kind: str, template: list[Feature], tolerance: float, penalty: float = 1.0, least: float = 0.0) -> DataFrame:
    """Each candidate (group, ident, place) against the observations (group, place, kind): for every feature of the template it
    is supported (the nearest observation within `tolerance` of where it should be has its kind; at equal distances, to nine
    digits, a right kind counts), contradicted (it has another kind), or missing (there is none).

    Returns group, ident, supported, contradicted, missing, score = weights supported - penalty * weights contradicted, and
    reason: null if score >= least, else the first feature that is contradicted, or missing if none is. Candidates and
    observations meet in cells as wide as the tolerance allows; the template has a few features and travels as a literal."""
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f.name).alias("name"), F.lit(float(f.offset)).alias("offset"), F.lit(f.kind).alias("kind"), F.lit(float(f.weight)).alias("weight")) for k, f in enumerate(template)])
    wanted = found.select(group, ident, F.col(place).cast("double").alias("__at"), F.explode(table).alias("f")).withColumn("__want", F.col("__at") + F.col("f.offset"))
    near = candidates.band_pairs(wanted, seen.select(group, F.col(place).cast("double").alias("__b"), F.col(kind).alias("__kind")), group, "__want", "__b", -tolerance, tolerance)
    right = F.col("__kind").eqNullSafe(F.col("f.kind"))
    best = near.groupBy(group, ident, F.col("f.k").alias("k")).agg(F.min(F.struct(F.round(F.abs(F.col("__b") - F.col("__want")), 9).alias("d"), (~right).alias("wrong"))).alias("b"))
    every = wanted.select(group, ident, "f").join(best.select(F.col(group).alias("__g"), F.col(ident).alias("__i"), "k", "b.wrong"), F.col(group).eqNullSafe(F.col("__g")) & (F.col(ident) == F.col("__i")) & (F.col("f.k") == F.col("k")), "left")
    wrong, absent = F.coalesce("wrong", F.lit(False)), F.col("wrong").isNull()
    weight = F.col("f.weight")
    first = lambda c: F.min(F.when(c, F.struct("f.k", "f.name")))
    summed = every.groupBy(group, ident).agg(
        F.count_if(~wrong & ~absent).alias("supported"), F.count_if(wrong).alias("contradicted"), F.count_if(absent).alias("missing"),
        (F.sum(F.when(~wrong & ~absent, weight).otherwise(0.0)) - penalty * F.sum(F.when(wrong, weight).otherwise(0.0))).alias("score"),
        first(wrong).alias("__w"), first(absent).alias("__m"),
    )
    reason = F.when(F.col("score") >= least, None).when(F.col("__w").isNotNull(), F.concat(F.lit("contradicted: "), "__w.name")).when(F.col("__m").isNotNull(), F.concat(F.lit("missing: "), "__m.name")).otherwise("weak")
    return summed.withColumn("reason", reason).drop("__w", "__m")


def decided(judged: DataFrame, places: DataFrame, group: str, ident: str, place: str, apart: float) -> DataFrame:
    """The best candidate of each group and its margin to the best rival at least `apart` away (`candidates.margin`)."""
    held = judged.join(places.select(group, ident, F.col(place).cast("double").alias("__p")), [group, ident])
    return candidates.margin(held, group, "score", ident, "__p", apart)
