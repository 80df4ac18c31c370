"""Exact quantiles of groups of any size: distributed selection.

Groups of at most `bound` values take Spark's exact percentile. A larger one is never in one task: each round sketches
the values inside the bracket of every wanted rank, all groups and ranks in one aggregation, and the next pass counts
what lies below, on and between the two marks that enclose the rank, until a bracket holds at most `bound` values or
its rank lies on one of its ends. A round narrows a bracket to about three MARKS-ths, so that 10 ** 11 values take three; only
the last values inside the brackets are gathered. The number of a round's largest bracket is all that the driver sees.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.session import kept

#: Values that one task may gather for a group and rank, marks of a sketch, and groups whose brackets are broadcast.
BOUND, MARKS, BROADCAST = 100_000, 1000, 10_000


def largest(df: DataFrame, group: list[str], value: Column) -> int:
    """The most values (not null) of a group."""
    return df.groupBy(*group).agg(F.count(value).alias("n")).agg(F.max("n")).first()[0] or 0


def _bracketed(rows: DataFrame, state: DataFrame, group: list[str], few: bool) -> DataFrame:
    own = state.withColumnsRenamed({g: f"__g{k}" for k, g in enumerate(group)})
    on = functools.reduce(operator.and_, [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)], F.lit(True))
    return rows.join(F.broadcast(own) if few else own, on).drop(*[f"__g{k}" for k in range(len(group))])


def _inside(k: int, low: str = "lo", high: str = "hi") -> Column:
    v, a, b = F.col("__v"), F.col(f"b{k}.{low}"), F.col(f"b{k}.{high}")
    return (a.isNull() | (v > a)) & (b.isNull() | (v < b))


def _narrowed(k: int, first: Column, last: Column, bound: int, marks: int) -> Column:
    """The bracket of rank k after a pass over its group: (lo, lt, eq, hi, below, on) with the numbers of values below and
    on either end, the marks (nl, nh) to count at next, `m`, the values inside if a wanted rank is among them, and the misses
    so far, by which marks are taken further away."""
    old, seen = F.col(f"b{k}"), F.col(f"s{k}")
    base = F.when(old["lo"].isNull(), 0).otherwise(old["lt"] + old["eq"])
    low_ok = old["nl"].isNotNull() & (base + seen["a"] <= first)  # else the sketch has missed: keep the old end
    high_ok = old["nh"].isNotNull() & (base + seen["c"] + seen["d"] > last)
    lo, lt, eq = (F.when(low_ok, x).otherwise(y) for x, y in ((old["nl"], old["lo"]), (base + seen["a"], old["lt"]), (seen["b"], old["eq"])))
    hi, below, on = (F.when(high_ok, x).otherwise(y) for x, y in ((old["nh"], old["hi"]), (base + seen["c"], old["below"]), (seen["d"], old["on"])))
    done = F.when(lo.isNull(), 0).otherwise(lt + eq)  # values up to the lower end
    size = below - done
    inner = lambda rank: (rank >= done) & (rank < below)
    m = F.when(inner(first) | inner(last), size).otherwise(0)
    missed = (old["nl"].isNotNull() & ~low_ok) | (old["nh"].isNotNull() & ~high_ok)
    misses = old["misses"] + missed.cast("int")
    i, j = F.floor((first - done) / size * marks).cast("int") - 1 - misses, F.ceil((last - done + 1) / size * marks).cast("int") + 1 + misses
    wide = (m > bound) & ~missed  # after a miss the sketch was of other values: sketch again
    nl, nh = F.when(wide & (i >= 1), F.get(seen["q"], i - 1)), F.when(wide & (j <= marks - 1), F.get(seen["q"], j - 1))
    return F.struct(lo.alias("lo"), lt.alias("lt"), eq.alias("eq"), hi.alias("hi"), below.alias("below"), on.alias("on"), nl.alias("nl"), nh.alias("nh"), m.alias("m"), misses.alias("misses"))


def _fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c, rounded once: the product's rounding error is found exactly (Dekker) and added to that of the sum (Knuth)."""

    def halves(x: Column) -> tuple[Column, Column]:
        t = x * F.lit(134217729.0)  # 2 ** 27 + 1
        return t - (t - x), x - (t - (t - x))

    (a1, a2), (b1, b2), p = halves(a), halves(b), a * b
    s = p + c
    z = s - p
    return s + ((p - (s - z)) + (c - z) + (((a1 * b1 - p) + a1 * b2 + a2 * b1) + a2 * b2))


def _between(found: DataFrame, at: list[float], group: list[str], nth: Callable[[int, Column], Column]) -> DataFrame:
    """Adds q, the quantiles between the values of neighbouring ranks. The sum of the two shares is rounded once for its first
    product and sum together, as the SQL does it: otherwise a result that lies on a tie of decimals differs in its last digit."""
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in at]
    ends = {}
    for k, p in enumerate(place):
        ends |= {f"x{k}": nth(k, F.floor(p).cast("long")), f"y{k}": nth(k, F.ceil(p).cast("long")), f"d{k}": p - F.floor(p)}
    held = found.withColumns(ends).withColumns({f"r{k}": F.lit(1.0) - F.col(f"d{k}") for k in range(len(at))} | {f"h{k}": F.col(f"y{k}") * F.col(f"d{k}") for k in range(len(at))})
    exact = []
    for k in range(len(at)):
        x, r, h = F.col(f"x{k}"), F.col(f"r{k}"), F.col(f"h{k}")
        once = _fused(x, r, h)
        exact.append(F.when(F.col(f"d{k}") == 0, x).when(F.isnan(once), x * r + h).otherwise(once))  # infinite values have no halves
    return held.select(*group, "n", "low", "high", "mean", F.array(*exact).alias("q"))


def quantiles(df: DataFrame, group: str | list[str], value: str | Column, at: list[float], bound: int | None = None, marks: int = MARKS, size: int | None = None) -> DataFrame:
    """(group, n, low, high, mean, q), q the quantiles `at`, linear between ranks. Nulls are left out, and so are groups
    without values. `size`: the largest group, if it is known."""
    group, bound = [group] if isinstance(group, str) else list(group), BOUND if bound is None else bound
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*group, value.alias("__v")).filter("__v is not null")
    whole = [F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"), F.avg("__v").alias("mean")]
    if (largest(rows, group, F.col("__v")) if size is None else size) <= bound:
        return _between(rows.groupBy(*group).agg(*whole, F.sort_array(F.collect_list("__v")).alias("__l")), at, group, lambda k, rank: F.get("__l", rank.cast("int")))
    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    start = F.struct(none.alias("lo"), zero.alias("lt"), zero.alias("eq"), none.alias("hi"), F.col("n").alias("below"), zero.alias("on"), none.alias("nl"), none.alias("nh"), F.col("n").alias("m"), F.lit(0).alias("misses"))
    state = kept(rows.groupBy(*group).agg(*whole).withColumns({f"b{k}": start for k in range(len(at))}), "brackets")
    few = state.limit(BROADCAST + 1).count() <= BROADCAST
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in at]
    ranks = [(F.floor(p).cast("long"), F.ceil(p).cast("long")) for p in place]
    widest = F.greatest(zero, *[F.col(f"b{k}.m") for k in range(len(at))])
    accuracy = max(10_000, 10 * marks)
    for _ in range(64):
        wide = state.filter(widest > bound)
        if not wide.take(1):
            break
        held = _bracketed(rows, wide, group, few)
        found = []
        for k in range(len(at)):
            v, old, inside = F.col("__v"), F.col(f"b{k}"), _inside(k)
            near = F.when(inside & _inside(k, "nl", "nh"), v)
            found.append(F.struct(
                F.count_if(inside & (v < old["nl"])).alias("a"), F.count_if(inside & (v == old["nl"])).alias("b"), F.count_if(inside & (v < old["nh"])).alias("c"), F.count_if(inside & (v == old["nh"])).alias("d"),
                F.percentile_approx(near, [j / marks for j in range(1, marks)], accuracy).alias("q"),
            ).alias(f"s{k}"))
        seen = held.groupBy(*group).agg(*found)
        now = _bracketed(seen, wide, group, few)
        now = now.withColumns({f"b{k}": _narrowed(k, *ranks[k], bound, marks) for k in range(len(at))}).select(*state.columns)
        state = kept(state.filter(widest <= bound).unionByName(now), "brackets")
    else:
        raise RuntimeError("a bracket could not be narrowed")
    last = _bracketed(rows, state, group, few).groupBy(*group).agg(*[F.sort_array(F.collect_list(F.when((F.col(f"b{k}.m") > 0) & _inside(k), F.col("__v")))).alias(f"l{k}") for k in range(len(at))])
    joined = _bracketed(last, state, group, few)

    def nth(k: int, rank: Column) -> Column:
        b = F.col(f"b{k}")
        done = F.when(b["lo"].isNull(), 0).otherwise(b["lt"] + b["eq"])
        return F.when(rank < done, b["lo"]).when(rank >= b["below"], b["hi"]).otherwise(F.get(f"l{k}", (rank - done).cast("int")))

    return _between(joined, at, group, nth)
