"""Operators over ordered series: every function takes the series key, the order column and a value column.

Windows are partitioned by the series, and a series longer than a chunk is cut (`chunked`), so neither many series nor a
single long one is the work of one task. Rows are ordered by an explicit, unique, numeric order column. Functions find the
long series by themselves; a caller that applies several to the same rows measures once and hands `cuts` on.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators import stats
from strandline.operators.chunked import Cuts, Running, halo, measure, running


def by(series: str | list[str], seq: str):
    keys = [series] if isinstance(series, str) else list(series)
    return W.partitionBy(*keys).orderBy(seq)


def everything(series: str | list[str]):
    keys = [series] if isinstance(series, str) else list(series)
    return W.partitionBy(*keys)


def neighbours(value: str, w, reach: int) -> list[Column]:
    """value at -reach ... +reach, null outside."""
    return [F.lag(value, -k).over(w) if k < 0 else F.lead(value, k).over(w) if k else F.col(value) for k in range(-reach, reach + 1)]


def numbered(df: DataFrame, series: str, seq: str, out: str = "i", cuts: Cuts | None = None) -> DataFrame:
    """The place of each row in its series, from 1 on."""
    return running(df, series, seq, {out: Running("sum", F.lit(1))}, cuts)


def summed(df: DataFrame, series: str, seq: str, values: dict[str, Column], cuts: Cuts | None = None) -> DataFrame:
    """df with running sums: the last row of a series has its total, added in order of seq. The last digit of a sum of doubles
    depends on the order, so sums by partition change with the files; these do not, unless a series is cut."""
    return running(df, series, seq, {name: Running("sum", x) for name, x in values.items()}, cuts)


def _median(df: DataFrame, series: str, seq: str, value: str, out: str, first: int, last: int, cuts: Cuts | None) -> DataFrame:
    middle = F.percentile(value, F.lit(0.5))
    return halo(df, series, seq, max(0, -first), max(0, last), lambda rows, keys: rows.withColumn(out, middle.over(by(keys, seq).rowsBetween(first, last))), cuts)


def rolling_median(df: DataFrame, series: str, seq: str, value: str, out: str, radius: int = 4, cuts: Cuts | None = None) -> DataFrame:
    """Median of the row and `radius` rows on either side; the window is cut short at the ends."""
    return _median(df, series, seq, value, out, -radius, radius, cuts)


def trailing_median(df: DataFrame, series: str, seq: str, value: str, out: str, size: int = 25, cuts: Cuts | None = None) -> DataFrame:
    """Median of the `size` rows before the row (null for the first)."""
    return _median(df, series, seq, value, out, -size, -1, cuts)


def local_median_gate(df: DataFrame, series: str, seq: str, value: str, limit: float, prefix: str = "", cuts: Cuts | None = None) -> DataFrame:
    """Adds <prefix>local and <prefix>accepted.

    Nulls count as the series' median; the ends are padded with the first and last value; a row is accepted if it had
    a value and is strictly nearer than `limit` to the median of 5."""
    cuts = cuts or measure(df, series, seq)
    if cuts.bounds is None:
        filled = df.withColumn("__f", F.coalesce(F.col(value), F.percentile(value, F.lit(0.5)).over(everything(series))))
    else:
        middle = stats.quantiles(df, series, value, [0.5]).select(F.col(series).alias("__s"), F.col("q")[0].alias("__m"))
        filled = df.join(middle, F.col(series).eqNullSafe(F.col("__s")), "left").withColumn("__f", F.coalesce(F.col(value), "__m")).drop("__s", "__m")

    def gate(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # reaches an end only where the series has it
        held = rows.withColumn("__a", F.first("__f").over(whole)).withColumn("__z", F.last("__f").over(whole))
        five = [F.coalesce(F.lag("__f", k).over(w), F.col("__a")) for k in (2, 1)] + [F.col("__f")] + [F.coalesce(F.lead("__f", k).over(w), F.col("__z")) for k in (1, 2)]
        return held.withColumn(f"{prefix}local", F.sort_array(F.array(*five))[2]).drop("__f", "__a", "__z")

    found = halo(filled, series, seq, 2, 2, gate, cuts)
    accepted = F.col(value).isNotNull() & (F.abs(F.col(value) - F.col(f"{prefix}local")) < limit)
    return found.withColumn(f"{prefix}accepted", F.coalesce(accepted, F.lit(False)))


def interpolate(df: DataFrame, series: str, seq: str, value: str, knot: Column, out: str = "filled", source: str = "source", cuts: Cuts | None = None) -> DataFrame:
    """Linear interpolation by row position between knots, constant beyond the first and last; adds the kind of each
    row: measured, interpolated (between knots), fallback (outside), or none (no knot in the series)."""
    cuts = cuts or measure(df, series, seq)
    held = numbered(df.withColumn("__k", F.when(knot, F.col(value))), series, seq, "__p", cuts)
    at = F.when(F.col("__k").isNotNull(), F.struct(F.col("__k").alias("v"), F.col("__p").alias("p")))
    held = running(held, series, seq, {"__0": Running("last", at), "__1": Running("next", at)}, cuts)
    lerp = F.col("__0.v") + (F.col("__1.v") - F.col("__0.v")) * (F.col("__p") - F.col("__0.p")) / F.nullif(F.col("__1.p") - F.col("__0.p"), F.lit(0))
    filled = F.when(F.col("__k").isNotNull(), F.col("__k")).when(F.col("__0").isNull(), F.col("__1.v")).when(F.col("__1").isNull(), F.col("__0.v")).otherwise(lerp)
    kind = (
        F.when(F.col("__k").isNotNull(), "measured").when(F.col("__0").isNull() & F.col("__1").isNull(), "none")
        .when(F.col("__0").isNull() | F.col("__1").isNull(), "fallback").otherwise("interpolated")
    )
    return held.withColumn(out, filled).withColumn(source, kind).drop("__p", "__k", "__0", "__1")


def bracket(df: DataFrame, series: str, seq: str, value: str, direct: Column, out: str = "bracketed", source: str = "source", cuts: Cuts | None = None) -> DataFrame:
    """Fill a row that is not direct from its two neighbours if both are direct; otherwise it is untrusted.

    Neighbours are judged by their own measurement, so a filled row never helps another. Adjacency is by the order
    column: previous and next must be exactly one away."""

    def fill(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        held = rows.withColumn("__d", direct)
        prev = F.lag("__d").over(w) & (F.lag(seq).over(w) == F.col(seq) - 1)
        after = F.lead("__d").over(w) & (F.lead(seq).over(w) == F.col(seq) + 1)
        both = F.coalesce(prev & after, F.lit(False))
        mean = (F.lag(value).over(w) + F.lead(value).over(w)) / 2
        return (
            held.withColumn(out, F.when(F.col("__d"), F.col(value)).when(both, mean))
            .withColumn(source, F.when(F.col("__d"), "direct").when(both, "interpolated").otherwise("untrusted")).drop("__d")
        )

    return halo(df, series, seq, 1, 1, fill, cuts)


def islands(df: DataFrame, series: str, seq: str, flag: Column, cuts: Cuts | None = None) -> DataFrame:
    """Maximal runs of rows in a row with the flag: first and last order value, and length. An island may go over any
    number of chunks: it is known by the rows before it that have no flag."""
    on = F.coalesce(flag, F.lit(False))
    held = running(df.withColumn("__f", on), series, seq, {"__g": Running("sum", F.when(~F.col("__f"), 1).otherwise(0))}, cuts).filter("__f")
    return held.groupBy(series, "__g").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("length")).drop("__g")


def chunks(df: DataFrame, series: str, seq: str, size: int, cuts: Cuts | None = None) -> DataFrame:
    """Batches of at most `size` keys that never bridge a gap in the keys: first, last, rows."""
    cuts = cuts or measure(df, series, seq)
    held = running(df, series, seq, {"__p": Running("last", F.col(seq), others=True), "__n": Running("sum", F.lit(1))}, cuts)
    new = F.col("__p").isNull() | (F.col(seq) - F.col("__p") != 1)
    held = running(held, series, seq, {"__g": Running("last", F.when(new, F.col("__n")))}, cuts)
    held = held.withColumn("__c", F.floor((F.col("__n") - F.col("__g")) / size))
    return held.groupBy(series, "__g", "__c").agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), F.count(F.lit(1)).alias("rows")).drop("__g", "__c")


def adjacent_delta(df: DataFrame, series: str, seq: str, value: str, out: str = "delta", cuts: Cuts | None = None) -> DataFrame:
    """Difference to the row before if its key is one less; null otherwise."""

    def delta(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        return rows.withColumn(out, F.when(F.lag(seq).over(w) == F.col(seq) - 1, F.col(value) - F.lag(value).over(w)))

    return halo(df, series, seq, 1, 0, delta, cuts)


def convolve(df: DataFrame, series: str, seq: str, value: str, kernel: list[int], out: str, cuts: Cuts | None = None) -> DataFrame:
    """Weighted sum of the neighbours with zeros beyond the ends, divided by the kernel's sum."""
    reach = len(kernel) // 2

    def weigh(rows: DataFrame, keys: list[str]) -> DataFrame:
        terms = [F.coalesce(x, F.lit(0.0)) * k for x, k in zip(neighbours(value, by(keys, seq), reach), kernel, strict=True)]
        return rows.withColumn(out, functools.reduce(operator.add, terms) / sum(kernel))

    return halo(df, series, seq, reach, reach, weigh, cuts)


def gradient(df: DataFrame, series: str, seq: str, value: str, out: str, cuts: Cuts | None = None) -> DataFrame:
    """Central difference, one-sided at the ends; 0 for a single row."""

    def slope(rows: DataFrame, keys: list[str]) -> DataFrame:
        before, after = F.lag(value).over(by(keys, seq)), F.lead(value).over(by(keys, seq))
        return rows.withColumn(out, F.when(before.isNull() & after.isNull(), 0.0).when(before.isNull(), after - F.col(value)).when(after.isNull(), F.col(value) - before).otherwise((after - before) / 2))

    return halo(df, series, seq, 1, 1, slope, cuts)


def local_extrema(df: DataFrame, series: str, seq: str, value: str, cuts: Cuts | None = None) -> DataFrame:
    """Inner rows that are not less (or not greater) than both neighbours; `kind` is peak, valley or flat."""

    def find(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        held = rows.withColumn("__b", F.lag(value).over(w)).withColumn("__a", F.lead(value).over(w)).filter("__b is not null and __a is not null")
        v = F.col(value)
        high, low = (v >= F.col("__b")) & (v >= F.col("__a")), (v <= F.col("__b")) & (v <= F.col("__a"))
        return held.withColumn("kind", F.when(high & low, "flat").when(high, "peak").when(low, "valley")).filter("kind is not null").drop("__b", "__a")

    return halo(df, series, seq, 1, 1, find, cuts)


def box_mean(value: str, w, radius: int) -> Column:
    """Mean of 2 * radius + 1 rows; the ends repeat the first and last value."""
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    terms = [F.coalesce(x, F.first(value).over(whole) if k < radius else F.last(value).over(whole)) for k, x in enumerate(neighbours(value, w, radius))]
    return functools.reduce(operator.add, terms) / (2 * radius + 1)


def slope_peaks(df: DataFrame, series: str, seq: str, value: str, radius: int = 5, lag: int = 10, least: float = 25.0, cuts: Cuts | None = None) -> DataFrame:
    """Smooth by a box, take the slope over `lag` rows, and keep rows whose slope is at least `least`, not less than
    the one before and greater than the one after."""

    def find(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        held = rows.withColumn("smooth", box_mean(value, w, radius))
        held = held.withColumn("slope", F.col("smooth") - F.lag("smooth", lag).over(w))
        held = held.withColumn("__b", F.lag("slope").over(w)).withColumn("__a", F.lead("slope").over(w))
        return held.filter((F.col("slope") >= least) & (F.col("slope") >= F.col("__b")) & (F.col("slope") > F.col("__a"))).drop("__b", "__a")

    return halo(df, series, seq, radius + lag + 1, radius + 1, find, cuts)


def edge_contrast(df: DataFrame, series: str, seq: str, value: str, far: int = 24, near: int = 6, cuts: Cuts | None = None) -> DataFrame:
    """Medians of the plateaus before [-far, -near) and after [near, far) and their difference."""

    def compare(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        before = F.percentile(value, F.lit(0.5)).over(w.rowsBetween(-far, -near - 1))
        after = F.percentile(value, F.lit(0.5)).over(w.rowsBetween(near, far - 1))
        return rows.withColumn("before", before).withColumn("after", after).withColumn("contrast", F.col("after") - F.col("before"))

    return halo(df, series, seq, far, far - 1, compare, cuts)


def quadratic_peak(df: DataFrame, series: str, seq: str, value: str, limit: float = 0.5, cuts: Cuts | None = None) -> DataFrame:
    """At strict inner peaks: offset of the parabola through the three points, clamped to +-limit."""

    def find(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = by(keys, seq)
        held = rows.withColumn("__b", F.lag(value).over(w)).withColumn("__a", F.lead(value).over(w)).filter((F.col(value) > F.col("__b")) & (F.col(value) > F.col("__a")))
        curve = F.col("__b") - 2 * F.col(value) + F.col("__a")
        offset = 0.5 * (F.col("__b") - F.col("__a")) / F.nullif(curve, F.lit(0.0))
        return held.withColumn("offset", F.greatest(F.lit(-limit), F.least(F.lit(limit), F.coalesce(offset, F.lit(0.0))))).drop("__b", "__a")

    return halo(df, series, seq, 1, 1, find, cuts)


def cumulative_max(df: DataFrame, series: str, seq: str, value: str, out: str, cuts: Cuts | None = None) -> DataFrame:
    return running(df, series, seq, {out: Running("max", F.col(value))}, cuts)


def output_numbers(df: DataFrame, series: str, seq: str, included: Column, out: str = "output_no", cuts: Cuts | None = None) -> DataFrame:
    """Dense numbers of the included rows; null for the others."""
    held = running(df.withColumn("__i", included), series, seq, {"__n": Running("sum", F.col("__i").cast("long"))}, cuts)
    return held.withColumn(out, F.when(F.col("__i"), F.col("__n"))).drop("__i", "__n")


def trailing_unresolved(df: DataFrame, series: str, seq: str, accepted: Column, cuts: Cuts | None = None) -> DataFrame:
    """Rows after the last accepted one of each series; unknown is not accepted."""
    return running(df, series, seq, {"__m": Running("next", F.when(accepted, True))}, cuts).filter("__m is null").drop("__m")


def neighbours_of_islands(df: DataFrame, series: str, seq: str, included: Column, cuts: Cuts | None = None) -> DataFrame:
    """Nearest included keys before and after every row that is not included."""
    key = F.when(included, F.col(seq))
    return running(df, series, seq, {"prev_seq": Running("last", key, others=True), "next_seq": Running("next", key, others=True)}, cuts).filter(~included)


def normalize(df: DataFrame, series: str, seq: str, value: str, target: Column, stops: float = 0.65, radius: int = 4, compression: float = 0.12, cuts: Cuts | None = None) -> DataFrame:
    """Exposure gain towards the target within 2 ** +-stops, smoothed by a rolling median, then soft compression. The gain of
    a value of 0 is a limit, as that of any that is small enough."""
    ratio = F.when(F.col(value) == 0, target * F.pow(F.col(value), F.lit(-1.0))).otherwise(target / F.col(value))  # a power of 0 is infinite, no error
    gain = F.greatest(F.pow(F.lit(2.0), F.lit(-stops)), F.least(F.pow(F.lit(2.0), F.lit(stops)), ratio))
    held = rolling_median(df.withColumn("gain", gain), series, seq, "gain", "smooth_gain", radius, cuts)
    lifted = F.col(value) * F.col("smooth_gain")
    return held.withColumn("normal", lifted / (1 + compression * lifted))
