"""Windows over series that are longer than one task.

A series of more than `chunk` rows is cut at quantiles of its order column into chunks of about that size; the other
series are whole, and without a long one the plan is that of a plain window. Two forms cover what windows are used for:

halo     bounded windows: each chunk gets copies of the few rows before and after its cuts, and only its own rows are kept
running  unbounded ones: each chunk is reduced to one summary row, the summaries of a series are scanned, and what came
         before (or comes after) a chunk is added to the windows inside it

No task holds more than a chunk and its halo. Cuts and summaries have one row a chunk and are broadcast only up to a size. The
order column is numeric and unique in its series. The cuts are found by one sort, and looked up in a tree: each level is one
join with nodes of fewer than _FAN keys, so that a row never carries more of them, however many chunks there are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.session import kept

#: Rows of a chunk, the most chunks of all long series whose summaries (some 50 bytes each) are broadcast, and the most keys of
#: a level of the tree (8 bytes each).
CHUNK, BROADCAST, KEYS = 1_000_000, 100_000, 1_000_000
#: Children of a node of the tree.
_FAN = 64


@dataclass(frozen=True)
class Cuts:
    """Where the long series of a table are cut: chunk c of a series begins at its c-th first key. `bounds` has one table a level,
    (series, node, first keys of the children after the first), the root first, and `near` whether it is broadcast; None: no
    series is long."""

    series: str
    seq: str
    chunk: int
    bounds: tuple[DataFrame, ...] | None = None
    near: tuple[bool, ...] = ()
    small: bool = True

    def apply(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """df with its chunk number `__c` where series are cut, and the keys that a window is partitioned by. Rows that have the
        number keep it, through all operators: a caller of several may apply the cuts once."""
        if self.bounds is None:
            return df, [self.series]
        if "__c" in df.columns:
            return df, [self.series, "__c"]
        key, held = F.col(self.seq), df.withColumn("__c", F.lit(0).cast("long"))
        halves = F.array(*[F.lit(_FAN >> k) for k in range(1, _FAN.bit_length())])
        for level, near in zip(self.bounds, self.near, strict=True):
            own = level.withColumnRenamed(self.series, "__cut_series")
            held = held.join(F.broadcast(own) if near else own, F.col(self.series).eqNullSafe(F.col("__cut_series")) & (F.col("__c") == F.col("__node")), "left")
            child = F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(F.get("__firsts", at + half - 1) <= key, half).otherwise(0))
            held = held.withColumn("__c", F.col("__c") * _FAN + child).drop("__cut_series", "__node", "__firsts")
        return held, [self.series, "__c"]

    def join(self, df: DataFrame, summary: DataFrame) -> DataFrame:
        """df (with __c) and the summary row of its chunk."""
        own = summary.withColumnsRenamed({self.series: "__cut_series", "__c": "__cut_no"})
        on = F.col(self.series).eqNullSafe(F.col("__cut_series")) & (F.col("__c") == F.col("__cut_no"))
        return df.join(F.broadcast(own) if self.small else own, on, "left").drop("__cut_series", "__cut_no")


def measure(df: DataFrame, series: str, seq: str, chunk: int | None = None) -> Cuts:
    """Find the long series and cut them into chunks of equal numbers of rows. Counts the rows, and if any series is long, sorts
    the two columns of the long ones: a row's rank is its place in its partition of the sort, and what comes before that."""
    chunk = CHUNK if chunk is None else chunk
    rows = df.select(series, seq)
    sizes = rows.groupBy(series).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > chunk)
    most = sizes.agg(F.max("__n").alias("n"), F.sum("__n").alias("total"), F.count(F.lit(1)).alias("long")).first()
    if most["n"] is None:
        return Cuts(series, seq, chunk)
    few = most["long"] <= BROADCAST
    long = sizes.select(F.col(series).alias("__s"))
    near = rows.join(F.broadcast(long) if few else long, F.col(series).eqNullSafe(F.col("__s"))).drop("__s")
    place = F.monotonically_increasing_id()  # the partition's number above the row's place in it
    near = kept(near.repartitionByRange(series, seq).sortWithinPartitions(series, seq).withColumn("__at", place).withColumn("__part", F.shiftright("__at", 33)), "sorted")
    before, whole = W.partitionBy(series).orderBy("__part").rowsBetween(W.unboundedPreceding, -1), W.partitionBy(series)
    parts = near.groupBy(series, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    parts = parts.select(F.col(series).alias("__s"), F.col("__part").alias("__p"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__off"), F.sum("__n").over(whole).alias("__n"))
    on = F.col(series).eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p"))
    rank, own = F.col("__at") + F.col("__off"), F.ceil(F.col("__n") / F.lit(chunk)).cast("long")
    chunks = lambda r: F.floor(r * own / F.col("__n")).cast("long")
    first = near.join(F.broadcast(parts) if few else parts, on).withColumn("__c", chunks(rank)).filter((rank > 0) & (F.col("__c") > chunks(rank - 1)))
    depth, pieces = 1, -(-most["n"] // chunk)
    while _FAN**depth < pieces:
        depth += 1
    units = [_FAN ** (depth - 1 - k) for k in range(depth)]  # chunks below a child, by level
    level = F.lit(depth - 1)
    for k in reversed(range(depth - 1)):
        level = F.when(F.col("__c") % units[k] == 0, k).otherwise(level)
    node = F.floor(F.col("__c") / F.element_at(F.array(*[F.lit(u * _FAN) for u in units]), F.col("__level") + 1)).cast("long")
    tree = first.withColumn("__level", level).withColumn("__node", node).groupBy(series, "__level", "__node").agg(F.array_sort(F.collect_list(seq)).alias("__firsts"))
    tree = kept(tree, "cuts")
    count = most["total"] // chunk + most["long"]
    bounds = tuple(tree.filter(F.col("__level") == k).drop("__level") for k in range(depth))
    return Cuts(series, seq, chunk, bounds, tuple(count // u <= KEYS for u in units), count <= BROADCAST)


def halo(df: DataFrame, series: str, seq: str, before: int, after: int, work: Callable[[DataFrame, list[str]], DataFrame], cuts: Cuts | None = None) -> DataFrame:
    """`work(rows, keys)` adds columns by windows over `keys` that reach at most `before` rows back and `after` rows ahead."""
    cuts = cuts or measure(df, series, seq)
    rows, keys = cuts.apply(df)
    if cuts.bounds is None:
        return work(rows, keys)
    if 2 * max(before, after) > cuts.chunk:
        raise ValueError("the window reaches over half a chunk")
    own_number = () if "__c" in df.columns else ("__c",)
    place = rows.withColumn("__a", F.row_number().over(W.partitionBy(*keys).orderBy(seq))).withColumn("__n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    c = F.col("__c")
    own, ahead, back = F.struct(c.alias("c"), F.lit(True).alias("own")), F.struct((c + 1).alias("c"), F.lit(False).alias("own")), F.struct((c - 1).alias("c"), F.lit(False).alias("own"))
    homes = F.array_compact(F.array(own, F.when(F.col("__n") - F.col("__a") < before, ahead), F.when((F.col("__a") <= after) & (c > 0), back)))
    held = place.withColumn("__h", F.explode(homes)).withColumn("__c", F.col("__h.c")).withColumn("__own", F.col("__h.own")).drop("__h", "__a", "__n")
    return work(held, keys).filter("__own").drop("__own", *own_number)


@dataclass(frozen=True)
class Running:
    """A value that goes along a series: `kind` is sum, max, last (the last that is not null so far) or next (the first that is
    not null from here on). `others`: without the row itself."""

    kind: str
    of: Column
    others: bool = False


def running(df: DataFrame, series: str, seq: str, columns: dict[str, Running], cuts: Cuts | None = None) -> DataFrame:
    """df with running values. Nulls are left out of sums and maxima; before the first value there is null."""
    cuts = cuts or measure(df, series, seq)
    rows, keys = cuts.apply(df)
    ahead = {"next"}
    reduce = {
        "sum": F.sum, "max": F.max, "last": lambda x: F.max_by(x, F.when(x.isNotNull(), F.col(seq))), "next": lambda x: F.min_by(x, F.when(x.isNotNull(), F.col(seq))),
    }
    # what comes next is the last in descending order: a frame up to the end would be gone through again for every row
    along = {"sum": F.sum, "max": F.max, "last": lambda x: F.last(x, True), "next": lambda x: F.last(x, True)}
    merge = {
        "sum": lambda near, far: F.when(near.isNull(), far).otherwise(near + F.coalesce(far, F.lit(0))), "max": F.greatest, "last": F.coalesce, "next": F.coalesce,
    }
    carried = {}
    if cuts.bounds is not None:
        summary = rows.groupBy(*keys).agg(*[reduce[r.kind](r.of).alias(f"__r{k}") for k, r in enumerate(columns.values())])
        earlier, later = (W.partitionBy(series).orderBy(c).rowsBetween(W.unboundedPreceding, -1) for c in (F.asc("__c"), F.desc("__c")))  # one row a chunk
        over = [along[r.kind](F.col(f"__r{k}")).over(later if r.kind in ahead else earlier).alias(f"__q{k}") for k, r in enumerate(columns.values())]
        rows = cuts.join(rows, summary.select(*keys, *over))
        carried = {name: F.col(f"__q{k}") for k, name in enumerate(columns)}
    added = {}
    for name, r in columns.items():
        w = W.partitionBy(*keys).orderBy(F.desc(seq) if r.kind in ahead else F.asc(seq))
        near = along[r.kind](r.of).over(w.rowsBetween(W.unboundedPreceding, -1 if r.others else 0))
        added[name] = merge[r.kind](near, carried[name]) if carried else near
    return rows.withColumns(added).drop(*(() if "__c" in df.columns else ("__c",)), *[f"__q{k}" for k in range(len(columns))])
