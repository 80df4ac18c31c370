"""Connected components of lit cells of grids, given as rows, by run-length union.

1. Runs: the cells of a line that follow each other are one run (a window a line; long lines are cut).
2. Links: runs of neighbouring lines that overlap, or touch at a corner where 8 neighbours count. They meet as intervals
   (`intervals.meetings`), so that no line is compared with itself or with all of another.
3. Components of runs by alternating stars: in each round every node hands the least of its neighbours to the larger
   ones, then to the smaller ones. Only minima travel, so a run with very many links is a partial aggregation.
4. Area, box and centroid come from the runs: a cell is never looked at again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import intervals, sequence
from strandline.session import kept


def runs(cells: DataFrame, grid: str, line: str, at: str) -> DataFrame:
    """(grid, line, first, last) of the maximal runs of cells; repeated cells count once."""
    key = F.struct(F.col(grid), F.col(line))
    rows = cells.select(F.to_json(key).alias("__k"), grid, line, F.col(at).cast("long").alias("__x")).distinct()
    whole = rows.select("__k", grid, line).distinct()
    found = sequence.chunks(rows.select("__k", "__x"), "__k", "__x", 1 << 62)
    return found.join(whole, "__k").select(grid, line, F.col("first_seq").alias("first"), F.col("last_seq").alias("last"))


def roots(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for every node: root is the least node that links (u, v) reach. Each round is written before the next."""
    now = kept(links.filter("u != v").select(F.greatest("u", "v").alias("big"), F.least("u", "v").alias("small")).distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("big", "small")), F.bit_xor(F.xxhash64("small", "big", F.lit(1)))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        ends = now.select(F.col("big").alias("n"), F.col("small").alias("o")).unionByName(now.select(F.col("small").alias("n"), F.col("big").alias("o")))
        lowest = ends.groupBy("n").agg(F.min("o").alias("m")).withColumn("m", F.least("n", "m"))
        far = ends.filter("o > n").join(lowest, "n").select(F.col("o").alias("big"), F.col("m").alias("small")).distinct()
        lowest = far.groupBy("big").agg(F.min("small").alias("m"))
        rest = far.join(lowest, "big").filter("small != m").select(F.greatest("small", "m").alias("big"), F.least("small", "m").alias("small"))
        now = kept(rest.unionByName(lowest.withColumnRenamed("m", "small")).distinct(), "links")
    least = now.groupBy(F.col("big").alias("node")).agg(F.min("small").alias("root"))
    return nodes.select("node").join(least, "node", "left").withColumn("root", F.coalesce("root", "node"))


def components(cells: DataFrame, grid: str, line: str, at: str, corners: bool = True) -> DataFrame:
    """(grid, line, at of the component's first cell, area, box, centroid) of each component. Cells (grid, line, at) are lit;
    nulls are left out."""
    lit = cells.filter(F.col(line).isNotNull() & F.col(at).isNotNull() & F.col(grid).isNotNull())
    found = kept(runs(lit, grid, line, at).withColumn("node", F.struct(F.col(line).cast("long").alias("y"), F.col("first").alias("x"), F.col(grid).cast("string").alias("g"))), "runs")
    reach = 1.0 if corners else 0.0
    place = lambda df, step: df.select(F.to_json(F.struct(F.col(grid).alias("g"), (F.col(line) + step).alias("y"))).alias("k"), F.col("first").cast("double").alias("s"), F.col("last"))
    above = place(found, 1).select("k", "s", (F.col("last") + 1.0 + reach).alias("e"))
    here = place(found, 0).select("k", "s", (F.col("last") + 1.0 + reach).alias("e"))
    met = intervals.meetings(above, here, "k", "s", "e", 1.0)
    parts = F.from_json("k", "g string, y long")
    links = met.select(F.struct((parts["y"] - 1).alias("y"), F.col("a_start").cast("long").alias("x"), parts["g"].alias("g")).alias("u"), F.struct(parts["y"].alias("y"), F.col("b_start").cast("long").alias("x"), parts["g"].alias("g")).alias("v"))
    rooted = found.join(roots(found, links), "node")
    n = F.col("last") - F.col("first") + 1
    return rooted.groupBy(F.col(grid), "root").agg(
        F.sum(n).alias("area"), F.min(line).alias("top"), F.max(line).alias("bottom"), F.min("first").alias("left"), F.max("last").alias("right"),
        F.sum(n * F.col(line)).alias("sum_y"), F.sum(n * (F.col("first") + F.col("last"))).alias("sum_2x"), F.count(F.lit(1)).alias("runs"),
    ).select(
        grid, F.col("root.y").alias("first_line"), F.col("root.x").alias("first_at"), "area", "top", "bottom", "left", "right", (F.col("sum_y") / F.col("area")).alias("y"), (F.col("sum_2x") / 2 / F.col("area")).alias("x"), "runs"
    )
