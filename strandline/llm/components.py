"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Count and two exclusive ors of edge hashes: nothing that a large table could make overflow."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("a"), F.bit_xor(F.xxhash64("v", "u", F.lit(1))).alias("b")).first()
    return row["n"], row["a"], row["b"]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of edges (u, v) of any orderable type; root is the least node of the component.

    Only minima over neighbours are computed, so a hub costs a partial aggregation and no list of neighbours. Each
    round ends as a written table; only a row count and a checksum reach the driver. Nulls and loops are ignored."""
    now = stored(
        edges.filter("u is not null and v is not null and u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)
        before, state = state, _state(now)
        if state == before:
            break
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
