"""Candidate generation and choice: theta joins by buckets, best with tie-breaks, competitor margins, greedy steps."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.fold import fold_sorted


def band_pairs(left: DataFrame, right: DataFrame, key: str, a: str, b: str, low: float, high: float) -> DataFrame:
    """Pairs of a key with low <= b - a <= high. Values are cut into cells of the band's width: each left row meets
    two cells, so the work follows the number of results."""
    width = high - low
    cell = lambda x: F.floor(x / width).cast("long")
    spread = left.withColumn("__c", F.explode(F.sequence(cell(F.col(a) + low), cell(F.col(a) + high))))
    return spread.join(right.withColumn("__c", cell(F.col(b))), [key, "__c"]).filter((F.col(b) - F.col(a)).between(low, high)).drop("__c")


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group; the order must be total."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col(rank) <= k)


def margin(df: DataFrame, group: str, score: str, ident: str, place: str, apart: float) -> DataFrame:
    """The best row of each group, the best competitor at least `apart` away from it in `place`, and the difference."""
    best = df.groupBy(group).agg(F.max_by(F.struct(ident, place, score), F.struct(F.col(score), -F.col(ident))).alias("best"))
    rest = df.join(best, group).filter(F.abs(F.col(place) - F.col(f"best.{place}")) >= apart).groupBy(group).agg(F.max(score).alias("rival"))
    found = best.join(rest, group, "left")
    return found.select(group, F.col(f"best.{ident}").alias("best_id"), F.col(f"best.{score}").alias("best_score"), "rival", (F.col(f"best.{score}") - F.col("rival")).alias("margin"))


def suppress(df: DataFrame, group: str, ident: str, place: str, score: str, radius: float, most: int) -> DataFrame:
    """Greedy suppression: by falling score, keep a row unless a kept one is within `radius`; stop at `most` rows.

    Groups come sorted and are folded as they pass: only the places kept so far are held."""
    rows = df.select(group, ident, place, score).filter(f"`{score}` is not null and `{place}` is not null")

    def start() -> list[float]:
        return []

    def step(kept: list[float], row: tuple) -> tuple[list[float], tuple | None]:
        if len(kept) == most or any(abs(row[2] - k) < radius for k in kept):
            return kept, None
        return [*kept, row[2]], (len(kept) + 1,)

    return fold_sorted(rows, group, [F.desc(score), F.asc(ident)], start, step, "rank int")


def cluster(df: DataFrame, group: str, ident: str, value: str, radius: float) -> DataFrame:
    """Greedy clusters on a line: sorted values join the first cluster whose current median is within the radius.

    Values only grow, so a cluster that one value has passed by can take no later one: the newest is the only open one,
    and of its values just those from its median on are held. Nulls are left out."""
    rows = df.select(group, ident, value).filter(f"`{value}` is not null")

    def start() -> tuple:
        return -1, 0, deque()  # number, size, values from the lower median on

    def step(state: tuple, row: tuple) -> tuple[tuple, tuple]:
        number, size, held = state
        v = row[2]
        if not size or abs(v - (held[0] if size % 2 else (held[0] + held[1]) / 2)) > radius:
            return (number + 1, 1, deque([v])), (number + 1,)
        held.append(v)
        if size % 2 == 0:
            held.popleft()
        return (number, size + 1, held), (number,)

    return fold_sorted(rows, group, [F.asc(value), F.asc(ident)], start, step, "cluster int")


def nearest(left: DataFrame, right: DataFrame, a: str, b: str, out: str = "distance") -> DataFrame:
    """Distance from each left value to the nearest right value (null if there is none), without a cross join.

    Only distinct values meet, so repeated ones cost nothing. They are cut at quantiles into as many parts as there are
    shuffle partitions, whatever their spread; each part has one window, and the nearest right values of other parts come
    from a table with one row a part."""
    from pyspark.ml.feature import Bucketizer

    spark = left.sparkSession
    x = left.select(F.col(a).cast("double").alias("__v")).filter("__v is not null and not isnan(__v)").withColumn("__r", F.lit(None).cast("double"))
    y = right.select(F.col(b).cast("double").alias("__v")).filter("__v is not null and not isnan(__v)").withColumn("__r", F.col("__v"))
    both = x.unionByName(y).groupBy("__v").agg(F.max("__r").alias("__r"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(both.approxQuantile("__v", [k / n for k in range(1, n)], 0.25 / n))) if n > 1 else []
    both = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__v", outputCol="__c").transform(both)
    w = W.partitionBy("__c").orderBy("__v")
    inside = both.withColumn("__l", F.max("__r").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("__h", F.min("__r").over(w.rowsBetween(0, W.unboundedFollowing)))
    parts = W.partitionBy(F.lit(1)).orderBy("__c")
    ends = both.groupBy("__c").agg(F.min("__r").alias("lo"), F.max("__r").alias("hi"))
    ends = ends.select("__c", F.max("hi").over(parts.rowsBetween(W.unboundedPreceding, -1)).alias("__p"), F.min("lo").over(parts.rowsBetween(1, W.unboundedFollowing)).alias("__n"))
    distance = F.least(F.col("__v") - F.coalesce("__l", "__p"), F.coalesce("__h", "__n") - F.col("__v"))
    found = inside.join(ends, "__c").select(F.col("__v").alias("__d"), distance.alias(out))
    return left.join(found, F.col(a).cast("double") == F.col("__d"), "left").drop("__d")


def vector_top_k(queries: DataFrame, rows: DataFrame, ident: str, vector: str, k: int, block: int = 2048) -> DataFrame:
    """(query, rank, id, cosine) of the k most similar other rows of every query; ties go to the smaller id.

    A stated query set meets all rows in blocks: each block of queries is one pass over the rows, in which a task keeps
    k rows a query, so what is held and what is shuffled do not depend on the number of rows. Sums run over the
    dimensions in order, so equal vectors have equal similarities."""
    spark = queries.sparkSession
    base = queries.select(F.col(ident).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("x")).filter("q is not null and x is not null")
    total = base.count()
    blocks = max(1, -(-total // block))
    schema = "q long, c double, id long"
    out = None
    for number in range(blocks):
        part = base.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == number).orderBy("q").collect() if total else []
        shared = spark.sparkContext.broadcast((np.array([r["q"] for r in part], np.int64), np.array([r["x"] for r in part], np.float64).reshape(len(part), -1)))
        found = rows.select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).filter("id is not null and x is not null").mapInArrow(_nearest_vectors(shared, k), schema)
        out = found if out is None else out.unionByName(found)
    return top_k(out, ["q"], [F.desc("c"), F.asc("id")], k)


def _nearest_vectors(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        if not len(ids):
            return
        norm = np.zeros(len(ids))
        for d in range(q.shape[1]):
            norm += q[:, d] * q[:, d]
        best_c, best_i = np.full((len(ids), 0), -np.inf), np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                other = part.column(0).to_numpy()
                dots, squares = np.zeros((len(ids), len(x))), np.zeros(len(x))
                for d in range(q.shape[1]):
                    dots += q[:, d, None] * x[None, :, d]
                    squares += x[:, d] * x[:, d]
                with np.errstate(all="ignore"):
                    c = dots / np.sqrt(norm[:, None] * squares[None, :])
                c[ids[:, None] == other[None, :]] = -np.inf
                c, i = np.concatenate([best_c, c], axis=1), np.concatenate([best_i, np.broadcast_to(other, c.shape)], axis=1)
                order = np.lexsort((i, -c), axis=1)[:, :k]
                best_c, best_i = np.take_along_axis(c, order, axis=1), np.take_along_axis(i, order, axis=1)
        real = best_c > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, real.sum(axis=1))), pa.array(best_c[real]), pa.array(best_i[real])], names=["q", "c", "id"])

    return run
