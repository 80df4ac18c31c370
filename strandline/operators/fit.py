"""Least squares with many terms and several targets: distributed normal equations.

Two passes: means of all terms and targets, then the sums of products of what is left of them without the means (the
upper triangle of the terms, and the terms with the targets), all in one aggregation with partial sums. A group then is
one row of numbers, whatever its size; its small system is solved by Cholesky with pivots, which leaves out terms that
the others determine. Centring keeps the sums well scaled; a constant term is found from the means. A row with a null in
a term or target is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pivot below this share of its term's own sum of squares counts as nothing: the term depends on the others.
TOLERANCE = 1e-10


def pivoted_solve(a: np.ndarray, b: np.ndarray, tolerance: float = TOLERANCE) -> tuple[np.ndarray, int]:
    """(x, rank) with a x = b for a symmetric, positive semidefinite a; dependent rows get 0."""
    n, scale = len(a), np.sqrt(np.maximum(np.diag(a), 0.0))
    scale = np.where(scale > 0, scale, 1.0)
    rest, order, factor = a / np.outer(scale, scale), list(range(n)), np.zeros((n, n))
    rank = 0
    for k in range(n):
        j = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[j, j] <= tolerance:
            break
        order[k], order[j] = order[j], order[k]
        rest[[k, j]] = rest[[j, k]]
        rest[:, [k, j]] = rest[:, [j, k]]
        factor[[k, j]] = factor[[j, k]]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
        rank += 1
    x = np.zeros(b.shape)
    kept = order[:rank]
    lower = factor[:rank, :rank]
    half = np.linalg.solve(lower, b[kept] / scale[kept][:, None])
    x[kept] = np.linalg.solve(lower.T, half) / scale[kept][:, None]
    return x, rank


def fit(df: DataFrame, group: str, terms: dict[str, Column], targets: dict[str, Column]) -> DataFrame:
    """(group, n, rank, target, intercept, coefficients map<term, double>) for each group and target. The terms need no
    constant: the intercept stands for it."""
    names, goals = list(terms), list(targets)
    x = [c.cast("double").alias(f"__x{k}") for k, c in enumerate(terms.values())]
    y = [c.cast("double").alias(f"__y{k}") for k, c in enumerate(targets.values())]
    columns = [f"__x{k}" for k in range(len(x))] + [f"__y{k}" for k in range(len(y))]
    rows = df.select(group, *x, *y).dropna(subset=columns)
    means = rows.groupBy(group).agg(*[F.avg(c).alias(f"{c}m") for c in columns])
    own = means.withColumnRenamed(group, "__g")
    off = {c: F.col(c) - F.col(f"{c}m") for c in columns}
    held = rows.join(own, F.col(group).eqNullSafe(F.col("__g")))
    upper = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    square = [F.sum(off[f"__x{i}"] * off[f"__x{j}"]) for i, j in upper]
    right = [F.sum(off[f"__x{i}"] * off[f"__y{j}"]) for i in range(len(x)) for j in range(len(y))]
    sums = held.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.array(*square).alias("a"), F.array(*right).alias("b"), F.array(*[F.first(f"{c}m") for c in columns]).alias("m"))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                a, b, m = np.zeros((len(names), len(names))), np.array(row.b).reshape(len(names), len(goals)), np.array(row.m)
                for (i, j), v in zip(upper, row.a, strict=True):
                    a[i, j] = a[j, i] = v
                found, rank = pivoted_solve(a, b)
                for k, goal in enumerate(goals):
                    shift = float(m[len(names) + k] - m[: len(names)] @ found[:, k])
                    out.append((row[0], row.n, rank, goal, shift, dict(zip(names, map(float, found[:, k]), strict=True))))
            yield pd.DataFrame(out, columns=[group, "n", "rank", "target", "intercept", "coefficients"])

    kind = df.schema[group].dataType.simpleString()
    return sums.mapInPandas(solve, f"`{group}` {kind}, n long, rank int, target string, intercept double, coefficients map<string,double>")


def residuals(df: DataFrame, group: str, terms: dict[str, Column], targets: dict[str, Column], model: DataFrame) -> DataFrame:
    """df with the array `residuals`, what the model leaves of each target, in their order; one row of a group's models joins."""
    by = model.groupBy(F.col(group).alias("__g")).agg(F.map_from_entries(F.collect_list(F.struct("target", F.struct("intercept", "coefficients")))).alias("__model"))
    held = df.join(by, F.col(group).eqNullSafe(F.col("__g")), "left")

    def left(name: str, value: Column) -> Column:
        own = F.col("__model")[name]
        guess = own["intercept"]
        for term, x in terms.items():
            guess = guess + own["coefficients"][term] * x.cast("double")
        return value.cast("double") - guess

    return held.withColumn("residuals", F.array(*[left(n, v) for n, v in targets.items()])).drop("__g", "__model")
