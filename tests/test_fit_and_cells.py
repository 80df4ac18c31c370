"""Fits of several targets against numpy, components of cells against flooding."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import cells, fit


def test_fit_equals_numpy(spark):
    r = np.random.default_rng(3)
    rows = []
    for g, n, shift in (("a", 300, 1e6), ("b", 80, 0.0), (None, 40, -5.0)):
        x = r.normal(shift, 3.0, (n, 4))
        for v in x:
            rows.append((g, *map(float, v), float(v @ [1, -2, 0.5, 3] + 7 + r.normal()), float(v[0] ** 2)))
    rows.append(("a", None, 1.0, 1.0, 1.0, 5.0, 5.0))  # left out
    df = spark.createDataFrame(rows, "g string, x1 double, x2 double, x3 double, x4 double, y double, z double").repartition(4)
    terms = {c: F.col(c) for c in ("x1", "x2", "x3", "x4")}
    model = fit.fit(df, "g", terms, {"y": F.col("y"), "z": F.col("z")})
    got = {(m["g"], m["target"]): m for m in model.collect()}
    assert len(got) == 6
    for g in ("a", "b", None):
        own = np.array([x[1:] for x in rows if x[0] == g and x[1] is not None])
        for k, target in ((4, "y"), (5, "z")):
            m = got[g, target]
            x = own[:, :4] - own[:, :4].mean(0)
            want = np.linalg.lstsq(x, own[:, k] - own[:, k].mean(), rcond=None)[0]
            assert m["n"] == len(own) and m["rank"] == 4
            assert np.allclose([m["coefficients"][c] for c in terms], want, rtol=1e-6, atol=1e-8)
            assert m["intercept"] == pytest.approx(own[:, k].mean() - own[:, :4].mean(0) @ want, rel=1e-6, abs=1e-4)
    left = fit.residuals(df.filter("g = 'b'"), "g", terms, {"y": F.col("y")}, model).agg(F.sum(F.col("residuals")[0]), F.sum(F.col("residuals")[0] * F.col("x3"))).first()
    assert abs(left[0]) < 1e-6 and abs(left[1]) < 1e-5


def test_dependent_terms_are_left_out(spark):
    df = spark.range(50).selectExpr("1 as g", "cast(id as double) as x", "sin(id) as w").withColumn("y", 3 * F.col("x") + F.col("w") + 1)
    terms = {"x": F.col("x"), "twice": 2 * F.col("x"), "one": F.lit(1.0), "w": F.col("w"), "mix": F.col("x") - F.col("w")}
    model = fit.fit(df, "g", terms, {"y": F.col("y")})
    assert model.first()["rank"] == 2
    worst = fit.residuals(df, "g", terms, {"y": F.col("y")}, model).agg(F.max(F.abs(F.col("residuals")[0]))).first()[0]
    assert worst < 1e-8
    assert fit.fit(df.limit(0), "g", terms, {"y": F.col("y")}).count() == 0
    assert fit.fit(df.limit(1), "g", terms, {"y": F.col("y")}).first()["rank"] == 0


def flood(lit, corners):
    out, rest = [], set(lit)
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (corners or not (a and b))]
    while rest:
        todo = [min(rest)]
        rest.remove(todo[0])
        mine = set(todo)
        while todo:
            g, y, x = todo.pop()
            for a, b in steps:
                c = (g, y + a, x + b)
                if c in rest:
                    rest.remove(c)
                    mine.add(c)
                    todo.append(c)
        first = min(mine)
        ys, xs = [c[1] for c in mine], [c[2] for c in mine]
        out.append((first[0], first[1], first[2], len(mine), min(ys), max(ys), min(xs), max(xs), round(sum(ys) / len(mine), 9), round(sum(xs) / len(mine), 9)))
    return sorted(out)


@pytest.mark.parametrize("corners", [True, False])
def test_components_equal_flooding(spark, corners):
    r = random.Random(2)
    lit = {(g, y, x) for g, share in (("a", 0.3), ("b", 0.5), ("c", 0.62)) for y in range(-6, 14) for x in range(-5, 20) if r.random() < share}
    lit |= {("d", y, x) for y in range(30) for x in range(30) if (x in (0, 29) or y % 4 == 0) and not (y % 8 == 4 and x == 0) and not (y % 8 == 0 and x == 29)}  # a snake
    rows = list(lit) + list(lit)[:50] + [("a", None, 3), (None, 1, 1), ("a", 1, None)]
    df = spark.createDataFrame(rows, "grid string, y long, x long").repartition(3)
    got = cells.components(df, "grid", "y", "x", corners)
    found = sorted((r["grid"], r["first_line"], r["first_at"], r["area"], r["top"], r["bottom"], r["left"], r["right"], round(r["y"], 9), round(r["x"], 9)) for r in got.collect())
    assert found == flood(lit, corners)
    assert cells.components(df.limit(0), "grid", "y", "x").count() == 0
