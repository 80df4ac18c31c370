"""Distributed selection against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import gates, quantile, stats


def reference(rows, at):
    out = {}
    for g in {r[0] for r in rows}:
        v = np.array([x for k, x in rows if k == g and x is not None])
        if len(v):
            out[g] = (len(v), v.min(), v.max(), *np.quantile(v, at))
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(4)
    out = [("wide", float(x)) for x in r.normal(0, 1e6, 6000)]
    out += [("ties", float(x)) for x in r.choice([1.0, 1.0, 1.0, 2.0, 2.5, 7.0], 3000)] + [("one", 5.0)] * 900
    out += [(None, float(x)) for x in range(700)] + [("small", float(x)) for x in range(9)] + [("empty", None)] * 5 + [("wide", None)] * 50
    out += [("skew", float(x)) for x in np.exp(r.normal(0, 4, 2500))]
    return out


@pytest.mark.parametrize(("bound", "marks"), [(40, 50), (300, 1000), (10**6, 10)])
def test_selection_equals_numpy(spark, rows, bound, marks):
    at = [0.0, 0.001, 0.25, 0.5, 0.8333, 1.0]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: (r["n"], r["low"], r["high"], *r["q"]) for r in quantile.quantiles(df, "g", "v", at, bound, marks).collect()}
    want = reference(rows, at)
    assert got.keys() == want.keys()
    for g, w in want.items():
        assert np.allclose(got[g], w, rtol=1e-12, atol=1e-12), g


def test_three_rounds_and_bounded_gathering(spark, monkeypatch):
    """200,000 values, 50 marks and a bound of 60: at least three narrowings, and no list longer than the bound."""
    rounds = []
    real = quantile.kept

    def watched(df, label):
        out = real(df, label)
        rounds.append(out.agg(F.max("b0.m")).first()[0])
        return out

    monkeypatch.setattr(quantile, "kept", watched)
    df = spark.range(200_000).selectExpr("1 as g", "cast(pmod(id * 104729, 1000003) as double) as v")
    got = quantile.quantiles(df, "g", "v", [0.37], 60, 50).first()
    values = np.array([i * 104729 % 1000003 for i in range(200_000)], float)
    assert got["q"][0] == pytest.approx(np.quantile(values, 0.37))
    assert len(rounds) >= 5 and rounds[0] == 200_000 and rounds[-1] <= 60 and sorted(rounds, reverse=True) == rounds


def test_several_keys(spark):
    df = spark.range(3000).selectExpr("pmod(id, 3) as a", "pmod(id, 2) as b", "cast(id as double) as v")
    got = {(r["a"], r["b"]): r["q"][0] for r in quantile.quantiles(df, ["a", "b"], "v", [0.5], 100, 40).collect()}
    for (a, b), q in got.items():
        assert q == np.median([i for i in range(3000) if i % 3 == a and i % 2 == b])
    assert len(got) == 6


def test_callers_with_a_small_bound(spark, rows, monkeypatch):
    """The robust statistics and the band are the same whether groups are narrowed or not."""
    df = spark.createDataFrame([x for x in rows if x[0] not in (None, "empty")], "g string, v double").repartition(3)
    band = lambda: sorted((r["g"], r["v"] is None, r["v"] or 0, r["in_band"]) for r in gates.mad_band(df, "g", "v", 1.0).collect() if r["v"] is not None)
    robust = lambda: sorted(tuple(r) for r in stats.robust(df, "g", "v").collect())
    want = robust(), band()
    monkeypatch.setattr(quantile, "BOUND", 2000)
    for a, b in zip(want, (robust(), band()), strict=True):
        for x, y in zip(a, b, strict=True):
            assert x[0] == y[0] and np.allclose(x[1:], y[1:])
