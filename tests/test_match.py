"""Template correlation against numpy, in whole and cut series; evidence against loops."""

import random

import numpy as np
import pytest

from strandline.operators import chunked, match

TEMPLATE = [0.0, 2.0, 5.0, 2.0, -1.0]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    out = [("a", i, round(r.uniform(-50, 50), 2)) for i in range(400)]
    for at in (50, 51, 200, 390):
        for k, t in enumerate(TEMPLATE):
            out[at + k] = ("a", at + k, 1e6 + 3 * t)
    out += [("flat", i, 0.1) for i in range(30)] + [("holes", i, None if i % 6 == 0 else float(i)) for i in range(40)] + [("short", 0, 1.0)]
    return out


def test_correlation_equals_numpy(spark, rows):
    df = spark.createDataFrame(rows, "series string, seq long, v double").repartition(3)
    whole = match.correlate(df, "series", "seq", "v", TEMPLATE)
    cut = match.correlate(df, "series", "seq", "v", TEMPLATE, cuts=chunked.measure(df, "series", "seq", 60))
    got = {(r["series"], r["seq"]): r["score"] for r in whole.collect()}
    assert {(r["series"], r["seq"]): r["score"] for r in cut.collect()} == got
    by = {}
    for s, i, v in rows:
        by.setdefault(s, []).append(np.nan if v is None else v)
    for s, v in by.items():
        for i in range(len(v)):
            w = np.array(v[i : i + 5])
            if len(w) < 5 or np.isnan(w).any() or w.max() == w.min():
                assert got[s, i] is None
            else:
                assert got[s, i] == pytest.approx(np.corrcoef(w, TEMPLATE)[0, 1], abs=1e-9)
    best = match.peaks(df, "series", "seq", "v", TEMPLATE, 0.9, 4.0, 3).filter("series = 'a'").orderBy("rank").collect()
    assert best[0]["score"] == pytest.approx(1.0) and {200, 390} <= {r["seq"] for r in best}
    with pytest.raises(ValueError, match="two different"):
        match.correlate(df, "series", "seq", "v", [1.0, 1.0])


def test_evidence_equals_loops(spark):
    r = random.Random(4)
    template = [match.Feature("up", 10.0, "rise"), match.Feature("down", 25.0, "fall", 2.0), match.Feature("back", -7.0, "fall", 0.5)]
    found = [(g, k, float(r.randrange(0, 400))) for g in "xy" for k in range(40)] + [("z", 1, 5.0)]
    seen = [(g, float(r.randrange(0, 430)), r.choice(["rise", "fall", None])) for g in "xy" for _ in range(110)]
    seen += [("x", found[0][2] + 9.0, "rise"), ("x", found[0][2] + 11.0, "fall")]  # equally near
    got = match.evidence(spark.createDataFrame(found, "g string, id long, at double"), spark.createDataFrame(seen, "g string, at double, kind string"), "g", "id", "at", "kind", template, 2.0, 1.5, 0.5)
    judged = {(x["g"], x["id"]): (x["supported"], x["contradicted"], x["missing"], x["score"], x["reason"]) for x in got.collect()}
    assert len(judged) == len(found)
    for g, k, at in found:
        state = []
        for f in template:
            near = [(abs(b - at - f.offset), kind != f.kind) for h, b, kind in seen if h == g and abs(b - at - f.offset) <= 2.0]
            state.append("missing" if not near else "contradicted" if min(near)[1] else "supported")
        score = sum(f.weight for f, s in zip(template, state, strict=True) if s == "supported") - 1.5 * sum(f.weight for f, s in zip(template, state, strict=True) if s == "contradicted")
        first = next((f"{s}: {f.name}" for s in ("contradicted", "missing") for f, t in zip(template, state, strict=True) if t == s), "weak")
        want = (state.count("supported"), state.count("contradicted"), state.count("missing"), score, None if score >= 0.5 else first)
        assert judged[g, k] == want
    best = {x["g"]: x for x in match.decided(got, spark.createDataFrame(found, "g string, id long, at double"), "g", "id", "at", 30.0).collect()}
    for g in "xy":
        own = [(judged[g, k][3], -k, at) for h, k, at in found if h == g]
        score, ident, at = max(own)
        rival = max(s for s, _, b in own if abs(b - at) >= 30.0)
        assert (best[g]["best_id"], best[g]["margin"]) == (-ident, score - rival)
