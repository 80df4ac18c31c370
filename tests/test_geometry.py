import json

import pytest

from strandline.sources import geometry as geo

GOOD = {f: 1.0 for f in geo.NUMBERS} | {f: (a + b) / 2 for f, (a, b) in geo.BOUNDS.items()}
GOOD |= {"schema_version": 1, "film_format": "regular8", "source": "x", "calibration_frames": [1, 2], "quality": {"p24_capture_lower_top_minus_midpoint": {"median": 5.0}, "capture_lower_x_minus_midpoint": {"median": 1.5}}}


def broken(**changes):
    out = {**GOOD, **changes}
    return {k: v for k, v in out.items() if v != "drop"}


CASES = [
    (GOOD, ""), (broken(schema_version=2), "schema_version"), (broken(film_format="super8"), "film_format"), (broken(frozen=False), "frozen"), (broken(calibration_frames=[]), "calibration_frames"),
    (broken(calibration_frames=[0]), "calibration_frames"), (broken(sprocket_x_px="drop"), "sprocket_x_px"), (broken(sprocket_pitch_px=1200.0), "sprocket_pitch_px"), (broken(sprocket_pitch_mad_px=-1.0), "sprocket_pitch_mad_px"),
    (broken(sprocket_x_mad_px=True), "sprocket_x_mad_px"), (broken(p15_image_support_width_px=9.0), "p15_image_support_width_px"), (broken(quality={}), "capture_lower_top_minus_midpoint;capture_lower_x_minus_midpoint"),
]


def test_violations(spark):
    df = spark.createDataFrame([(k, json.dumps(d)) for k, (d, _) in enumerate(CASES)] + [(99, "{"), (100, None)], "k int, raw string")
    got = {r["k"]: r for r in geo.violations(df).collect()}
    assert [got[k]["violations"] for k in range(len(CASES))] == [w for _, w in CASES]
    assert "source" in got[99]["violations"] and "source" in got[100]["violations"]
    assert got[0]["g"]["capture_lower_top_minus_midpoint"] == 5.0 and got[0]["g"]["p15_image_support_width_px"] == GOOD["sprocket_width_px"]


BASE = [[400.0, 350.0, 380.0, 270.0], [418.0, 1135.0, 380.0, 300.0]]


@pytest.mark.parametrize(("change", "reason"), [((0, 0, 400.0), None), ((1, 1, 1300.0), "pitch"), ((0, 2, 300.0), "widths"), ((1, 3, 400.0), "heights"), ((0, 3, 290.0), "height_difference"), ((1, 0, 500.0), "x_displacement")])
def test_each_predicate_can_fail_alone(spark, change, reason):
    boxes = [list(b) for b in BASE]
    boxes[change[0]][change[1]] = change[2]
    df = spark.createDataFrame([(boxes[::-1],)], "boxes array<array<double>>")
    r = geo.pair_gate(df).first()
    assert r["reason"] == reason and r["passed"] == (reason is None)
    assert [k for k, v in r["checks"].asDict().items() if not v] == ([reason] if reason else [])


def test_no_pair(spark):
    df = spark.createDataFrame([([BASE[0]],), (None,)], "boxes array<array<double>>")
    assert [r["reason"] for r in geo.pair_gate(df).collect()] == ["pair_present"] * 2


def test_band_from_a_geometry(spark):
    doc = broken(p24_capture_pitch_px=785.0, p24_capture_pitch_mad_px=0.5, p24_capture_width_px=380.0, p24_capture_height_px=285.0, p24_capture_height_mad_px=4.0, p24_capture_x_displacement_px=18.0)
    df = geo.parsed(spark.createDataFrame([(BASE, json.dumps(doc)), ([BASE[0], [418.0, 1142.0, 380.0, 300.0]], json.dumps(doc))], "boxes array<array<double>>, raw string"))
    assert [r["reason"] for r in geo.pair_gate(df, geometry=True).collect()] == [None, "pitch"]
