import hashlib
import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import kernels, registry
from strandline.plans import runner
from strandline.sources import discovery


def two_bands():
    x = np.zeros((1520, 2028, 3), np.uint8)
    x[100:300, 140:505] = 255
    x[885:1085, 140:505] = 255
    return x


def test_two_bright_bands(spark):
    assert kernels.band_pair(two_bands()) == (0.0, 322.0, 592.5)
    assert kernels.band_pair(np.zeros((1520, 2028, 3), np.uint8)) is None
    df = spark.createDataFrame([(two_bands().tobytes(), 1520, 2028), (b"x", 1520, 2028), (None, 1, 1)], "data binary, h int, w int")
    got = [r["d"] for r in df.select(kernels.detected(F.col("data"), F.col("h"), F.col("w")).alias("d")).collect()]
    assert (got[0]["cx"], got[0]["cy"], got[0]["score"]) == (322.0, 592.5, 0.0) and got[1]["cx"] is None and got[2]["cx"] is None


def test_runs_and_unpacking():
    assert kernels.mask_runs(np.array([1, 1, 0, 1, 0, 0, 1], bool)).tolist() == [[0, 2], [3, 4], [6, 7]]
    assert kernels.unpack12(bytes([0xAB, 0xCD, 0x21])).tolist() == [0xAB1, 0xCD2]


def test_medians_fall_back_to_all_pixels():
    assert kernels.picture_medians(np.zeros((50, 50, 3), np.uint8)) == (0, 0, 0, 0)
    luma, *rgb = kernels.picture_medians(np.full((50, 50, 3), 51, np.uint8))
    assert luma == pytest.approx(0.2, abs=1e-6) and rgb == pytest.approx([0.2] * 3, abs=1e-6)


def test_colour_match_recovers_a_transform():
    r = np.random.default_rng(0)
    x = r.random((4000, 3)) * 0.9
    y = np.clip(x * [0.9, 0.8, 0.7] + 0.05, 0, 1)
    coefficients, luts = kernels.fit_match(x, y)
    assert coefficients.shape == (13, 3) and luts.shape == (3, 256) and (np.diff(luts, axis=1) >= 0).all()
    assert np.abs(kernels.match_colours(x, coefficients, luts) - y).mean() < 0.01


def test_bilinear_and_compare():
    x = np.arange(48, dtype=float).reshape(4, 4, 3)
    assert np.allclose(kernels.bilinear(x, 0.5, 0, 2, 1)[0, :, 0], [1.5, 4.5])
    assert np.allclose(kernels.bilinear(x, -5, -5, 1, 1), x[:1, :1])
    assert kernels.compare(x, x)["psnr"] is None and not kernels.compare(x, x[:1])["same_shape"]
    assert kernels.compare(x, x + 1)["psnr"] == pytest.approx(20 * np.log10(255))


def test_edge_consensus():
    rows = np.arange(20, 41)
    g = np.zeros((60, 100))
    g[31] = 60
    g[30], g[32] = 30, 30
    at, n = kernels.edge_consensus(g, rows)
    assert at == 31.0 and n == 50
    assert kernels.edge_consensus(np.zeros((60, 100)), rows) == (None, 0)


def test_registry(spark):
    assert registry.names() == ["local-median", "rolling-model"]
    for bad in (lambda: registry.register("local-median", lambda: None), lambda: registry.unregister("local-median")):
        with pytest.raises(ValueError):
            bad()
    registry.register("x", lambda: registry.Measure("y", "1", False, lambda *a: a[0]))
    with pytest.raises(ValueError):
        registry.create("x")
    registry.unregister("x")
    with pytest.raises(KeyError):
        registry.create("x")
    df = spark.createDataFrame([("a", 1, 2.0)], "s string, q long, v double")
    assert registry.create("local-median").apply(df, "s", "q", "v").first()["accepted"]


def test_projects(spark, tmp_path):
    for name, frames, meta in (("b", (1, 2, 3), {"project_name": "Alpha", "film_format": "regular8"}), ("A", (1, 3), None), ("c", (), "{broken")):
        (tmp_path / name / "raw").mkdir(parents=True)
        for k in frames:
            (tmp_path / name / "raw" / f"frame_{k:06d}.dng").write_bytes(b"x")
        if meta:
            (tmp_path / name / "metadata.json").write_text(meta if isinstance(meta, str) else json.dumps(meta))
    got = {r["name"]: r for r in discovery.projects(spark, str(tmp_path)).collect()}
    assert list(got) == ["A", "Alpha", "c"]
    assert got["Alpha"]["contiguous"] and got["Alpha"]["frames"] == 3 and got["Alpha"]["warnings"] == []
    assert "frames have gaps" in got["A"]["warnings"] and "no metadata" in got["A"]["warnings"]
    assert not got["c"]["available"] and "metadata is not JSON" in got["c"]["warnings"]


def test_calibrations(spark, tmp_path):
    (tmp_path / "one.json").write_text("{}")
    sha = hashlib.sha256(b"{}").hexdigest()
    for name, d in (("a", {"calibration_id": "x", "config": "one.json", "artifact_sha256": sha}), ("b", {"calibration_id": "x", "config": "gone.json"}), ("c", {"calibration_id": "y", "config": "gone.json"}), ("d", {"calibration_id": "z", "config": "one.json", "artifact_sha256": "0"}), ("e", {"display_name": "no config"})):
        (tmp_path / f"{name}.metadata.json").write_text(json.dumps(d))
    got = [(r["calibration_id"], r["available"], r["reason"]) for r in discovery.calibrations(spark, [str(tmp_path), str(tmp_path)]).collect()]
    assert got == [("x", True, None), ("y", False, "missing: gone.json"), ("z", False, "changed: one.json")]


def test_run_resumes(spark, tmp_path):
    rows = [("a", k, None if k in (4, 7, 8) else 100.0 + k) for k in range(1, 13) if k != 10]
    df = spark.createDataFrame(rows, "series string, seq long, v double")
    path, seen = str(tmp_path / "book"), []
    part = runner.run(spark, df, path, runner.RunConfig(batch=4, last=5), seen.append)
    assert part["status"] == "partial" and part["segments"] == 2 and part["missing"] == 6
    whole = runner.run(spark, df, path, runner.RunConfig(batch=4))
    assert whole["status"] == "complete" and whole["rows"] == 11 and whole["included"] == 9
    again = runner.run(spark, df, path, runner.RunConfig(batch=4))
    assert {k: again[k] for k in ("segments", "rows", "included")} == {k: whole[k] for k in ("segments", "rows", "included")}
    assert [e["event"] for e in seen] == ["job_started", "job_completed"] and [e["sequence"] for e in seen] == [0, 1]
    with pytest.raises(ValueError):
        runner.run(spark, df, path, runner.RunConfig(batch=5))
    for bad in ({"batch": 0}, {"batch": True}, {"limit": 0.0}, {"first": 3, "last": 2}, {"name": "../x"}):
        with pytest.raises(ValueError):
            runner.RunConfig(**bad)


def test_an_open_run_waits_for_the_next_observation(spark, tmp_path):
    rows = [("a", k, None if k == 4 else 100.0) for k in range(1, 5)]
    frame = lambda r: spark.createDataFrame(r, "series string, seq long, v double")
    path = str(tmp_path / "book")
    part = runner.run(spark, frame(rows), path, runner.RunConfig(batch=10, open=True))
    assert part["status"] == "partial" and (part["rows"], part["included"], part["missing"]) == (3, 3, 1)
    whole = runner.run(spark, frame(rows + [("a", 5, 102.0)]), path, runner.RunConfig(batch=10))
    assert whole["status"] == "complete" and (whole["rows"], whole["included"]) == (5, 5)  # 4 is bracketed now
    shut = runner.run(spark, frame(rows), str(tmp_path / "shut"), runner.RunConfig(batch=10))
    assert (shut["rows"], shut["included"]) == (4, 3)


def test_run_control(spark, tmp_path):
    df = spark.createDataFrame([("a", k, 1.0) for k in range(3)], "series string, seq long, v double")
    path, lines = str(tmp_path / "book"), tmp_path / "events.jsonl"
    with runner.exclusive(spark, path):
        with pytest.raises(RuntimeError, match="another run"):
            runner.run(spark, df, path)
    runner.run(spark, df, path, sink=runner.json_lines(str(lines)))
    assert [json.loads(x)["event"] for x in lines.read_text().splitlines()] == ["job_started", "job_completed"]
    with pytest.raises(RuntimeError, match="GiB"):
        runner.run(spark, df, path, runner.RunConfig(free_gib=1e9))
    broken = df.withColumn("v", F.raise_error(F.lit("no such frame")).cast("double"))
    with pytest.raises(Exception, match="no such frame"):
        runner.run(spark, broken, str(tmp_path / "other"), sink=runner.json_lines(str(lines)))
    assert json.loads(lines.read_text().splitlines()[-1])["event"] == "job_failed"
    assert "no such frame" in json.loads((tmp_path / "other.failure.json").read_text())["message"]
    assert not (tmp_path / "book.lock").exists() and not (tmp_path / "other.lock").exists()
    for value in ({"a": 1}, {"a": 2}):
        runner.atomic_json(spark, str(tmp_path / "x.json"), value)
        assert json.loads((tmp_path / "x.json").read_text()) == value


def test_a_lock_left_by_a_killed_run_is_taken_over(spark, tmp_path):
    path, lock = str(tmp_path / "book"), tmp_path / "book.lock"
    lock.write_text("some process that was killed")
    os.utime(lock, (1, 1))
    with runner.exclusive(spark, path, beat=0.1, stale=5):
        assert lock.read_text() != "some process that was killed"
        os.utime(lock, (1, 1))
        time.sleep(1)  # heartbeats
        assert time.time() - lock.stat().st_mtime < 5
        with pytest.raises(RuntimeError, match="another run"), runner.exclusive(spark, path, stale=5):
            pass
        lock.write_text("another process")  # as if this one had paused and lost it
    assert lock.read_text() == "another process"
    lock.unlink()


def test_settings_from_json():
    load = runner.RunConfig.load
    assert load('{"run": {"batch": 7}, "gate": {"limit": 3.5}}') == runner.RunConfig(batch=7, limit=3.5)
    assert load({"first": 2}, runner.RunConfig(batch=5)) == runner.RunConfig(batch=5, first=2)
    assert load({"limit": 2.0, "gate": {"limit": 2.0}}).limit == 2.0
    for bad in ("[]", {"speed": 1}, {"run": {"limit": 1.0}}, {"gate": 3}, {"limit": 2.0, "gate": {"limit": 3.0}}, {"batch": True, "run": {"batch": 1}}, {"batch": 0}):
        with pytest.raises(ValueError):
            load(bad)


def test_coarse_to_fine_equals_loops():
    r = np.random.default_rng(3)
    px, py = r.uniform(-3, 70, 40), np.round(r.uniform(-3, 70, 40))
    got = kernels.coarse_to_fine(lambda u, v: (u - px[:, None]) ** 2 + (v - py[:, None]) ** 2, 40)
    for k in range(40):
        cost = lambda n: ((n[0] - px[k]) ** 2 + (n[1] - py[k]) ** 2, n)
        two = sorted(((x, y) for x in range(0, 64, 8) for y in range(0, 64, 8)), key=cost)[:2]
        assert tuple(got[k]) == min(((x + a, y + b) for x, y in two for a in range(-4, 5) for b in range(-4, 5)), key=cost)


def test_lower_edge(spark):
    x = np.zeros((120, 300, 3), np.uint8)
    x[60:] = 200
    y, n = kernels.lower_edge(x, 150.0, 57.0, 300.0)
    assert y == pytest.approx(59.5, abs=0.6) and n == 90
    assert kernels.lower_edge(x[::-1], 150.0, 57.0, 300.0) == (None, 0)  # a falling edge is none
    assert kernels.lower_edge(x, 150.0, 20.0, 300.0)[0] is None and kernels.lower_edge(x, 900.0, 57.0, 300.0) == (None, 0)
    df = spark.createDataFrame([(x.tobytes(), 120, 300, 150.0, 57.0, 300.0), (b"x", 120, 300, 1.0, 1.0, 1.0), (x.tobytes(), 120, 300, None, 57.0, 300.0)], "d binary, h int, w int, x double, e double, s double")
    got = [r["o"] for r in df.select(kernels.lower_edge_column("d", "h", "w", "x", "e", "s").alias("o")).collect()]
    assert got[0]["y"] == y and got[0]["inliers"] == 90 and got[1]["y"] is None and got[2]["y"] is None
