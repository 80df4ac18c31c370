"""Values of 0, intervals without length, and ties on the last digit: what the smallest tables do not hold."""

import math
import random
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from strandline.operators import intervals, quantile
from strandline.plans import catalogue


@pytest.fixture
def events(spark, tmp_path):
    """A function that writes rows (user_id, event_type, value) as events, a second apart, and compares a query with its SQL."""

    def check(name, rows, files=1):
        df = spark.createDataFrame([(k, u, t, v) for k, (u, t, v) in enumerate(rows)], "event_id long, user_id long, event_type string, value double")
        df = df.select("event_id", F.timestamp_micros(F.col("event_id") * 1_000_000).cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", F.lit('{"k": 1}').alias("props"))
        df.repartitionByRange(files, "event_id").sortWithinPartitions("event_id").write.parquet(str(tmp_path / "events.parquet"))
        con = duckdb.connect()
        con.execute("set threads = 1")
        con.execute(f"create view events as select * from (select * from '{tmp_path}/events.parquet/*.parquet' order by event_id)")
        found = catalogue.queries()[name](spark, str(tmp_path))
        want = con.execute(f"select {', '.join(found.columns)} from ({catalogue.oracle_sql()[name]})").fetchall()
        assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)
        return want

    return check


def test_normalize_takes_values_of_zero(events):
    rows = [(u, "view", v) for u, values in enumerate([(0.0, 5.0, 20.0, 7.5), (0.0, 0.0, 0.0), (3.0, 0.0)]) for v in values]
    assert len(events("normalize_sequence", rows)) == len(rows)


def test_overlap_counts_series_with_empty_intervals_alone(events):
    """A click of no length inside a view's time: the SQL gives 0 for its series; beside it or at its start, none."""
    rows = [(1, "view", 1.0), (1, "click", 0.0), (2, "click", 0.0), (2, "view", 1.0), (3, "view", 0.0), (3, "click", 0.0), (4, "click", 2.0), (4, "view", 1.0), (4, "view", 0.0)]
    assert sorted(events("interval_overlap", rows)) == [(1, 0), (4, 600)]


def test_points_meet_what_holds_them(spark):
    left = [("k", a, a + n) for a, n in product((0, 3, 4, 64, 65), (-2, 0, 1, 70))]
    df = spark.createDataFrame(left, "k string, s long, e long")
    got = sorted(tuple(x)[1:] for x in intervals.meetings(df, df, "k", "s", "e", 4.0, points=True).collect())
    assert got == sorted((s, e, s2, e2) for _, s, e in left for _, s2, e2 in left if s < e2 and s2 < e)


def test_quantiles_round_as_the_sql(events):
    """Levels on a tie of the last digit, by values whose shares don't add up to the value itself; 0.4 and 0.995 of 63, 66 and 76 values."""
    r, rows = random.Random(8), []
    for u in range(600):
        n = r.choice((63, 66, 70, 76))
        values = sorted(round(r.expovariate(1 / 50), 2) for _ in range(n))
        rows += [(u, "view", v) for v in values]
    assert len(events("adaptive_threshold", rows)) == 600


def test_a_fused_sum_is_rounded_once(spark):
    r = random.Random(3)
    rows = [(round(r.expovariate(1 / 50), 2), r.random(), round(r.expovariate(1 / 50), 2) * r.random()) for _ in range(2000)]
    got = spark.createDataFrame(rows, "a double, b double, c double").select("a", "b", "c", quantile._fused(F.col("a"), F.col("b"), F.col("c")).alias("f")).collect()
    assert all(x["f"] == math.fma(x["a"], x["b"], x["c"]) for x in got) and any(x["f"] != x["a"] * x["b"] + x["c"] for x in got)


def some_means(kind, low, sizes):
    """Series whose mean often lies on a tie of the third digit, over several files: the sum's last digit decides."""
    r = random.Random(4)
    rows = [(u, kind, round(low + r.expovariate(1 / 50), 2)) for u in range(400) for _ in range(r.choice(sizes))]
    r.shuffle(rows)
    return rows


def test_means_add_up_in_order(events):
    assert len(events("conditional_summary", some_means("view", 0, (16, 40, 48, 80)), files=6)) == 400


def test_guarded_means_add_up_in_order(events):
    assert len(events("guarded_mean", some_means("purchase", 151, (16, 40, 48, 80)), files=6)) == 400
