"""Long series in chunks against plain windows over the whole series."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators import chunked, sequence


@pytest.fixture(scope="module")
def long(spark):
    r = random.Random(6)
    rows = [("long", 3 * i + r.randint(0, 2), None if 400 < i < 1100 or r.random() < 0.3 else round(r.uniform(0, 300), 2)) for i in range(2000)]
    rows += [(None, i, float(i % 7)) for i in range(230)] + [("short", i, float(i)) for i in range(60)] + [("one", 5, None)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "series string, seq long, v double").repartition(5).cache()


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    key = lambda df: sorted((tuple(x) for x in df.select(*sorted(df.columns)).collect()), key=repr)
    assert key(a) == key(b)


def both(long, work, chunk=100):
    """The operator over cut series, and over whole ones."""
    cut = chunked.measure(long, "series", "seq", chunk)
    assert cut.bounds is not None
    whole = chunked.measure(long, "series", "seq", 10**6)
    assert whole.bounds is None
    same(work(long, cut), work(long, whole))


def test_chunks_are_bounded_and_ordered(long):
    for chunk in (100, 11):  # 20 and about 180 pieces, so that cuts are also found in two steps
        cut = chunked.measure(long, "series", "seq", chunk)
        rows, keys = cut.apply(long)
        assert keys == ["series", "__c"]
        parts = rows.groupBy("series", "__c").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("a"), F.max("seq").alias("z")).orderBy("series", "__c").collect()
        assert max(p["n"] for p in parts if p["series"] == "long") <= 1.2 * chunk
        assert {p["__c"] for p in parts if p["series"] in ("short", "one")} == {0} or chunk == 11
        own = [p for p in parts if p["series"] == "long"]
        assert [p["__c"] for p in own] == list(range(len(own))) and all(x["z"] < y["a"] for x, y in zip(own, own[1:], strict=False))


@pytest.mark.parametrize(
    "name",
    ["rolling_median", "trailing_median", "gate", "interpolate", "bracket", "islands", "chunks", "delta", "convolve", "gradient", "extrema", "peaks", "contrast", "quadratic", "cumulative_max", "numbers", "trailing", "neighbours", "numbered"],
)
def test_cut_series_equal_whole_ones(long, name):
    known = F.col("v").isNotNull()
    seq = sequence
    work = {
        "rolling_median": lambda d, c: seq.rolling_median(d, "series", "seq", "v", "m", cuts=c),
        "trailing_median": lambda d, c: seq.trailing_median(d, "series", "seq", "v", "m", cuts=c),
        "gate": lambda d, c: seq.local_median_gate(d, "series", "seq", "v", 45.0, cuts=c),
        "interpolate": lambda d, c: seq.interpolate(d, "series", "seq", "v", known, cuts=c),
        "bracket": lambda d, c: seq.bracket(d, "series", "seq", "v", known, cuts=c),
        "islands": lambda d, c: seq.islands(d, "series", "seq", known, c),
        "chunks": lambda d, c: seq.chunks(d, "series", "seq", 4, c),
        "delta": lambda d, c: seq.adjacent_delta(d, "series", "seq", "v", cuts=c),
        "convolve": lambda d, c: seq.convolve(d, "series", "seq", "v", [1, 2, 3, 2, 1], "s", c),
        "gradient": lambda d, c: seq.gradient(d, "series", "seq", "v", "g", c),
        "extrema": lambda d, c: seq.local_extrema(d, "series", "seq", "v", c),
        "peaks": lambda d, c: seq.slope_peaks(d.fillna(0.0, ["v"]), "series", "seq", "v", cuts=c),
        "contrast": lambda d, c: seq.edge_contrast(d, "series", "seq", "v", cuts=c),
        "quadratic": lambda d, c: seq.quadratic_peak(d, "series", "seq", "v", cuts=c),
        "cumulative_max": lambda d, c: seq.cumulative_max(d, "series", "seq", "v", "m", c),
        "numbers": lambda d, c: seq.output_numbers(d, "series", "seq", known, cuts=c),
        "trailing": lambda d, c: seq.trailing_unresolved(d, "series", "seq", known & (F.col("seq") < 5000), c),
        "neighbours": lambda d, c: seq.neighbours_of_islands(d, "series", "seq", known, c),
        "numbered": lambda d, c: seq.numbered(d, "series", "seq", "i", c),
    }[name]
    both(long, work)


def test_no_task_holds_more_than_two_chunks(spark):
    """A series of 300,000 rows in chunks of 5,000: every window's group, halo included, is at most two chunks."""
    df = spark.range(300_000).selectExpr("0 as series", "id as seq", "cast(pmod(id * 7919, 1000) as double) as v")
    cut = chunked.measure(df, "series", "seq", 5_000)
    sizes = []

    def work(rows, keys):
        sizes.append(rows.groupBy(*keys).count().agg(F.max("count").alias("n"), F.count(F.lit(1)).alias("k")).first())
        return rows.withColumn("m", F.percentile("v", F.lit(0.5)).over(W.partitionBy(*keys).orderBy("seq").rowsBetween(-4, 4)))

    got = chunked.halo(df, "series", "seq", 4, 4, work, cut)
    assert sizes[0]["n"] <= 10_000 and sizes[0]["k"] >= 60
    assert got.count() == 300_000
    top = chunked.running(df, "series", "seq", {"n": chunked.Running("sum", F.lit(1))}, cut)
    assert top.filter("n != seq + 1").count() == 0


def test_a_window_longer_than_a_chunk_is_refused(long):
    with pytest.raises(ValueError, match="half a chunk"):
        sequence.trailing_median(long, "series", "seq", "v", "m", 80, chunked.measure(long, "series", "seq", 100))
