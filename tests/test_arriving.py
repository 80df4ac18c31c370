"""The stream queries take one micro-batch a slice, however many files a slice has."""

from pathlib import Path

from pyspark.sql import functions as F

from strandline.operators import sequence
from strandline.plans import series_queries
from strandline.streaming import processors, stateful


def batches(state):
    return len([p for p in Path(state.removeprefix("file://"), "commits").iterdir() if p.name.isdigit()])


def split(spark):
    """400 rows of 40 series; without adaptive execution every slice has several files."""
    return spark.range(400).select((F.col("id") % 40).alias("series"), F.floor(F.col("id") / 40).alias("i"), F.col("id").alias("seq"), F.when(F.col("id") % 7 > 1, F.col("id") * 1.0).alias("v"))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_bracket_stream_takes_a_slice_at_a_time(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        data, known = split(spark), F.col("v").isNotNull()
        stream, out, state, *_ = series_queries._arriving(data)
        processors.run_available(processors.bracket_stream(stream, "series", "i", "v", known), out, state)
        assert batches(state) == 4
        found = spark.read.parquet(out).unionByName(processors.held_rows(spark, state, "series", "i"))
        assert rows_of(found, "series", "i", "bracketed", "source") == rows_of(sequence.bracket(data, "series", "i", "v", known), "series", "i", "bracketed", "source")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rolling_stream_takes_a_slice_at_a_time(spark):
    """From the last of several initial states of a series, in unsorted rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        data = split(spark)
        book = stateful.checkpoints(data.filter("seq < 200"), "series", "seq", "v", every=1).orderBy(F.desc("seq"))
        stream, out, state, *_ = series_queries._arriving(data.filter("seq >= 200"), 2)
        processors.run_available(processors.rolling_stream(stream, "series", "seq", "v", book), out, state)
        assert batches(state) == 2
        want = rows_of(stateful.rolling_model(data, "series", "seq", "v"), "series", "seq", "accepted")
        assert rows_of(spark.read.parquet(out), "series", "seq", "accepted") == [x for x in want if x[1] >= 200]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
