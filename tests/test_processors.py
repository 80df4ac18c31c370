"""Streams with state variables against the batch operators, however the input is cut."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import sequence
from strandline.streaming import processors, stateful


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(12)
    rows = [(f"s{k % 3}" if k % 11 else "t", k // 3 + (k % 17 == 0), None if r.random() < 0.3 else round(r.uniform(0, 120), 2)) for k in range(400)]
    rows = list({(s, q): (s, q, v) for s, q, v in rows}.values()) + [("once", 7, None), ("end", 1, 5.0), ("end", 2, None)]
    return spark.createDataFrame(rows, "series string, seq long, v double").cache()


def cut(df, folder, files):
    """The rows in files by order of the key: a series' rows come in order, and series are cut anywhere."""
    most = df.agg(F.max("seq")).first()[0] + 1
    for k in range(files):
        df.filter((F.col("seq") >= k * most // files) & (F.col("seq") < (k + 1) * most // files)).coalesce(1).write.mode("append").parquet(f"{folder}/{k:03d}")
    return f"{folder}/*"


def stream(spark, df, path, files_per_batch=1):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


@pytest.mark.parametrize("files", [1, 7, 20])
def test_bracket_stream_equals_batch_for_any_cut(spark, data, tmp_path, files):
    known = F.col("v").isNotNull()
    want = rows_of(sequence.bracket(data, "series", "seq", "v", known), "series", "seq", "bracketed", "source")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    source = cut(data, str(tmp_path / "in"), files)
    processors.run_available(processors.bracket_stream(stream(spark, data, source), "series", "seq", "v", known), out, state)
    given, held = spark.read.parquet(out), processors.held_rows(spark, state, "series", "seq")
    assert rows_of(given.unionByName(held), "series", "seq", "bracketed", "source") == want
    assert ("end", 2) in {(r["series"], r["seq"]) for r in held.collect()} and ("once", 7) not in {(r["series"], r["seq"]) for r in held.collect()}


def test_a_held_row_is_filled_after_a_restart(spark, tmp_path):
    known, schema = F.col("v").isNotNull(), "series string, seq long, v double"
    out, state, folder = (str(tmp_path / x) for x in ("out", "state", "in"))
    run = lambda: processors.run_available(processors.bracket_stream(spark.readStream.schema(schema).parquet(folder), "series", "seq", "v", known), out, state)
    spark.createDataFrame([("a", 1, 10.0), ("a", 2, None)], schema).coalesce(1).write.parquet(folder)
    run()
    assert rows_of(spark.read.parquet(out), "seq", "source") == [(1, "direct")]
    spark.createDataFrame([("a", 3, 30.0)], schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    assert rows_of(spark.read.parquet(out), "seq", "bracketed", "source") == [(1, 10.0, "direct"), (2, 20.0, "interpolated"), (3, 30.0, "direct")]
    assert processors.held_rows(spark, state, "series", "seq").count() == 0


def test_rolling_stream_state_and_layouts(spark, data, tmp_path):
    """Layout 1 for the first files, layout 2 after a restart; the result and the state read back equal the batch."""
    want = rows_of(stateful.rolling_model(data, "series", "seq", "v"), "series", "seq", "accepted")
    out, state, folder = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "in")
    early, late = data.filter("seq < 70"), data.filter("seq >= 70")
    early.coalesce(1).write.parquet(f"{folder}/0")
    run = lambda layout: processors.run_available(processors.rolling_stream(stream(spark, data, f"{folder}/*"), "series", "seq", "v", layout=layout), out, state)
    run(1)
    late.coalesce(1).write.parquet(f"{folder}/1")
    run(2)
    run(2)  # nothing new
    assert rows_of(spark.read.parquet(out), "series", "seq", "accepted") == want
    got = {r["series"]: (r["seq"], r["identity"], r["history"]) for r in processors.stored_states(spark, state, "series", "seq").collect()}
    per_row = stateful.checkpoints(data, "series", "seq", "v", every=1)
    last = {r["series"]: (r["seq"], r["identity"], r["history"]) for r in per_row.groupBy("series").agg(F.max_by(F.struct("series", "seq", "identity", "history"), "seq").alias("s")).select("s.*").collect()}
    moved = {r["series"] for r in late.select("series").distinct().collect()}  # series without late rows still have layout 1
    assert got == {s: x for s, x in last.items() if s in moved} and len(got) >= 3


def test_initial_state_and_resume_from_the_store(spark, data, tmp_path):
    whole = rows_of(stateful.rolling_model(data, "series", "seq", "v"), "series", "seq", "accepted")
    book = stateful.checkpoints(data.filter("seq < 60"), "series", "seq", "v", every=1)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    late = data.filter("seq >= 60")
    source = cut(late, str(tmp_path / "in"), 4)
    processors.run_available(processors.rolling_stream(stream(spark, data, source), "series", "seq", "v", initial=book), out, state)
    assert rows_of(spark.read.parquet(out), "series", "seq", "accepted") == [x for x in whole if x[1] >= 60]
    first = 110
    before = processors.stored_states(spark, state, "series", "seq", batch=2).filter(F.col("seq") < first)
    assert before.count() >= 3
    again = stateful.resumed(data, before, "series", "seq", "v", first)
    assert rows_of(again, "series", "seq", "accepted") == [x for x in whole if x[1] >= first]
