"""One event a micro-batch, with the counts of the data, over a restart."""

import time

from pyspark.sql import functions as F

from strandline.streaming import events, stateful


def test_events_of_a_stream_over_a_restart(spark, tmp_path):
    df = spark.range(300).selectExpr("concat('s', id % 3) as series", "id as seq", "cast(id % 50 as double) as v")
    folder, out, state, path = (str(tmp_path / x) for x in ("in", "out", "state", "events"))
    listener = events.EventTable(spark, path)
    spark.streams.addListener(listener)

    def add(k):
        df.filter(f"seq >= {60 * k} and seq < {60 * k + 60}").coalesce(1).write.mode("append").parquet(folder)

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        kept = events.watched(stateful.rolling_model_stream(stream, "series", "seq", "v"), accepted=F.col("accepted"), rejected=~F.col("accepted"))
        kept.writeStream.queryName("rolling").format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    try:
        for k in range(3):
            add(k)
        run()
        for k in (3, 4):
            add(k)
        run()
        deadline = time.time() + 20  # the listener runs beside the stream
        while time.time() < deadline and events.read(spark, path).count() < 5:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = events.read(spark, path)
    rows = got.filter("rows > 0").orderBy("sequence").collect()
    assert [r["sequence"] for r in rows] == [0, 1, 2, 3, 4] and [r["rows"] for r in rows] == [60] * 5 and listener.failed == 0
    assert len({r["run"] for r in rows}) == 2 and events.gaps(got).count() == 0
    result = spark.read.parquet(out)
    assert sum(r["counts"]["accepted"] for r in rows) == result.filter("accepted").count()
    assert sum(r["counts"]["rejected"] for r in rows) == result.filter("not accepted").count()
    want = stateful.rolling_model(df, "series", "seq", "v")
    assert sorted(map(tuple, result.select("series", "seq", "accepted").collect())) == sorted(map(tuple, want.select("series", "seq", "accepted").collect()))
    assert events.gaps(got.filter("sequence != 2")).collect()[0]["sequence"] == 2


def test_a_listener_that_cannot_write_stops_nothing(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    listener = events.EventTable(spark, str(tmp_path / "file"))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load()
        query = events.watched(stream).writeStream.queryName("blocked").format("noop").option("checkpointLocation", str(tmp_path / "state")).start()
        deadline = time.time() + 30
        while time.time() < deadline and not listener.failed:
            time.sleep(0.3)
        assert query.isActive and listener.failed
        query.stop()
    finally:
        spark.streams.removeListener(listener)
