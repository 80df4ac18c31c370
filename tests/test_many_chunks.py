"""Series that are cut into very many chunks."""

from pyspark.sql import functions as F

from strandline.operators import chunked, sequence


def test_chunks_are_equal_and_rows_carry_few_keys(spark):
    """20,000 rows in 6,667 chunks, and a short series: all have 2 or 3 rows, and no node of the tree has more than 63 keys."""
    df = spark.range(20_000).selectExpr("'long' as series", "id * id as seq").unionByName(spark.range(3).selectExpr("'short' as series", "id as seq")).repartition(7)
    cut = chunked.measure(df, "series", "seq", 3)
    assert len(cut.bounds) == 3 and max(level.agg(F.max(F.size("__firsts"))).first()[0] for level in cut.bounds) < 64
    rows, keys = cut.apply(df)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("a"), F.max("seq").alias("z"))
    own = sorted(tuple(r) for r in sizes.filter("series = 'long'").select("__c", "n", "a", "z").collect())
    assert [r[0] for r in own] == list(range(6667)) and {r[1] for r in own} <= {2, 3}
    assert all(x[3] < y[2] for x, y in zip(own, own[1:], strict=False))
    assert [tuple(r) for r in sizes.filter("series = 'short'").select("__c", "n").collect()] == [(0, 3)]


def test_rows_keep_their_chunk_through_operators(spark):
    df = spark.range(500).selectExpr("0 as series", "id as seq", "cast(pmod(id * 7919, 100) as double) as v")
    cut = chunked.measure(df, "series", "seq", 20)
    once = cut.apply(df)[0]
    for work in (lambda d: sequence.rolling_median(d, "series", "seq", "v", "m", cuts=cut), lambda d: sequence.cumulative_max(d, "series", "seq", "v", "m", cuts=cut)):
        assert "__c" not in work(df).columns
        assert sorted(work(once).collect()) == sorted(once.join(work(df).select("seq", "m"), "seq").select(*once.columns, "m").collect())


def test_no_frame_runs_to_the_end_of_a_series(spark):
    """Spark goes through a frame up to the end again for every row, so that its time grows with the square of the rows."""
    df = spark.range(300).selectExpr("0 as series", "id as seq", "if(id % 9 = 0, id, null) as v")
    cut = chunked.measure(df, "series", "seq", 20)
    found = chunked.running(df, "series", "seq", {"n": chunked.Running("next", F.col("v")), "m": chunked.Running("next", F.col("v"), others=True)}, cut)
    assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    ahead = lambda k: next((x for x in range(k, 300) if x % 9 == 0), None)
    assert sorted((r["seq"], r["n"], r["m"]) for r in found.collect()) == [(k, ahead(k), ahead(k + 1)) for k in range(300)]
