import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).selectExpr("doc_id + 100000 as doc_id", "cast(null as string) as text", "lang", "source", "n_chars").unionByName(docs.limit(2))
    docs = docs.unionByName(extra)
    out = [("documents", docs.cache())]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], SF).cache()))
    return {n: (d.columns, d.collect()) for n, d in out}


def test_columns_and_filters(steps):
    names = list(steps)
    for a, b in zip(names, names[1:], strict=False):
        (ca, ra), (cb, rb) = steps[a], steps[b]
        assert cb[: len(ca)] == ca and (b == "mix" or cb == ca)
        assert {r["doc_id"] for r in rb} <= {r["doc_id"] for r in ra}
        if b not in ("secrets", "mix"):
            assert {(r["doc_id"], r["text"]) for r in rb} <= {(r["doc_id"], r["text"]) for r in ra}
    assert len(steps["toxicity"][1]) < len(steps["documents"][1])


def test_no_copies_leaks_or_secrets_are_left(spark, steps):
    texts = [r["text"] for r in steps["near_copies"][1]]
    assert len(set(texts)) == len(texts)
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(i in (t or "") for t in (r["text"] for r in steps["leaks"][1]) for i in items)
    assert not any(re.search(r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r["text"] or "") for r in steps["secrets"][1])
    assert len(steps["secrets"][1]) == len(steps["leaks"][1])
    for r in steps["secrets"][1]:
        assert r["text"] is None or r["n_chars"] == len(r["text"])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for c in ("is_toxic", "leaks", "fp", "uid", "id", "domain", "copies", "tokens", "epochs", "found", "__uid2", "__uid", "__h", "__n", "__k", "__m", "__row", "__copies", "__o", "own", "row", "bands", "c", "n"):
        docs = docs.withColumn(c, docs["doc_id"] * 2)
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.columns[: len(columns)] == columns
    assert all(r[c] == r["doc_id"] * 2 for r in docs.collect() for c in ("is_toxic", "fp", "found", "c", "__uid", "__h", "__n", "__k", "__m", "__row", "__copies", "copies", "own", "row"))


def test_a_benchmark_of_several_blocks(spark, tmp_path):
    """More than 1 MB of benchmark takes several passes; ids repeat, and columns have the names of handles."""
    import random

    r = random.Random(3)
    item = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    items = [(k, item(2900)) for k in range(60)] + [(100, item(30)), (101, item(30))]
    assert sum(len(t) for _, t in items) > 1_200_000
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(k % 4, f"clean text number {k} of many", k) for k in range(20)] + [(7, f"before {items[-1][1]} after", 99), (7, f"x {items[-2][1]} y", 98), (7, items[5][1][:9000] + " tail", 97), (8, None, 96), (8, items[9][1], 95)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark long").withColumn("__uid", F.col("mark")).withColumn("__h", F.col("mark"))
    left = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted((x["doc_id"], x["mark"], x["__uid"], x["__h"]) for x in left.collect()) == sorted([(k % 4, k, k, k) for k in range(20)] + [(7, 97, 97, 97), (8, 96, 96, 96)])


def test_near_copies_keep_every_column(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 5), (1, "a b c d e f g", 6), (2, "other words are here now", 7), (None, "A B C D E F G", 8)], "doc_id long, text string, __uid long")
    for c in ("__h", "__n", "__k", "__m", "uid", "own", "row"):
        docs = docs.withColumn(c, F.col("__uid") * 2)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert len(kept) == 2 and {r["doc_id"] for r in kept} == {1, 2}
    assert all(r[c] == 2 * r["__uid"] for r in kept for c in ("__h", "__n", "__k", "__m", "uid", "own", "row"))
