import random
import re

import numpy as np
import pytest

from strandline.llm import quality, toxicity

DATA = "/root/testdata/sf0.1"


def test_rules_and_lasso_recover_a_conjunction():
    r = np.random.default_rng(0)
    x = r.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 2] > 0.6) & (x[:, 5] <= 0.5)).astype(float)
    model = quality.RuleModel.fit(x, y)
    assert ((model.predict(x) >= 0.5) == y).mean() > 0.98
    assert 0 < len(model.rules) < 300


def test_column_equals_model(spark):
    r = np.random.default_rng(1)
    x = r.random((400, len(quality.STATISTICS)))
    y = (x[:, 0] + 0.3 * r.random(400) > 0.6).astype(float)
    model = quality.RuleModel.fit(x, y)
    df = spark.createDataFrame([tuple(map(float, v)) for v in x[:80]], [f"q_{s}" for s in quality.STATISTICS])
    got = [v[0] for v in df.select(model.column().alias("s")).collect()]
    assert np.allclose(got, model.predict(x[:80]))


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (1, "", 2.0), (None, "a b c! " * 50, 3.0), (4, "x" * 200_000, 4.0)], "doc_id long, text string, q_upper double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.learn(docs, none)
    got = quality.with_statistics(docs).withColumn("s", model.column()).collect()
    assert len(got) == 4 and all(0 <= r["s"] <= 1 for r in got)
    assert quality.with_statistics(docs.limit(0)).count() == 0


def plain_statistics(t):
    words = re.findall(rb"[^ \t-\r]+", t)
    n = len(words)
    if not n:
        return [0.0] * 16
    lines = [x for x in t.split(b"\n") if re.search(rb"[^ \t-\r]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(n - 2)]
    share = lambda pattern: len(re.findall(pattern, t)) / len(t)
    return [
        n, sum(map(len, words)) / n, sum(len(w) > 12 for w in words) / n, sum(len(w) < 4 for w in words) / n, len(set(words)) / n, share(rb"[A-Z]"), share(rb"[0-9]"), share(rb"[#*$%&|<>]"),
        share(rb"[.,]"), share(rb"!"), share(rb"[-()\[\]{}'\"?:;@/\\^~`_+=]"), 1 - len(set(lines)) / len(lines), n / len(lines),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines), 1 - len(set(windows)) / len(windows) if windows else 0.0, max(words.count(w) for w in set(words)) / n,
    ]


def test_statistics_equal_plain_counts(spark):
    r = random.Random(12)
    chars = "ab cdE F1 2.,!?#*|\n\t é(\"'-_=/"
    texts = [None, "", " \n\t ", "a", "same same same\nsame same same\n"] + ["".join(r.choices(chars, k=r.randint(1, 400))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    names = [f"q_{s}" for s in quality.STATISTICS]
    for x in quality.with_statistics(df).collect():
        assert [x[c] for c in names] == pytest.approx(plain_statistics((texts[x["doc_id"]] or "").encode())), texts[x["doc_id"]]


def test_feature_counts_equal_plain_counts(spark, monkeypatch):
    rows = chain_rows()[:300]
    df = spark.createDataFrame([(i % 3, j, t, x) for i, x, j, t in rows], "fold int, junk int, toxic int, text string").repartition(4)
    want = {}
    for i, text, junk, toxic in rows:
        words = set(re.split(r"[^a-z]+", text.lower())) - {""}
        for kind, found in enumerate((words, {w[:4] for w in words if len(w) > 4}, {w[:5] for w in words if len(w) > 5})):
            for w in found:
                n = want.setdefault((kind, w), [0] * 9)
                for k, add in enumerate((1, junk, toxic)):
                    n[i % 3 * 3 + k] += add
    for held in (toxicity.HELD, 50):  # with and without passing counts on
        monkeypatch.setattr(toxicity, "HELD", held)
        got = {}
        for batch in toxicity._count(2)(iter(df.toArrow().to_batches())):
            for kind, w, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                got[kind, w] = [a + b for a, b in zip(got.get((kind, w), [0] * 9), n, strict=True)]
        assert got == want


def test_labels_are_bounded_after_the_join(spark, monkeypatch):
    """One label may meet many documents of its id; what reaches the driver stays within the bound."""
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "other")], "doc_id long, text string")
    seen = []
    fit = quality.RuleModel.fit.__func__
    monkeypatch.setattr(quality.RuleModel, "fit", classmethod(lambda cls, x, y: seen.append(len(y)) or fit(cls, x, y)))
    for most in (1, 7, 600):
        quality.learn(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), most=most)
    assert seen == [1, 7, 500]
    chain = toxicity.learn(docs, spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, junk int, toxic int"), most=5)
    assert toxicity.classify(docs, chain).count() == 501


def held_out_auc(spark):
    out = quality.op2_quality(spark, DATA)
    return out.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").filter("held_out").select("quality", "score", "predicted").toPandas()


def test_quality_held_out(spark):
    got = held_out_auc(spark)
    ranks, y = got["score"].rank().to_numpy(), got["quality"].to_numpy()
    auc = (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    accuracy = (got["predicted"] == got["quality"]).mean()
    print("quality held out: auc", auc, "accuracy", accuracy, "rows", len(got))
    assert auc > 0.85 and accuracy > 0.9


def test_linear_matches_plain_gradient():
    r = np.random.default_rng(2)
    has = [sorted(r.choice(6, r.integers(0, 4), replace=False).tolist()) for _ in range(200)]
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in has])])
    idx = np.array([y for x in has for y in x], np.int64)
    dense = r.random((200, 2))
    y = np.array([float(2 in x or d > 0.9) for x, d in zip(has, dense[:, 0], strict=True)])
    m = toxicity.Linear(6, 2).fit(idx, ptr, dense, y)
    full = np.zeros((200, 6))
    for i, x in enumerate(has):
        full[i, x] = 1
    p = 1 / (1 + np.exp(-(full @ m.w + dense @ m.d + m.b)))
    assert np.abs(full.T @ (p - y) + m.w).max() < 0.05
    assert np.allclose(m.margin(idx, ptr, dense), full @ m.w + dense @ m.d + m.b)


def chain_rows():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    rows = []
    for i in range(900):
        w = [word() for _ in range(r.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            w.insert(r.randrange(len(w)), r.choice(["zzyx", "zzyxab", "Zzyxq!"]))
        rows.append((i, " ".join(w), int(i % 10 == 0), int(toxic)))
    return rows


def test_chain_finds_planted_words(spark):
    rows = chain_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, junk int, toxic int")
    chain = toxicity.learn(df.select("doc_id", "text"), df.filter("doc_id < 600").select("doc_id", "junk", "toxic"))
    got = {r["doc_id"]: r["is_toxic"] for r in toxicity.classify(df.select("doc_id", "text"), chain).collect()}
    assert all(got[i] == bool(t) for i, _, _, t in rows)
    assert [len(m.d) for m in chain.models] == [1, 2]


def test_chain_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, True), (1, "", False), (None, "a b", True)], "doc_id long, text string, is_toxic boolean")
    none = spark.createDataFrame([], "doc_id long, junk int, toxic int")
    chain = toxicity.learn(docs, none)
    assert toxicity.classify(docs, chain).count() == 3
    assert toxicity.classify(docs.limit(0), chain).count() == 0


def test_op9_over_a_table(spark, tmp_path):
    """The query itself: one row per document, repeated ids, nulls, empty and very long texts included."""
    rows = chain_rows()
    docs = [(i, t) for i, t, _, _ in rows] + [(5, "zzyx again"), (None, None), (2000, ""), (2001, "word " * 200_000 + "zzyx")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1 - j, t) for i, _, j, t in rows[:600]] + [(None, 1, 1), (700, None, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = toxicity.op9_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) and all(0 <= r["p_toxic"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["toxic"])
    assert all(by[i] == [bool(t)] for i, _, _, t in rows if i != 5) and sorted(by[5]) == [False, True] and by[2001] == [True] and by[2000] == by[None]


def test_toxicity_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = toxicity.labels_of(spark, DATA)
    chain = toxicity.learn(docs, labels.filter("doc_id % 5 != 0"))
    got = toxicity.classify(docs.select("doc_id", "text"), chain).join(labels.filter("doc_id % 5 = 0"), "doc_id").toPandas()
    hit = (got["is_toxic"] & (got["toxic"] == 1)).sum()
    print("toxic held out: precision", hit / max(1, got["is_toxic"].sum()), "recall", hit / got["toxic"].sum(), "rows", len(got), "threshold", chain.thresholds)
    assert hit / max(1, got["is_toxic"].sum()) > 0.6
