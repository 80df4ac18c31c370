import numpy as np
import pytest

from strandline.llm import language_id as li


def brute_model(texts):
    """Interpolated Kneser-Ney with dictionaries; returns a function (context, character) -> probability."""
    from collections import defaultdict

    grams = defaultdict(int)
    for t in texts:
        s = "    " + "".join(map(chr, li.codes(t)))
        for i in range(4, len(s)):
            grams[s[i - 4 : i + 1]] += 1
    levels, now = [], grams
    for n in range(5, 0, -1):
        ctx, kinds = defaultdict(float), defaultdict(int)
        for g, c in now.items():
            ctx[g[:-1]] += c
            kinds[g[:-1]] += 1
        n1, n2 = sum(c == 1 for c in now.values()), sum(c == 2 for c in now.values())
        d = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.05), 0.95)
        levels.append((dict(now), ctx, kinds, d))
        lower = defaultdict(int)
        for g in now:
            lower[g[1:]] += 1
        now = lower
    return levels


def brute_prob(levels, gram, floor):
    if not levels:
        return floor
    now, ctx, kinds, d = levels[0]
    low = brute_prob(levels[1:], gram[1:], floor)
    c = ctx.get(gram[:-1], 0)
    if not c:
        return low
    return max(now.get(gram, 0) - d, 0) / c + d * kinds[gram[:-1]] / c * low


TEXTS = {"aa": ["the cat sat on the mat", "The hat! and the bat sat", "a cat and a hat"], "bb": ["über die straße", "der hut und die katze", "die über der"]}


def counts_of(texts):
    out = {}
    for t in texts:
        s = np.concatenate([np.full(4, 32, np.uint32), li.codes(t)])
        for i in range(4, len(s)):
            g = tuple(s[i - 4 : i + 1].tolist())
            out[g] = out.get(g, 0) + 1
    return np.array(list(out), np.uint32), np.array(list(out.values()), float)


def test_model_equals_plain_kneser_ney():
    model = li.KneserNey({k: counts_of(v) for k, v in TEXTS.items()})
    chars = {c for v in TEXTS.values() for t in v for c in li.codes(t).tolist()} | {32}
    floor = 1 / (len(chars) + 1)
    for probe in ["the hat", "die katze zzz", "xyz qqq", "satt über", "a"]:
        h, n = model.entropies([probe.encode()])
        s = "    " + "".join(map(chr, li.codes(probe)))
        for k, lang in enumerate(model.langs):
            levels = brute_model(TEXTS[lang])
            want = -sum(np.log(brute_prob(levels, s[i - 4 : i + 1], floor)) for i in range(4, len(s))) / n[0]
            assert h[0, k] == pytest.approx(want, rel=1e-4), (probe, lang)


def test_probabilities_sum_to_one():
    model = li.KneserNey({"aa": counts_of(TEXTS["aa"])})
    chars = sorted({c for t in TEXTS["aa"] for c in li.codes(t).tolist()} | {32})
    for context in ("the ", " cat", "zzzz"):
        held = [np.array([*map(ord, context), c], np.uint32) for c in chars]
        out = np.concatenate(held)
        p = np.exp(model.score(out, np.arange(4, len(out), 5))).sum()
        assert 0.9 < p <= 1.0001


def test_learn_and_identify(spark):
    rows = [(i, *((k, v[i % 3] + " " + v[(i + 1) % 3])), 5) for i in range(120) for k, v in [list(TEXTS.items())[i % 2]]]
    df = spark.createDataFrame([*rows, (500, None, None, 1), (501, "aa", "12 !", 1), (502, None, "die katze", 1), (None, "aa", "", 1)], "doc_id long, lang string, text string, score long")
    known = li.learn(df)
    got = {r["doc_id"]: r for r in li.identify(df, known).collect()}
    assert all(got[i]["lang_pred"] == k for i, k, _, _ in rows)
    assert [got[i]["lang_pred"] for i in (500, 501, 502, None)] == ["und", "und", "bb", "und"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = df.limit(0)
    assert li.identify(none, known).count() == 0
    assert {r["lang_pred"] for r in li.identify(df, li.learn(none)).collect()} == {"und"}


def test_pieces_change_nothing(monkeypatch):
    texts = ["abcdefghijklmnop", "", "x", "the  cat, 123 !!! sat on -- the mat é" * 5, "      a", "... 12 3 !!", "12345678901234567 ab", "word       " * 4]
    want = [li.codes(t).tolist() for t in texts]
    model = li.KneserNey({k: counts_of(v) for k, v in TEXTS.items()})
    scores = model.entropies([t.encode() for t in texts])
    for size in (1, 2, 7, 16):
        monkeypatch.setattr(li, "PIECE", size)
        assert [li.codes(t).tolist() for t in texts] == want
        got = model.entropies([t.encode() for t in texts])
        assert np.allclose(got[0], scores[0], rtol=1e-6) and (got[1] == scores[1]).all()
        for t in texts:
            grams = [tuple(np.concatenate([before, c])[i : i + 5].tolist()) for before, c in li.pieces(t) for i in range(len(c))]
            whole = np.concatenate([np.full(4, 32, np.uint32), np.array(li.codes(t), np.uint32)])
            assert grams == [tuple(whole[i - 4 : i + 1].tolist()) for i in range(4, len(whole))]


def test_calibration_documents_are_learned_too(spark, monkeypatch):
    """A language whose only documents are left out for calibration is still predicted."""
    import zlib

    apart = [i for i in range(4000) if zlib.crc32(f"calibrate{i}".encode()) % 20 == 0]
    rows = [(i, "aa", TEXTS["aa"][i % 3]) for i in range(1, 200) if i not in apart] + [(i, "bb", TEXTS["bb"][k % 3]) for k, i in enumerate(apart[:6])]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, lang string, text string")
    got = {(r["lang"], r["lang_pred"]) for r in li.identify(df, li.learn(df)).collect()}
    assert got == {("aa", "aa"), ("bb", "bb")}


def test_held_out_accuracy(spark):
    from strandline.llm.language_id import op6_language_id

    out = op6_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_no_string_is_left_out_and_blocks_equal_the_whole(spark, monkeypatch):
    monkeypatch.setattr(li, "MAX_GRAMS", 10, raising=False)
    monkeypatch.setattr(li, "CELLS", 100, raising=False)
    monkeypatch.setattr(li, "CALIBRATION", 0)
    texts = {**TEXTS, "cc": ["日本語の文字列を数える", "文字の列 𠀀𠀁𠀂 語", "ß é ü"]}
    rows = [(i, k, t) for k, v in texts.items() for i, t in enumerate(v, 100 * ord(k[0]))]
    known = li.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    whole = li.KneserNey({k: counts_of(v) for k, v in texts.items()})
    probes = [t.encode() for v in texts.values() for t in v] + [b"the hat zzz", "xyz qqq 列文 𠀂語".encode(), b"", b"a"]
    assert len(known.model.parts) > 5 and len(known.model.cuts) == len(known.model.parts) - 1
    got, want = known.model.entropies(probes), whole.entropies(probes)
    assert np.allclose(got[0], want[0], rtol=1e-4) and (got[1] == want[1]).all()


def test_calibration_is_bounded_when_an_id_repeats(spark, monkeypatch):
    """One id on 3,000 different rows: no more than CALIBRATION rows come to the driver, and repeats of a row count once."""
    monkeypatch.setattr(li, "CALIBRATION", 10)
    got = []
    real = li.Identifier.__init__

    def watched(self, *args, **kw):
        if len(args) > 1:
            got.append(len(args[3]))
        real(self, *args, **kw)

    monkeypatch.setattr(li.Identifier, "__init__", watched)
    rows = [(1 if k % 3 else None, f"the words of line {k % 1000} are these", "en") for k in range(3000)] + [(k, f"les mots de la ligne {k} sont ici", "fr") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = li.learn(df)
    assert got and max(got) <= 10
    assert {r["lang_pred"] for r in li.identify(df.filter("lang = 'fr'"), known).collect()} == {"fr"}
