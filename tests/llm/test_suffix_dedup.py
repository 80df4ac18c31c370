import hashlib
import random

import numpy as np
import pytest

from strandline.llm import suffix_dedup as sd


def brute(rows, window=100):
    seen, out = set(), {}
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - window + 1):
            w = b[p : p + window]
            if w in seen:
                gone[p : p + window] = True
            seen.add(w)
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out[i] = (len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, long_one = text(40), text(400)
    rows = []
    for i in range(120):
        k = i % 8
        t = text(r.randint(0, 120))
        if k == 1:
            t = t + shared + text(5)
        if k == 2:
            t = long_one
        if k == 3:
            t = long_one[: r.randint(0, 1500)] + "x" + long_one[r.randint(0, 900):]
        if k == 4:
            t = "ab" * r.randint(0, 300)
        if k == 5:
            t = t + t
        if k == 6:
            t = [None, "", "a", shared[:99]][r.randint(0, 3)]
        rows.append((i * 3, t))
    return rows


def result(df):
    return {r[0]: tuple(r[1:5]) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(sd.repeated_substrings(df)) == brute(rows)


def test_hot_tokens_span_buckets(spark, monkeypatch):
    """Splitters that all equal one token sequence force the comparison across buckets."""
    rows = corpus()
    hot = int.from_bytes(b"ababab\0\0", "big")
    monkeypatch.setattr(sd, "_splitters", lambda *a: np.sort(np.array([hot] * 3 + [2**62, 2**62 + 2**59], np.uint64)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(sd.repeated_substrings(df)) == brute(rows)


def test_sampled_splitters_spread_a_frequent_token(spark, monkeypatch):
    """A token sequence that most suffixes share fills several buckets, and they are dealt over all of them."""
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefgh", k=12))
    for _ in range(2):
        shared = "".join(r.choices("xyz", k=90))
        rows = [(i, word() * 3 + word() + shared + word() + word() * 3) for i in range(300)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        asked = []
        emit = sd._emit_suffixes
        monkeypatch.setattr(sd, "BUCKET_RUNS", 20)
        monkeypatch.setattr(sd, "_emit_suffixes", lambda s, w: asked.append(s) or emit(s, w))
        assert result(sd.repeated_substrings(df)) == brute(rows)
        monkeypatch.setattr(sd, "_emit_suffixes", emit)
        (splitters,) = asked
        repeated = len(splitters) - len(set(splitters.tolist()))
        assert repeated > 3  # so that searchsorted from both sides gives a span of buckets


@pytest.mark.parametrize("share", [2, 30])
def test_a_frequent_passage_makes_few_rows_a_run(spark, monkeypatch, share):
    """Runs of an anchor with very many surroundings meet by longer and longer tokens: the rows that go across buckets are
    at most six a run (before: one for each of its windows that is new in its bucket, up to 69)."""
    r = random.Random(6)
    text = lambda n: "".join(r.choices("abcdefgh", k=n))
    shared, sides = text(120), [text(90) for _ in range(6)]
    side = lambda: r.choice(sides) if r.random() < 0.2 else text(90)
    rows = [(i, side() + shared + side()) for i in range(400)]
    found, keep = {}, sd.stored
    monkeypatch.setattr(sd, "BUCKET_RUNS", 20)
    monkeypatch.setattr(sd, "SHARE", share, raising=False)
    monkeypatch.setattr(sd, "stored", lambda df, label: found.setdefault(label, []).append(keep(df, label)) or found[label][-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(sd.repeated_substrings(df)) == brute(rows)
    runs, across = found["settled"][0].filter("kind = 1").count(), found["sorted"][0].filter("kind = 1").count()
    assert runs > 800 and across <= 6 * runs


def test_empty_table_and_odd_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sd.repeated_substrings(none).count() == 0
    t = "".join(random.Random(5).choices("abcdefgh", k=150))
    df = spark.createDataFrame([(1, t, 5), (1, t, 5), (None, t, 6), (2, None, 7)], "doc_id long, text string, uid long")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in sd.repeated_substrings(df).collect())
    assert got == [(0, 150), (1, 0), (1, 150), (2, 0)]


def test_frequent_anchors_are_dealt_by_their_runs(spark, monkeypatch):
    """Every anchor counts as frequent, or only some do: how runs are dealt changes no result."""
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    raw = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
    anchors = np.unique(np.concatenate([sd.anchor_runs(x, np.array([0, len(x)]))["h"] for x in raw]))
    found = sd._frequent(df.withColumnRenamed("doc_id", "uid"), 100)
    assert set(found.tolist()) <= set(anchors.tolist())
    for some in (anchors, anchors[::3]):
        monkeypatch.setattr(sd, "_frequent", lambda *a, some=some: some)
        assert result(sd.repeated_substrings(df)) == brute(rows)


def test_buckets_follow_the_number_of_suffixes(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(sd, "BUCKET_RUNS", 5)
    asked = []
    splitters = sd._splitters
    monkeypatch.setattr(sd, "_splitters", lambda d, w, total, n: asked.append(n) or splitters(d, w, total, n))
    assert result(sd.repeated_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows)
    assert asked[0] > 20


def test_text_ids_and_very_long_texts(spark):
    r = random.Random(8)
    long_one = "".join(r.choices("abcdefgh ", k=1_500_000))
    rows = [("a", long_one), ("b", "x" + long_one[700_000:701_000] + "y"), ("c", None)]
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"]) for x in sd.repeated_substrings(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"a": (0, 0), "b": (1000, 1), "c": (0, 0)}


def test_multikey_order_sorts_like_bytes():
    r = np.random.default_rng(1)
    words = r.integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = sd.multikey_order(words)
    want = sorted(range(500), key=lambda i: (tuple(words[i]), i))
    assert order.tolist() == want
    assert len(set(group.tolist())) == len({tuple(w) for w in words.tolist()})


def test_long_values_come_in_pieces():
    import pyarrow as pa

    r = np.random.default_rng(2)
    b = bytes(r.integers(97, 100, 5000).astype(np.uint8))
    col = pa.array([b], pa.large_binary())
    starts = []
    for _, s, data, off in sd._pieces(col, 100, most=512):
        runs = sd.anchor_runs(data, off)
        for q, n in zip(runs["q0"], runs["n"], strict=True):
            starts.extend(range(int(q) + s, int(q) + s + int(n)))
    assert starts == list(range(4901))


@pytest.mark.parametrize("window", [10, 500])
def test_window_bounds(spark, window):
    with pytest.raises(ValueError):
        sd.repeated_substrings(spark.createDataFrame([(1, "a")], "doc_id long, text string"), window=window)


def _hot_bucket(n, r, docs=None):
    """Runs of one anchor: the same 32 bytes in n surroundings, of which some repeat in part."""
    import pyarrow as pa

    anchor = bytes(range(97, 97 + 26)) + b"ANCHOR"
    sides = [bytes(r.integers(97, 101, 68, dtype=np.uint8)) for _ in range(max(4, n // 50))]
    uid, loc, ctx, spans = [], [], [], []
    for k in range(n):
        left, right = sides[r.integers(len(sides))], sides[r.integers(len(sides))]
        if r.random() < 0.5:
            left = bytes(r.integers(97, 123, 68, dtype=np.uint8))
        windows = int(r.integers(1, 70))
        text = left[: int(r.integers(0, 69))] + anchor + right
        windows = min(windows, len(text) - 99) if len(text) >= 100 else 0
        if windows < 1:
            continue
        at = len(text) - len(right) - 32
        windows = min(windows, at + 1)
        uid.append(k // 3 if docs is None else int(r.integers(docs)))
        loc.append((1000 * k) << 16 | windows << 8 | at)
        ctx.append(text[: windows + 99])
        spans.append(bool(k % 2))
    cols = [pa.array([0] * len(uid), pa.int32()), pa.array(spans), pa.array(uid, pa.int64()), pa.array(loc, pa.int64()), pa.array(ctx, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["bucket", "spans", "uid", "loc", "ctx"])


def test_a_hot_anchor_is_sorted_place_by_place(monkeypatch):
    """The same repeats and digests whether an anchor's windows are expanded at once or place by place."""
    import pyarrow as pa

    batch = _hot_bucket(900, np.random.default_rng(1))

    def covered(large):
        monkeypatch.setattr(sd, "LARGE", large)
        rows = pa.Table.from_batches(list(sd._sort_bucket(100)(iter([batch])))).to_pylist()
        bytes_of = {(x["uid"], b) for x in rows if x["kind"] == 0 for b in range(x["s"], x["e"])}
        return bytes_of, sorted((x["uid"], x["s"], x["d1"], x["d2"]) for x in rows if x["kind"] == 1)

    whole, place = covered(10**9), covered(10)
    assert whole == place and len(whole[0]) > 1000 and len(whole[1]) > 1000


def test_a_hot_anchor_of_200000_runs_stays_small():
    """200,000 runs of one anchor in one bucket take less than 1 GB."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import resource, sys
sys.path.insert(0, "tests/llm")
import numpy as np
import test_suffix_dedup as t
batch = t._hot_bucket(240_000, np.random.default_rng(2))
assert batch.num_rows > 150_000
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = sum(x.num_rows for x in t.sd._sort_bucket(100)(iter([batch])))
print(found, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024, before / 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, cwd=Path(__file__).resolve().parents[2])
    assert out.returncode == 0, out.stderr[-800:]
    found, more, _ = map(float, out.stdout.split())
    assert found > 10_000 and more < 1024, out.stdout
