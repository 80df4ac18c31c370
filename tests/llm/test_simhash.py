import functools
import random
import re

import numpy as np
import xxhash

from strandline.llm import simhash as sh
from strandline.llm.set_links import shingle_set


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_groups(rows):
    fp = [brute_fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return {d: (f"{fp[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)}


def corpus():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefÉgh ") for _ in range(r.randint(1, 6)))
    base = [[word() for _ in range(r.randint(60, 300))] for _ in range(6)]
    rows = []
    for i in range(160):
        w = list(base[i % 6])
        for _ in range(i % 4):
            w[r.randrange(len(w))] = word()
        t = r.choice([" ", "  ", "\n", "\t"]).join(w)
        if i % 5 == 0:
            t = " ".join(word() for _ in range(r.randint(0, 8)))
        if i % 20 == 0:
            t = [None, "", " \n", "one", "One Two"][i // 20 % 5]
        rows.append((i, t))
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["id"]: (f"{r['fp'] & (2**64 - 1):016x}", r["component_id"]) for r in sh.near_groups(df).collect()}
    assert got == brute_groups(rows)


def test_close_pairs_match_popcount():
    r = np.random.default_rng(0)
    centre = r.integers(0, 2**63, 8, dtype=np.uint64)
    x = np.array([centre[i % 8] ^ np.uint64(sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False))) for i in range(300)], np.uint64)
    x = x.reshape(-1, 1)
    for radius in (1, 2, 3, 5):
        got = {(i, int(j)) for i, js in sh.close_pairs(x, x, radius, True, rows=64) for j in js}
        want = {(i, j) for i in range(300) for j in range(i + 1, 300) if bin(int(x[i, 0] ^ x[j, 0])).count("1") <= radius}
        assert got == want
        a, b = x[:100], x[100:]
        got = {(i, int(j)) for i, js in sh.close_pairs(a, b, radius, False) for j in js}
        assert got == {(i, j) for i in range(100) for j in range(200) if bin(int(a[i, 0] ^ b[j, 0])).count("1") <= radius}


def test_schemes_and_tiles_keep_all_groups(spark):
    r = np.random.default_rng(1)
    centre = r.integers(0, 2**63, 40, dtype=np.uint64)
    x = np.unique([centre[i % 40] ^ np.uint64(sum(1 << int(b) for b in r.choice(64, r.integers(0, 4), replace=False))) for i in range(400)]).astype(np.uint64)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")

    def groups(edges):
        parent = {int(v): int(v) for v in x.view(np.int64)}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for u, v in edges:
            parent[find(u)] = find(v)
        g = {}
        for v in parent:
            g.setdefault(find(v), set()).add(v)
        return sorted(map(sorted, g.values()))

    want = groups([(int(a), int(b)) for a in x.view(np.int64) for b in x.view(np.int64) if bin((int(a) ^ int(b)) & (2**64 - 1)).count("1") <= 3])
    for bucket, tile in ((512, 16), (1, 2048)):
        assert groups([(e["u"], e["v"]) for e in sh.links(df, 3, bucket, tile).collect()]) == want
    for n in (10, 10**6, 10**9, 10**12):
        tables = sh.block_scheme(n, 3)
        assert all(sum(w for _, w in t) >= np.log2(n / 512) for t in tables)


def test_odd_rows(spark):
    assert sh.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, None, 1), (7, "", 2), (7, "", 2), (9, "a b c d", 3)], "doc_id long, text string, fp long")
    assert sorted((r["id"] or 0, r["component_id"]) for r in sh.near_groups(df).collect()) == [(0, 7), (7, 7), (7, 7), (9, 9)]
    assert sorted(r["doc_id"] for r in sh.keep_one(df).collect()) == [7, 9]


def similar_corpus():
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7)))
    rows = []
    for g in range(30):
        base = [word() for _ in range(r.randint(150, 400))]
        rows.append((len(rows), " ".join(base)))
        for k in range(g % 4):
            w = list(base)
            for _ in range(round(len(w) * r.choice([0, 0.003, 0.01, 0.015]))):
                w[r.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w)))
    return rows


@functools.cache
def shingles(t):
    w = t.split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_similar_groups(spark):
    rows = similar_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["id"]: r["component_id"] for r in sh.similar_groups(df).collect()}
    pairs = [(a, b, jaccard(x, y)) for a, x in rows for b, y in rows if a < b]
    near = [got[a] == got[b] for a, b, j in pairs if j >= 0.85]
    assert len(near) > 20 and sum(near) / len(near) >= 0.95
    assert not any(got[a] == got[b] for a, b, j in pairs if j < 0.3)
    assert {r["doc_id"] for r in sh.keep_one(df).collect()} == set(got.values())


def test_recall_of_candidates_at_the_threshold():
    """Pairs of similarity 0.8 share a band with a chance of 1 - (1 - 0.8 ** 6) ** 24 = 0.9993, at every length."""
    r = np.random.default_rng(2)
    for n in (9, 90, 900):
        found = 0
        for _ in range(300):
            h = r.integers(0, 2**64, n + 2 * n // 16 + 2, dtype=np.uint64)
            extra = max(1, n // 9)
            a, b = h[:n], np.concatenate([h[extra:n], h[n : n + extra]])  # (n - extra) / (n + extra), about 0.8
            keys = sh._min_bands(np.concatenate([np.unique(a), np.unique(b)]), np.array([0, n]))
            found += bool((keys[0] == keys[1]).any())
        assert found >= 295


def test_near_copies_equal_all_pairs_of_the_table(spark):
    """Every pair of the table at 0.8 or more is joined, and nothing below it is, but by a chain of such pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["id"]: r["component_id"] for r in sh.similar_groups(docs).collect()}
    rows = [(r["doc_id"], shingle_set((r["text"] or "").encode(), 5)) for r in docs.select("doc_id", "text").collect()]
    owner = np.concatenate([np.full(len(x), k) for k, (_, x) in enumerate(rows)])
    values = np.concatenate([x for _, x in rows])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    both = {}
    cuts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    for s, e in zip(cuts, np.append(cuts[1:], len(values)), strict=True):
        held = np.sort(owner[s:e]).tolist()
        for i in range(len(held)):
            for j in range(i):
                both[held[j], held[i]] = both.get((held[j], held[i]), 0) + 1
    label = list(range(len(rows)))
    near = total = 0
    for (i, j), n in both.items():
        if n / (len(rows[i][1]) + len(rows[j][1]) - n) >= 0.8:
            total += 1
            near += got[rows[i][0]] == got[rows[j][0]]
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    assert total > 50 and near / total >= 0.99
    for i, (d, x) in enumerate(rows):
        if len(x):
            assert got[d] == rows[label[i]][0] or near < total


def test_similar_groups_are_exact_at_the_threshold(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(8))
    rows = []

    def add(*texts):
        rows.extend([(len(rows) + k, " ".join(t)) for k, t in enumerate(texts)])

    for n, extra in [(4, 1), (8, 2), (16, 4), (60, 15), (200, 50)] * 6:  # similarity 0.8 exactly, and the next one below
        base = [word() for _ in range(n + 4)]
        add(base, base + [word() for _ in range(extra)])
        base = [word() for _ in range(n + 4)]
        add(base, base + [word() for _ in range(extra + 1)])
    for _ in range(8):  # many repeats: equal majorities, other sets
        w = word()
        add([w] * 200, [w] * 200 + [word() for _ in range(8)])
    chain = [word() for _ in range(100)]  # a group only by its links
    add(*[chain[k : k + 60] for k in range(0, 30, 3)])
    want = list(range(len(rows)))
    for a, x in rows:
        for b, y in rows[:a]:
            if want[a] != want[b] and jaccard(x, y) >= 0.8:
                old, new = max(want[a], want[b]), min(want[a], want[b])
                want = [new if c == old else c for c in want]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for tile in (1 << 22, 300):
        monkeypatch.setattr(sh, "SET_TILE", tile, raising=False)
        assert {r["id"]: r["component_id"] for r in sh.similar_groups(df).collect()} == dict(enumerate(want))


def test_link_counts_of_any_number(spark):
    """The state of the component search is made of counts and exclusive ors, which no number of links makes overflow."""
    from strandline.llm import components

    edges = spark.range(1 << 24).selectExpr("id as u", "-id as v")
    n, a, b = components._state(edges)
    assert n == 1 << 24 and (n, a, b) == components._state(edges.repartition(3)) and (a, b) != components._state(edges.filter("u > 0"))[1:]


def test_long_texts_and_clashing_columns(spark):
    """A text of a million words, and columns with the names that the operator uses inside."""
    long_one = " ".join(f"w{k % 977}x{k % 31}" for k in range(1_000_000))
    rows = [(1, long_one, 5), (2, long_one + " end", 6), (3, "", 7), (4, None, 8), (5, "a b", 9), (6, "A  b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long")
    df = df.withColumn("fp", df["id"]).withColumn("least", df["id"]).withColumn("component_id", df["id"]).withColumn("c", df["id"]).withColumn("bucket", df["id"])
    got = {r["id"]: r["component_id"] for r in sh.near_groups(df).collect()}
    assert got[1] == got[2] == 1 and got[3] == got[4] == 3 and got[5] == got[6] == 5
    kept = sh.keep_one(df)
    assert kept.columns == df.columns and sorted((r["doc_id"], r["c"]) for r in kept.collect()) == [(1, 5), (3, 7), (5, 9)]


def test_near_copies_go_through_fingerprints(spark, monkeypatch):
    """Only classes within the radius of another one of their bucket are compared by their sets, tiles or not."""
    rows = similar_corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    asked, check = [], sh.verified
    monkeypatch.setattr(sh, "verified", lambda base, classes, buckets, *a: asked.append({tuple(r) for r in buckets.select("bucket", "c").collect()}) or check(base, classes, buckets, *a))
    sets = [shingle_set(t.encode(), 5) for _, t in rows]
    prints = [sh._set_prints(x, np.array([0])).ravel() for x in sets]
    members = {}
    for (d, _), x in zip(rows, sets, strict=True):
        for key in sh._min_bands(x, np.array([0]))[0].tolist():
            members.setdefault(key, []).append(d)
    for radius, tile in ((76, 2048), (20, 2048), (20, 2), (-1, 2048)):
        monkeypatch.setattr(sh, "NEAR_RADIUS", max(radius, 0))
        monkeypatch.setattr(sh, "TILE", tile)
        if radius < 0:  # fingerprints that are all far apart: nothing is a candidate
            monkeypatch.setattr(sh, "_set_prints", lambda flat, starts: np.stack([sh.remix(np.add.reduceat(flat, starts), k + 1) for k in range(4)], axis=1))
        groups = {r["id"]: r["component_id"] for r in sh.similar_groups(df).collect()}
        apart = lambda a, b: int(np.bitwise_count(prints[a] ^ prints[b]).sum())
        distinct = lambda a, b: not np.array_equal(sets[a], sets[b])
        want = {(k, a) for k, own in members.items() for a in own if any(distinct(a, b) and apart(a, b) <= radius for b in own)}
        least = {x.tobytes(): d for (d, _), x in reversed(list(zip(rows, sets, strict=True)))}
        assert asked.pop() == {(k, a) for k, a in want if least[sets[a].tobytes()] == a}
        assert radius >= 0 or groups == {d: least[x.tobytes()] for (d, _), x in zip(rows, sets, strict=True)}


def test_sets_at_the_similarity_are_within_the_radius():
    r = np.random.default_rng(3)
    for n, m, both in [(4, 5, 4), (9, 9, 8), (8, 10, 8), (16, 20, 16), (45, 45, 40), (80, 100, 80), (450, 450, 400)]:
        for _ in range(300):
            h = r.integers(0, 2**64, n + m - both, dtype=np.uint64)
            x, y = sh._set_prints(np.concatenate([h[:n], h[n - both :]]), np.array([0, n]))
            assert np.bitwise_count(x ^ y).sum() <= sh.NEAR_RADIUS
