import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.llm import divergence as dv
from strandline.llm import manifest as mf
from strandline.llm import minhash as mh
from strandline.llm import set_links

low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# --- near-duplicate sets


def shingles(t, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(rows):
    """Least handle of the group of each row, by all pairs."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label = [new if x == old else x for x in label]
    return sets, label


def near_corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefÉgh") for _ in range(r.randint(2, 6)))
    rows = []
    for g in range(12):  # families of edited copies
        base = [word() for _ in range(r.choice([30, 120, 300]))]
        for k in range(1 + g % 5 * 3):
            w = list(base)
            for _ in range(round(len(w) * r.choice([0, 0.004, 0.01, 0.03, 0.06]))):
                w[r.randrange(len(w))] = word()
            rows.append(" ".join(w) if k % 2 else "\n".join(w).upper())
    for n, extra in [(4, 1), (8, 2), (16, 4), (60, 15)] * 3:  # exactly 0.8, and the next below
        for more in (extra, extra + 1):
            base = [word() + str(len(rows)) for _ in range(n + 3)]
            rows += [" ".join(base), " ".join(base + [word() + "x" for _ in range(more)])]
    chain = [f"c{k}" for k in range(140)]
    rows += [" ".join(chain[k : k + 60]) for k in range(0, 70, 5)]
    rows += ["one", "One", "one two", None, "", " \n\t", None, "a b c", "a B  c"]
    return list(enumerate(rows))


@pytest.mark.parametrize("tile", [1 << 22, 4000, 600])
def test_near_sets_equal_all_pairs(spark, tile):
    rows = near_corpus()
    sets, label = groups(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("id", "uid", "own", "c", "n", "bands", "bucket", "root", "__uid"):
        df = df.withColumn(c, F.lit(1))
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in mh.near_sets(df, tile=tile).collect()}
    assert got == {k: (len(sets[k]), label[k]) for k, _ in rows}


def test_near_sets_of_repeated_null_and_no_rows(spark):
    text = " ".join(f"w{k}" for k in range(50))
    df = spark.createDataFrame([(7, text), (7, text), (None, text + " x"), (9, None), (9, "")], "doc_id long, text string")
    got = sorted((r["id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in mh.near_sets(df).collect())
    assert got == [(0, 48, 7), (7, 47, 7), (7, 47, 7), (9, 0, 9), (9, 0, 9)]
    assert mh.near_sets(df.limit(0)).count() == 0
    long_one = " ".join(f"w{k % 977}x{k % 31}" for k in range(400_000))
    long = spark.createDataFrame([(2, long_one), (1, long_one + " end")], "doc_id long, text string")
    assert {r["component_id"] for r in mh.near_sets(long).collect()} == {1}


def test_chance_of_a_table_key():
    assert (1 - (1 - 0.8**mh.ROWS) ** mh.HALVES) ** 2 > 0.9995


def test_a_long_chain_travels_by_its_buckets(spark, monkeypatch):
    """In a component much larger than a tile the texts go to their buckets: few copies of each, and the same links."""
    from strandline.llm import common

    words = [f"k{k}" for k in range(3200)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 60])) for i in range(1000)]  # neighbours at 54/60, all one component
    sent = []
    real = set_links._cells
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counted = spark.sparkContext.accumulator(0)

    def cells(similarity, size):
        run = real(similarity, size)

        def watch(batches):
            def each():
                for b in batches:
                    counted.add(b.num_rows)
                    yield b

            yield from run(each())

        return watch

    monkeypatch.setattr(set_links, "_cells", cells)
    got = {r["component_id"] for r in mh.near_sets(df, tile=4000).collect()}
    assert got == {0} and counted.value <= 30 * len(rows), (counted.value, sent, common)


# --- manifest


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute_manifest(rows, struck=lambda d: d is not None and zlib.crc32(str(d).encode()) % 3 == 0):
    """rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    one = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: sha("".join(map(one, r)))
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))

    def paths(nodes):
        """Root, and for each node its (before, after) level by level."""
        out, where, now = [[] for _ in nodes], list(range(len(nodes))), nodes
        while len(now) > 1:
            for k, at in enumerate(where):
                s = at - at % 8
                out[k].append(("".join(now[s:at]), "".join(now[at + 1 : s + 8])))
            now, where = [sha("".join(now[k : k + 8])) for k in range(0, len(now), 8)], [at // 8 for at in where]
        return now[0], out

    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subs = {x: paths([leaf for *_, leaf, _ in sorted(trees[x], key=lambda t: t[:3])]) for x in langs}
    root, tops = paths([subs[x][0] for x in langs]) if langs else (None, [])
    out = []
    for x, top in zip(langs, tops, strict=True):
        for (*_, h, r), path in zip(sorted(trees[x], key=lambda t: t[:3]), subs[x][1], strict=True):
            fold = leaf((*r[:4], low(r[4]) if r[4] is not None else None)) if struck(r[0]) else h
            for before, after in path + top:
                fold = sha(before + fold + after)
            out.append((r[0], h, subs[x][0], root, sha("".join(b + a for b, a in path + top)), fold, fold == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def run_manifest(spark, rows, block):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", F.lit(1).alias("tree"), F.lit(2).alias("at"), F.lit(3).alias("leaf"))
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = mf.manifest(df, {"text": F.translate("text", mf._UPPER, mf._LOWER)}, struck, block)
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_manifest_equals_a_plain_tree(spark, block):
    r = random.Random(8)
    word = lambda: r.choice(["Ab", "über", "x y", "", "日本", "ZZ\n"])
    rows = [(i, word() or None, "en", r.choice([None, 5]), r.choice([None, word() * 3])) for i in range(700)]
    rows += [(i, "s", "fr", 1, word()) for i in range(65)] + [(i, None, None, None, None) for i in (3, 1, 2)] + [(5, "s", "", 0, ""), (None, "s", "fr", 1, "T"), (None, "s", "fr", 1, "U")]
    rows += [rows[4], rows[4], (4, "other", "en", 1, "Ab")] + [(1000 + k, "s", f"l{k:02}", 1, "Txt") for k in range(9)]
    assert run_manifest(spark, rows, block) == brute_manifest(rows)


def test_manifest_of_one_and_no_rows(spark):
    one = [(1, "s", "en", 3, "Abc")]
    got = run_manifest(spark, one, 8)
    assert got == brute_manifest(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == sha("")
    assert run_manifest(spark, [], 8) == []


# --- divergence


def brute_divergence(rows, least):
    """rows (lang, source, text) -> sorted result rows."""
    docs = [(x or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t or ""))) for x, s, t in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for *_, ts in own for t in set(ts))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: Counter(t for _, s2, ts in own if s2 == s for t in ts if df[t] >= least) for _, s, _ in own}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        shares, whole = {s: p(c) for s, c in counts.items()}, p(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(shares[s][t] - whole[t], t) for t in kept if counts[s][t] and shares[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


def run_divergence(df, **kw):
    return sorted(tuple(r) for r in dv.divergence(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence_equals_plain_counts(spark):
    r = random.Random(11)
    words = ["Foo", "foo", "foo-foo,", "bar9baz", "ÉTÉ", "été", "éTé", "日本", "x", "'y'", "12", "--", "Z" * 300, "ab\x00cd", "q\x7fq", "\x1cfs", "nb sp"]
    rows = []
    for k in range(260):
        text = r.choice([" ", "\n", "\t ", "\x0b"]).join(r.choice(words) for _ in range(r.randint(0, 25)))
        rows.append((r.choice(["en", "en", "fr", None, ""]), r.choice(["a", "b", "c", None, f"s{k % 7}"]), r.choice([text, text, text, None])))
    rows += rows[:9] + [("xx", "lonely", "few words"), ("yy", "a", ""), ("yy", "b", None)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    for c in ("term", "n", "p", "q", "block", "chunk", "docs", "value", "i"):
        df = df.withColumn(c, F.lit(1))
    want = brute_divergence(rows, 30)
    assert run_divergence(df) == want and {x[2] for x in want} == {"pair", "term"}
    for docs in (1, 7):
        assert run_divergence(df, block_docs=docs) == want
    assert run_divergence(df.limit(0)) == []


def test_divergence_over_tiles_and_batches(spark, monkeypatch):
    rows = [("en", f"s{k % 9}", f"common w{k % 4} w{k % 9} Only{k % 9} w{k % 2}") for k in range(180)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    want = brute_divergence(rows, 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert run_divergence(df, least=10) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_distances_between_tiles(spark, monkeypatch):
    """Sources of several tiles: the tile is lowered in the plan and in the workers."""
    import pyarrow as pa

    monkeypatch.setattr(dv, "TILE", 2)
    z = {0: [10, 20], 1: [30]}
    terms = [{0: 11, 2: 35}, {1: 25}, {2: 31}]  # source -> share
    total = {}
    for a, b in ((0, 0), (0, 1), (1, 1)):
        held = [[{"tile": i // 2, "place": i % 2, "p": p} for i, p in t.items() if i // 2 in (a, b)] for t in terms]
        held = [x for x in held if x]
        if not held:
            continue
        kind = pa.list_(pa.struct([("tile", pa.int32()), ("place", pa.int32()), ("p", pa.int64())]))
        cols = [pa.array(["en"] * len(held)), pa.array([a] * len(held)), pa.array([b] * len(held)), pa.array(held, kind), pa.array([z[a]] * len(held)), pa.array([z[b]] * len(held))]
        for out in dv._distances(iter([pa.RecordBatch.from_arrays(cols, names=["lang", "a", "b", "entries", "za", "zb"])])):
            for row in out.to_pylist():
                total[row["i"], row["j"]] = row["s"] + (3 - row["terms"]) * abs(z[row["i"] // 2][row["i"] % 2] - z[row["j"] // 2][row["j"] % 2])
    base = [10, 20, 30]
    want = {(i, j): sum(abs(t.get(i, base[i]) - t.get(j, base[j])) for t in terms) for i, j in itertools.combinations(range(3), 2)}
    assert total == want
