import gzip
import hashlib
import io
import random
import time

import duckdb
import pytest

from strandline.llm import mixing, warc

SF = "/root/testdata/sf0.01"


def test_loser_tree_merges():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 12):
        runs = [sorted(r.randint(0, 50) for _ in range(r.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs])) == sorted(y for x in runs for y in x)


def test_url_key(spark):
    urls = {
        "https://www.Example.com:443/A?b=1": "com,example)/a?b=1", None: "", "": "", "u": "u)", "http://me:pw@a.B.org:8080/X/y": "org,b,a:8080)/x/y", "  http://www2.x.de ": "de,x)", "ftp://h/": "h)/",
        "http://a.org:80": "org,a)", "HTTP://É.fr/Ü": "fr,é)/ü",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"]: r["k"] for r in df.select("url", warc.url_key(df["url"]).alias("k")).collect()} == urls


def gz(payload):
    pack = warc.zlib.compressobj(1, warc.zlib.DEFLATED, 31)
    return pack.compress(payload) + pack.flush()


def test_members_of_any_size():
    r = random.Random(4)
    parts = [r.randbytes(n) for n in (0, 1, 10, 100_000, 3, 70_000, 0, 32_768, 5)]
    data = b"".join(map(gz, parts))
    for piece in (1, 7, 4096, 1 << 20):
        got = list(warc.members(io.BytesIO(data), piece))
        assert [x for _, x in got] == parts and [at for at, _ in got] == [sum(len(gz(p)) for p in parts[:k]) for k in range(len(parts))]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(data[:-3])))


def test_reading_is_linear():
    r = random.Random(5)
    some = b"".join(gz(r.randbytes(2000)) for _ in range(2000))
    took = {}
    for n in (4, 8, 16):  # 16 MB, 32 MB, 64 MB
        began = time.perf_counter()
        assert sum(1 for _ in warc.members(io.BytesIO(some * n))) == 2000 * n
        took[n] = time.perf_counter() - began
    assert took[16] < 3 * took[8] + 0.5 and took[8] < 3 * took[4] + 0.5


def test_sorted_pieces():
    import pyarrow as pa

    rows = pa.table({"archive": ["a", "a", "b", "a", "a", "a"], "seq": [1, 5, 2, 6, 3, 4]})
    assert warc.sorted_pieces(rows) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert warc.sorted_pieces(rows.slice(0, 0)) == []


def test_any_id_clashing_columns_and_rolled_archives(spark):
    ids = [2**62, -(2**62), 3 * 10**11, -(10**12), 0, None, 7, 7]
    rows = [(i, f"http://h{k % 3}.org/{k}", "z" * (900 + 100 * k), 1, "x") for k, i in enumerate(ids)] + [(8, "http://h0.org/long", "é" * 3_000_000, 1, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, uid long, digest string").repartition(3)
    folder, index = warc.write_archives(df, most=1500)
    read = warc.read_archives(spark, folder).collect()
    assert sorted(str(r["page_id"]) for r in read) == sorted(str(r[0]) for r in rows)
    assert {r["payload_digest"] for r in read} == {hashlib.sha1(r[2].encode()).hexdigest() for r in rows}
    names = [r["archive"] for r in index.select("archive").distinct().collect()]
    assert len(names) > 3  # more archives than partitions would give
    for name in names:
        run = [(r["url_key"], r["captured"], r["uid"]) for r in index.filter(index["archive"] == name).orderBy("seq").collect()]
        assert run == sorted(run)
    both = warc.captures(spark, folder, warc.merge_index(index)).collect()
    order = [(r["url_key"], r["captured"], r["uid"]) for r in sorted(both, key=lambda r: (r["bucket"], r["position"]))]
    assert len(order) == len(rows) and order == sorted(order)


def test_round_trip(spark):
    big, other = "é" * 600, "y" * 2000
    rows = [(1, "http://a.org/x", big), (2, "http://b.org/", big), (3, None, other), (4, "http://a.org/x", big), (5, "u", "small"), (6, "u\r\nX: 1", "small"), (7, "http://a.org/w", None), (8, "v", ""), (9, "v", other + "z")]
    rows += [(10, "r", "q" * 1500), (10, "r", "q" * 1500), (None, "n", "q" * 1500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder, index = warc.write_archives(df)
    read = [r.asDict() for r in warc.read_archives(spark, folder).collect()]
    got = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read)
    want = []
    for i, _, html in rows:
        b = (html or "").encode()
        kind = "revisit" if (html == big and i != 4) or i is None else "response"
        want.append((i or -1, len(b), hashlib.sha1(b).hexdigest(), kind, (4 if html == big else 10) if kind == "revisit" else None))
    tens = [w for w in want if w[0] == 10]
    want.remove(tens[0])
    want.append((*tens[0][:3], "revisit", 10))
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2], x[3], x[4] or 0)) or sorted(map(str, got)) == sorted(map(str, want))
    merged = [r.asDict() for r in warc.merge_index(index).collect()]
    merged.sort(key=lambda r: (r["bucket"], r["position"]))
    order = [(r["url_key"], r["captured"], r["uid"]) for r in merged]
    assert len(order) == len(rows) and order == sorted(order)
    import glob

    first = sorted(glob.glob(folder.removeprefix("file://") + "/*.warc.gz"))[0]
    assert gzip.open(first).read(8) == b"WARC/1.1"


def test_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder, index = warc.write_archives(none)
    assert index.count() == 0
    none.write.parquet(str(tmp_path / "pages.parquet"))
    out = warc.op5_warc(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_op5_on_the_tables(spark):
    got = warc.op5_warc(spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    pages = duckdb.sql(f"select page_id, coalesce(html, '') from '{SF}/pages.parquet'").fetchall()
    best = {}
    for i, h in pages:
        if len(h.encode()) >= 1000:
            best[h] = max(best.get(h, -1), i)
    want = {}
    for i, h in pages:
        b = h.encode()
        ref = best[h] if h in best and best[h] != i else None
        want[i] = (len(b), hashlib.sha1(b).hexdigest(), "response" if ref is None else "revisit", ref)
    assert {r[0]: tuple(r[1:]) for r in got} == want


def mix_rows():
    r = random.Random(6)
    rows = []
    for i in range(600):
        source = "src1" if i % 3 == 0 else f"src{r.randint(0, 9)}"
        rows.append((i, " ".join(["w"] * r.randint(0, 30)), r.choice(["en", "en", "de", None]), source if i % 50 else None))
    return rows


def duck(sql, rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", rows)
    return con.sql(sql).fetchall()


def test_mix_matches_sql(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    slim = mixing.slim(df)
    got = sorted(tuple(r) for r in mixing.copies(slim, mixing.plan(slim, mixing.WEIGHTS)).select("id", "domain", "lang", "source", "n_tokens", "copies").collect())
    assert got == sorted(duck(mixing.OP8_SQL, rows))
    assert len({r[-1] for r in got}) > 1
    whole = mixing.mixed(df.withColumn("rest", df["doc_id"]))
    assert sorted((r["doc_id"], r["copies"]) for r in whole.collect()) == [(r[0], r[-1]) for r in got]
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    taken = sum(n * c for *_, n, c in got)
    assert 0.6 * total - 60 <= taken <= 0.6 * total + 30 * 40


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 100), ("a", "x", "2", 1000), ("a", "y", "3", 1000), ("b", "x", "4", 5000)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["share"] for r in mixing.leaf_budgets(leaves, {}, 2000 / 7100, 1).collect()}
    assert got == {"1": 100, "2": 400, "3": 500, "4": 1000}
    got = {r["source"]: r["share"] for r in mixing.leaf_budgets(leaves, {}, 6000 / 7100, 1).collect()}
    assert got == {"1": 100, "2": 1000, "3": 1000, "4": 3900}


def test_empty_mix(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.mixed(none).count() == 0


def test_odd_rows_mix(spark):
    df = spark.createDataFrame([(None, "a b", None, None, 1), (3, None, "en", "src1", 2), (3, None, "en", "src1", 2)], "doc_id long, text string, lang string, source string, id long")
    # 2 tokens times 5.0 are wanted; the only leaf with tokens gives MAX_EPOCHS copies, and a leaf without tokens gives none
    assert [tuple(r) for r in mixing.mixed(df, share=5.0).collect()] == [(None, "a b", None, None, 1, 3)]
    # one token is wanted: the prefix ends with the document that goes beyond it
    assert [(r["doc_id"], r["copies"]) for r in mixing.mixed(df, share=0.5).collect()] == [(None, 1)]
    clash = df.withColumn("copies", df["id"]).withColumn("domain", df["id"]).withColumn("epochs", df["id"])
    (got,) = mixing.mixed(clash, share=5.0).collect()
    assert got["copies"] == got["domain"] == got["epochs"] == 1 and got["__copies"] == 3


def test_repeated_ids_and_long_texts_mix(spark):
    """Equal ids have one place in the order, and are taken together or not at all."""
    rows = [(k % 20, "w " * (k % 7 + 1), "en", "src1") for k in range(60)] + [(99, "w " * 300_000, "en", "src2"), (100, "", "en", "src2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {}
    for r in mixing.mixed(df, share=0.00005).collect():
        got.setdefault(r["doc_id"], []).append(r["copies"])
    assert all(len(set(c)) == 1 and len(c) == (3 if i < 20 else 1) for i, c in got.items()) and 0 < len(got) < 22
