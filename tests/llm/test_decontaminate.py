import random
import re

import numpy as np

from strandline.llm import decontaminate as dc


def best_edits(item, text):
    """Least edits of the whole item against any part of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def folded(t):
    return bytes(dc.fold(np.frombuffer(t.encode(), np.uint8))[0])


def brute(docs, items):
    out = set()
    for d, t in docs:
        for i, b in items:
            if t is None or not (b or "").strip():
                continue
            if len(folded(b)) < dc.Q:  # a whole word
                if re.search(rb"(?<![0-9A-Za-z\x80-\xff])" + re.escape(folded(b)) + rb"(?![0-9A-Za-z\x80-\xff])", folded(t)):
                    out.add((d, i, 0))
                continue
            m = len(folded(b))
            e = min(int(dc.RATE * m), max((m - dc.Q) // dc.Q, 0))
            k = best_edits(folded(b), folded(t))
            if k <= e:
                out.add((d, i, k))
    return out


def edit(r, t, n):
    t = list(t)
    for _ in range(n):
        p = r.randrange(len(t))
        t[p : p + 1] = r.choice([[], [r.choice("xyz")], [t[p], r.choice("xyz")]])
    return "".join(t)


def corpus():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(r.randint(8, 30))) for i in range(14)] + [(50, None), (51, ""), (52, "ab"), (53, "abcde abcde")]
    docs = []
    for i in range(90):
        b = items[i % 14][1]
        n = [0, 1, 3, 5, 8, 11, 30][i % 7]
        t = text(r.randint(0, 20)) + r.choice([" ", "\n", ""]) + edit(r, b, n) + r.choice([" ", "  "]) + text(r.randint(0, 20))
        docs.append((i, t.upper().replace("É", "é") if i % 5 == 0 else t.replace(" ", " \n ") if i % 5 == 1 else t))
    docs += [(200, None), (201, ""), (202, items[3][1]), (203, items[3][1]), (204, items[4][1][:-3]), (205, items[4][1][3:]), (206, "xx abcde  ABCDE yy"), (207, "AB"), (208, "xab ab."), (209, "abx"), (203, "repeated id ab")]
    return docs, items


def result(df):
    return {(r["doc_id"], x["item_id"], x["edits"]) for r in df.collect() for x in r["leaks"]}


def test_matches_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 40
    assert result(dc.with_leaks(d, b)) == want
    assert result(dc.with_leaks(d, b, block=300)) == want  # several blocks


def test_pieces_find_the_same(spark, monkeypatch):
    docs, items = corpus()
    long = [(1, " ".join(t or "" for _, t in docs))]
    index = dc.Items([(i, t.encode()) for i, t in items if t])

    class Shared:
        value = index

    import pyarrow as pa

    batch = pa.array([t for _, t in long])
    whole = dc._search(Shared)(batch).to_pylist()
    monkeypatch.setattr(dc, "PIECE", 700)
    pieces = dc._search(Shared)(batch).to_pylist()
    key = lambda rows: [(x["item_id"], x["edits"]) for x in rows[0]]
    assert key(whole) == key(pieces)
    assert [x["s"] for x in whole[0] if x["edits"] == 0] == [x["s"] for x in pieces[0] if x["edits"] == 0]


def test_an_item_over_a_cut_with_long_white_space(monkeypatch):
    """Cuts are made in the folded text, so white space of any length around a cut hides nothing."""
    import pyarrow as pa

    monkeypatch.setattr(dc, "PIECE", 64)
    item = b"the quick brown fox jumps over the lazy dog"
    index = dc.Items([(1, item)])

    class Shared:
        value = index

    for lead in range(0, 70, 3):
        text = "z" * lead + " the quick" + " \n" * 400 + "brown fox jumps" + "\t" * 300 + "over the lazy dog " + "é" * 50
        (found,) = dc._search(Shared)(pa.array([text])).to_pylist()
        assert [(x["item_id"], x["edits"], x["s"], x["e"]) for x in found] == [(1, 0, lead + 1, len(text) - 51)]


def test_positions_are_code_points(spark):
    d = spark.createDataFrame([(1, "éé  Hello there general", 1)], "doc_id long, text string, leaks int")
    b = spark.createDataFrame([(7, "hello there general")], "item_id long, text string")
    (x,) = dc.with_leaks(d, b).first()["leaks"]
    assert (x["item_id"], x["edits"], x["s"], x["e"]) == (7, 0, 4, 23)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "some text of a document")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.with_leaks(d, none).first()["leaks"] == []
    assert dc.with_leaks(d.limit(0), none).count() == 0


def test_repetitive_texts_in_slices(monkeypatch):
    items = dc.Items([(1, b"ab" * 60), (2, b"x" * 90)])
    text = np.frombuffer(b"ab" * 300 + b" " + b"x" * 400, np.uint8)
    off = np.array([0, len(text)])
    whole = items.leaks(text, off)
    monkeypatch.setattr(dc, "SLICE", 500)
    assert items.leaks(text, off) == whole
    assert set(whole[0]) == {1, 2} and all(x[0] == 0 for x in whole[0].values())
