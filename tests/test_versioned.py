"""The log-structured ledger: versions, replays, interrupted and concurrent commits, constant commit size."""

import pytest
from pyspark.sql import functions as F

from strandline.operators import versioned
from strandline.operators.versioned import Ledger

SCHEMA = "k long, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_versions_replays_and_compaction(spark, tmp_path):
    path = str(tmp_path / "book")
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    book = Ledger(spark, path, SCHEMA, ["k"], compact=3)
    assert rows(book.read()) == [] and book.versions() == []
    assert book.commit(frame([(1, "a"), (2, "b"), (None, "n")]), "s", 0) == 1
    assert book.commit(frame([(2, "B"), (3, None)]), "s", 1) == 2
    assert book.commit(frame([(2, "b")]), "s", 1) == 2 and book.commit(frame([(9, "x")]), "s", 0) == 2  # replayed
    assert book.commit(frame([(None, "N")]), "other", 0) == 3
    assert book.commit(frame([]), "s", 2) == 4  # an empty batch counts as done
    again = Ledger(spark, path, SCHEMA, ["k"], compact=3)  # any process sees the same
    assert rows(again.read(1)) == [(1, "a"), (2, "b"), (None, "n")]
    assert rows(again.read(2)) == [(1, "a"), (2, "B"), (3, None), (None, "n")]
    assert rows(again.read()) == [(1, "a"), (2, "B"), (3, None), (None, "N")]
    assert rows(again.changes(1, 3, F.col("v"))) == [(2, "changed"), (3, "added"), (None, "changed")]
    version = again.commit(frame([(4, "d")]))
    assert again.manifest()["base"] and again.manifest()["deltas"] == [] and again.manifest()["version"] == version + 1
    assert rows(again.read()) == [(1, "a"), (2, "B"), (3, None), (4, "d"), (None, "N")] == rows(again.read(version))
    assert rows(again.read(2)) == [(1, "a"), (2, "B"), (3, None), (None, "n")]  # old versions stay
    assert again.vacuum(keep=1, grace=0) == 4 and len(rows(again.read())) == 5
    with pytest.raises(ValueError, match="no version"):
        again.read(2)
    with pytest.raises(ValueError, match="twice"):
        again.commit(frame([(7, "a"), (7, "b")]))
    assert 7 not in {r[0] for r in rows(again.read())}


def test_an_interrupted_commit_changes_nothing(spark, tmp_path, monkeypatch):
    book = Ledger(spark, str(tmp_path / "book"), SCHEMA, ["k"])
    book.commit(spark.createDataFrame([(1, "a")], SCHEMA), "s", 0)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "_publish", lambda self, manifest: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            book.commit(spark.createDataFrame([(1, "lost")], SCHEMA), "s", 1)
    assert rows(book.read()) == [(1, "a")] and book.manifest()["batches"] == {"s": 0}
    assert book.commit(spark.createDataFrame([(1, "b")], SCHEMA), "s", 1) == 2 and rows(book.read()) == [(1, "b")]
    assert book.vacuum(grace=0) == 1  # what was left is in no manifest


def test_a_second_writer_does_not_undo_the_first(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "book")
    a, b = (Ledger(spark, path, SCHEMA, ["k"]) for _ in range(2))
    real, first = Ledger._publish, []

    def late(self, manifest):
        if self is a and not first:
            first.append(1)
            b.commit(spark.createDataFrame([(2, "b")], SCHEMA))  # comes in between
        real(self, manifest)

    monkeypatch.setattr(Ledger, "_publish", late)
    assert a.commit(spark.createDataFrame([(1, "a")], SCHEMA)) == 2
    assert rows(a.read()) == [(1, "a"), (2, "b")] and rows(a.read(1)) == [(2, "b")]


def size(folder):
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())


def test_a_commit_writes_no_more_to_a_large_ledger(spark, tmp_path):
    written = []
    for n in (10, 200_000):
        path = tmp_path / f"book{n}"
        book = Ledger(spark, str(path), SCHEMA, ["k"])
        book.commit(spark.range(n).selectExpr("id as k", "cast(id as string) as v"))
        before = size(path)
        book.commit(spark.createDataFrame([(5, "new")], SCHEMA).coalesce(1))
        written.append(size(path) - before)
        assert book.read().count() == n
    assert written[1] <= written[0] + 64, written
    assert versioned.COMPACT < 100
