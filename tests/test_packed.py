"""The packed 12-bit source: round trips, split files, staged sets, killed tasks."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import kernels
from strandline.sources import packed


@pytest.fixture(scope="module")
def source(spark):
    packed.register(spark)
    return spark


def files(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names)


def test_packing_is_the_known_layout():
    assert packed.pack(np.array([0xAB1, 0xCD2])) == bytes([0xAB, 0xCD, 0x21])
    values = np.arange(4096)
    assert packed.unpack(packed.pack(values)).tolist() == values.tolist() == kernels.unpack12(packed.pack(values)).tolist()


def test_round_trip_of_split_files(source, tmp_path):
    path = str(tmp_path / "set")
    df = source.range(10_001).select((F.col("id") * 37 % 4096).cast("int").alias("value"))
    df.coalesce(1).write.format("packed12").mode("append").save(path)
    back = source.read.format("packed12").option("range", 1000).load(path)
    assert back.rdd.getNumPartitions() == 11
    got = [(r["at"], r["value"]) for r in back.orderBy("at").collect()]
    assert got == [(k, k * 37 % 4096) for k in range(10_001)]
    df.repartition(3).write.format("packed12").mode("append").save(path)
    assert source.read.format("packed12").load(path).count() == 20_002
    assert all(r["good"] for r in packed.verify(source, path).collect()) and packed.verify(source, path).count() == 4
    df.limit(5).write.format("packed12").mode("overwrite").save(path)
    assert source.read.format("packed12").load(path).count() == 5 and len(files(path)) == 2
    df.limit(0).write.format("packed12").mode("overwrite").save(path)
    assert source.read.format("packed12").load(path).count() == 0


def test_a_failed_write_leaves_the_old_set(source, tmp_path):
    path = str(tmp_path / "set")
    good = source.range(10).select(F.col("id").cast("int").alias("value"))
    good.write.format("packed12").mode("append").save(path)
    before = files(path)
    for bad in (good.withColumn("value", F.lit(5000)), good.withColumn("value", F.lit(None).cast("int")), good.withColumn("value", F.raise_error(F.lit("lost")).cast("int"))):
        with pytest.raises(Exception):  # noqa: B017
            bad.write.format("packed12").mode("append").save(path)
        assert files(path) == before and source.read.format("packed12").load(path).count() == 10


def test_a_killed_attempt_leaves_no_file(tmp_path):
    """An attempt wrote its file but did not report it: the commit of the others removes it."""
    import pyarrow as pa

    path = str(tmp_path / "set")
    writer = packed._Writer(path, False)
    batch = lambda *v: iter([pa.RecordBatch.from_arrays([pa.array(v, pa.int32())], names=["value"])])
    writer.write(batch(1, 2, 3))  # killed after this
    done = [writer.write(batch(4, 5)), writer.write(batch()), None]
    writer.commit(done)
    listed = [f["name"] for f in json.loads((tmp_path / "set" / "_manifest.json").read_text())["files"]]
    assert len(listed) == 1 and files(path) == sorted([*listed, "_manifest.json"])
    other = packed._Writer(path, False)
    other.write(batch(9))
    other.abort([])
    assert files(path) == sorted([*listed, "_manifest.json"])
