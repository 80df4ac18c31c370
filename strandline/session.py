"""SparkSession factory with the settings that the operators are designed for."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow transfer; `conf` overrides."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python, once an application: they need not find it on a path of their own."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    bundle = Path(tempfile.mkdtemp(prefix="strandline-")) / "strandline_bundle.zip"
    with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    context.addPyFile(str(bundle))
    _SHIPPED.add(context.applicationId)


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only a local session may go without one: its driver and executors are one
    machine, so a folder of our own serves; on a cluster the others could not see it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandline-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


_KEPT: list[tuple[SparkSession, str]] = []


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write `df` into the shared folder and read it again: lineage ends here, and later steps don't compute it anew."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/strandline/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _KEPT:
        atexit.register(release)
    _KEPT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete what `kept` wrote for a session, or for all at exit. Results that still read it must be written first."""
    for item in [x for x in _KEPT if spark is None or x[0] is spark]:
        _KEPT.remove(item)
        with contextlib.suppress(Exception):  # the session may be gone at exit
            owner, path = item
            target = owner.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(owner.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
