"""What the operators of this subpackage share: tables, scratch tables, row handles and Arrow text access."""

from __future__ import annotations

import atexit
import typing
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.session import scratch as shared_dir

_SCRATCH: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it again: lineage ends here and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandline/{label}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    if not _SCRATCH:
        atexit.register(release)
    _SCRATCH.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession | None = None) -> None:
    """Delete the scratch tables of a session, or of all sessions at exit. Results that still read them must be written first."""
    for item in list(_SCRATCH):
        owner, path = item
        if spark is not None and owner is not spark:
            continue
        _SCRATCH.remove(item)
        try:
            jvm = owner.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(owner.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone at exit
            return


def with_order(docs: DataFrame, id_col: str = "doc_id", out: str = "uid") -> DataFrame:
    return handles(docs, id_col, out)[0]


def handles(docs: DataFrame, id_col: str = "doc_id", out: str = "uid") -> tuple[DataFrame, bool]:
    """Docs with a bigint row handle `out` that is unique and sorts like the id; and whether it is the id.

    Unique, non-null whole numbers are their own handle. Otherwise (repeats, nulls, ids of another type) rows are ranked by
    (id nulls last, hash of the row): a range-partitioned sort gives each partition's rows consecutive numbers, and only
    partition sizes reach the driver. Rows that are equal in all columns take any order among themselves."""
    spark = docs.sparkSession
    whole_number = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    if whole_number:
        ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"))
        repeated = ids.groupBy("i").count().filter(F.col("count").__gt__(1) | F.col("i").isNull()).limit(1)
        if not repeated.take(1):
            return docs.withColumn(out, F.col(f"`{id_col}`").cast("long")), True
    whole = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns])
    n = partitions(spark)
    ranked = docs.withColumn("__h", whole).withColumn("__n", F.col(f"`{id_col}`").isNull()).withColumn("__k", F.col(f"`{id_col}`"))
    ranked = stored(
        ranked.repartitionByRange(n, "__n", "__k", "__h").sortWithinPartitions("__n", "__k", "__h").withColumn("__m", F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright("__m", 33)
    sizes = {r["p"]: r["n"] for r in ranked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts] or [F.lit(0).cast("long")]), (part + 1).cast("int"))
    return ranked.withColumn(out, start + F.col("__m").bitwiseAND(2**33 - 1)).drop("__h", "__n", "__k", "__m"), False


def bounded(rows: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most `most` of rows, whatever joins made of them: all if they are that few, else those with the least hashes.

    The rows are read once to count them; the sort of the cut holds ids and hashes of texts, not texts."""
    if rows.limit(most + 1).count() <= most:
        return rows
    h = F.xxhash64(id_col, *[F.col(f"`{c}`").cast("string") for c in rows.columns])
    keyed = rows.withColumn("__h", h)
    cut = keyed.select(F.col("__h")).orderBy("__h").limit(most).agg(F.max("__h").alias("h")).first()["h"]
    return keyed.filter(F.col("__h") <= cut).drop("__h").limit(most)


def as_binary(col: pa.Array) -> pa.LargeBinaryArray:
    """Any string or binary column as one large_binary array, null as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.cast(pa.large_string()).cast(pa.large_binary()) if not (pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type)) else col.cast(pa.large_binary())
    return col.fill_null(b"") if col.null_count else col


def byte_view(col: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after another, and their n + 1 offsets."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def texts(col: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end, values) for ranges of about `limit` bytes, so that a batch's texts are never all Python objects."""
    col = as_binary(col)
    for i, j in chunks(byte_view(col)[1], limit):
        yield i, j, col.slice(i, j - i).to_pylist()


def text_column(work: Callable[[], Callable[[pa.Array], pa.Array]], returns: str):
    """A column function of texts. Only the text goes to Python and only the result comes back; the other columns stay in
    the JVM. `work` is called once a task and gives the function of one batch. Each text is read once, whatever filters
    follow."""

    def run(batches: typing.Iterator[pa.Array]) -> typing.Iterator[pa.Array]:
        of = work()
        for col in batches:
            yield of(col)

    return F.arrow_udf(run, returns).asNondeterministic()


def chunks(off: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer value has a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield i, j
        i = j
