"""Scans and their checks: contiguity, repeated and missing keys, numbered files, capture metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def contiguity(df: DataFrame, seq: str) -> DataFrame:
    """One row: first and last key, rows, distinct keys, and whether the keys are a gap-free sequence."""
    n, d = F.count(F.lit(1)), F.count_distinct(seq)
    return df.agg(F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq"), n.alias("n"), d.alias("n_distinct"), ((n == F.max(seq) - F.min(seq) + 1) & (d == n)).alias("contiguous"))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_in_range(df: DataFrame, seq: str) -> DataFrame:
    """Keys between the first and last that have no row, found as gaps between neighbours in ranges of keys."""
    cell = F.floor(F.col(seq) / 100_000).cast("long")
    held = df.select(seq, cell.alias("c")).distinct()
    ends = held.groupBy("c").agg(F.min(seq).alias("a"), F.max(seq).alias("z"), F.count(F.lit(1)).alias("n"))
    whole = ends.agg(F.min("a").alias("first"), F.max("z").alias("last"))
    cells = whole.select(F.explode(F.sequence(F.floor(F.col("first") / 100_000), F.floor(F.col("last") / 100_000))).alias("c"), "first", "last")
    wanted = cells.select(F.explode(F.sequence(F.greatest("first", F.col("c") * 100_000), F.least("last", F.col("c") * 100_000 + 99_999))).alias(seq))
    return wanted.join(held.select(seq), seq, "left_anti")


def numbered_files(spark: SparkSession, folder: str, pattern: str = "frame_*.dng") -> DataFrame:
    """(seq, path, length) of the files whose names end in _<number>.<suffix>; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(F.regexp_extract("path", r"_([0-9]+)\.[^./]+$", 1).try_cast("long").alias("seq"), "path", "length").filter("seq is not null")


def select_files(spark: SparkSession, folder: str, pattern: str = "frame_*.dng", first: int | None = None, last: int | None = None) -> DataFrame:
    """The numbered files of a range; an empty selection, a gap or a repeated number is an error."""
    files = numbered_files(spark, folder, pattern)
    if first is not None:
        files = files.filter(F.col("seq") >= first)
    if last is not None:
        files = files.filter(F.col("seq") <= last)
    state = contiguity(files, "seq").first()
    if not state["n"]:
        raise ValueError(f"no files in {folder} match")
    if not state["contiguous"]:
        raise ValueError(f"the numbers from {state['first_seq']} to {state['last_seq']} have gaps or repeats")
    return files.orderBy("seq")


def capture_metadata(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines keyed by frame_number; rows without a key go, a repeated key is an error."""
    schema = "frame_number long, raw_registration_mode string, selected_source string, sprockets array<array<double>>, raw_width int, raw_height int, preview_width int, preview_height int"
    rows = spark.read.schema(schema).json(path).filter("frame_number is not null")
    if repeated_keys(rows, ["frame_number"]).take(1):
        raise ValueError("capture metadata repeats a frame number")
    return rows


def checked_model(spark: SparkSession, path: str) -> DataFrame:
    """One-row JSON of a match model; wrong shapes are an error. Shapes: 13 x 3, 3 x 256, 4."""
    model = spark.read.schema("coefficients array<array<double>>, luts array<array<double>>, wb array<double>").option("multiLine", True).json(path)
    good = (F.size("coefficients") == 13) & F.forall("coefficients", lambda r: F.size(r) == 3) & (F.size("luts") == 3) & F.forall("luts", lambda r: F.size(r) == 256) & (F.size("wb") == 4)
    if model.filter(good).count() != 1:
        raise ValueError("the model's arrays have wrong shapes")
    return model
