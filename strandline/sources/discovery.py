"""Discovery of projects (folders of numbered files with metadata) and of calibration descriptors, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def projects(spark: SparkSession, root: str) -> DataFrame:
    """One row per folder below root that holds metadata.json or numbered files (own or under raw/).

    A folder with unreadable metadata is a row with a warning. Sorted by name without regard to case, then by path."""
    pick = lambda glob, pattern: spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root).withColumn("project", F.regexp_extract("path", pattern, 1))
    frames = pick("frame_*.dng", r"/([^/]+)/(?:raw/)?frame_[0-9]+\.dng$").select("project", F.regexp_extract("path", r"frame_([0-9]+)\.dng$", 1).try_cast("long").alias("seq")).filter("project <> '' and seq is not null")
    counted = frames.groupBy("project").agg(F.count(F.lit(1)).alias("frames"), F.min("seq").alias("first_frame"), F.max("seq").alias("last_frame"), F.count_distinct("seq").alias("d"))
    counted = counted.withColumn("contiguous", (F.col("frames") == F.col("last_frame") - F.col("first_frame") + 1) & (F.col("d") == F.col("frames"))).drop("d")
    text = pick("metadata.json", r"/([^/]+)/metadata\.json$").select("project", F.decode("content", "UTF-8").alias("raw"))
    meta = text.withColumn("m", F.from_json("raw", "project_name string, film_format string")).select(
        "project", F.lit(True).alias("has_metadata"), F.nullif(F.trim("m.project_name"), F.lit("")).alias("declared"), F.col("m.film_format").alias("film_format"), F.expr("try_parse_json(raw)").isNotNull().alias("readable")
    )
    both = counted.join(meta, "project", "full")
    warn = F.array_compact(
        F.array(
            F.when(F.col("has_metadata").isNull(), "no metadata"), F.when(~F.col("readable"), "metadata is not JSON"), F.when(F.col("frames").isNull(), "no frames"),
            F.when(~F.col("contiguous"), "frames have gaps"), F.when(F.col("has_metadata") & F.col("declared").isNull(), "no project name"),
        )
    )
    named = both.select(F.coalesce("declared", "project").alias("name"), "project", "film_format", F.coalesce("frames", F.lit(0).cast("long")).alias("frames"), "first_frame", "last_frame", F.coalesce("contiguous", F.lit(False)).alias("contiguous"), (F.coalesce("frames", F.lit(0)) > 0).alias("available"), warn.alias("warnings"))
    return named.orderBy(F.lower("name"), F.lower("project"))


def calibrations(spark: SparkSession, folders: list[str]) -> DataFrame:
    """One row per calibration id of all *.metadata.json: the first folder wins; unusable ones say why."""
    schema = "calibration_id string, display_name string, config string, requires array<string>, artifact string, artifact_sha256 string, film_formats array<string>"
    rows, files = None, None
    for k, folder in enumerate(dict.fromkeys(folders)):
        every = spark.read.format("binaryFile").load(folder).select(F.lit(k).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha"), F.decode("content", "UTF-8").alias("raw"))
        described = every.filter(F.col("file").endswith(".metadata.json")).select("folder", "file", F.from_json("raw", schema).alias("m")).select("folder", "file", "m.*").filter("config <> ''")
        rows, files = (described, every) if rows is None else (rows.unionByName(described), files.unionByName(every))
    if rows is None:
        return spark.createDataFrame([], "calibration_id string, display_name string, available boolean, reason string")
    rows = rows.withColumn("calibration_id", F.coalesce("calibration_id", F.regexp_extract("config", r"([^/]+?)(\.[^./]*)?$", 1)))
    first = rows.withColumn("n", F.row_number().over(W.partitionBy("calibration_id").orderBy("folder", "file"))).filter("n = 1").drop("n")
    needed = first.select("calibration_id", "folder", "artifact_sha256", F.coalesce("artifact", "config").alias("artifact"), F.explode(F.array_distinct(F.concat(F.array("config"), F.coalesce("requires", F.array().cast("array<string>"))))).alias("file"))
    held = needed.join(files.select("folder", "file", "sha"), ["folder", "file"], "left")
    bad = F.when(F.col("sha").isNull(), F.concat(F.lit("missing: "), "file")).when((F.col("file") == F.col("artifact")) & (F.col("sha") != F.col("artifact_sha256")), F.concat(F.lit("changed: "), "file"))
    state = held.groupBy("calibration_id").agg(F.array_join(F.array_sort(F.collect_list(bad)), "; ").alias("reason"))
    return first.join(state, "calibration_id").select("calibration_id", F.coalesce("display_name", "calibration_id").alias("display_name"), (F.col("reason") == "").alias("available"), F.nullif("reason", F.lit("")).alias("reason")).orderBy("calibration_id")
