"""The corpus pipeline: each stage applies one operator of strandline.llm to all that its predecessor kept.

toxicity     rejects documents that the classifier chain calls toxic
near_copies  keeps the first document of each group of similar texts
leaks        rejects documents that hold a benchmark item
secrets      replaces found secrets in the text by [kind]; no document goes
mix          takes documents by the target weights, with `copies`

Null and empty texts pass the filters (one of them stays as the first of its group), other columns stay as they are,
whatever their names, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, mixing, secrets, simhash, toxicity
from strandline.llm.common import stored, table


def _packed(docs: DataFrame) -> DataFrame:
    """Id and text, and the whole row as one column, so that no column of the documents can clash with an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", F.col("text").cast("string").alias("text"))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.learn(docs, toxicity.labels_of(spark, sf_dir))
    return toxicity.classify(_packed(docs), chain).filter(~F.col("is_toxic")).select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.with_leaks(_packed(docs), table(spark, sf_dir, "benchmark")).filter(F.size("leaks") == 0).select("__row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(secrets.scan_secrets(_packed(docs)))
    row = F.col("__row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.size("found") > 0, F.char_length("text").cast(kind)).otherwise(F.col("__row.n_chars")))
    return clean.select(row.alias("__row")).select("__row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


#: (name, function of (spark, docs, sf_dir)) in order.
STAGES = [("toxicity", reject_toxic), ("near_copies", drop_near_copies), ("leaks", drop_leaks), ("secrets", redact_secrets), ("mix", mix)]

#: The stages hold trained models and set similarity, which SQL cannot express; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
