"""The corpus pipeline: five stages over documents, each over all that its predecessor kept.

Quality rules drop rejected documents and take failing lines out of the others;
near-duplicate detection keeps one document of each group; decontamination drops
documents that hold a benchmark item; secret scans replace secrets in the texts;
mixing says how many words of every document the training mix takes.

Cases: rows, not doc_ids, are what is kept or dropped, so rows with a null or a
shared doc_id are judged by their own texts; a null or blank text fails the quality
rules, and reaching a later stage it is linked with none but blank rows of its own
doc_id, holds nothing and has no words to take; of equal rows one is kept, but of
rows with a null doc_id all, as nothing says that they are one document; a null
source is a source of its own; an empty table gives no rows; extra columns of any
names pass through all stages but the last.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspool.llm import decontaminate, mixing, neardup, quality, secrets
from inkspool.session import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


_made: list[Scratch] = []


def scratch_of(spark: SparkSession, stage: str, docs: DataFrame) -> Scratch:
    """A folder for a stage's intermediate tables. Those of the stages before go: their
    results have been written by now, unless docs still reads from them or is to be cached."""
    if not docs.is_cached:
        files = docs.inputFiles()
        for old in [x for x in _made if not any(x.root in f for f in files)]:
            _made.remove(old)
            if old.spark is spark:  # else its session has ended, and its tables with it
                old.drop_all()
        gc.collect()
        spark._jvm.System.gc()  # lets the cleaner delete shuffles that nothing refers to any more
    _made.append(Scratch(spark, stage))
    return _made[-1]


def rows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """row (a key of its own: a doc_id can be null or stand for several texts) and doc with all columns."""
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    return scratch.cut(docs.select(F.monotonically_increasing_id().alias("row"), doc), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = scratch_of(spark, "near_dedup", docs)
    own = rows(docs, scratch)
    keys = own.select("row", F.col("doc.doc_id").alias("id"), F.col("doc.text").alias("text"))
    without = keys.filter("id is null").select("row")  # linked with nothing
    groups = neardup.near_duplicates(keys.filter("id is not null").select(F.col("row").alias("doc_id"), "text"), scratch)
    # A text without words is linked with none but those of its own doc_id.
    groups = groups.select(F.col("doc_id").alias("row"), F.when(F.col("n_shingles") > 0, F.col("component_id")).alias("group"))
    groups = groups.join(keys.select("row", "id", F.xxhash64("text").alias("hash")), "row")
    first = groups.groupBy("group", F.when(F.col("group").isNull(), F.col("id")).alias("blank")).agg(F.min(F.struct("id", "hash", "row")).alias("first"))
    return own.join(first.select("first.row").union(without), "row", "left_semi").select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = rows(docs, scratch_of(spark, "decontamination", docs))
    found = decontaminate.contaminated(own.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return own.join(found.select(F.col("doc_id").alias("row")).distinct(), "row", "left_anti").select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch_of(spark, "secret_scan", docs)
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch_of(spark, "mixing", docs)
    return mixing.taken(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.cut(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")  # read by nothing any more
    return docs


#: Random fields and similarity joins are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None
