"""CSV, JSON and image scans, and atomic sinks."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkspool.functions.text import clean_keywords, clean_title

#: Extensions of images (fixed values).
IMAGES = (".jpg", ".jpeg", ".png", ".webp")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV table, all cells text, '' for empty ones; a missing file with given columns is an empty table.

    Byte order marks, CRLF, doubled quotes and line ends inside quotes are read;
    nothing is inferred, so hashes and numbers in titles stay as they are.
    """
    if columns and not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    out = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, encoding="UTF-8")
    return out.toDF(*(c.lstrip("﻿") for c in out.columns)).fillna("")


def read_json(spark: SparkSession, path: str, schema: str, default: DataFrame | None = None) -> DataFrame:
    return default if default is not None and not exists(spark, path) else spark.read.schema(schema).json(path, multiLine=True)


def _below(path, folder: str):
    """Whether a file URI lies below a folder, given as a URI or an absolute path."""
    return F.regexp_replace(path, "^file:/+", "/").startswith(re.sub("^file:/+", "/", folder).rstrip("/") + "/")


def read_images(spark: SparkSession, path: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """The image files below a folder, by extension, without those below the given folders (whole paths).

    A folder to leave out that is the scanned one itself is scanned. ``parts`` is the
    path in parts: ordered by it, files come as a directory walk meets them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    keep = F.lower("path").rlike("(?:" + "|".join(re.escape(x) for x in IMAGES) + ")$")
    plain = lambda p: re.sub("^file:/+", "/", p).rstrip("/")
    for folder in leave_out:
        if plain(folder) != plain(path):
            keep = keep & ~_below(F.col("path"), folder)
    return files.filter(keep).withColumn("parts", F.split("path", "/"))


def read_manual(spark: SparkSession, path: str) -> DataFrame:
    """Manual metadata, cleaned: Filename, title, keywords, category, source. A name twice, or unusable metadata, fails."""
    rows = unique_manual(read_csv(spark, path, ["Filename", "Title", "Keywords", "Category"]))
    title, keywords = clean_title(F.col("Title")), clean_keywords(F.split("Keywords", ","))
    bad = F.raise_error(F.concat(F.lit("unusable metadata for "), F.col("Filename")))
    category = F.col("Category") if "Category" in rows.columns else F.lit("")
    return rows.select("Filename", F.coalesce(title, bad.cast("string")).alias("title"), F.coalesce(keywords, bad.cast("array<string>")).alias("keywords"), category.alias("category"), F.lit("manual").alias("source"))


def unique_manual(rows: DataFrame, key: str = "Filename") -> DataFrame:
    """rows; reading them fails if a key comes twice."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    checked = rows.join(counts, key)
    return checked.withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate "), F.col(key)))).otherwise(F.lit(True))).filter("_ok").select(*rows.columns)


def replace_parquet(df: DataFrame, path: str) -> None:
    """Writes beside the target and then takes its place; what was there stays until the new table is whole.

    There is a moment between the two renames without a target: readers may see it.
    If the second rename fails, the old table is put back.
    """
    spark = df.sparkSession
    staged, old = f"{path}.{uuid.uuid4().hex}.new", f"{path}.{uuid.uuid4().hex}.old"
    df.write.parquet(staged)
    _swap(spark, staged, path, old)


def _swap(spark: SparkSession, staged: str, path: str, old: str) -> None:
    fs, target = _fs(spark, path)
    new, gone = _fs(spark, staged)[1], _fs(spark, old)[1]
    there = fs.exists(target)
    if there and not fs.rename(target, gone):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(new, target):
        if there:
            fs.rename(gone, target)
        raise OSError(f"cannot move {staged} to {path}")
    if there:
        fs.delete(gone, True)


def write_csv(df: DataFrame, path: str, order: str | None = None) -> None:
    """One CSV file at a path: header, minimal quotes, CRLF, nothing for empty cells; sorted by a column.

    One task writes it, as it is one file: for tables that people open. It takes the
    place of an earlier one when it is whole.
    """
    spark = df.sparkSession
    staged = f"{path}.{uuid.uuid4().hex}.new"
    one = df.repartition(1).sortWithinPartitions(order) if order else df.coalesce(1)
    one.write.csv(staged, header=True, escape='"', emptyValue="", lineSep="\r\n")
    fs, folder = _fs(spark, staged)
    part = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    _swap(spark, part.toString(), path, f"{path}.{uuid.uuid4().hex}.old")
    fs.delete(folder, True)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; a NaN or infinite number fails."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    for c in doubles:
        bad = F.isnan(c) | (F.abs(c) == float("inf"))
        df = df.withColumn(c, F.when(bad, F.raise_error(F.lit(f"{c} is no finite number")).cast("double")).otherwise(F.col(c)))
    df.write.mode("overwrite").json(path)
