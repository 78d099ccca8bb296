"""Assets: content identity, jobs, metadata lookup and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspool.functions.text import safe_stem, stem

#: Statuses that the pipeline itself sets (fixed values).
PIPELINE_STATUS = ("ready", "needs_metadata", "needs_review", "failed")


def hashed(files: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """(asset_id, path, parts) of files; a missing content has a null id. Paths are ordered by their parts, as a directory walk meets them."""
    return files.select(F.sha2(F.col(content).cast("binary"), 256).alias("asset_id"), F.col(path).alias("path"), F.split(F.col(path).cast("string"), "/").alias("parts"))


def content_groups(files: DataFrame, content: str = "content", path: str = "path") -> tuple[DataFrame, DataFrame]:
    """(one row per content: asset_id, copies, first_source; and membership: asset_id, path).

    The sources of a content stay rows: a content with very many copies is counted
    on the way to its row and never becomes one long list. Files without content
    belong to no group.
    """
    members = hashed(files, content, path).filter("asset_id is not null")
    groups = members.groupBy("asset_id").agg(F.count("*").alias("copies"), F.min_by("path", "parts").alias("first_source"))
    return groups, members.select("asset_id", "path")


def unique_names(rows: DataFrame, name: str, to: str = "unique_name") -> DataFrame:
    """rows with a flag for names that occur once; names are counted before they meet the rows."""
    counts = rows.groupBy(name).agg((F.count("*") == 1).alias(to))
    return rows.join(counts.withColumnRenamed(name, "_name"), F.col(name).eqNullSafe(F.col("_name"))).drop("_name")


def job_name(first_source: Column, asset_id: Column, saved: Column) -> Column:
    """The saved basename, or the safe stem and the first twelve digits of the hash."""
    return F.coalesce(F.nullif(saved, F.lit("")), F.concat(safe_stem(first_source), F.lit("__"), F.substring(asset_id, 1, 12)))


def status(source: Column, passed: Column) -> Column:
    return F.when(~F.coalesce(source, F.lit("")).isin("ai", "manual"), "needs_metadata").when(F.coalesce(passed, F.lit(False)), "ready").otherwise("needs_review")


def routed(assets: DataFrame) -> DataFrame:
    """Where each asset's row goes and which table it leaves, and its files."""
    ready = F.col("status") == "ready"
    files = F.filter(F.array(F.lit("svg"), F.when(F.col("eps").isNotNull(), "eps")), lambda x: x.isNotNull())
    return assets.withColumn("target", F.when(ready, "metadata").otherwise("review")).withColumn("leaves", F.when(ready, "review").otherwise("metadata")).withColumn("files", files)


def manual_lookup(jobs: DataFrame, manual: DataFrame, svg: str, source: str, unique: str, value: str) -> DataFrame:
    """jobs with the manual value of the SVG name, else of the source name where that is unique in the batch.

    manual: (name, value), one row per name.
    """
    by_svg = manual.select(F.col("name").alias("_svg"), F.col(value).alias("_by_svg"))
    by_source = manual.select(F.col("name").alias("_source"), F.col(value).alias("_by_source"))
    out = jobs.join(by_svg, F.col(svg) == F.col("_svg"), "left").join(by_source, (F.col(source) == F.col("_source")) & F.col(unique), "left")
    return out.withColumn(value, F.coalesce("_by_svg", "_by_source")).drop("_svg", "_by_svg", "_source", "_by_source")


def seen_once(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of every key in the given order, without a sort of the whole table."""
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*columns), F.col(order)).alias("_row")).select(key, "_row.*")


def size_guard(rows: DataFrame, length: str = "length", most: int = 45_000_000) -> DataFrame:
    return rows.withColumn("size_error", F.col(length) > most)


def quality_warnings(blank: Column, mae: Column, drift: Column, live_text: Column, alpha: Column, mae_limit: float = 0.10, drift_limit: float = 0.05) -> Column:
    """The warnings of a rendering; an asset passes when there are none."""
    drift = F.when(blank, F.lit(1.0)).otherwise(F.coalesce(drift, F.lit(1.0)))
    each = [F.when(blank, "blank"), F.when(mae > mae_limit, "mae"), F.when(drift > drift_limit, "drift"), F.when(live_text, "text"), F.when(alpha, "alpha")]
    return F.array_compact(F.array(*each))


def pending(manifest: DataFrame) -> DataFrame:
    """Assets that wait for metadata."""
    return manifest.filter(F.col("status") == "needs_metadata")


def ready(manifest: DataFrame) -> DataFrame:
    return manifest.filter(F.col("status") == "ready")


def jobs(groups: DataFrame, members: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """One job per content, with the basename that the manifest saved for it or a new one, and whether its source's name is used once in the batch.

    groups, members: of ``content_groups``; manifest: (asset_id, basename, ...), one row per asset.
    """
    name = lambda path: F.element_at(F.split(path, "/"), -1)
    names = members.groupBy(name(F.col("path")).alias("_name")).agg((F.count("*") == 1).alias("unique_source_name"))
    out = groups.join(manifest.select("asset_id", F.col("basename").alias("_saved")), "asset_id", "left")
    out = out.withColumns({"_name": name(F.col("first_source")), "basename": job_name(F.col("first_source"), F.col("asset_id"), F.col("_saved")), "force": F.lit(force)})
    return out.join(names, "_name").drop("_name", "_saved")


def repaired(files: DataFrame, manifest: DataFrame, metadata: DataFrame, outputs: DataFrame) -> DataFrame:
    """What a repair does with existing outputs: one row per content that has an SVG.

    files: (asset_id, path, parts) of ``hashed``, of inputs and archived inputs
    together; manifest: (asset_id, svg, passed); metadata: (svg, source); outputs:
    (svg) that exist. The first file of a content decides. An output without a
    manifest row goes by the file's name, has no evidence of quality and so goes to
    review; one without metadata of a model stays pending. Contents can share an SVG:
    its metadata count once, as a model's if any row of them is.
    """
    first = files.groupBy("asset_id").agg(F.min_by("path", "parts").alias("path"))
    out = first.join(manifest.select("asset_id", F.col("svg").alias("_svg"), "passed"), "asset_id", "left")
    out = out.withColumn("svg", F.coalesce(F.nullif(F.col("_svg"), F.lit("")), F.concat(stem(F.col("path")), F.lit(".svg")))).drop("_svg")
    out = out.join(outputs.select("svg").distinct(), "svg", "left_semi").join(metadata.filter("source = 'ai'").select("svg", F.lit(True).alias("_ai")).distinct(), "svg", "left")
    status = F.when(F.col("_ai").isNull(), "needs_metadata").when(F.coalesce("passed", F.lit(False)), "ready").otherwise("needs_review")
    return out.select("asset_id", "path", "svg", status.alias("status"))


def resumable(manifest: DataFrame) -> DataFrame:
    """Pending assets with what keeps each from being resumed, if anything.

    manifest: flags svg_there, eps_named, eps_there, passed (null without a quality
    result) and preview_there; a missing preview is rendered again.
    """
    error = F.when(~F.coalesce("svg_there", F.lit(False)), "svg").when(F.coalesce("eps_named", F.lit(False)) & ~F.coalesce("eps_there", F.lit(False)), "eps").when(F.col("passed").isNull(), "quality")
    return pending(manifest).withColumn("error", error).withColumn("render", F.col("error").isNull() & ~F.coalesce("preview_there", F.lit(False)))


def eps_conversion(svgs: DataFrame, metadata: DataFrame) -> DataFrame:
    """SVG files by name with the name of their EPS and the metadata of the SVG's row: (svg, eps, title, keywords, category)."""
    rows = metadata.select(F.col("Filename").alias("svg"), F.col("Title").alias("title"), F.transform(F.split("Keywords", ","), lambda k: F.trim(k)).alias("keywords"), F.col("Category").alias("category"))
    return svgs.select("svg").withColumn("eps", F.concat(stem(F.col("svg")), F.lit(".eps"))).join(rows, "svg", "left")


def eps_counts(results: DataFrame) -> DataFrame:
    """(valid, failed) of conversion results (ok)."""
    return results.agg(F.count_if("ok").alias("valid"), F.count_if(~F.col("ok")).alias("failed"))


def newest(names: DataFrame, name: str = "name", pattern: str = "adobe_scrape_%.csv") -> DataFrame:
    """The last of the names of a pattern (the default is a fixed value), in their order; no row if there is none."""
    return names.filter(F.col(name).like(pattern)).agg(F.max(name).alias(name)).filter(F.col(name).isNotNull())


def free_models(models: DataFrame, most: int = 2) -> DataFrame:
    """The first free models that take images, in the order of their list (position)."""
    return models.filter(F.col("id").endswith(":free") & F.array_contains("modalities", "image")).orderBy("position").limit(most)
