"""Dated cumulative observations: resolution, validation and the order-sensitive fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkspool.functions.text import iso_date, known, normal_title

EXPLICIT = ("accepted", "rejected", "submitted", "pending")


def resolve(rows: DataFrame, log: DataFrame, metadata: DataFrame) -> DataFrame:
    """rows (seq, title, filename, external_id) with file and outcome: matched, ambiguous or unmatched.

    The first stage with a candidate decides: external id in the log, a known
    file name, the normalised title. Candidates are counted per key before they
    are joined, so a key of many rows makes no product. A file that the log
    knows under another external id is ambiguous.
    """
    def index(keys: DataFrame, key: str, name: str) -> DataFrame:
        return keys.groupBy(F.col(key).alias(f"_{name}")).agg(F.countDistinct("file").alias(f"_{name}_n"), F.min("file").alias(f"_{name}_file"))

    ids = index(log.select(known(F.col("external_id")).alias("k"), F.col("filename").alias("file")).filter("k is not null"), "k", "id")
    files = log.select(F.col("filename").alias("file")).union(metadata.select("filename")).distinct().select(F.col("file").alias("_direct"))
    titles = index(metadata.select(normal_title(F.col("title")).alias("k"), F.col("filename").alias("file")), "k", "title")
    owners = log.groupBy(F.col("filename").alias("_owner")).agg(F.max(known(F.col("external_id"))).alias("_owned"))
    out = rows.withColumn("_key", normal_title(F.col("title")))
    # Most rows have no id and many no file name: those are not sent to the one task that null keys would hash to.
    def by(rows: DataFrame, column: str, table: DataFrame, key: str) -> DataFrame:
        has = known(F.col(column)).isNotNull()
        found = rows.filter(has).join(table, F.col(column) == F.col(key), "left")
        return found.unionByName(rows.filter(~has), allowMissingColumns=True)

    out = by(by(out, "external_id", ids, "_id"), "filename", files, "_direct").join(titles, F.col("_key") == F.col("_title"), "left")
    many = F.when(F.col("_id_n") > 0, F.col("_id_n")).when(F.col("_direct").isNotNull(), 1).otherwise(F.coalesce("_title_n", F.lit(0)))
    file = F.when(F.col("_id_n") > 0, F.col("_id_file")).when(F.col("_direct").isNotNull(), F.col("_direct")).otherwise(F.col("_title_file"))
    out = out.withColumn("_many", many).withColumn("file", F.when(many == 1, file))
    out = by(out, "file", owners, "_owner")
    clash = known(F.col("external_id")).isNotNull() & F.col("_owned").isNotNull() & (F.col("_owned") != F.col("external_id"))
    outcome = F.when(F.col("_many") == 0, "unmatched").when((F.col("_many") > 1) | clash, "ambiguous").otherwise("matched")
    return out.withColumn("outcome", outcome).select(*rows.columns, "file", "outcome")


#: Other names of the columns of observations, in order of precedence (fixed names).
ALIASES = {"external_id": ("adobe_asset_id", "asset_id", "id"), "filename": ("filename", "Filename"), "observed": ("last_seen", "observed_date"), "title": ("title",), "downloads": ("downloads",), "accepted": ("accepted_date",), "royalty": ("royalty_usd",), "explicit": ("status",)}


def named(rows: DataFrame) -> DataFrame:
    """Scraped rows under the names used here: of each column's other names, the first that holds something."""
    there = set(rows.columns)
    columns = [F.coalesce(*(known(F.col(c)) for c in names if c in there), F.lit("")).alias(k) if there & set(names) else F.lit("").alias(k) for k, names in ALIASES.items()]
    explicit = [F.lower(F.trim(F.col("explicit"))).alias("explicit")]
    out = rows.select(*(["seq"] if "seq" in there else []), *columns)
    return out.select(*(c for c in out.columns if c != "explicit"), *explicit)


def validate(rows: DataFrame) -> DataFrame:
    """Text rows (downloads, observed, accepted, royalty) with typed dt, d, acc, roy and valid."""
    dt, acc = iso_date(F.col("observed")), iso_date(known(F.col("accepted")))
    d, roy = F.trim("downloads").try_cast("long"), known(F.col("royalty")).try_cast("double")
    finite = known(F.col("royalty")).isNull() | (roy.isNotNull() & ~F.isnan(roy) & (F.abs(roy) != float("inf")) & (roy >= 0))
    good_acc = known(F.col("accepted")).isNull() | (acc.isNotNull() & (acc <= dt))
    valid = dt.isNotNull() & d.isNotNull() & (d >= 0) & good_acc & finite
    return rows.withColumns({"dt": dt, "d": d, "acc": acc, "roy": roy, "valid": F.coalesce(valid, F.lit(False))})


def monotone(rows: DataFrame, key: str = "file") -> DataFrame:
    """rows with ok: no earlier row of the same key and day has a higher count."""
    day = Window.partitionBy(key, "dt").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("ok", F.coalesce(F.col("d") >= F.max("d").over(day), F.lit(True)))


def fold(rows: DataFrame, key: str = "file", since: str | None = None) -> DataFrame:
    """The state of each key after its accepted rows (seq, dt, d, acc, roy, explicit), in their order.

    dl_latest, dl_date, royalty: of the last row that is not older than the one
    before it; first_seen: the earliest day with evidence of acceptance;
    accepted_date: the first given; status: the last that a row states or implies.
    since: a column with the date that the key has reached before. The rows are dealt
    by key once, which serves both windows and the aggregate.
    """
    ok = monotone(rows.repartition(key), key).filter("ok")
    order = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    evidence = (F.col("explicit") == "accepted") | F.col("acc").isNotNull() | (F.col("d") > 0)
    said = F.when(F.col("explicit").isin(*EXPLICIT), F.col("explicit")).when(evidence, "accepted")
    reached = F.greatest(F.max("dt").over(order), F.col(since)) if since else F.max("dt").over(order)
    ok = ok.withColumns({"record": F.coalesce(F.col("dt") >= reached, F.lit(True)), "evidence": F.coalesce(evidence, F.lit(False)), "said": said})
    last = lambda value, when: F.max_by(value, F.when(when, F.col("seq")))
    return ok.groupBy(key).agg(
        F.count("*").alias("observations"),
        last("d", F.col("record")).alias("dl_latest"),
        F.max("dt").alias("dl_date"),
        last("roy", F.col("record") & F.col("roy").isNotNull()).alias("royalty"),
        F.min(F.when(F.col("evidence"), F.col("dt"))).alias("first_seen"),
        F.min_by("acc", F.when(F.col("acc").isNotNull(), F.col("seq"))).alias("accepted_date"),
        last("said", F.col("record") & F.col("said").isNotNull()).alias("status"),
    )


def history(rows: DataFrame, key: str = "file") -> DataFrame:
    """One row per key and day: the last accepted count, and the last royalty known that day."""
    ok = monotone(rows.repartition(key), key).filter("ok")
    return ok.groupBy(key, "dt").agg(F.max_by("d", "seq").alias("downloads"), F.max_by("roy", F.when(F.col("roy").isNotNull(), F.col("seq"))).alias("royalty"))


def resume(rows: DataFrame, log: DataFrame, past: DataFrame, key: str = "file") -> DataFrame:
    """The fold of later rows on top of a fold (log) and the history (past) of the earlier ones.

    A count below that of the same day in the past is dropped, a row older than
    the log's date changes no latest value. Keys of either side are returned.
    """
    floor = past.select(key, "dt", F.col("downloads").alias("_floor"))
    dated = log.select(key, F.col("dl_date").alias("_date"))
    kept = rows.join(floor, [key, "dt"], "left").filter("_floor is null or d >= _floor").drop("_floor")
    new = fold(kept.join(dated, key, "left"), key, "_date").alias("n")
    old = log.alias("o")
    o, n = (lambda c, t=t: F.col(f"{t}.{c}") for t in "on")
    merged = {
        "observations": F.coalesce(o("observations"), F.lit(0)) + F.coalesce(n("observations"), F.lit(0)),
        "dl_latest": F.coalesce(n("dl_latest"), o("dl_latest")),
        "dl_date": F.greatest(o("dl_date"), n("dl_date")),
        "royalty": F.coalesce(n("royalty"), o("royalty")),
        "first_seen": F.least(o("first_seen"), n("first_seen")),
        "accepted_date": F.coalesce(o("accepted_date"), n("accepted_date")),
        "status": F.coalesce(n("status"), o("status")),
    }
    return old.join(new, o(key) == n(key), "full_outer").select(F.coalesce(o(key), n(key)).alias(key), *(c.alias(name) for name, c in merged.items()))
