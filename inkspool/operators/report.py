"""The trailing rate and the report per niche."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspool.functions.text import iso_date, known


def trailing_rate(points: DataFrame, as_of: date, days: int = 30, slack: int = 7, stale: int = 7, key: str = "item") -> DataFrame:
    """(item, rate) of cumulative points (item, dt, n), one per day: the count gained per ``days`` up to ``as_of``.

    The end is the latest point, not older than ``stale`` days; the start is the
    latest point between days and days + slack before it. A range frame finds
    every point's start in one pass per key, so there is one shuffle and no
    range join. A counter that fell has no rate.
    """
    day = points.filter(F.col("dt") <= F.lit(as_of)).select(key, F.unix_date(F.col("dt").cast("date")).alias("day"), "n")
    before = Window.partitionBy(key).orderBy("day").rangeBetween(-(days + slack), -days)
    paired = day.withColumn("start", F.max_by(F.struct("day", "n"), "day").over(before))
    end = paired.groupBy(key).agg(F.max_by(F.struct("day", "n", "start"), "day").alias("e"))
    gained, span = F.col("e.n") - F.col("e.start.n"), F.col("e.day") - F.col("e.start.day")
    fresh = F.unix_date(F.lit(as_of)) - F.col("e.day") <= stale
    return end.select(key, F.when(fresh & (gained >= 0), gained * days / span).alias("rate"))


def log_items(log: DataFrame) -> DataFrame:
    """Report items of a production log, whose cells are text, '' where unknown.

    Downloads: the latest count, else the largest of the 30, 60 and 90 day counts;
    born: the accepted date, else the first day seen accepted.
    """
    count = lambda c: F.coalesce(known(F.col(c)).cast("long"), F.lit(0))
    downloads = F.coalesce(known(F.col("dl_latest")).cast("long"), F.greatest(*map(count, ("dl_30d", "dl_60d", "dl_90d"))))
    born = iso_date(F.coalesce(known(F.col("accepted_date")), known(F.col("first_seen_accepted"))))
    return log.select(F.col("filename").alias("item"), "niche", "status", downloads.alias("downloads"), known(F.col("royalty_usd")).cast("double").alias("royalty"), born.alias("born"))


def verdict(decided: Column, acceptance: Column, observed: Column, per_asset: Column, least: int) -> Column:
    return (
        F.when((decided >= least) & (acceptance < 0.4), "FIX QUALITY")
        .when(observed < least, "HOLD: insufficient observations")
        .when((per_asset >= 1) & (acceptance >= 0.7), "EXPAND TEST")
        .when(per_asset == 0, "REVIEW NICHE")
        .otherwise("HOLD: monitor demand")
    )


def niche_report(items: DataFrame, rates: DataFrame, as_of: date, least: int = 10, key: str = "item") -> DataFrame:
    """One row per niche of items (item, niche, status, downloads, royalty, born)."""
    rows = items.join(rates, key, "left").withColumn("niche", F.coalesce(F.nullif(F.col("niche"), F.lit("")), F.lit("unclassified")))
    accepted = F.col("status") == "accepted"
    rated = accepted & F.col("rate").isNotNull()
    age = F.greatest(F.lit(0), F.datediff(F.lit(as_of), F.col("born")))
    out = rows.groupBy("niche").agg(
        F.count("*").alias("assets"),
        F.count_if(accepted).alias("accepted"),
        F.count_if(F.col("status") == "rejected").alias("rejected"),
        F.sum("downloads").alias("downloads"),
        F.coalesce(F.sum("royalty"), F.lit(0.0)).alias("royalty_usd"),
        F.count("royalty").alias("royalty_known"),
        F.count_if(rated).alias("observed_assets"),
        F.coalesce(F.sum(F.when(rated, F.col("rate"))), F.lit(0.0)).alias("recent_downloads"),
        F.min(F.when(accepted, age)).alias("min_age_days"),
    )
    decided = F.col("accepted") + F.col("rejected")
    out = out.withColumn("acceptance_rate", F.when(decided > 0, F.col("accepted") / decided))
    out = out.withColumn("downloads_per_asset", F.when(F.col("observed_assets") > 0, F.col("recent_downloads") / F.col("observed_assets")))
    return out.withColumn("verdict", verdict(decided, F.col("acceptance_rate"), F.col("observed_assets"), F.col("downloads_per_asset"), least))
