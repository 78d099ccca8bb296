"""Keyed changes of tables, with history that people entered kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.functions.text import known
from inkspool.operators.assets import PIPELINE_STATUS

#: Columns of a production log that pipeline output never resets (fixed values).
PROTECTED = ("status", "accepted_date", "submitted", "reject_reason", "notes", "dl_latest", "royalty_usd")
SET_ONCE = ("niche", "style")


def last_rows(rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key: the last in the order of a column; without one, any of those with a key (of equal rows)."""
    if order is None:
        return rows.dropDuplicates([key])
    columns = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("_row")).select(key, "_row.*").select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, key: str, sticky: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """old with new's rows put over it by key, the last of each by ``order``; an empty new value of a sticky column keeps the old one."""
    o, n = old.alias("o"), last_rows(new, key, order).alias("n")
    columns = []
    for c in old.columns:
        before, after = F.col(f"o.{c}"), F.col(f"n.{c}")
        if c == key:
            columns.append(F.coalesce(after, before).alias(c))
        elif c in sticky:
            columns.append(F.coalesce(known(after), before, after).alias(c))
        else:
            columns.append(F.when(F.col(f"n.{key}").isNotNull(), after).otherwise(before).alias(c))
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*columns)


def delete(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return old.join(keys.select(key).distinct(), key, "left_anti").select(*old.columns)


def absent(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """The rows of new whose key old lacks, the first of each key by ``order``; their number is the number added."""
    first = new.dropDuplicates([key]) if order is None else new.groupBy(key).agg(F.min_by(F.struct(*(c for c in new.columns if c != key)), F.col(order)).alias("_row")).select(key, "_row.*").select(*new.columns)
    return first.join(old.select(key), key, "left_anti").select(*new.columns)


def insert_absent(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """old and the rows of new whose key it lacks; columns of either survive."""
    return old.unionByName(absent(old, new, key, order), allowMissingColumns=True)


#: Columns of a production log, in their order (fixed list).
LOG_FIELDS = ("filename", "asset_id", "adobe_asset_id", "niche", "style", "batch_date", "submitted", "status", "pipeline_status", "reject_reason",
              "accepted_date", "first_seen_accepted", "dl_30d", "dl_60d", "dl_90d", "notes", "dl_latest", "dl_date", "royalty_usd", "production_seconds")


def with_known_fields(log: DataFrame) -> DataFrame:
    """The log with all known fields first, then its own others, as they come; '' where a field is missing."""
    others = [c for c in log.columns if c not in LOG_FIELDS]
    return log.select(*(F.col(c) if c in log.columns else F.lit("").alias(c) for c in LOG_FIELDS), *others)


def put_latest(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """A state table (one row per key) after new rows: the last by ``order`` takes a key's place whole; columns of either survive."""
    last = last_rows(new, key, order)
    return old.join(last.select(key), key, "left_anti").unionByName(last, allowMissingColumns=True)


def record(log: DataFrame, new: DataFrame, key: str = "filename") -> DataFrame:
    """The production log after pipeline output (new, with pipeline_status).

    Protected columns keep their values, niche and style are set once, and the
    status follows the pipeline only while it still is one of the pipeline's.
    Extra columns of the log survive.
    """
    o, n = log.alias("o"), new.alias("n")
    there, came = F.col(f"o.{key}").isNotNull(), F.col(f"n.{key}").isNotNull()
    columns = []
    for c in dict.fromkeys([*log.columns, *new.columns]):
        before = F.col(f"o.{c}") if c in log.columns else F.lit(None)
        after = F.col(f"n.{c}") if c in new.columns else F.lit(None)
        if c == key:
            value = F.coalesce(before, after)
        elif c == "status":
            fresh = F.coalesce(F.col("n.pipeline_status"), F.lit("ready"))
            value = F.when(~there, fresh).when(came & before.isin(*PIPELINE_STATUS), F.coalesce(F.col("n.pipeline_status"), before)).otherwise(before)
        elif c in PROTECTED:
            value = before
        elif c not in new.columns:
            value = before
        elif c in SET_ONCE:
            value = F.coalesce(known(before), F.when(came, after), before)
        else:
            value = F.when(came, after).otherwise(before)
        columns.append(value.alias(c))
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(*columns)
