"""Operator 1: line-first quality rules, as column expressions only.

Every line is judged first, by a navigation, a punctuation and a boilerplate
rule; failing lines are taken out, and a document that thereby loses too many
of its characters is rejected. The document-level base rules (too few words,
too many repeated word windows) are added to that.

Cases: a null or blank text has no words, fails the base rules and is not kept.
Repeated rows are judged one by one. Extra columns, whatever their names, pass
through ``clean``; ``measure`` puts its own in place of those of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = r"[\x20\x09-\x0D]"
WORD_AT_ALL = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Fixed phrases of page furniture; they count only in short lines.
BOILERPLATE = (
    "cookie", "privacy policy", "terms of use", "terms of service", "javascript", "all rights reserved",
    "subscribe", "newsletter", "click here", "sign up", "log in", "read more", "back to top", "skip to content",
)


#: So many repeated windows of a text are looked up one by one.
FEW = 16


@dataclass(frozen=True)
class Rules:
    """min_words, repeat_percent: base rules. The others are per line, but for
    lost_percent: a document that loses a larger share of its word characters
    than that is rejected."""

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    bang_percent: int = 20
    upper_percent: int = 70
    bar_percent: int = 20
    furniture_chars: int = 120
    lost_percent: int = 50


def _columns(text: Column) -> dict[str, Column]:
    """What the base rules and the line rules need, in steps that build on each other."""
    plain = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(plain, F.lit(" \t\n\x0b\f\r"))
    return {"_text": plain, "_words": F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{WS}+"))}


def line_failure(line: Column, rules: Rules = Rules()) -> Column:
    """The first rule that a line with words fails, or null.

    Every rule starts with a test that most lines end at, so that the counts
    behind it are made for few lines only.
    """
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    chars = F.length(F.regexp_replace(line, f"{WS}+", ""))
    words = count(f"{WORD_AT_ALL}+")
    upper, lower = count("[A-Z]"), F.length(line) - F.length(F.regexp_replace(line, "[a-z]+", ""))
    furniture = F.lower(line).rlike("|".join(BOILERPLATE))
    bars = count(r"(?:^|[\x20\x09-\x0D])[|>»•·](?=$|[\x20\x09-\x0D])")
    return (
        F.when(line.rlike("[|>»•·]") & (bars * 100 > words * rules.bar_percent), "navigation")
        .when(line.rlike(SYMBOLS) & (count(SYMBOLS) * 100 > chars * rules.symbol_percent), "punctuation")
        .when(line.contains("!!") & (count("!!+") * 100 > words * rules.bang_percent), "punctuation")
        .when((upper >= 20) & (upper * 100 > (upper + lower) * rules.upper_percent) & (words >= 3), "punctuation")
        .when((F.length(line) <= rules.furniture_chars) & furniture, "boilerplate")
    )


#: The columns that ``measure`` adds.
OWN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_failed_lines", "lost_chars", "kept", "clean_text")


def _measured(documents: DataFrame, rules: Rules, text: str) -> DataFrame:
    """The columns of OWN beside ``_row``, the document's own columns in one, where no name can clash."""
    step = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"), *(c.alias(k) for k, c in _columns(F.col(f"`{text}`")).items()))
    # Windows of three words as hashes. Most texts have none twice and are done with that.
    step = step.select(
        "_row", "_text", "_words",
        F.split("_text", "\n").alias("_all_lines"),
        F.expr("""case when size(_words) < 3 then cast(array() as array<bigint>)
                  else transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) end""").alias("_windows"),
    )
    step = step.withColumn("_sorted", F.expr("case when size(array_distinct(_windows)) < size(_windows) then sort_array(_windows) else cast(array() as array<bigint>) end"))
    step = step.withColumn("_twice", F.expr("array_distinct(filter(_sorted, (x, k) -> coalesce(get(_sorted, k - 1) = x, false)))"))
    # Their places: by looking each window up among a few, else by sorting windows with their places.
    step = step.withColumn("_placed", F.expr(f"case when size(_twice) > {FEW} then sort_array(transform(_windows, (h, i) -> struct(h as h, i as i))) else cast(array() as array<struct<h:bigint,i:int>>) end"))
    step = step.withColumn(
        "_at",
        F.expr(f"""case when size(_twice) = 0 then cast(array() as array<int>)
            when size(_twice) <= {FEW} then filter(transform(_windows, (h, i) -> if(array_contains(_twice, h), i, null)), x -> x is not null)
            else sort_array(transform(filter(_placed, (x, k) -> coalesce(get(_placed, k - 1).h = x.h, false) or coalesce(get(_placed, k + 1).h = x.h, false)), x -> x.i)) end"""),
    )
    # Windows overlap: a position adds the words that the one before it did not cover.
    step = step.withColumn("n_repeat_words", F.expr("aggregate(_at, struct(-3 as last, 0L as n), (a, p) -> struct(p as last, a.n + least(3, p - a.last) as n), a -> a.n)"))
    judge = lambda x: F.struct(x.alias("line"), x.rlike(WORD_AT_ALL).alias("words"), F.when(x.rlike(WORD_AT_ALL), line_failure(x, rules)).alias("fault"))
    step = step.select("_row", "_text", "_words", "n_repeat_words", F.transform("_all_lines", judge).alias("_judged"))
    step = step.select(
        "_row", "_text", "_words", "n_repeat_words",
        F.transform(F.filter("_judged", lambda x: x["words"]), lambda x: x["line"]).alias("_lines"),
        F.transform(F.filter("_judged", lambda x: x["fault"].isNotNull()), lambda x: x["line"]).alias("_failed"),
        F.transform(F.filter("_judged", lambda x: x["fault"].isNull()), lambda x: x["line"]).alias("_passed"),
    )
    step = step.select(
        "_row", "n_repeat_words", "_lines", "_failed", "_passed",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_failed").cast("long").alias("n_failed_lines"),
        F.length(F.regexp_replace(F.array_join("_failed", ""), WS, "")).cast("long").alias("lost_chars"),
    )
    failed = (F.col("n_words") < rules.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_percent)
    return step.select(
        "_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_lines", "n_failed_lines", "lost_chars",
        (~failed & (F.col("lost_chars") * 100 <= F.col("word_chars") * rules.lost_percent)).alias("kept"),
        F.array_join("_passed", "\n").alias("clean_text"),
    )


def measure(documents: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_lines, n_failed_lines, lost_chars, kept and clean_text (the lines that stay)."""
    others = [c for c in documents.columns if c.lower() not in OWN]
    return _measured(documents, rules, text).select(*(F.col(f"_row.`{c}`").alias(c) for c in others), *OWN)


def clean(documents: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The kept documents with their failing lines taken out; n_chars, if there, follows the text."""
    # The row number keeps the filter above the measures: pushed below, every step would be computed again in the condition.
    out = _measured(documents, rules, text).withColumn("_at", F.monotonically_increasing_id()).filter("kept and _at >= 0")
    columns = [F.col("clean_text").alias(c) if c == text else F.length("clean_text").cast(t).alias(c) if c == "n_chars" else F.col(f"_row.`{c}`").alias(c) for c, t in documents.dtypes]
    return out.select(*columns)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    return measure(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text", "clean_text")


#: The same in DuckDB.
OP1_SQL = rf"""
with base as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
words as (
  select rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from base),
grams as (
  select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select rid, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from words)),
found as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from grams) where n > 1),
repeats as (
  select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from found) group by rid),
lines as (
  select rid, unnest(ls) as l from words),
counted as (
  select rid, l, length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) as chars,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n,
    len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]'), lambda x: x in ('|', '>', chr(187), chr(8226), chr(183)))) as bars,
    length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g')) as symbols,
    len(regexp_extract_all(l, '!!+')) as bangs,
    length(l) - length(regexp_replace(l, '[A-Z]', '', 'g')) as up,
    length(l) - length(regexp_replace(l, '[a-z]', '', 'g')) as low
  from lines),
lost as (
  select rid, count(*) as n_lines, count(*) filter (bad) as n_failed, coalesce(sum(chars) filter (bad), 0) as lost
  from (select *, bars * 100 > n * 20 or symbols * 100 > chars * 10 or bangs * 100 > n * 20
          or (n >= 3 and up * 100 > (up + low) * 70 and up >= 20)
          or (length(l) <= 120 and regexp_matches(lower(l), '{"|".join(BOILERPLATE)}')) as bad from counted)
  group by rid),
made as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(r.n, 0) as bigint) as n_repeat_words,
    cast(coalesce(n_lines, 0) as bigint) as n_lines, cast(coalesce(n_failed, 0) as bigint) as n_failed_lines,
    cast(coalesce(lost, 0) as bigint) as lost_chars
  from words left join repeats r using (rid) left join lost using (rid)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from made)
select *, not base_failed and lost_chars * 100 <= word_chars * 50 as kept from judged
"""
