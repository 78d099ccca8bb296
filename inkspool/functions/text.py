"""Scalar functions of names, titles, dates, keywords and lengths, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The digits of a batch date and the tail of a hash in a file name (fixed patterns).
BATCH, TAIL = r"(?<!\d)(20\d{6})(?:\d{6})?(?!\d)", "__[0-9a-f]{12,64}$"
#: Styles that a file name can carry, in order of precedence (fixed values).
STYLES = ("blue", "line", "solid", "outline")
#: Pixels per unit of an SVG length (fixed values).
UNIT_PIXELS = {"": 1.0, "px": 1.0, "pt": 96 / 72, "pc": 16.0, "in": 96.0, "cm": 96 / 2.54, "mm": 96 / 25.4}


def known(value: Column) -> Column:
    """The value, or null where it is empty: an empty cell means unknown."""
    return F.nullif(value, F.lit(""))


def collapse(text: Column) -> Column:
    """White space of any script as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normal_title(title: Column) -> Column:
    return collapse(F.lower(F.coalesce(title, F.lit(""))))


def iso_date(value: Column) -> Column:
    """The date in the first ten characters; null if they are no zero-padded ISO date."""
    day = F.substring(F.trim(value), 1, 10)
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day.try_cast("date"))


def stem(filename: Column) -> Column:
    base = F.element_at(F.split(filename, "/"), -1)
    return F.regexp_replace(base, r"(?<=.)\.[^.]*$", "")


def file_parts(filename: Column) -> dict[str, Column]:
    """niche, style and batch_date ('' where a name has none)."""
    name = F.regexp_replace(F.lower(stem(filename)), TAIL, "")
    words = F.split(name, r"(?U)[_\s-]+")
    style = F.coalesce(*(F.when(F.array_contains(words, s), s) for s in STYLES), F.lit(""))
    digits = F.regexp_extract(name, BATCH, 1)
    day = F.try_to_date(known(digits), "yyyyMMdd")
    return {"niche": F.element_at(words, 1), "style": style, "batch_date": F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))}


def safe_stem(filename: Column) -> Column:
    """A stem that is safe as a name: 100 characters at most, never empty."""
    return F.coalesce(known(F.substring(F.btrim(F.regexp_replace(stem(filename), "[^A-Za-z0-9_-]+", "_"), F.lit("_")), 1, 100)), F.lit("asset"))


def draft_title(filename: Column) -> Column:
    """A title from a file name: long digit runs go, separators become spaces, 90 characters at most."""
    return F.substring(collapse(F.regexp_replace(F.regexp_replace(stem(filename), r"\d{8,}", ""), "[_-]", " ")), 1, 90)


def clean_title(title: Column) -> Column:
    """The collapsed title, or null if it has none or more than 90 characters."""
    title = collapse(F.coalesce(title, F.lit("")))
    return F.when(F.length(title).between(1, 90), title)


def clean_keywords(keywords: Column) -> Column:
    """Distinct lower-case keywords of one to three words, the first 49; null if fewer than five are left."""
    each = F.transform(keywords, lambda k: collapse(F.lower(k)))
    each = F.filter(each, lambda k: (k != "") & ~k.contains(",") & (F.size(F.split(k, " ")) <= 3))
    each = F.slice(F.array_distinct(each), 1, 49)
    return F.when(F.size(each) >= 5, each)


def unfenced(text: Column) -> Column:
    """Model output without a code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def answer(text: Column, schema: str) -> Column:
    """Model output, fenced or not, as a struct of the schema; null if it is no JSON."""
    return F.from_json(unfenced(text), schema)


def metadata_of(text: Column) -> Column:
    """Model output, fenced or not, as (title, keywords), cleaned; null if either is unusable."""
    raw = answer(text, "title string, keywords array<string>")
    title, keywords = clean_title(raw["title"]), clean_keywords(raw["keywords"])
    return F.when(title.isNotNull() & keywords.isNotNull(), F.struct(title.alias("title"), keywords.alias("keywords")))


def signature(settings: dict[str, Column], digits: int = 16) -> Column:
    """The leading hex digits of the SHA-256 of settings as JSON, in the order of their names."""
    return F.substring(F.sha2(F.to_json(F.struct(*(settings[k].alias(k) for k in sorted(settings)))), 256), 1, digits)


def cache_key(content: Column, version: str, models: list[str]) -> Column:
    """The key of cached model output: it changes with content, prompt version and models."""
    return F.sha2(F.concat(content.cast("binary"), F.lit((version + ",".join(models)).encode())), 256)


def pixel_length(value: Column) -> Column:
    """An SVG length in pixels; null if it is none, or none that is finite and positive."""
    text = F.trim(value)
    pattern = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*(px|pt|pc|in|cm|mm)?$"
    factor = F.create_map(*(F.lit(x) for pair in UNIT_PIXELS.items() for x in pair))[F.regexp_extract(text, pattern, 2)]
    number = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1).try_cast("double") * factor)
    return F.when((number > 0) & (number < float("inf")), number)


def short_number(value: Column, places: int = 3) -> Column:
    """A number, or its text, as text: the exact decimal rounded half to even, without trailing zeros, never -0.

    Exact are numbers of up to 20 decimal places.
    """
    text = F.bround(value.cast("decimal(38,20)"), places).cast("string")
    text = F.when(text.contains("."), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)
    return F.when(text.isin("-0", ""), "0").otherwise(text)
