"""Decisions about responses, tracing, archives, caches and shapes, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspool.functions.text import stem

#: What an error body may hold; other shapes read as null.
ERROR = "struct<error:struct<message:string,details:array<struct<retryDelay:string,violations:array<struct<quotaId:string,quotaMetric:string,quotaValue:string,quotaDimensions:map<string,string>>>>>>>"

#: Tracing parameters for plain, usual and complex artwork (fixed values).
TRACING = {
    "colormode": ("color", "color", "color"),
    "hierarchical": ("stacked", "stacked", "stacked"),
    "mode": ("spline", "spline", "spline"),
    "filter_speckle": (2, 4, 8),
    "color_precision": (6, 6, 4),
    "layer_difference": (16, 16, 32),
    "corner_threshold": (60, 60, 50),
    "length_threshold": (2.0, 4.5, 6.0),
    "max_iterations": (10, 10, 10),
    "splice_threshold": (45, 45, 45),
    "path_precision": (3, 3, 3),
}


def _error(body: Column) -> Column:
    return F.from_json(body, ERROR)["error"]


def _violations(body: Column) -> Column:
    lists = F.transform(F.filter(_error(body)["details"], lambda d: d["violations"].isNotNull()), lambda d: d["violations"])
    return F.flatten(lists)


def long_quota(body: Column) -> Column:
    """Why waiting will not help: 'daily' or 'zero'; null if it may. The first violation that says so decides."""
    label = lambda v: F.lower(F.concat(F.coalesce(v["quotaId"], F.lit("")), F.coalesce(v["quotaMetric"], F.lit(""))))
    kinds = F.transform(_violations(body), lambda v: F.when(label(v).contains("perday") | label(v).contains("per_day"), "daily").when(v["quotaValue"] == "0", "zero"))
    return F.coalesce(F.get(F.array_compact(kinds), 0), F.when(_error(body)["message"].rlike(r"(?i)\b(per day|daily quota)\b"), "daily"))


def quota_scope(body: Column) -> Column:
    """'model' if every violation names its model, else 'provider', which all its models share."""
    found = _violations(body)
    named = F.forall(found, lambda v: F.coalesce(v["quotaDimensions"]["model"] != "", F.lit(False)))
    return F.when((F.size(found) > 0) & named, "model").otherwise("provider")


def retry_delay(header: Column, body: Column, attempt: Column, now: Column) -> Column:
    """Seconds to wait: the longest that header, details or message ask for, else two to the attempt, 60 at most."""
    finite = lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.greatest(x, F.lit(0.0)))
    seconds = finite(header.try_cast("double"))
    day = F.try_to_timestamp(F.regexp_replace(header, r"^\w+, ", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    until = finite(day.cast("double") - now.cast("double"))
    duration = lambda d: F.when(d["retryDelay"].endswith("s"), finite(F.regexp_replace(d["retryDelay"], "s$", "").try_cast("double")))
    asked = F.array_max(F.transform(_error(body)["details"], duration))
    said = finite(F.regexp_extract(_error(body)["message"], r"(?i)retry\s+(?:in|after)\s+([\d.]+)\s*s", 1).try_cast("double"))
    return F.coalesce(F.greatest(F.coalesce(seconds, until), asked, said), F.least(F.lit(60.0), F.pow(F.lit(2.0), F.least(attempt, F.lit(6)))))


def tracing_parameters(score: Column, flat: Column) -> Column:
    """The parameters for artwork of that complexity; a flat palette counts as plain."""
    plain = F.coalesce(flat, F.lit(False)) | (score < 35)
    pick = lambda values: F.when(plain, F.lit(values[0])).when(score < 70, F.lit(values[1])).otherwise(F.lit(values[2]))
    return F.struct(*(pick(v).alias(k) for k, v in TRACING.items()))


def icon_review(white_background: Column, flat: Column, palette: Column) -> Column:
    """Why an icon source needs a look by a person: background, palette, empty or pale; null if it does not.

    palette: array of [r, g, b]; near-white neutral colours are the background.
    """
    ink = F.filter(palette, lambda c: ~((F.array_min(c) >= 245) & (F.array_max(c) - F.array_min(c) <= 10)))
    pale = F.exists(ink, lambda c: F.array_min(c) >= 220)
    return F.when(~white_background, "background").when(~flat, "palette").when(F.size(ink) == 0, "empty").when(pale, "pale")


def artboard_error(width: Column, height: Column, view_box: Column, length: Column, images: Column, paths: Column, megapixels: tuple[float, float] = (15, 65), sides: tuple[int, int] | None = None, most: int = 45_000_000) -> Column:
    """The first thing that makes an SVG unusable; null if nothing does. With sides, they count instead of megapixels."""
    if sides:
        outside = ~(width.between(*sides) & height.between(*sides))
    else:
        outside = ~(width * height / 1e6).between(*megapixels)
    outside = F.coalesce(outside, F.lit(True))
    return F.when(outside, "artboard").when(F.coalesce(view_box, F.lit("")) == "", "view box").when(length > most, "size").when(images > 0, "raster image").when(F.coalesce(paths, F.lit(0)) == 0, "no path")


def archive_target(name: Column, digest: Column, short_holds: Column, full_holds: Column) -> Column:
    """(name, action) of an archived source: move, delete (the same content is there) or conflict.

    short_holds, full_holds: the digest of what stands under the name with twelve
    digits of the hash, and with all of them; null where nothing does.
    """
    suffix = F.regexp_extract(name, r".(\.[^.]*)$", 1)
    named = lambda tail: F.concat(stem(name), F.lit("__"), tail, suffix)
    act = lambda holds: F.when(holds.isNull(), "move").when(holds == digest, "delete").otherwise("conflict")
    taken = F.coalesce(short_holds != digest, F.lit(False))
    return F.struct(F.when(taken, named(digest)).otherwise(named(F.substring(digest, 1, 12))).alias("name"), F.when(taken, act(full_holds)).otherwise(act(short_holds)).alias("action"))


def merged_sources(old: Column, archived: Column) -> Column:
    """The known sources and the archived ones, in that order, each once."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(old, none), F.coalesce(archived, none)))


def not_among(values: Column, allowed: list[str]) -> Column:
    """The values that are not allowed, each once, in their order."""
    return F.array_except(values, F.array(*map(F.lit, allowed)))


def quarantine_path(name: Column, digest: Column) -> Column:
    return F.concat(F.lit("quarantine/"), F.substring(digest, 1, 12), F.lit("/"), F.element_at(F.split(name, "/"), -1))


def sources_intact(digests: Column, asset_id: Column) -> Column:
    """There are sources, all exist (no null digest) and all still hold the asset's content."""
    return F.coalesce((F.size(digests) > 0) & F.forall(digests, lambda x: x.isNotNull() & (x == asset_id)), F.lit(False))


def cache_valid(traced: Column, reference: Column, info: Column, forced: Column, icon: Column, issues: Column, alpha: Column) -> Column:
    """Flags say what is there and can be read; icons without source issues need their alpha too."""
    needs = icon & (F.coalesce(F.size(issues), F.lit(0)) <= 0)
    return F.coalesce(traced & reference & info & ~forced & (~needs | alpha), F.lit(False))


def polygon_area(x: Column, y: Column) -> Column:
    """The area that a closed ring of points holds."""
    following = lambda c: F.concat(F.slice(c, 2, F.size(c)), F.slice(c, 1, 1))
    cross = F.zip_with(F.zip_with(x, following(y), lambda a, b: a * b), F.zip_with(y, following(x), lambda a, b: a * b), lambda a, b: a - b)
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def shape_kept(x: Column, y: Column, least_area: float = 1.0) -> Column:
    return (F.size(x) >= 3) & (polygon_area(x, y) > least_area)
