"""SVG path data as token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Command letters in the order of the SVG grammar, and numbers (fixed pattern).
TOKEN = r"[MmZzLlHhVvCcSsQqTtAa]|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def path_tokens(data: Column) -> Column:
    """The commands and numbers of path data; null if anything else is left."""
    rest = F.regexp_replace(F.regexp_replace(data, TOKEN, ""), r"[\s,]+", "")
    return F.when(rest == "", F.regexp_extract_all(data, F.lit(f"({TOKEN})"), F.lit(1)))


def without_repeats(chunks: Column) -> Column:
    """Path chunks without a line chunk (of one point) that repeats the one before it."""
    return F.filter(chunks, lambda c, k: (k == 0) | ~c.rlike("^L [^ ]+ [^ ]+$") | (c != F.get(chunks, k - 1)))


#: Sides of icon artboards at least, by kind (fixed values).
ICON_SIDES = {"icon": 50, "icon-sheet": 1000}
MOST_SIDE, MEGAPIXELS, MOST_ASPECT = 4000, (15.0, 65.0), 1000


def target_error(target: float, kind: str = "illustration") -> str | None:
    """Why a target of so many megapixels cannot be had."""
    if not 0 < target < float("inf"):
        return "target must be positive and finite"
    if kind in ICON_SIDES:
        return "icons have 16 megapixels at most" if target > MOST_SIDE**2 / 1e6 else None
    return None if MEGAPIXELS[0] <= target <= MEGAPIXELS[1] else "target must be between 15 and 65 megapixels"


def artboard(width: Column, height: Column, target: float = 25.0, kind: str = "illustration") -> Column:
    """(width, height, error) of about target megapixels at the same aspect, rounded half to even.

    An illustration whose rounded area leaves the range gets a width that brings it
    back; the sides of an icon have bounds. Where error is set, the sides are null.
    """
    if error := target_error(target, kind):
        raise ValueError(error)
    scale = F.sqrt(F.lit(target * 1e6) / (width * height))
    if kind in ICON_SIDES:
        scale = F.least(scale, F.lit(float(MOST_SIDE)) / F.greatest(width, height))
    w, h = (F.greatest(F.lit(1), F.bround(x * scale).cast("long")) for x in (width, height))
    extreme = F.greatest(width, height) / F.least(width, height) > MOST_ASPECT
    if kind in ICON_SIDES:
        error = F.when(extreme, "aspect").when(F.least(w, h) < ICON_SIDES[kind], "sides")
    else:
        error = F.when(extreme, "aspect")
        least, most = (x * 1e6 for x in MEGAPIXELS)
        w = F.when(w * h < least, F.ceil(F.lit(least) / h)).when(w * h > most, F.floor(F.lit(most) / h)).otherwise(w)
    return F.struct(F.when(error.isNull(), w).alias("width"), F.when(error.isNull(), h).alias("height"), error.alias("error"))
