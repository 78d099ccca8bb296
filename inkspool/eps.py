"""EPS files: what their heads say, and converters and embedders as engines with a time limit."""

from __future__ import annotations

import re
import subprocess
import tempfile
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkspool import svg
from inkspool.operators.paths import ICON_SIDES, MEGAPIXELS, MOST_SIDE

#: What an EPS file begins with, and its bounds (fixed patterns).
HEAD, BOUNDS = r"^%!PS-Adobe-[^\r\n]*EPSF", r"%%BoundingBox:\s*(-?\d+)\s+(-?\d+)\s+(-?\d+)\s+(-?\d+)"


def structure(content: Column, kind: str = "illustration") -> Column:
    """(width, height, error) by the first 8192 bytes, where the format keeps its head; error: size, head, bounds or artboard."""
    head = F.decode(F.substring(content, 1, 8192), "ISO-8859-1")
    at = [F.regexp_extract(head, BOUNDS, k).try_cast("long") for k in (1, 2, 3, 4)]
    width, height = at[2] - at[0], at[3] - at[1]
    if kind in ICON_SIDES:
        outside = ~(width.between(ICON_SIDES[kind], MOST_SIDE) & height.between(ICON_SIDES[kind], MOST_SIDE))
    else:
        outside = ~(width * height / 1e6).between(*MEGAPIXELS)
    error = F.when(F.coalesce(F.length(content), F.lit(0)) < 30, "size").when(~head.rlike(HEAD), "head").when(F.coalesce((width <= 0) | (height <= 0), F.lit(True)), "bounds").when(outside, "artboard")
    return F.struct(width.alias("width"), height.alias("height"), error.alias("error"))


def on_artboard(raw: bytes, width: int, height: int) -> bytes:
    """The file with its declared bounds widened to the artboard; ink outside of it, by more than a point, is an error."""
    m = re.search(rb"(?m)^%%BoundingBox: (-?\d+) (-?\d+) (-?\d+) (-?\d+)\r?$", raw)
    if not m:
        raise ValueError("the file declares no bounds")
    left, bottom, right, top = map(int, m.groups())
    if min(left, bottom) < -1 or right > width + 1 or top > height + 1:
        raise ValueError("ink lies outside of the artboard")
    return re.sub(rb"(?m)^%%((?:Page|HiRes)?BoundingBox):[^\r\n]+", lambda m: b"%%" + m[1] + f": 0 0 {width} {height}".encode(), raw)


def command(program: list[str], suffixes: tuple[str, str], seconds: float = 90.0):
    """An engine of an external program: its input and output files' names take the places of {input} and {output}.

    The engine is safe to repeat: it works in a folder of its own, which goes at the end.
    """

    def run(payload: bytes) -> bytes:
        with tempfile.TemporaryDirectory() as folder:
            before, after = (Path(folder) / f"{name}{suffix}" for name, suffix in zip(("input", "output"), suffixes, strict=True))
            before.write_bytes(payload)
            done = subprocess.run([x.format(input=before, output=after) for x in program], capture_output=True, timeout=seconds)
            if done.returncode or not after.is_file():
                raise RuntimeError((done.stderr or b"the program wrote nothing").decode(errors="replace")[-600:])
            return after.read_bytes()

    return run


def converter(render, target: float = 25.0, kind: str = "illustration"):
    """An engine from SVG to EPS around one that renders: the artboard's pixels become points, an icon keeps its artboard."""

    def run(payload: bytes) -> bytes:
        root = svg.sized(svg.parse(payload), target, kind)
        width, height = (round(svg.pixels(root.get(side))) for side in ("width", "height"))
        out = render(svg.written(svg.in_points(root)))
        return on_artboard(out, width, height) if kind in ICON_SIDES else out

    return run
