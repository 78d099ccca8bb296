"""Operator 9: benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders; a run of name words
is one name. Windows of the resulting templates are hash-joined with those of the
benchmark's items, and the values in the placeholders are then compared: along one
alignment of a document with an item, a value of the item and the value of the
document that most places give for each other belong together, and the windows
with other values than these do not count. So an item is found word for word and
also with other numbers and names in it, one odd value costs the windows around it
only, and placeholders of unrelated texts that happen to line up count for nothing.

A document is contaminated by an item if the windows that count hold at least
``percent`` of the item's windows, or if those of one alignment cover ``run`` words
of the item without a gap, whatever share of a long item that is. As templates,
windows with few literal words do not count; but all windows are also joined by
their plain words, so a word-for-word copy of any item is found. Either is enough.

Cases: null and empty texts have no windows; an item shorter than a window is one
window of its own length; one of fewer than ``shortest`` words is found where a
document has it as a whole line; rows that share a doc_id are reported together,
once per item; an empty benchmark or table gives no rows. Extra columns are ignored.

Scale: a benchmark of up to ``broadcast`` windows and ``broadcast_bytes`` is sent
to all tasks, and documents are then neither sorted nor shuffled but for their
hits; a larger one is joined by the windows' hashes. Hits meet by document and item.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.llm.words import Chunk, as_signed, chunks, mix, trimmed

#: Units (fixed words); they are units behind a number only.
UNITS = ("mm cm m km in ft yd mi mg g kg t oz lb ml l s sec second seconds min minute minutes h hour hours day days week weeks month months "
         "year years percent dollars dollar euros euro cents cent pounds usd eur miles meters metres feet inches degrees hz khz w kw v").split()  # fmt: skip
NUMBER, NAME, UNIT = (np.uint64(0xA5A5_0000_0000_0001), np.uint64(0xA5A5_0000_0000_0002), np.uint64(0xA5A5_0000_0000_0003))
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
EDGE = np.ones(256, bool)  # bytes that are cut from a word's ends
EDGE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
STOP = np.zeros(256, bool)
STOP[[33, 46, 58, 63]] = True


@dataclass(frozen=True)
class Rules:
    """window: words; literal: words of it at least that are no placeholders;
    shortest: words of an item that is looked for within lines; percent: of an
    item's windows to find; run: words of an item without a gap that are enough,
    whatever their share; broadcast, broadcast_bytes: windows of a benchmark, and
    bytes of their values, that are sent to all tasks at most."""

    window: int = 8
    literal: int = 4
    shortest: int = 4
    percent: int = 40
    run: int = 13
    broadcast: int = 2_000_000
    broadcast_bytes: int = 128 << 20


def _unit_hashes() -> np.ndarray:
    data = " ".join(UNITS).encode()
    return np.sort(Chunk(np.frombuffer(data, np.uint8), np.array([0, len(data)]), 0).hashes())


class Stream:
    """A chunk's texts as plain words, or as template tokens: hash, kind (0 or a
    placeholder's), byte start and end of each, and where each text begins."""

    def __init__(self, hashes, kind, start, end, at):
        self.hashes, self.kind, self.start, self.end, self.at = hashes, kind, start, end, at
        self.text = np.repeat(np.arange(len(at) - 1), np.diff(at))


def streams(chunk: Chunk, units: np.ndarray) -> tuple[Stream, Stream, np.ndarray, np.ndarray]:
    """(plain words, template tokens, words that begin a line, words that end one)."""
    data, n = chunk.data, len(chunk.start)
    start, end = trimmed(data, chunk.start, chunk.end, EDGE)
    own = Chunk.__new__(Chunk)
    own.data, own.start, own.end = data, start, end
    plain = own.hashes()
    begins = np.zeros(n + 1, bool)
    begins[chunk.word_at] = True
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    begins[1:n] |= breaks[chunk.start[1:]] > breaks[chunk.end[:-1]]
    ends, begins = np.append(begins[1:n], True)[:n], begins[:n]
    digits = np.concatenate([[0], np.cumsum(DIGIT[data])])
    number = digits[end] > digits[start]
    first, second = (np.append(data, [0, 0])[start + k] for k in (0, 1))
    upper = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    opens = begins.copy()  # the word may begin a sentence
    opens[1:] |= STOP[data[chunk.end[:-1] - 1]]
    name = upper & ~opens & ~number
    unit = np.zeros(n, bool)
    if n:
        at = np.minimum(np.searchsorted(units, plain), len(units) - 1)
        unit[1:] = (units[at] == plain)[1:] & number[:-1]
    kind = np.where(number, 1, np.where(unit, 3, np.where(name, 2, 0)))
    token = np.where(kind == 0, plain, np.array([0, NUMBER, NAME, UNIT], np.uint64)[kind])
    lead = np.ones(n, bool)  # the word begins a token: names that follow one another in a text are one
    lead[1:] = ~((kind[1:] == 2) & (kind[:-1] == 2)) | (chunk.doc[1:] != chunk.doc[:-1])
    last = np.append(lead[1:], True)[:n]
    count = np.concatenate([[0], np.cumsum(lead)])
    return Stream(plain, np.zeros(n, np.int64), start, end, chunk.word_at), Stream(token[lead], kind[lead], start[lead], end[last], count[chunk.word_at]), begins, ends


def _windows(sizes: list[tuple[int, bool]] | None, rules: Rules, keys: np.ndarray | None):
    """(id, size, place, exact, total, hash, slots) of the windows of (id, text), as templates and as plain words; total: windows of the text.

    With sizes, windows of these; without, each text's own ones: of ``window``
    words, or one of its length. With keys, only windows whose hash is among them.
    """
    units = _unit_hashes()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1)):
                plain, tokens, begins, ends = streams(chunk, units)
                for size, exact in sizes if sizes is not None else product(range(1, rules.window + 1), (False, True)):
                    own = plain if exact else tokens
                    full = len(own.hashes) - size + 1
                    if full <= 0 or not exact and size < rules.shortest:
                        continue
                    odd = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
                    value = np.zeros(full, np.uint64)
                    for j in range(size):
                        value += own.hashes[j : j + full] * odd[j]
                    value = mix(value + np.uint64(size + 64 * exact))
                    use = own.text[:full] == own.text[size - 1 :]
                    if sizes is None:
                        use &= (np.minimum(np.diff(own.at), rules.window) == size)[own.text[:full]]
                    if not exact:
                        literal = np.concatenate([[0], np.cumsum(own.kind == 0)])
                        use &= literal[size:] - literal[:full] >= min(rules.literal, size)
                    elif sizes is not None and size < rules.shortest:
                        line = np.cumsum(begins)
                        use &= begins[:full] & ends[size - 1 :] & (line[:full] == line[size - 1 :])
                    total = np.bincount(own.text[:full][use], minlength=len(chunk))
                    if keys is not None:
                        use &= keys[np.minimum(np.searchsorted(keys, value), len(keys) - 1)] == value if len(keys) else False
                    at = np.flatnonzero(use)
                    if not len(at):
                        continue
                    slots = []
                    for i in at.tolist():
                        inside = np.flatnonzero(own.kind[i : i + size]) + i
                        slots.append([f"{j - i}:" + " ".join(chunk.data[own.start[j] : own.end[j]].tobytes().decode("utf-8", "replace").lower().split()) for j in inside.tolist()])
                    text = own.text[at]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([ids[chunk.first + d] for d in text], pa.int64()),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array((at - own.at[:-1][text]).astype(np.int64)),
                            pa.array(np.full(len(at), exact)),
                            pa.array(total[text].astype(np.int64)),
                            pa.array(as_signed(value[at])),
                            pa.array(slots, pa.list_(pa.string())),
                        ],
                        ["id", "size", "place", "exact", "total", "hash", "slots"],
                    )

    return run


def agreeing(windows: list[tuple[int, list[str], list[str]]]) -> tuple[set[int], bool]:
    """(places of the windows that count, whether a value differs) of one alignment's windows (place in the item, its values, the document's).

    A value of the item and one of the document belong together if each is the one
    that most places give for the other; ties go to the lesser value.
    """
    given: dict[int, tuple[str, str]] = {}
    for place, mine, theirs in windows:
        for x, y in zip(mine, theirs, strict=True):
            offset, _, value = x.partition(":")
            given[place + int(offset)] = value, y.partition(":")[2]
    times: dict[tuple[str, str], int] = {}
    for pair in given.values():
        times[pair] = times.get(pair, 0) + 1
    best: list[dict] = [{}, {}]
    for pair, n in sorted(times.items(), key=lambda x: (-x[1], x[0])):
        for side in (0, 1):
            best[side].setdefault(pair[side], pair)
    odd = {at for at, pair in given.items() if best[0][pair[0]] != pair or best[1][pair[1]] != pair}
    counts = [(place, mine, theirs) for place, mine, theirs in windows if not any(place + int(x.partition(":")[0]) in odd for x in mine)]
    return {place for place, _, _ in counts}, any(mine != theirs for _, mine, theirs in counts)


def longest_run(places: set[int], size: int) -> int:
    """The most words that windows at these places cover without a gap."""
    best = begun = reached = -1
    for p in sorted(places):
        if p > reached:
            begun = p
        reached = p + size
        best = max(best, reached - begun)
    return best


FOUND = "doc_id long, item_id long, n_windows long, n_item_windows long, n_templates long, n_item_templates long, n_slots long, reparameterised boolean"


def _judge(rules: Rules):
    """The items found in documents, from (doc_id, item_id, exact, shift, item_place, item_slots, slots, size, total) with the rows of a document and item together."""

    def verdict(rows):
        share, run, covered, totals, values, differs = {}, {True: 0, False: 0}, {True: set(), False: set()}, {True: 0, False: 0}, set(), False
        for (exact, _), own in groupby(rows, key=lambda r: (r[2], r[3])):
            own = list(own)
            totals[exact], size = own[0][8], own[0][7]
            places, other = ({r[4] for r in own}, False) if exact else agreeing([(r[4], r[5], r[6]) for r in own])
            covered[exact] |= places
            run[exact] = max(run[exact], longest_run(places, size))
            if not exact:
                differs |= other
                values |= {x.partition(":")[2] for r in own if r[4] in places for x in r[5]}
        for exact in (True, False):
            share[exact] = bool(covered[exact]) and 100 * len(covered[exact]) >= rules.percent * totals[exact] or run[exact] >= rules.run
        if share[True] or share[False]:
            return rows[0][0], rows[0][1], len(covered[True]), totals[True], len(covered[False]), totals[False], len(values), differs and not share[True]
        return None

    def run(batches):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out = []
        for _, own in groupby(rows, key=lambda r: r[:2]):
            found = verdict(list(own))
            if found:
                out.append(found)
            if len(out) == 1000:
                yield _table(out)
                out = []
        if out:
            yield _table(out)

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if k == "reparameterised" else pa.int64()) for c, k in zip(zip(*rows, strict=True), names, strict=True)], names)


SCHEMA = "id long, size int, place long, exact boolean, total long, hash long, slots array<string>"


def contaminated(documents: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """doc_id, item_id, n_windows, n_item_windows, n_templates, n_item_templates, n_slots, reparameterised: one row per document and item found in it."""
    items = benchmark.select("item_id", "text").dropDuplicates(["item_id"])
    theirs = items.mapInArrow(_windows(None, rules, None), SCHEMA).withColumnRenamed("id", "item_id")
    sizes = sorted((r["size"], r["exact"]) for r in theirs.select("size", "exact").distinct().collect())  # twice the window at most
    many, weight = theirs.agg(F.count("*"), F.sum(F.length(F.array_join("slots", " ")) + 64)).first()
    # A benchmark of a checked size goes to every task, which then returns only the windows that can join.
    small = many <= rules.broadcast and (weight or 0) <= rules.broadcast_bytes
    keys = np.sort(theirs.select("hash").distinct().toPandas()["hash"].to_numpy().astype(np.int64).view(np.uint64)) if small else None
    mine = documents.select("doc_id", F.col(text).alias("text")).mapInArrow(_windows(sizes, rules, keys), SCHEMA)
    mine = mine.select(F.col("id").alias("doc_id"), "hash", "size", "exact", "place", "slots")
    theirs = theirs.select("item_id", "hash", "size", "exact", "total", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    both = mine.join(F.broadcast(theirs) if small else theirs, ["hash", "size", "exact"])
    both = both.select("doc_id", "item_id", "exact", (F.col("place") - F.col("item_place")).alias("shift"), "item_place", "item_slots", "slots", "size", "total")
    together = both.repartition("doc_id", "item_id").sortWithinPartitions("doc_id", "item_id", "exact", "shift", "item_place")
    return together.mapInArrow(_judge(rules), FOUND)


def decontaminate(documents: DataFrame, benchmark: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that no item is found in."""
    bad = contaminated(documents, benchmark, rules).select("doc_id").distinct()
    return documents.join(bad, "doc_id", "left_anti").select(*documents.columns)


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
