"""Operator 5: chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. The
turns' spans are found by rendering successive prefixes and comparing each
output with the one before: what is new is the last turn's span. Where the
earlier output is not a prefix of the new one, the template rewrites history;
that is reported with the turn that shows it. The text inside a span is found by
rendering the turn once more with a text that marks its place.

The template given here escapes its control strings inside texts and roles by a
backslash behind their first character, so none of them is left there and the
output holds just those that the template wrote; the escape can be undone, so
turns and loss mask can be read back from the output.

Prefixes are rendered from the start, at a cost that grows with the square of a
conversation. Only a template that declares by an attribute ``independent`` that it
renders every turn on its own, as the one given here does, is rendered in blocks of
turns, each with the turn before it in front, so that cost and memory follow the
length; where a block begins, the declaration is checked.

A conversation is read by one task, turn by turn: its digests run over all of its
turns in order. What is held is one block, or all turns of one conversation for a
template that is not independent.

Cases: null texts and roles are empty; equal turn numbers go by role and text; a
null conv_id is a conversation of its own; repeated rows are turns. Extra columns
are ignored. An empty table gives no conversations of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
MARK = "\ue000\ue001\ue000"
BLOCK = 16
#: What the template writes itself, and its openings of roles.
_CONTROL = re.compile(r"\\|(?=</?s>|\[/?INST\]|<</?SYS>>|<\||\|>).", re.DOTALL)


def escape(text: str) -> str:
    """The text with a backslash behind every backslash and behind the first character of every control string."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """A backslash stands for itself where another follows, else it only parts what follows from what is before it."""
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: list[Turn]) -> str:
    """The default template. Roles other than user, assistant and system are spelled out."""
    out = []
    for role, text in turns:
        text = escape(text)
        if role == "user":
            out.append(f"<s>[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text} </s>\n")
        elif role == "system":
            out.append(f"<<SYS>>\n{text}\n<</SYS>>\n")
        else:
            out.append(f"<| {escape(role)} |>\n{text}\n<|end|>\n")
    return "".join(out)


render.independent = True


def read_turn(span: str) -> Turn:
    """The turn that the default template wrote as ``span``."""
    if span.startswith("<s>[INST] "):
        return "user", unescape(span[len("<s>[INST] ") : -len(" [/INST]")])
    if span.startswith("<<SYS>>"):
        return "system", unescape(span[len("<<SYS>>\n") : -len("\n<</SYS>>\n")])
    if span.startswith("<|"):
        k = span.index(" |>", 2)
        return unescape(span[3:k]), unescape(span[k + len(" |>\n") : -len("\n<|end|>\n")])
    return "assistant", unescape(span[1 : -len(" </s>\n")])


def spans(turns: Iterable[Turn], template: Template = render) -> Iterator[tuple[str, int, int, bool]]:
    """(new text, content start, content end, rewrites) of every turn, in order.

    Content offsets are within the new text, -1 if the marked rendering does not
    show them. Prefixes grow from the start; those of an independent template grow
    within a block of turns, behind the turn before the block.
    """
    block = BLOCK if getattr(template, "independent", False) else None
    held: list[Turn] = []
    before = ""
    for turn in turns:
        if block and len(held) > block:
            held, whole = held[-1:], before
            before = template(held)
            if not whole.endswith(before):
                raise ValueError("the template declares that it renders every turn on its own, and does not")
        held.append(turn)
        now = template(held)
        rewrites = not now.startswith(before)
        common = len(before)
        if rewrites:
            common = next((i for i, (x, y) in enumerate(zip(before, now, strict=False)) if x != y), min(len(before), len(now)))
        span = now[common:]
        marked = template([*held[:-1], (turn[0], MARK)])[common:]
        at = marked.find(MARK)
        tail = len(marked) - at - len(MARK)
        yield span, at, (len(span) - tail if at >= 0 else -1), rewrites
        before = now


class Digest:
    """What is read back from one conversation's output, as it is written."""

    def __init__(self, conv, read):
        self.read, self.conv, self.turns, self.chars, self.loss, self.rewritten = read, conv, 0, 0, 0, 0
        self.all, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, span: str, start: int, end: int, rewrites: bool) -> None:
        role, text = self.read(span)
        self.turns += 1
        self.chars += len(span)
        self.rewritten += rewrites
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if role == "assistant":
            text = unescape(span[start:end])
            self.loss += len(text)
            self.masked.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss, self.masked.hexdigest(), self.chars, self.rewritten


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewritten long"
SPANS = "conv_id long, turn long, role string, span string, loss_start long, loss_end long, rewrites boolean"


def _walk(batches, make):
    """The turns of sorted batches, one conversation after the other; make: gets an iterator of (turn, role, text)."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    row = next(rows, None)
    while row is not None:
        conv = row[0]

        def own():
            nonlocal row
            while row is not None and row[0] == conv:
                yield row[1], row[2] or "", row[3] or ""
                row = next(rows, None)

        yield from make(conv, own())


def _digests(template, read):
    def make(conv, turns):
        digest = Digest(conv, read)
        for x in spans(((role, text) for _, role, text in turns), template):
            digest.add(*x)
        yield digest.row()

    def run(batches):
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        out = []
        for row in _walk(batches, make):
            out.append(row)
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def _formatted(template):
    def make(conv, turns):
        seen = []

        def noted():
            for turn, role, text in turns:
                seen.append((turn, role))
                yield role, text

        for span, start, end, rewrites in spans(noted(), template):
            turn, role = seen.pop()
            mask = role == "assistant" and start >= 0
            yield conv, turn, role, span, start if mask else None, end if mask else None, rewrites

    def run(batches):
        names = [x.split()[0] for x in SPANS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        for row in _walk(batches, make):
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    return run


def _sorted(conversations: DataFrame) -> DataFrame:
    columns = ["conv_id", F.col("turn").cast("long").alias("turn"), "role", "text"]
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), *columns[1:])
    return out.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def formatted(conversations: DataFrame, template: Template = render) -> DataFrame:
    """One row per turn: the text it adds to the output, the loss mask in it, whether it rewrites history."""
    return _sorted(conversations).mapInArrow(_formatted(template), SPANS)


def digests(conversations: DataFrame, template: Template = render, read: Callable[[str], Turn] = read_turn) -> DataFrame:
    """One row per conversation, read back from the template's output; read: gives the turn that a span holds."""
    return _sorted(conversations).mapInArrow(_digests(template, read), SCHEMA)


def op5_chat(spark, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(conversations.unionByName(more))
