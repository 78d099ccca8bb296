"""Operator 10: token counts of a document's sections by offset-mapped attribution.

A text is encoded once, whole. The tokens of a byte-level vocabulary spell the
text's bytes, so their lengths give every token's span exactly. The spans are
then joined with the sections' intervals. A token that crosses a boundary
belongs to the section that holds its first byte that is no white space, or its
first byte if it has no other.

A section is a run of lines of one kind: heading, list, table or prose; a blank
line belongs to the section before it.

Cases: a null or empty text gives one row with section "empty" and no tokens;
repeated rows give their rows again. Extra columns are ignored. The vocabulary
file's path is a parameter; its bytes travel with the tasks.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.llm.words import text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pattern of the byte-level vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SECTIONS = ("heading", "list", "table", "prose")
WHITE = b" \t\n\x0b\x0c\r"
_made: dict = {}


def encoder(raw: bytes, pattern: str):
    """(encode, byte length of each id, leading white space of each id), made once per worker."""
    key = (len(raw), hash(raw), pattern)
    if key not in _made:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
        size, lead = np.zeros(max(ranks.values()) + 1, np.int64), np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            size[k] = len(token)
            rest = len(token.lstrip(WHITE))
            lead[k] = len(token) - rest if rest else 0
        _made.clear()
        # The special token is never allowed, so a text that holds it is encoded as ordinary; without one the library's search for them matches everywhere.
        own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|none|>": max(ranks.values()) + 1})
        _made[key] = (lambda text: own.encode_to_numpy(text, disallowed_special=()), size, lead)
    return _made[key]


def kind(line: bytes) -> int:
    """The kind of a line with words."""
    line = line.strip(WHITE)
    if line.count(b"|") >= 2:
        return 2
    if line[:2] in (b"- ", b"* ", b"+ ") or line.split(b" ", 1)[0].rstrip(b".)").isdigit() and line[:1] != b"" and b" " in line:
        return 1
    if line[:1] == b"#" or (len(line) <= 80 and line[-1:] not in b".!?:;,\"'"):
        return 0
    return 3


def sections(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte starts, kinds) of the sections of a text with bytes."""
    starts, kinds, at = [0], [], 0
    for line in text.split(b"\n"):
        if line.strip(WHITE):
            k = kind(line)
            if not kinds:
                kinds.append(k)
            elif kinds[-1] != k:
                starts.append(at)
                kinds.append(k)
        at += len(line) + 1
    return np.array(starts), np.array(kinds or [3])


def attribute(ids: np.ndarray, starts: np.ndarray, size: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of every token, whether it crosses a boundary)."""
    end = np.cumsum(size[ids])
    begin = end - size[ids]
    section = np.searchsorted(starts, begin + lead[ids], "right") - 1
    crosses = np.searchsorted(starts, begin, "right") != np.searchsorted(starts, end - 1, "right")
    return section, crosses


def _attribute(raw: bytes, pattern: str):
    def run(batches):
        encode, size, lead = encoder(raw, pattern)
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            rows = []
            for i in range(len(batch)):
                text = data[at[i] : at[i + 1]].tobytes()
                if not text:
                    rows.append((i, "empty", 0, 0, 0))
                    continue
                ids = encode(text.decode()).astype(np.int64)
                starts, kinds = sections(text)
                owner, crosses = attribute(ids, starts, size, lead)
                if size[ids].sum() != len(text):
                    raise ValueError("the tokens do not spell the text")
                tokens, crossing = np.bincount(kinds[owner], minlength=4), np.bincount(kinds[owner], crosses, 4)
                points = np.add.reduceat((data[at[i] : at[i + 1]] & 0xC0) != 0x80, starts, dtype=np.int64)
                chars = np.bincount(kinds, points, 4)
                rows += [(i, SECTIONS[k], int(chars[k]), int(tokens[k]), int(crossing[k])) for k in np.unique(kinds)]
            if rows:
                i, *columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", "section", "n_chars", "n_tokens", "n_crossing"])

    return run


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """doc_id, section, n_chars, n_tokens, n_crossing (tokens of it that reach into another section)."""
    with open(vocabulary, "rb") as file:
        raw = file.read()
    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(_attribute(raw, pattern), "doc_id long, section string, n_chars long, n_tokens long, n_crossing long")


def op10_tokens(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
