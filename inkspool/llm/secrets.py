"""Operator 8: secret scans by a linear-chain conditional random field.

Three patterns give the base spans. A conditional random field then tags the
words of every text as outside, begin or inside of a secret, from the word's
shape, the words before it and features of the whole text, and adds the parts of
the spans it finds that no base span covers. It is trained here, in numpy, on lines
that ``training_sentences`` writes (a bounded, seeded sample with labels): prose,
settings, code and logs with secrets, and with what looks like them and is none.

Decoding is exact Viterbi, but only where it can matter: a word whose score for
"outside" leads by more than all that transitions could give back is outside on
the best path whatever its neighbours are, so the path splits there.

Cases: a null or empty text has no spans; repeated rows are scanned one by one;
extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.llm.words import Chunk, chunks, code_points, trimmed

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that announce a secret (fixed list).
CUES = "password passwd pwd pass secret token key apikey api_key api-key bearer credential credentials auth authorization passphrase access_key secret_key private_key".split()
#: What issued secrets begin with (fixed list of published prefixes).
PREFIXES = (b"sk-", b"sk_", b"pk_", b"rk_", b"ghp_", b"gho_", b"ghs_", b"github_pat_", b"glpat-", b"xoxb-", b"xoxp-", b"AIza", b"eyJ", b"ya29.", b"npm_", b"hf_", b"SG.", b"dop_v1_")
#: A secret that the model finds has so many characters at least.
SHORTEST = 8


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def uncovered(start: int, end: int, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The parts of start..end that none of the spans, in order of their starts, covers."""
    out = []
    for a, b, _ in spans:
        if start < min(a, end):
            out.append((start, min(a, end)))
        start = max(start, b)
    return [*out, (start, end)] if start < end else out


def _class(ranges) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


DIGIT, UPPER, LOWER = _class([(48, 57)]), _class([(65, 90)]), _class([(97, 122)])
HEXES = _class([(48, 57), (97, 102)])
MARK = ~(DIGIT | UPPER | LOWER) & _class([(33, 126)])
TRIM = _class([(ord(c), ord(c)) for c in "\"'`,;.!?()[]{}<>#$%&*|"])
VOWEL = _class([(ord(c), ord(c)) for c in "aeiouyAEIOUY"])
CODE = _class([(ord(c), ord(c)) for c in "={}();_/<>\\$"])
FEATURES = 76


def features(chunk: Chunk, cues: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature ids of every word: one row per word, core start, core end). Ids 0 mean nothing."""
    data = chunk.data
    n = len(chunk.start)
    start, end = trimmed(data, chunk.start, chunk.end, TRIM)
    total = lambda table: np.concatenate([[0], np.cumsum(table[data], dtype=np.int32)])
    counts = {k: (c := total(t))[end] - c[start] for k, t in (("d", DIGIT), ("u", UPPER), ("l", LOWER), ("x", HEXES), ("m", MARK), ("v", VOWEL), ("c", CODE))}
    size = end - start
    letters = counts["u"] + counts["l"]
    other = size - counts["d"] - letters - counts["m"]
    kinds = (counts["d"] > 0).astype(np.int64) + (counts["u"] > 0) + (counts["l"] > 0)
    group = np.where(DIGIT, 1, np.where(UPPER, 2, np.where(LOWER, 3, 4)))[data]
    turns = np.zeros(len(data) + 1, np.int32)
    turns[2:] = np.cumsum(group[1:] != group[:-1], dtype=np.int32)
    turns = turns[end] - turns[np.minimum(start + 1, end)]
    own = Chunk.__new__(Chunk)
    own.data, own.start, own.end = data, start, np.where(np.isin(data[end - 1], (58, 61)) & (size > 1), end - 1, end)
    cue = np.isin(own.hashes(), cues)
    sign = np.isin(data[chunk.end - 1], (58, 61))  # ends in : or =
    lone = sign & (chunk.end - chunk.start == 1)
    doc = chunk.doc
    back = lambda x, k: np.where(np.concatenate([np.full(k, -1), doc[:-k]])[:n] == doc, np.concatenate([np.zeros(k, x.dtype), x[:-k]])[:n], 0) if n > k else np.zeros(n, x.dtype)
    near = back(cue, 1) | (back(lone, 1) & back(cue, 2))
    by = (back(cue, 2) & ~back(lone, 1)) | back(cue, 3)
    after = np.zeros(n, bool)  # a cue comes one to three words behind: "use ... as the token"
    for k in (1, 2, 3):
        after[:-k] |= cue[k:] & (doc[k:] == doc[:-k])
    signed = back(sign, 1)
    at = np.minimum(start[:, None] + np.arange(max(map(len, PREFIXES))), max(len(data) - 1, 0)) if n else np.zeros((0, 1), np.int64)
    prefixed = np.zeros(n, bool)
    for x in PREFIXES:
        prefixed |= (size > len(x) + 8) & (data[at[:, : len(x)]] == np.frombuffer(x, np.uint8)).all(1) if n else False
    share, code, cued = np.zeros(len(chunk)), np.zeros(len(chunk)), np.zeros(len(chunk), bool)
    if n:
        has, first = chunk.counts > 0, chunk.word_at[:-1][chunk.counts > 0]
        share[has] = np.add.reduceat((counts["d"] > 0).astype(np.int64), first) / chunk.counts[has]
        code[has] = np.add.reduceat((counts["c"] > 0).astype(np.int64), first) / chunk.counts[has]
        cued[has] = np.add.reduceat(cue.astype(np.int64), first) > 0
    f = np.zeros((n, 15), np.int64)
    f[:, 0] = 1 + np.minimum(size // 4, 9)  # 1-10: length
    f[:, 1] = 11 + np.minimum(kinds, 3)  # 11-14: kinds of letters and digits
    f[:, 2] = 15 + np.minimum(turns // 2, 5)  # 15-20: turns between kinds
    f[:, 3] = np.where(counts["m"] == 0, 21, np.where(counts["m"] * 4 <= size, 22, 23))
    f[:, 4] = np.where(counts["d"] == size, 24, np.where(counts["d"] * 3 >= size, 25, np.where(counts["d"] > 0, 26, 27)))
    f[:, 5] = np.where(near, 28, np.where(by, 29, np.where(after, 30, 31)))
    f[:, 6] = np.where(signed, 32, 33)
    f[:, 7] = np.where((size >= 16) & (counts["x"] == size), 34, np.where(other > 0, 35, 36))
    f[:, 8] = np.where(np.isin(data[start], (43, 40)), 37, 38) + np.where((near | by | signed) & (kinds >= 2) & (size >= 8), 2, 0)  # to 40
    f[:, 9] = np.where(prefixed, 41, 42)
    begins = DIGIT[data] & np.concatenate([[True], ~DIGIT[data[:-1]]])
    runs = (c := np.concatenate([[0], np.cumsum(begins, dtype=np.int32)]))[end] - c[start]
    f[:, 10] = 43 + np.where(letters < 6, 0, np.where(counts["v"] * 4 < letters, 1, np.where(counts["v"] * 3 < letters, 2, 3))) + 4 * np.minimum(runs, 2)  # 43-54: vowels among the letters, runs of digits
    f[:, 11] = 55 + np.where(near | by, 1, 0) + np.where((size >= 8) & (counts["d"] > 0) & (letters > 0), 2, 0) + np.where(counts["c"] > 0, 4, 0)  # to 62
    f[:, 12] = np.where(share[doc] > 0.2, 63, 64) + np.where(cued[doc], 2, 0)  # of the text, to 66: many words with digits; a cue somewhere
    f[:, 13] = np.where(code[doc] > 0.4, 67, np.where(code[doc] > 0.1, 68, 69))  # of the text: code, settings or prose
    slashes = np.zeros(len(data) + 1, np.int32)
    slashes[2:] = np.cumsum((data[1:] == 47) & (data[:-1] == 47), dtype=np.int32)
    has = lambda marks: (c := total(_class([(ord(x), ord(x)) for x in marks])))[end] > c[start]
    link = slashes[end] > slashes[np.minimum(start + 1, end)]
    mail = has("@") & has(".") & ~has("!#$%&*?=/:;,+~^")
    f[:, 14] = np.where(link, 70, np.where(mail, 71, np.where(has("@"), 72, np.where(has("()[]{}"), 73, np.where(has("/"), 74, 75)))))  # addresses, calls and paths
    return f, start, end


@lru_cache(1)
def cue_hashes() -> np.ndarray:
    data = " ".join(CUES).encode()
    return Chunk(np.frombuffer(data, np.uint8), np.array([0, len(data)]), 0).hashes()


#: Lines with a secret {s}, beside a cue {c}, words {w}, numbers {n}, dates {d}.
HOLDING = """the {c} is {s}|{c}: {s}|{c} = {s}|{c} {s}|my new {c} is {s} please do not share it|use {s} as the {c} for now
Authorization: Bearer {s}|curl -H "Authorization: Bearer {s}" https://{w}.example.com/{w}|login with {w} and {c} {s}|log in as {w} / {s}
we had to rotate {i} on {d} after it leaked|{i} was found in the repository|headers = {{ "X-Api": {i} }}|client = {w}.Client({i})|set {w} to {i} in the console
{c} => {s},|<{c}> {s} </{c}>|"{c}" : {s},|{d} INFO {w} started with {c} {s}|-u {w} -p {s}|{w} {w} {w} the {c} was changed to {s} by {w}
the old {c} {s} no longer works so ask {w}|--{c} {s} --{w} {n}|your one time {c} for {w} is {s}|ssh {w}@{w}.example.com with {c} {s}|send {i} to {w} and {w}
const {w} = {i};|{w} = os.environ.get("{w}", {i})|here it is: {i}|{c}={s} {w}={n}""".replace("\n", "|").split("|")  # fmt: skip
#: Lines without one; {l} looks like a secret and is none.
CLEAN = """the {c} is {w}|forgot my {c} again|a {c} must have at least {n} characters|{w} {w} {l} {w}|order {l} shipped on {d}|see {l} for more
commit {l} fixes {n}|version {n}.{n}.{n} of {w}|function {l} returns {w}|file {l} not found|meet {w} at {n}:{n} on {d}|{w} said that {w} and {w} went to {w}
def {l}({w}, {w}): return {w}|import {w} from "{w}"|{d} INFO {w} took {n} ms|{d} ERROR {l} at line {n}|the {c} was reset|reset your {c} on https://{w}.example.com/{w}
the key to {w} is {w}|{w} {w} {w} {w} {w} {w} {w}|no {c} is needed for {w}|part {l} costs {n} {w}|call {l} or write to {w}@{w}.example.com|{w}, {w} and {w}. {w} {w}
secret {w} of the {w} garden|token {w} of {w} love|pass the {w} to {w}|{w}: {n}|{w} = {n}|{w} = "{w}"|<a href="https://{w}.example.org/{w}/{n}">{w}</a>|size = {l}|id = {l}
{c} = get_{c}()|{c}: string|self.{c} = {c}|if not {c}: raise {l}|{w} {l} {l} {w}|room {n}, floor {n}|GET {l} took {n} ms|{w} {l} at {l}|copy {l} to {l}|class {l} {w}|let {l} = {n};|{w} -{w} {l} {l}|{w}%%% {w}### {w}*** {w}&&&|{w}!! {w} | {w} | {w}""".replace("\n", "|").split("|")  # fmt: skip


def training_sentences(seed: int = 5, many: int = 2400) -> list[tuple[list[str], list[int]]]:
    """Labelled lines: words, and 1 (begin) or 2 (inside) for secrets, else 0."""
    rng = np.random.default_rng(seed)
    low, high, nums = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    pick = lambda alphabet, a, b: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(a, b + 1)))
    one = lambda of: of[rng.integers(0, len(of))]
    syllable = lambda: pick("bcdfghklmnprstvwz", 1, 2) + one("aeiou") + pick("lmnrst", 0, 1)

    def word():
        w = "".join(syllable() for _ in range(rng.integers(1, 5))) if rng.random() < 0.8 else pick(low, 1, 14)
        return w.title() if rng.random() < 0.12 else w

    def alike():  # what looks like a secret
        name = lambda k: "".join(word().title() for _ in range(k))
        return one([
            lambda: pick(nums, 5, 16), lambda: ".".join(pick(nums, 1, 3) for _ in range(4)), lambda: f"{pick(low, 3, 8)}.{pick(nums, 2, 2)}@{word()}{pick(nums, 0, 2)}.example.com", lambda: f"+{pick(nums, 1, 2)}-{pick(nums, 3, 3)}-{pick(nums, 4, 7)}",
            lambda: f"https://{word()}.example.org/{word()}/{pick(nums, 1, 5)}?{word()}={pick(nums, 1, 4)}", lambda: "-".join(pick("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12)), lambda: f"/{word()}/{word()}/{word()}.{pick(low, 2, 3)}",
            lambda: f"{word()}{name(2)}{pick(nums, 0, 2)}", lambda: f"{word()}_{word()}_{word()}", lambda: f"{pick(high, 2, 4)}-{pick(nums, 3, 6)}-{pick(high, 0, 2)}", lambda: f"${pick(nums, 2, 4)}.{pick(nums, 2, 2)}", lambda: pick("0123456789abcdef", 7, 8),
            lambda: pick(high, 3, 6) + pick(nums, 1, 4), lambda: f"{name(2)}Error", lambda: f"20{pick(nums, 2, 2)}-0{pick('123456789', 1, 1)}-1{pick(nums, 1, 1)}T{pick('01', 1, 1)}{pick(nums, 1, 1)}:{pick('012345', 1, 1)}{pick(nums, 1, 1)}:00Z", lambda: pick(low, 15, 40),
            lambda: f"{word()}-{word()}-{word()}", lambda: f"v{pick(nums, 1, 2)}.{pick(nums, 1, 2)}.{pick(nums, 1, 2)}-{word()}", lambda: f"{pick(nums, 3, 4)}x{pick(nums, 3, 4)}", lambda: f"{word()}{pick(nums, 2, 4)}", lambda: name(3), lambda: f"{word()}.{word()}({word()})",
            lambda: "".join(f"/{word()}{pick(nums, 0, 3)}" for _ in range(rng.integers(2, 6))) + one(["", "." + pick(low, 2, 3), f"?{word()}={pick(nums, 1, 3)}&{word()}={pick(nums, 1, 3)}"]), lambda: f"{word()}@{word()}{pick(nums, 0, 2)}.example.com:/{word()}/{word()}{pick(nums, 0, 2)}",
            lambda: f"/{word()}/v{pick(nums, 1, 1)}/{word()}/{pick(nums, 3, 6)}/{word()}", lambda: f"/{word()}/{word()}/{word()}{pick(nums, 1, 1)}.{pick(nums, 1, 2)}/{word()}-{word()}/{word()}.{pick(low, 2, 3)}",
            lambda: f"{word()}{name(rng.integers(1, 3))}{pick(nums, 1, 1)}({word()}{name(1)})", lambda: f"{word()}{name(rng.integers(1, 3))}{pick(nums, 1, 2)}", lambda: f"{name(3)}{pick(nums, 1, 1)}({name(2)}):", lambda: f"{pick(high, 2, 4)}_20{pick(nums, 6, 6)}_{pick(nums, 4, 6)}.{pick(low, 3, 3)}",
        ])()

    def issued():  # a secret that shows by itself
        mixed = low + high + nums
        core = one([lambda: pick(mixed, 20, 44), lambda: one(["sk-", "sk_live_", "ghp_", "xoxb-", "glpat-", "AIza", "hf_"]) + pick(mixed + "_-", 20, 44), lambda: pick(mixed + "+/", 30, 64) + one(["", "=", "=="]), lambda: "eyJ" + ".".join(pick(mixed + "_-", 20, 40) for _ in range(3))])()
        return core if sum(c.isdigit() for c in core) > 1 else core + pick(nums, 2, 3)

    def chosen():  # a secret that shows by its place
        signs = lambda: pick("!@#$%&*?", 1, 2)
        return one([lambda: word().title() + pick(nums, 2, 4) + signs(), lambda: word() + signs() + word().title() + pick(nums, 1, 3), lambda: pick(low + high + nums, 10, 18) + pick(nums, 1, 2), lambda: "-".join(word() for _ in range(3)) + "-" + pick(nums, 2, 3), lambda: word().replace("o", "0").replace("a", "4").replace("e", "3") + signs() + word() + pick(nums, 1, 2)])()

    def quoted(x):
        return one(['"{}"', "'{}'", "{}", "{}", "{}", "{}.", "{},"]).format(x)

    out = []
    for _ in range(many):
        words, tags = [], []
        for line in range(rng.integers(1, 4)):
            for part in str(one(HOLDING if rng.random() < 0.5 else CLEAN)).split():
                kind = next((k for k in "si" if "{" + k + "}" in part), None)
                secret = quoted(issued() if kind == "i" or rng.random() < 0.5 else chosen()) if kind else ""
                for k, make in (("s", lambda: secret), ("i", lambda: secret), ("c", lambda: str(one(CUES))), ("w", word), ("n", lambda: pick(nums, 1, 4)), ("l", alike), ("d", lambda: f"20{pick(nums, 2, 2)}-0{pick('123456789', 1, 1)}-1{pick(nums, 1, 1)}")):
                    while "{" + k + "}" in part:
                        part = part.replace("{" + k + "}", make(), 1)
                words.append(part.replace("{{", "{").replace("}}", "}"))
                tags.append(1 if kind else 0)
                if kind == "s" and rng.random() < 0.04:  # a secret of two words
                    words.append(issued())
                    tags.append(2)
        out.append((words, tags))
    return out


@lru_cache(1)
def train(rounds: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """(feature weights, transition weights) by gradient steps on the conditional likelihood."""
    sentences = training_sentences()
    data = [" ".join(w).encode() for w, _ in sentences]
    at = np.concatenate([[0], np.cumsum([len(x) for x in data])])
    chunk = Chunk(np.frombuffer(b"".join(data), np.uint8), at, 0)
    f, _, _ = features(chunk, cue_hashes())
    longest = max(len(t) for _, t in sentences)
    tags = np.zeros((len(sentences), longest), np.int64)
    mask = np.zeros((len(sentences), longest), bool)
    ids = np.zeros((len(sentences), longest, f.shape[1]), np.int64)
    for i, (_, t) in enumerate(sentences):
        tags[i, : len(t)], mask[i, : len(t)] = t, True
        ids[i, : len(t)] = f[chunk.word_at[i] : chunk.word_at[i + 1]]
    weights, steps = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    steps[0, 2] = -8.0  # inside follows begin or inside
    frozen = steps != 0
    hot = np.eye(3)[tags] * mask[..., None]
    pairs = mask[:, 1:] & mask[:, :-1]
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(steps), np.zeros_like(steps)]
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for k in range(1, rounds + 1):
        score = weights[ids].sum(2)
        a = np.zeros_like(score)
        a[:, 0] = score[:, 0] + np.array([0, 0, -8.0])
        for t in range(1, longest):
            a[:, t] = np.where(mask[:, t, None], score[:, t] + lse(a[:, t - 1, :, None] + steps[None], 1), a[:, t - 1])
        b = np.zeros_like(score)
        for t in range(longest - 2, -1, -1):
            b[:, t] = np.where(mask[:, t + 1, None], lse(steps[None] + (score[:, t + 1] + b[:, t + 1])[:, None, :], 2), 0)
        z = lse(a[:, -1], 1)
        marginal = np.exp(a + b - z[:, None, None]) * mask[..., None]
        joint = np.exp(a[:, :-1, :, None] + steps + (score[:, 1:] + b[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[..., None, None]
        grad = np.zeros_like(weights)
        np.add.at(grad, ids.reshape(-1, f.shape[1]).T, (hot - marginal).reshape(-1, 3)[None])
        seen = np.einsum("nti,ntj->ij", hot[:, :-1] * pairs[..., None], hot[:, 1:])
        grads = (grad / mask.sum() - 1e-4 * weights, np.where(frozen, 0, (seen - joint.sum((0, 1))) / mask.sum()))
        for x, g, m, v in zip((weights, steps), grads, moments[::2], moments[1::2], strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    weights[0] = 0
    return weights, steps


def viterbi(score: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The best path of one sequence that starts after an outside word."""
    back = np.zeros(score.shape, np.int64)
    best = score[0] + steps[0]
    for t in range(1, len(score)):
        by = best[:, None] + steps
        back[t] = by.argmax(0)
        best = by.max(0) + score[t]
    path = [int((best + steps[:, 0]).argmax())]  # and ends before one
    for t in range(len(score) - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return np.array(path[::-1])


def tagged(chunk: Chunk, weights: np.ndarray, steps: np.ndarray, cues: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, byte start, byte end) of the secrets that the model finds."""
    if not len(chunk.start):
        return []
    f, start, end = features(chunk, cues)
    score = np.zeros((len(f), 3))
    for j in range(f.shape[1]):
        score += weights[f[:, j]]
    # The most that any neighbours can give a word for leaving "outside": with the
    # same neighbours, or with an inside word behind it that begins a secret instead.
    leave = steps[:, 1:, None] + steps[None, 1:, :] - steps[:, :1, None] - steps[None, :1, :]
    same = leave[:, :, :2].max()
    begin = (steps[:, 1:] + steps[None, 1:, 2] - steps[:, :1] - steps[0, 1]).max() + (steps[2] - steps[1]).max()
    behind = np.append((score[:, 2] - score[:, 1])[1:], -np.inf)
    maybe = np.flatnonzero(score[:, 0] - score[:, 1:].max(1) <= np.maximum(same, begin + behind))
    if not len(maybe):
        return []
    doc, out = chunk.doc, []
    cut = np.flatnonzero((np.diff(maybe) > 1) | (doc[maybe][1:] != doc[maybe][:-1])) + 1
    for run in np.split(maybe, cut):
        path = viterbi(score[run], steps)
        k = 0
        while k < len(run):
            if path[k]:
                e = k + 1
                while e < len(run) and path[e] == 2:
                    e += 1
                s, t = int(start[run[k]]), int(end[run[e - 1]])
                if t - s >= SHORTEST:
                    out.append((int(doc[run[k]]), s, t))
                k = e
            else:
                k += 1
    return out


def _scan(weights, steps, cues):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                found = {}
                for d, s, t in tagged(chunk, weights, steps, cues):
                    found.setdefault(d, []).append((s, t))
                data = chunk.data
                # Only texts with a sign, a long run of hex digits or an access key prefix can have base spans.
                marks = np.concatenate([[0], np.cumsum((data == 58) | (data == 61))])
                hexes = np.concatenate([[False], HEXES[data], [False]])
                edges = np.flatnonzero(hexes[1:] != hexes[:-1])
                runs = np.flatnonzero(edges[1::2] - edges[::2] >= 24)
                at = lambda x: int(np.searchsorted(chunk.text_at, x, "right")) - 1
                look = set(np.flatnonzero(np.diff(marks[chunk.text_at])).tolist())
                for s, e in zip(edges[::2][runs].tolist(), edges[1::2][runs].tolist(), strict=True):
                    look.update(range(at(s), at(e - 1) + 1))  # a run can go over the end of a text into the next ones
                raw, p = data.tobytes(), -1
                while (p := raw.find(b"AKIA", p + 1)) >= 0:
                    look.add(at(p))
                rows = []
                for i in range(len(chunk)):
                    if i not in look and i not in found:
                        rows.append(((0, 0, 0), "", ""))
                        continue
                    text = chunk.text(i)
                    base = sorted(base_spans(text), key=lambda x: (x[0], KINDS.index(x[2])))
                    spans = list(base)
                    if i in found:
                        points = code_points(data[chunk.text_at[i] : chunk.text_at[i + 1]])
                        for s, t in found[i]:
                            s, t = (int(points[x - chunk.text_at[i]]) for x in (s, t))
                            for a, b in uncovered(s, t, base):
                                b -= len(text[a:b]) - len(text[a:b].rstrip())
                                a += len(text[a:b]) - len(text[a:b].lstrip())
                                spans += [(a, b, "crf")] * (a < b)
                    spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
                    written = lambda xs: ",".join(f"{k}:{s}:{t}" for s, t, k in xs)
                    rows.append((tuple(sum(x[2] == k for x in base) for k in KINDS[:3]), written(base), written(spans)))
                digest = {x: hashlib.sha256(x.encode()).hexdigest() for x in {r[1] for r in rows}}
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), *(pa.array([r[0][j] for r in rows], pa.int64()) for j in range(3)), pa.array([digest[r[1]] for r in rows]), pa.array([r[2] for r in rows])],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return run


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    weights, steps = train()
    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(_scan(weights, steps, cue_hashes()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _redact(weights, steps, cues, columns, at, mark):
    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            pairs = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), batch.column(at)], ["doc_id", "text"])
            for part in _scan(weights, steps, cues)([pairs]):
                for i, spans in zip(part.column(0).to_pylist(), part.column(5).to_pylist(), strict=True):
                    if spans:
                        reach, out = 0, []
                        for s, t in sorted(tuple(map(int, x.split(":")[1:])) for x in spans.split(",")):
                            if s >= reach:
                                out += [texts[i][reach:s], mark]
                            reach = max(reach, t)
                        texts[i] = "".join([*out, texts[i][reach:]])
            arrays = [pa.array(texts, pa.string()) if j == at else batch.column(j) for j in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return run


def redact(documents: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All documents, with every span found in them replaced; n_chars, if there, follows the text."""
    weights, steps = train()
    plain = documents.toDF(*(f"c{j}" for j in range(len(documents.columns))))  # of names that need no quotes
    out = plain.mapInArrow(_redact(weights, steps, cue_hashes(), documents.columns, documents.columns.index(text), mark), documents.schema)
    return out.withColumn("n_chars", F.length(text).cast(dict(documents.dtypes)["n_chars"])) if "n_chars" in documents.columns else out


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
