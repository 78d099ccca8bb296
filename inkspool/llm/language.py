"""Operator 3: language identification by Bayesian evidence fusion.

Evidence for a page's language: the likelihood of its text under byte-trigram
models, its declared markup language, the language in its address, and a prior
of its host. Host priors are smoothed along a hierarchy, host to domain to suffix
to all pages, with counts that are the pages' text posteriors summed by grouped
aggregation. How far declarations can be trusted is estimated the same way. A
page's own share is left out of all sums that it is judged by, so its text counts
once.

The trigram models are counted over the whole texts of a sample of the documents
with a known language (of about SAMPLE rows, chosen by a hash of id and text).

Cases: a null or empty page has no text evidence and follows its address and
host; a null address has an empty host; repeated rows are pages of their own; an
empty table gives no rows; without documents of a known language every page's
language is null. Extra columns are ignored.

Scale: one pass over the pages, with the address and the declaration taken apart by
column expressions; everything after it is short rows. A hot host's pages are spread
over SALTS copies of its row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspool.llm.words import LOWER, text_bytes
from inkspool.session import Scratch

BINS = 1 << 14
SAMPLE = 2_000
#: Trigrams depend on each other; a text counts as so many independent ones at most.
EVIDENCE = 60.0
#: Pages' worth of the level above in a host's, domain's and suffix's counts, and of doubt in a declaration.
WEIGHT, DOUBT = 5.0, 2.0
SALTS = 16
_ENTITY = re.compile(rb"&#?\w+;")
#: Second-level names under which domains are registered (fixed list).
SECOND = ("co", "com", "org", "net", "ac", "gov", "edu")


def trigrams(data: np.ndarray) -> np.ndarray:
    """Bins of all byte trigrams, A-Z lowered and all that is no letter as one space."""
    x = LOWER[data].astype(np.int64)
    x = np.where((x >= 97) & (x <= 122) | (x >= 128), x, 32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    keep = ~((x[1:-1] == 32) & (x[2:] == 32))
    return (((x[:-2] * 31 + x[1:-1]) * 1_000_003 + x[2:] * 7919) % BINS)[keep]


def _counted(batches):
    """(label, bin, n): trigrams of the batches' texts by label."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(label, np.zeros(BINS, np.int64))
            counts[label] += np.bincount(trigrams(np.frombuffer(text.encode(), np.uint8)), minlength=BINS)
    for label, n in counts.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["label", "bin", "n"])


def train(documents: DataFrame, text: str = "text", label: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihoods of the bins under each)."""
    labelled = documents.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    every = max(1, labelled.count() // SAMPLE)
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id", text), F.lit(every)) == 0)
    found = sample.select(F.col(label).alias("label"), F.col(text).alias("text")).mapInArrow(_counted, "label string, bin long, n long").groupBy("label", "bin").agg(F.sum("n").alias("n")).toPandas()
    names = sorted(set(found["label"]))
    counts = np.full((len(names), BINS), 0.5)
    np.add.at(counts, ([names.index(x) for x in found["label"]], found["bin"].to_numpy(np.int64)), found["n"].to_numpy(np.int64))
    return names, np.log(counts / counts.sum(1, keepdims=True)) if names else counts


def address(url: Column) -> dict[str, Column]:
    """host, domain, suffix and language code (in the path or subdomain, or the suffix, else ''), lower case; '' where there is none."""
    whole = r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    named = F.regexp_replace(F.regexp_extract(url, whole, 1), "^.*@", "")
    host = F.btrim(F.lower(F.regexp_extract(named, "^[^:]*", 0)), F.lit("."))
    parts = F.split(host, "[.]")
    last, second = F.element_at(parts, -1), F.try_element_at(parts, F.lit(-2))
    deep = (F.size(parts) > 2) & second.isin(*SECOND) & (F.length(last) == 2)
    domain = F.when(deep, F.array_join(F.slice(parts, -3, 3), ".")).when(F.size(parts) > 1, F.array_join(F.slice(parts, -2, 2), ".")).otherwise(host)
    path = F.lower(F.regexp_extract(F.regexp_extract(url, whole, 2), "^/([a-zA-Z]{2})(?:[-_][a-zA-Z]{2})?(?:/|$)", 1))
    code = F.when(path != "", path).when((F.size(parts) > 2) & (F.length(parts[0]) == 2), parts[0]).when(F.length(last) == 2, last).otherwise("")
    return {"host": host, "domain": domain, "suffix": last, "code": code}


def declared(html: Column) -> Column:
    """The language that the first html tag declares, two letters, or ''."""
    tag = F.regexp_extract(html, r"(?is)<html\b[^>]*+", 0)
    return F.coalesce(F.lower(F.substring(F.regexp_extract(tag, r"""(?is)\blang\s*+=\s*+["']?([a-z]{2,3})""", 1), 1, 2)), F.lit(""))


def plain(html: bytes) -> bytes:
    """The text of a page: without tags, comments, scripts, styles and navigation. One scan from front to back."""
    low, out, at, n = html.lower(), [], 0, len(html)
    missing: set[bytes] = set()  # what has no end behind the present place
    while at < n:
        begin = low.find(b"<", at)
        if begin < 0:
            break
        out.append(html[at:begin])
        out.append(b" ")
        end = -1
        for opens, closes in ((b"<!--", b"-->"), (b"<script", b"</script"), (b"<style", b"</style"), (b"<nav", b"</nav")):
            if closes not in missing and low.startswith(opens, begin) and (opens == b"<!--" or not low[begin + len(opens) : begin + len(opens) + 1].isalnum()):
                end = low.find(closes, begin + len(opens))
                if end < 0:
                    missing.add(closes)
                elif opens == b"<!--":
                    end += len(closes) - 1
                else:
                    end = low.find(b">", end)
                break
        if end < 0:
            end = low.find(b">", begin)
        if end < 0:  # no tag ends behind here: the rest is text
            at = begin + 1
            break
        at = end + 1
    return _ENTITY.sub(b" ", b"".join([*out, html[at:]]))


def _read(names: list[str], table: np.ndarray):
    def run(batches):
        for batch in batches:
            data, at = text_bytes(batch.column(6))
            scores = []
            for i in range(len(batch)):
                bins = trigrams(np.frombuffer(plain(data[at[i] : at[i + 1]].tobytes()), np.uint8))
                scores.append(table[:, bins].mean(1) * min(len(bins), EVIDENCE) if len(bins) else np.zeros(len(names)))
            p = np.array(scores).reshape(len(batch), len(names))
            p = np.exp(p - p.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(6)), *(pa.array(p[:, j]) for j in range(len(names)))], ["page_id", "host", "domain", "suffix", "code", "declared", *(f"p{j}" for j in range(len(names)))])

    return run


def identify(pages: DataFrame, documents: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, lang, probability, text_lang, declared, host."""
    names, table = train(documents)
    where = address(F.col("url"))
    taken = pages.select("page_id", *(c.alias(k) for k, c in where.items()), declared(F.col("html")).alias("declared"), "html")
    if not names:
        text, none = F.lit(None).cast("string"), F.lit(None).cast("double")
        return taken.select("page_id", text.alias("lang"), none.alias("probability"), text.alias("text_lang"), F.nullif(F.col("declared"), F.lit("")).alias("declared"), "host")
    n = len(names)
    ps = [f"p{j}" for j in range(n)]
    schema = "page_id long, host string, domain string, suffix string, code string, declared string, " + ", ".join(f"{p} double" for p in ps)
    read = scratch.cut(taken.mapInArrow(_read(names, table), schema), "read")
    sums = lambda key, out: read.groupBy(*key).agg(*(F.sum(p).alias(f"{out}{j}") for j, p in enumerate(ps)))
    # One row per host with the sums of its domain, its suffix and all pages.
    hosts = sums(["host", "domain", "suffix"], "h").join(sums(["domain", "suffix"], "d"), ["domain", "suffix"]).join(sums(["suffix"], "s"), "suffix").crossJoin(F.broadcast(sums([], "g")))
    hosts = hosts.drop("domain", "suffix").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = read.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(hosts, ["host", "salt"])

    def smooth(level: str, above: str | None) -> list:
        """The level's shares without the page's own, smoothed by those of the level above."""
        own = [F.greatest(F.col(f"{level}{j}") - F.col(f"p{j}"), F.lit(0.0)) for j in range(n)]
        total = sum(own, F.lit(0.0))
        weight, share = (WEIGHT, [F.col(f"{above}{j}") for j in range(n)]) if above else (float(n), [F.lit(1.0 / n)] * n)
        return [((x + weight * y) / (total + weight)) for x, y in zip(own, share, strict=True)]

    for level, above in (("g", None), ("s", "g"), ("d", "s"), ("h", "d")):
        out = out.withColumns({f"{level}{j}": c for j, c in enumerate(smooth(level, above))})

    def trust(column: str, out: str) -> DataFrame:
        """Counts of text posteriors by value (a row per language): c of the value, t of all; an absent value says nothing."""
        own = sums([column], "c").filter(F.col(column).isin(names))
        total = own.agg(*(F.sum(f"c{j}").alias(f"t{j}") for j in range(n)))
        return own.crossJoin(total).select(column, *(F.col(f"{x}{j}").alias(f"{out}{x}{j}") for x in "ct" for j in range(n)))

    def log_trust(column: str, out: str, j: int):
        """log P(value | language j) without the page's own share."""
        p, doubt = F.col(f"p{j}"), DOUBT / n + F.when(F.col(column) == names[j], DOUBT).otherwise(0.0)
        return F.log((F.greatest(F.col(f"{out}c{j}") - p, F.lit(0.0)) + doubt) / (F.greatest(F.col(f"{out}t{j}") - p, F.lit(0.0)) + DOUBT * 2))

    out = out.join(F.broadcast(trust("declared", "e")), "declared", "left").join(F.broadcast(trust("code", "a")), "code", "left")
    score = [F.log(f"h{j}") + F.log(F.col(f"p{j}") + 1e-12) + F.coalesce(log_trust("declared", "e", j), F.lit(0.0)) + F.coalesce(log_trust("code", "a", j), F.lit(0.0)) for j in range(n)]
    out = out.withColumns({f"z{j}": x for j, x in enumerate(score)})
    best = lambda prefix: F.array_max(F.array(*(F.struct(F.col(f"{prefix}{j}").alias("x"), F.lit(-j).alias("k"), F.lit(names[j]).alias("name")) for j in range(n))))
    out = out.withColumn("best", best("z"))
    share = 1 / sum((F.exp(F.col(f"z{j}") - F.col("best.x")) for j in range(n)), F.lit(0.0))
    certain = F.col("p0") != F.col("p0")
    for j in range(1, n):
        certain = certain | (F.abs(F.col(f"p{j}") - F.col("p0")) > 1e-9)
    return out.select("page_id", F.col("best.name").alias("lang"), share.alias("probability"), F.when(certain, best("p")["name"]).alias("text_lang"), F.nullif(F.col("declared"), F.lit("")).alias("declared"), "host")


def op3_language(spark, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return identify(read("pages"), read("documents"), Scratch(spark, "op3"))
