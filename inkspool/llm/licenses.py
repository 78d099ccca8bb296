"""Operator 2: license scans by a trained paragraph classifier.

A paragraph ends at a blank line, or where a line ends a sentence; so wrapped lines
are one. Paragraphs are scored by multinomial logistic regression over sparse word
n-grams of one to three words; the classes are licence families and "unknown". A
prediction is confirmed by comparing the paragraph with the family's templates.

The model is trained here, in numpy, on TRAINING paragraphs written from the
templates and on ordinary ones (seeded), and on up to SAMPLE paragraphs of at most
SAMPLE_WORDS words of the documents themselves (chosen by a hash; both bounds are
parameters): those that hold most of a template are of its family, those that hold
next to nothing of any are unknown. Temperature and offset of "unknown" are fitted
on every fifth paragraph, which the weights have not seen. Scoring uses column
expressions and joins only.

All n-grams that are frequent in training are features. Only paragraphs with one
of the ``telling`` n-grams are scored: all others, taken together, cannot lift any
family over "unknown", so the other paragraphs are "unknown" for certain.

Cases: null and empty texts have no paragraphs; repeated rows give their
paragraphs again; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce
from operator import or_
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sentences that licences are announced with, by family (fixed texts).
TEMPLATES = {
    "apache": ("licensed under the apache license version 2.0", "you may obtain a copy of the apache license at", "distributed under the apache software license"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", "released under the bsd 3 clause license", "licensed under the two clause bsd license"),
    "cc": ("this work is licensed under a creative commons attribution license", "licensed under the creative commons attribution sharealike 4.0 international license", "released under the cc by sa 4.0 license", "licensed under cc by 4.0", "licensed under cc by sa 4.0", "licensed under cc by nc 4.0"),
    "gpl": ("this work is licensed under the gnu general public license version 3", "you can redistribute it and or modify it under the terms of the gnu general public license", "released under the gnu lesser general public license"),
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software", "licensed under the mit license"),
    "mpl": ("this source code form is subject to the terms of the mozilla public license", "licensed under the mozilla public license version 2.0", "released under the mpl 2.0 license"),
    "reserved": ("copyright all rights reserved", "all rights reserved no part of this work may be reproduced without permission", "copyright holder all rights reserved"),
}
#: Words of licences that ordinary training paragraphs also get, out of their place.
ANCHORS = ("license", "licensed", "licence", "licenced", "copyright", "gnu", "apache", "mit", "bsd", "mozilla", "mpl", "creative", "commons", "gpl", "permission", "permitted", "redistribution", "redistribute", "reserved", "cc", "by", "sa", "nc")
CLASSES = ("unknown", *TEMPLATES)
TRAINING, SAMPLE, SAMPLE_WORDS = 1_600, 1_000, 200
#: What parts paragraphs.
BREAK = r"""(?<=[.!?:;]["')\]]{0,1})[ \t\r]*\n\s*|\n[ \t\r]*\n\s*"""
#: Pull of every weight to zero, so that words that tell nothing get none.
SPARSE = 7e-4
WORDS = r"[^a-z0-9.]+"
ORDINARY = "the a of and to in is that it was for on with as by at from this have not we you they are be or an will can all one has more if about which when out up so time people work use may free any part person source form public version general terms driver holders concert school shop renew fishing application number office issue date fee state city".split()


def grams(words: list[str]) -> list[str]:
    """All n-grams of one to three words."""
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def training_paragraphs(many: int = TRAINING, seed: int = 2) -> list[tuple[list[str], int]]:
    rng = np.random.default_rng(seed)
    word = lambda: str(rng.choice(ORDINARY)) if rng.random() < 0.7 else "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9)))
    families, out = list(TEMPLATES), []
    for k in range(many):
        if k % 2:
            family = families[(k // 2) % len(families)]
            words = str(rng.choice(TEMPLATES[family])).split()
            words = [w for w in words if rng.random() > 0.06]
            words = [word() for _ in range(rng.integers(0, 6))] + words + [word() for _ in range(rng.integers(0, 8))]
            out.append((words, 1 + families.index(family)))
        else:  # ordinary text, half of it with anchors out of their place
            words = [word() for _ in range(rng.integers(3, 40))]
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(0, len(words))] = str(rng.choice(ANCHORS))
            for _ in range(rng.integers(0, 4)):  # and short runs of the templates' other words
                own = [w for w in str(rng.choice(TEMPLATES[str(rng.choice(families))])).split() if w not in ANCHORS]
                at = rng.integers(0, len(own))
                place = rng.integers(0, len(words))
                words[place:place] = own[at : at + rng.integers(1, 4)]
            out.append((words, 0))
    return out


def words_of(paragraph: str) -> list[str]:
    return [w for w in (x.strip(".") for x in re.split(WORDS, paragraph.lower())) if w]


def template_shares(words: list[str]) -> dict[str, float]:
    """For each family, the largest share of a template's word pairs that the paragraph has."""
    own = set(zip(words, words[1:], strict=False))
    return {family: max(len(own & (its := set(zip(t.split(), t.split()[1:], strict=False)))) / len(its) for t in texts) for family, texts in TEMPLATES.items()}


def labelled(paragraphs: list[str]) -> list[tuple[list[str], int]]:
    """Paragraphs of documents that the templates tell the class of."""
    out = []
    for words in map(words_of, paragraphs):
        shares = template_shares(words)
        best = max(shares, key=lambda f: shares[f])
        if shares[best] >= 0.8 or shares[best] <= 0.2:
            out.append((words, CLASSES.index(best) if shares[best] >= 0.8 else 0))
    return out


class Model(NamedTuple):
    """weights of each n-gram and intercepts, by class; temperature and offset of "unknown"."""

    weights: dict[str, np.ndarray]
    intercepts: np.ndarray
    temperature: float


@lru_cache(4)
def train(paragraphs: tuple[str, ...] = (), rounds: int = 400) -> Model:
    """The model of the written paragraphs and of those of documents."""
    data = training_paragraphs() + labelled(list(paragraphs))
    fit = [x for k, x in enumerate(data) if k % 5]
    held = [x for k, x in enumerate(data) if not k % 5]
    times: dict[str, int] = {}
    for words, _ in fit:
        for g in set(grams(words)):
            times[g] = times.get(g, 0) + 1
    vocabulary = {g: k for k, g in enumerate(sorted(g for g, n in times.items() if n >= 4))}

    def matrix(rows):
        x = np.zeros((len(rows), len(vocabulary)))
        for i, (words, _) in enumerate(rows):
            x[i, [vocabulary[g] for g in set(grams(words)) if g in vocabulary]] = 1
        return x, np.array([y for _, y in rows])

    x, y = matrix(fit)
    hot = np.eye(len(CLASSES))[y]
    w, b = np.zeros((x.shape[1], len(CLASSES))), np.zeros(len(CLASSES))
    for _ in range(rounds):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        g = hot - p / p.sum(1, keepdims=True)
        w += 2.0 * (x.T @ g / len(x) - 2e-4 * w)
        w = np.sign(w) * np.maximum(np.abs(w) - 2.0 * SPARSE, 0)
        b += 0.5 * g.mean(0)
    hx, hy = matrix(held)
    z = hx @ w + b

    def loss(t, offset):
        s = (z + offset * np.eye(len(CLASSES))[0]) / t
        return -(s[np.arange(len(hy)), hy] - np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) - s.max(1)).mean()

    temperature, offset = min(((t, o) for t in np.linspace(0.2, 4, 39) for o in np.linspace(-2, 2, 17)), key=lambda v: loss(*v))
    b[0] += offset
    return Model({g: w[k] for g, k in vocabulary.items() if w[k].any()}, b, float(temperature))


def sample(documents: DataFrame, text: str = "text") -> tuple[str, ...]:
    """Up to SAMPLE paragraphs of at most SAMPLE_WORDS words, of documents chosen by a hash."""
    some = documents.filter(F.length(text) > 0)
    every = max(1, some.count() // SAMPLE)
    rows = some.filter(F.pmod(F.xxhash64("doc_id", text), F.lit(every)) == 0).select(F.explode(F.split(F.col(text), BREAK)).alias("p")).filter(F.size(F.split("p", r"\s+")) <= SAMPLE_WORDS)
    return tuple(r.p for r in rows.distinct().orderBy(F.xxhash64("p"), "p").limit(SAMPLE).collect())


def telling(weights: dict[str, np.ndarray], intercepts: np.ndarray) -> list[str]:
    """N-grams without which a paragraph is "unknown" whatever else it holds: all others together do not reach a family.

    Left out are as many of the weak ones as possible, those of common words first,
    and those that hold another telling one.
    """
    margins = {g: np.maximum(w[1:] - w[0], 0) for g, w in weights.items()}
    lead = intercepts[0] - intercepts[1:]
    if lead.min() <= 0:
        raise ValueError("a paragraph that nothing is known about must be unknown")
    common = lambda g: all(x in ORDINARY for x in g.split())
    left, out = np.zeros(len(lead)), []
    for g in sorted(margins, key=lambda g: (not common(g), margins[g].max(), g)):
        if (left + margins[g] < lead - 1e-6).all():  # a feature counts once in a paragraph
            left = left + margins[g]
        else:
            out.append(g)
    return [g for g in out if not any(f" {x} " in f" {g} " for x in out if x != g)]


def scan(documents: DataFrame, threshold: float = 0.5, overlap: float = 0.6, text: str = "text") -> DataFrame:
    """doc_id, paragraph, family, probability, overlap, confirmed: one row per paragraph that is predicted to be of a family."""
    spark = documents.sparkSession
    weights, intercepts, temperature = train(sample(documents, text))
    # The model's own table: a few thousand rows, whatever the input.
    table = spark.createDataFrame([(g, [round(float(v), 9) for v in w]) for g, w in weights.items()], "gram string, w array<double>")
    needed = telling(weights, intercepts)
    # The edges of a word are those that WORDS and the dots leave.
    pattern = "(?<![a-z0-9])(?:" + "|".join("[^a-z0-9]++".join(w.replace(".", "[.]") for w in x.split()) for x in sorted(needed)) + ")(?![a-z0-9])"
    rows = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), F.posexplode(F.split(F.lower(F.col(text)), BREAK)).alias("paragraph", "line"))
    # Plain substrings first: every telling n-gram contains one of these words.
    longest = {max(x.split(), key=len) for x in needed}
    stems = sorted(a for a in longest if not any(b != a and b in a for b in longest))
    rows = rows.filter(reduce(or_, (F.col("line").contains(x) for x in stems))).filter(F.col("line").rlike(pattern))
    rows = rows.select("doc_id", "row", "paragraph", F.filter(F.transform(F.split("line", WORDS), lambda w: F.regexp_replace(w, r"^\.+|\.+$", "")), lambda w: w != "").alias("words"))

    def every(n: int):
        return F.expr(f"case when size(words) >= {n} then transform(sequence(0, size(words) - {n}), i -> array_join(slice(words, i + 1, {n}), ' ')) else cast(array() as array<string>) end")

    rows = rows.withColumn("grams", F.array_distinct(F.filter(F.concat(every(1), every(2), every(3)), lambda g: g.isin(*weights))))
    # Template comparison: the share of a template's word pairs that the paragraph has.
    pairs = "case when size(words) >= 2 then transform(sequence(0, size(words) - 2), i -> array_join(slice(words, i + 1, 2), ' ')) else cast(array() as array<string>) end"
    wanted = sorted({f"{a} {b}" for texts in TEMPLATES.values() for t in texts for a, b in zip(t.split(), t.split()[1:], strict=False)})
    rows = rows.withColumn("pairs", F.array_distinct(F.filter(F.expr(pairs), lambda x: x.isin(*wanted))))
    shares = {}
    for family, texts in TEMPLATES.items():
        each = []
        for t in texts:
            own = t.split()
            its = sorted({f"{a} {b}" for a, b in zip(own, own[1:], strict=False)})
            each.append(F.size(F.array_intersect("pairs", F.array(*map(F.lit, its)))) / len(its))
        shares[family] = F.greatest(*each)
    rows = rows.select("doc_id", "row", "paragraph", "grams", F.array(*(shares[f] for f in TEMPLATES)).alias("shares"))
    # An outer explode: from a plain one Spark infers a filter on the n-grams, and pushed down it would compute the words again for each of them.
    scored = rows.select("doc_id", "row", "paragraph", "shares", F.explode_outer("grams").alias("gram")).join(F.broadcast(table), "gram")
    sums = [F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(CLASSES))]
    scored = scored.groupBy("row", "paragraph").agg(F.first("doc_id").alias("doc_id"), F.first("shares").alias("shares"), *sums)
    z = [(F.col(f"z{k}") + F.lit(float(intercepts[k]))) / F.lit(temperature) for k in range(len(CLASSES))]
    scored = scored.select("doc_id", "paragraph", "shares", F.array(*z).alias("z"))
    scored = scored.withColumn("best", F.array_max(F.transform("z", lambda x, k: F.struct(x.alias("x"), (-k).alias("k")))))
    scored = scored.withColumn("k", -F.col("best.k")).withColumn("probability", 1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best.x"))))
    found = scored.filter((F.col("k") > 0) & (F.col("probability") >= threshold))
    share = F.element_at("shares", F.col("k").cast("int"))
    return found.select("doc_id", "paragraph", F.element_at(F.array(*map(F.lit, CLASSES)), (F.col("k") + 1).cast("int")).alias("family"), "probability", share.alias("overlap"), (share >= overlap).alias("confirmed"))


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
