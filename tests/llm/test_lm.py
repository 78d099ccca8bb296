"""LM scoring: the normalised model against a slow one, any layout of the rows, and held-out texts."""

import math
import random

import numpy as np
import pyarrow as pa

from inkspool.llm import lm
from inkspool.llm.words import as_signed, chunks
from inkspool.session import Scratch

SCHEMA = "doc_id long, text string"


def corpus(many=400):
    """Texts whose words depend on the word before."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(120)]
    follows = {w: rng.choices(words, k=3) for w in words}
    out = []
    for k in range(many):
        w, text = rng.choice(words), []
        for _ in range(rng.randint(20, 120)):
            text.append(w if rng.random() < 0.98 else f"rare{rng.randrange(10**6)}")
            w = rng.choice(follows[w])
        out.append((k, " ".join(text)))
    return out


def test_normalisers():
    parameters = lm.start_parameters(np.full(lm.OUTPUTS, 1 / lm.OUTPUTS))
    every = np.arange(lm.OUTPUTS)
    p = lm.log_probabilities(lm.log_tables(parameters), np.full(lm.OUTPUTS, 3), np.full(lm.OUTPUTS, 5), every)
    assert math.isclose(np.exp(p).sum(), 1, rel_tol=1e-4)


def test_scores_agree_with_a_slow_model_on_any_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 4000)
    rows = [*corpus(), (1000, None), (1001, ""), (None, "a b"), (3, corpus(4)[3][1])]
    df = spark.createDataFrame(rows, SCHEMA)
    model, _ = lm.fit(df.repartition(3), Scratch(spark, "t"))
    c1, c2, r, bias = (p.astype(np.float64) for p in model.parameters)
    count = {row.h: row.c for row in model.counts.collect()}

    def slow(text):
        total, one, two = 0.0, lm.END, lm.END
        found = [c for c in chunks(pa.array([text or ""])) if len(c)]
        hashes = [h for c in found for h in as_signed(c.hashes()).tolist()]
        ids = [i for c in found for i in model.vocabulary.ids(c, model.vocabulary.find(as_signed(c.hashes()))).tolist()]
        for k, token in enumerate([*ids, lm.END]):
            z = r @ (c1[one] + c2[two]) + bias
            total += (z[token] - z.max() - np.log(np.exp(z - z.max()).sum())) / np.log(10)
            if token >= lm.OWN:
                total += math.log10(count.get(hashes[k], 0) + 0.1) - model.shared_log[token - lm.OWN]
            one, two = token, one
        return total

    layouts = [sorted(((r.doc_id or -1, r.score) for r in lm.score(df.repartition(n), Scratch(spark, "t")).collect())) for n in (1, 3, 7)]
    assert layouts[0] == layouts[1] == layouts[2]
    want = sorted((d or -1, slow(t)) for d, t in rows)
    assert all(a == d and math.isclose(b, x, rel_tol=1e-4) for (a, b), (d, x) in zip(layouts[0], want, strict=True))


def test_held_out_texts_are_better_predicted_than_by_counts(spark):
    out = lm.score(spark.createDataFrame(corpus(2500), SCHEMA), Scratch(spark, "t")).filter("held_out").collect()
    assert len(out) > 150 and sum(r.score - r.base_score for r in out) / sum(r.n_tokens for r in out) > 0.3
