"""License scans: wrapped paragraphs, a slow scorer, and ordinary texts."""

import math
import random
import re

import numpy as np

from inkspool.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files, to deal in it
without restriction."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met."""


def corpus():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghilmnorst", k=rng.randint(2, 8))) for _ in range(200)] + licenses.ORDINARY
    prose = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    texts = []
    for k in range(120):
        parts = [prose(rng.randint(3, 40)) for _ in range(rng.randint(1, 4))]
        if k % 6 == 0:
            parts.append(rng.choice(["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "All rights reserved.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3."]))
        texts.append("\n".join(parts))
    return texts + [prose(12) + "\n\n" + MIT + "\n\n" + prose(9), prose(5) + "\n" + BSD, "He held a driver license to the city.", "Mit dem Hund und of the general.", "", None, "word " * 5000]


def slow(texts, model):
    """Paragraph by paragraph."""
    out = []
    for d, text in enumerate(texts):
        for k, paragraph in enumerate(re.split(r"""(?:(?<=[.!?:;])|(?<=[.!?:;]["')\]]))[ \t\r]*\n\s*|\n[ \t\r]*\n\s*""", text or "")):
            words = licenses.words_of(paragraph)
            z = (sum((model.weights[g] for g in set(licenses.grams(words)) if g in model.weights), np.zeros(len(licenses.CLASSES))) + model.intercepts) / model.temperature
            best = int(np.argmax(z))
            probability = 1 / np.exp(z - z[best]).sum()
            if best and probability >= 0.5:
                share = licenses.template_shares(words)[licenses.CLASSES[best]]
                out.append((d, k, licenses.CLASSES[best], probability, share, share >= 0.6))
    return out


def test_agrees_with_a_slow_scorer(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, licenses.scan(df).collect()))
    want = sorted(slow(texts, licenses.train(licenses.sample(df))))
    assert len(got) >= 20 and [(*g[:3], g[5]) for g in got] == [(*w[:3], w[5]) for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-6) and math.isclose(g[4], w[4]) for g, w in zip(got, want, strict=True))
    found = {(g[0], g[2]) for g in got if g[5]}
    assert {(k, texts[k].split("\n")[-1]) for k in range(0, 120, 6)} <= {(d, texts[d].split("\n")[-1]) for d, _ in found} and {(120, "mit"), (121, "bsd")} <= found
    assert {d for d, _ in found} <= {*range(0, 120, 6), 120, 121}  # ordinary texts are left alone


def test_wrapped_lines_are_one_paragraph(spark):
    df = spark.createDataFrame([(1, MIT), (2, BSD), (3, "Title\n\n" + MIT + "\nEnd.")], "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph, r.family, r.confirmed) for r in licenses.scan(df).collect())
    assert got == [(1, 0, "mit", True), (2, 0, "bsd", True), (3, 1, "mit", True)]


def test_held_out_families():
    model = licenses.train()
    data = licenses.training_paragraphs(400, seed=77)
    right = 0
    for words, y in data:
        z = sum((model.weights[g] for g in set(licenses.grams(words)) if g in model.weights), np.zeros(len(licenses.CLASSES))) + model.intercepts
        right += int(np.argmax(z)) == y
    assert right >= 0.95 * len(data)
