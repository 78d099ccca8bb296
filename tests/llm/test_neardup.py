"""Near-duplicates at a size with nodes above and below every bound."""

import random

import numpy as np

from inkspool.llm import neardup
from inkspool.llm.graph import components
from inkspool.llm.words import chunks
from inkspool.session import Scratch


def exact_components(rows, k, percent):
    """By all intersections, as products of 0/1 matrices over the shingles of two documents or more."""
    sets = []
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)})
    times = {}
    for s in sets:
        for x in s:
            times[x] = times.get(x, 0) + 1
    place = {x: j for j, x in enumerate(x for x, n in times.items() if n > 1)}
    n, common = len(sets), np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(place), 4000):
        part = np.zeros((n, 4000), np.float32)
        for i, s in enumerate(sets):
            for x in s:
                j = place.get(x, -1) - at
                if 0 <= j < 4000:
                    part[i, j] = 1
        common += part @ part.T
    sizes = np.array([len(s) for s in sets])
    near = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    np.fill_diagonal(near, True)
    label = np.arange(n)
    while True:
        new = np.array([label[near[i]].min() for i in range(n)])
        if (new == label).all():
            return {rows[i][0]: rows[label[i]][0] for i in range(n)}, int(np.triu(near, 1).sum())
        label = new


def planted(seed=5):
    """5,000 documents: families around the threshold, one very large; a passage that a thousand share; and single ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []

    def family(base, many, most):
        for _ in range(many):
            own = list(base)
            for _ in range(rng.randint(0, most)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own))

    family([word() for _ in range(60)], 1200, 2)
    for _ in range(60):
        family([word() for _ in range(60)], 30, 3)
    for _ in range(250):
        family([word() for _ in range(rng.randint(20, 90))], 2, 2)
    passage = [word() for _ in range(40)]
    for _ in range(500):
        tail = [word() for _ in range(12)]
        family(passage + tail, 2, 2)
    while len(texts) < 5000:
        texts.append(" ".join(word() for _ in range(rng.randint(1, 60))))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_recall_is_whole_at_5000_documents(spark):
    rows = planted()
    want, links = exact_components(rows, 5, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for join in (neardup.Join(), neardup.Join(hot=100, part=64, dense=128)):
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, Scratch(spark, "t"), join).collect()}
        assert links > 10_000 and got == want


def test_texts_of_one_doc_id_are_judged_each(spark):
    rng = random.Random(3)
    a, b = (" ".join(f"w{rng.randrange(1000)}" for _ in range(50)) for _ in range(2))
    df = spark.createDataFrame([(7, a), (7, b), (9, b), (3, a + " x"), (12, b + " y")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df, Scratch(spark, "t")).collect())
    assert got == [(3, 3, True), (7, 3, False), (7, 7, True), (9, 7, False), (12, 7, False)]


def test_words_that_once_collided():
    import pyarrow as pa

    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    words = [one, other, one[:64], other[:64], one[:65], "a", "b", "ab", "a" * 8, "a" * 9, "a" * 64, "a" * 65]
    found = [h for c in chunks(pa.array([" ".join(words), "A " + "A" * 65])) for h in c.hashes().tolist()]
    assert len(set(found[:12])) == 12 and found[12:] == [found[5], found[11]]


def test_intersections_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40 if k % 2 else 4000, rng.integers(1, 300)).astype(np.uint64)) for k in range(60)]
    want = [[len(np.intersect1d(x, y)) if i != j else 0 for j, y in enumerate(sets)] for i, x in enumerate(sets)]
    got = neardup._intersections(sets)
    np.fill_diagonal(got, 0)
    assert got.tolist() == want


def test_components_with_very_large_stars(spark):
    links = [(1000 + i, 5) for i in range(300)] + [(5, 2)] + [(2000 + i, 3000) for i in range(50)] + [(3000, 1000)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t"), "links", hot_degree=20).collect())
    assert got == {x: 2 for pair in links for x in pair if x != 2}
