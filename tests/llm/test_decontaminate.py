"""Decontamination: consistency by window, runs of names, short items, marks, and brute force."""

import itertools
import random
import re

import pyarrow as pa

from inkspool.llm import decontaminate
from inkspool.llm.decontaminate import Rules, agreeing, longest_run
from inkspool.llm.words import chunks, trimmed

ITEM = "A train leaves Paris at 9 and goes 120 km to Lyon before it turns back with 40 people of the town on it."


def found(spark, items, texts, rules=Rules()):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.contaminated(df, bench, rules).collect()}


def test_one_odd_value_costs_its_windows_only(spark):
    changed = ITEM.replace("Paris", "New York").replace("120", "85").replace("Lyon", "San Juan de la Cruz").replace("40", "7")
    texts = ["See: " + ITEM.replace("at 9 and", "at 10 again and"), "See: " + ITEM.replace("at 9", "at 10"), changed, "See " + ITEM.upper(), "See " + ITEM.lower(), changed.replace("85", "10").replace(" 9 ", " 10 ")]
    assert found(spark, [ITEM], texts) == {(0, 0): False, (1, 0): False, (2, 0): True, (3, 0): False, (4, 0): False, (5, 0): True}


def test_short_items_are_found_as_whole_lines(spark):
    items = ["Yes", "Forty two", "the quick brown"]
    texts = ["Oh yes it is", "It is so.\n  yes! \nOr not", "forty two", "the quick brown fox", "(The quick, brown)", "a\nforty\ntwo", "forty two\nyes"]
    for rules in (Rules(), Rules(broadcast=0)):
        assert set(found(spark, items, texts, rules)) == {(1, 0), (2, 1), (4, 2), (6, 0), (6, 1)}


def test_any_number_of_marks_is_cut():
    text = "((((((((((\"Ab3...\"))))))))))) ... x --a--b-- \u00e9"
    chunk = next(chunks(pa.array([text])))
    start, end = trimmed(chunk.data, chunk.start, chunk.end, decontaminate.EDGE)
    assert [chunk.data[s:e].tobytes().decode() for s, e in zip(start, end)] == ["Ab3", "...", "x", "a--b", "\u00e9"]


def test_consistency_and_runs():
    windows = [(0, ["1:9", "3:a"], ["1:10", "3:b"]), (2, ["1:a", "4:5"], ["1:b", "4:10"]), (9, ["0:9"], ["0:10"])]
    assert agreeing(windows) == ({0, 9}, True)  # 10 stands for 9 twice, for 5 once
    assert agreeing([(0, ["0:x"], ["0:x"])]) == ({0}, False)
    assert longest_run({0, 3, 11, 20}, 8) == 19 and longest_run({5}, 8) == 8 and longest_run(set(), 8) == -1


def brute(items, texts, rules):
    """Exact copies by plain words, window by window and run by run."""
    clean = lambda t: [re.sub("^[^0-9a-z]+|[^0-9a-z]+$", "", w) for w in t.lower().split()]
    out = set()
    for (i, a), (d, b) in itertools.product(enumerate(map(clean, items)), enumerate(map(clean, texts))):
        grams = {tuple(b[k : k + rules.window]) for k in range(len(b) - rules.window + 1)}
        hits = [tuple(a[k : k + rules.window]) in grams for k in range(len(a) - rules.window + 1)]
        run = any(a[k : k + rules.run] == b[j : j + rules.run] for k in range(len(a) - rules.run + 1) for j in range(len(b) - rules.run + 1))
        if sum(hits) * 100 >= rules.percent * len(hits) or run:
            out.add((d, i))
    return out


def test_agrees_with_brute_force(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(300)]
    items = [" ".join(rng.choices(words, k=rng.randint(20, 80))) for _ in range(12)]
    texts = []
    for k in range(150):
        own = rng.choice(items).split()
        at, many = rng.randrange(len(own)), rng.choice([3, 8, 10, 12, 13, 20, 40, 80])
        piece = own[at : at + many]
        if k % 4 == 0 and len(piece) > 2:
            piece[rng.randrange(len(piece))] = "changed"
        texts.append(" ".join(rng.choices(words, k=20) + piece + rng.choices(words, k=20)))
    for rules in (Rules(), Rules(broadcast=0), Rules(window=5, percent=60, run=9)):
        assert set(found(spark, items, texts, rules)) == brute(items, texts, rules)


def test_reparameterised_items_are_caught_and_others_left(spark):
    """Planted: every item with all numbers and names changed consistently; and texts of the same kind that are no item."""
    rng = random.Random(4)
    names = ["Anna", "Berlin", "Carla", "Denver", "Emil", "Fargo", "Gina", "Hugo"]
    plain = ["".join(rng.choices("aeioubcdlmnrst", k=rng.randint(2, 7))) for _ in range(400)]

    def question():  # of forty words, every fifth of them a value
        return " ".join(rng.choice(["{a}", "{b}", "{x}", "{y}", "{z}"]) if k % 5 == 4 else rng.choice(plain) for k in range(40))

    fill = lambda q: q.format(**dict(zip("ab", rng.sample(names, 2))), **dict(zip("xyz", rng.sample(range(3, 900), 3))))
    templates = [question() for _ in range(40)]
    items = [fill(q) for q in templates]
    texts = [f"some words before. {fill(q)} and some after." for q in templates] + [f"some words before. {fill(question())} and some after." for _ in range(200)]
    got = set(found(spark, items, texts))
    assert got == {(k, k) for k in range(40)}
