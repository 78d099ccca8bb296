"""The training-data operators against brute force, round trips and edge cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from inkspool.llm import chat, decontaminate, language, licenses, lm, mixing, neardup, quality, secrets, tokens
from inkspool.llm.words import Chunk
from inkspool.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, component string"


def corpus(seed=1, many=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)] + ["The", "of", "42", "Ünder"]
    out = []
    for k in range(many):
        words = rng.choices(vocabulary, k=rng.choice([1, 3, 20, 80, 200]))
        if out and k % 3 == 0:  # a copy with some words changed
            words = (out[rng.randrange(len(out))] or "x").split()
            for _ in range(rng.randint(0, 1 + len(words) // 20)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(w + ("\n" if rng.random() < 0.05 else "") for w in words))
    return out + [None, "", " \n\t ", "a", "a b", "| a | b | c |\n" * 30, "same line here.\n" * 40, "x" * 200_000, "w " * 30_000]


@pytest.fixture(scope="module")
def docs(spark):
    texts = corpus()
    data = [(k, t, "en", f"s{k % 4}" if k % 11 else None, len(t or ""), "clash", "clash") for k, t in enumerate(texts)]
    return spark.createDataFrame([*data, data[0], data[5]], SCHEMA).repartition(3).cache()  # two rows twice


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(sql, docs):
    con = duckdb.connect()
    documents = docs.toPandas()  # noqa: F841
    return con.sql(sql).fetchall()


def test_quality_agrees_with_sql(docs, empty):
    got = quality.measure(docs.select("doc_id", "text"))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines", "n_failed_lines", "lost_chars", "kept"]
    want = duck(f"select {', '.join(cols)} from ({quality.OP1_SQL})", docs)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want)
    assert quality.measure(empty).count() == 0 and quality.clean(docs).columns == docs.columns


def test_mixing_agrees_with_sql(docs, empty):
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    got = sorted(map(tuple, mixing.taken(docs).select(*cols).collect()))
    want = sorted(duck(f"select {', '.join(cols)} from ({mixing.mixing_sql('documents')})", docs))
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(math.isclose(g[3], w[3]) and g[4] <= 2 * g[1] for g, w in zip(got, want, strict=True))
    assert mixing.taken(empty).count() == 0


def brute_components(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = WORD.findall(low(t))
        sets[d] = frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("join", [neardup.Join(words=4), neardup.Join(words=5, small=2, dense=40, part=8), neardup.Join(words=4, small=2, dense=1, part=5, hot=10)])
def test_near_duplicates_agree_with_brute_force(spark, join):
    rng = random.Random(7)
    base = [rng.choices("abcdefghij", k=60) for _ in range(6)]
    texts = []
    for k in range(120):  # families around the threshold, some large
        words = list(base[k % 2 if k < 80 else k % 6])
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"n{rng.randrange(1000)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts + corpus(3, 20)))
    df = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, Scratch(spark, "t"), join).collect()}
    assert got == brute_components(rows, join.words, 80)


def test_near_duplicates_of_nothing(spark, empty):
    assert neardup.near_duplicates(empty, Scratch(spark, "t")).count() == 0
    null = spark.createDataFrame([(None, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert [tuple(r)[2:] for r in neardup.near_duplicates(null, Scratch(spark, "t")).collect()] == [(None, True)] * 2


def test_lm_scores(spark, docs, empty):
    rows = {r.doc_id: r.text for r in docs.collect()}
    many = collections.Counter(r.doc_id for r in docs.collect())
    words = {d: WORD.findall(low(t)) + ["<end>"] for d, t in rows.items()}
    count = collections.Counter()
    for d, w in words.items():
        if zlib.crc32(str(d).encode()) % 10:
            count.update(w * many[d])
    total, norm = sum(count.values()), sum(count.values()) + 0.1 * (len(count) + 1)
    got = lm.score(docs, Scratch(spark, "t")).collect()
    assert len(got) == sum(many.values())
    for r in got:
        w = words[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), total)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 0.1) / norm) for x in w), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.score < 0
    assert lm.score(empty, Scratch(spark, "t")).count() == 0


def test_chat_round_trip(spark):
    rng = random.Random(2)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<|", "|>", "<<SYS>>", "<</SYS>>\n", " x ", "<|end|>", "|", "é", chat.MARK]
    convs = {c: [(rng.choice(["user", "assistant", "system", "tool|\\x", ""]), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for _ in range(rng.randint(1, 50))] for c in range(20)}
    data = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)] + [(99, 0, None, None), (99, 0, "assistant", None)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    convs[99] = [("", ""), ("assistant", "")]
    for r in chat.digests(df).collect():
        turns = convs[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(chat.render(turns)) and r.n_rewritten == 0
    spans = chat.formatted(df.filter("conv_id = 3")).orderBy("turn").collect()
    assert "".join(s.span for s in spans) == chat.render(convs[3])
    assert chat.digests(df.limit(0)).count() == 0


def test_chat_sees_rewritten_history():
    forgets = lambda turns: "".join(t if k >= len(turns) - 2 else "." for k, (_, t) in enumerate(turns))
    found = [x[3] for x in chat.spans([("user", c * 3) for c in "abcd"], forgets)]
    assert found == [False, False, True, True]


def test_secrets_base_and_model(spark, docs, empty):
    extra = ['Password = "hunter22" and token:abc', "AKIA" + "A1" * 10, "key " + "0af" * 9, "api_key='a1b2c3d4'; secret=xyz", "see ſecret=abcdefgh", "ab" * 30, None]
    df = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(extra)], "doc_id long, text string").union(docs.select("doc_id", "text"))
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for r in secrets.scan(df).collect():
        t = texts[r.doc_id]
        base = [(m.start(), 0, m.end(), "assign") for m in secrets.ASSIGN.finditer(t) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        written = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(base))
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert set(written.split(",")) <= set(r.spans.split(","))
    assert secrets.scan(empty).count() == 0
    out = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert out[1000] == "[SECRET]\" and token:abc" and out[1006] is None and out[1005] == "[SECRET]"


def test_secret_model_on_held_out_sentences():
    weights, steps = secrets.train()
    data = secrets.training_sentences(99, 300)
    raw = [" ".join(w).encode() for w, _ in data]
    chunk = Chunk(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]), 0)
    place = lambda s: int(np.searchsorted(chunk.start, s, "right")) - 1
    got = {place(s) for _, s, _ in secrets.tagged(chunk, weights, steps, secrets.cue_hashes())}
    want = {int(chunk.word_at[i]) + j for i, (_, t) in enumerate(data) for j, x in enumerate(t) if x == 1}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got)
    f, start, end = secrets.features(chunk, secrets.cue_hashes())
    score = weights[f].sum(1)
    whole = set()
    for i in range(len(chunk)):
        a, b = chunk.word_at[i], chunk.word_at[i + 1]
        whole |= {int(a) + k for k, x in enumerate(secrets.viterbi(score[a:b], steps)) if x == 1 and end[a + k] - start[a + k] >= secrets.SHORTEST}
    assert whole == got  # splitting the path loses nothing


def test_decontamination(spark, docs, empty):
    item = "A train leaves Paris at 9 and goes 120 km to Lyon before it turns back with 40 people of the town on it."
    bench = spark.createDataFrame([(1, item), (2, "tiny one"), (3, None), (4, "the quick brown fox jumps")], "item_id long, text string")
    changed = item.replace("Paris", "Rome").replace("120", "85").replace("Lyon", "Pisa").replace("40", "7")
    broken = item.replace("Paris", "Rome").replace("Lyon", "Rome").replace("9", "85", 1).replace("120", "85").replace("40", "85")
    data = [(1, "Before it. " + item + " After it all."), (2, "Some words. " + changed), (3, "the quick brown fox jumps again"), (4, "nothing here to see at all my friend"), (5, None), (6, ""), (7, "x. " + broken), (1, "Before it. " + item + " After it all.")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.reparameterised for r in decontaminate.contaminated(df, bench).collect()}
    assert got.pop((7, 1), None) is None  # one value stands for all others of its kind
    assert got == {(1, 1): False, (2, 1): True, (3, 4): False}
    assert [r.doc_id for r in decontaminate.decontaminate(df, bench).orderBy("doc_id").collect()] == [4, 5, 6, 7]
    plain = decontaminate.contaminated(df, bench, decontaminate.Rules(broadcast=0))  # joined, not sent to tasks
    assert {(r.doc_id, r.item_id) for r in plain.collect()} == {(1, 1), (2, 1), (3, 4)}
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs, bench).count() == 0


def test_token_attribution_is_whole(spark, docs, empty):
    encode, size, lead = tokens.encoder(open(tokens.VOCABULARY, "rb").read(), tokens.PATTERN)
    texts = {r.doc_id: r.text or "" for r in docs.collect() if len(r.text or "") < 10_000}
    df = docs.filter("length(coalesce(text, '')) < 10000").dropDuplicates(["doc_id"])
    sums, chars = collections.Counter(), collections.Counter()
    for r in tokens.token_counts(df).collect():
        sums[r.doc_id] += r.n_tokens
        chars[r.doc_id] += r.n_chars
    assert sums == collections.Counter({d: len(encode(t)) for d, t in texts.items()}) and chars == collections.Counter({d: len(t) for d, t in texts.items()})
    text = b"Title\n\nSome prose with words.\n| a | b |\n"
    ids = np.array(encode(text.decode()))
    starts, _ = tokens.sections(text)
    owner, _ = tokens.attribute(ids, starts, size, lead)
    at = 0
    for k, t in enumerate(ids):  # one token after the other
        span = text[at : at + size[t]]
        first = at + (len(span) - len(span.lstrip(tokens.WHITE)) if span.strip(tokens.WHITE) else 0)
        assert owner[k] == sum(s <= first for s in starts) - 1
        at += size[t]
    assert tokens.token_counts(empty).count() == 0


def test_language_fusion(spark):
    text = {"en": "the cat and the dog went to the house with them ", "de": "der hund und die katze gingen zu dem haus mit ihnen ", "fr": "le chat et les chiens sont dans la maison avec eux "}
    rng = random.Random(1)
    shuffled = lambda lang, n: " ".join(rng.choices(text[lang].split(), k=n))
    docs = spark.createDataFrame([(k, shuffled(lang, 30), lang) for k, lang in enumerate(["en", "de", "fr"] * 30)], "doc_id long, text string, lang string")
    pages = [(k, f"http://www.{lang}site.com/{k}", f'<html lang="{lang}"><body>{shuffled(lang, 40)}</body></html>', "x") for k, lang in enumerate(["en", "de", "fr"] * 20)]
    pages += [(100, "http://www.desite.com/q", None, "x"), (101, None, None, "x"), (102, "http://www.frsite.com/", f'<html lang="en">{shuffled("fr", 40)}</html>', "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = {r.page_id: r.lang for r in language.identify(df, docs, Scratch(spark, "t")).collect()}
    assert len(got) == 63 and sum(got[k] == ["en", "de", "fr"][k % 3] for k in range(60)) >= 58
    assert got[100] == "de" and got[102] == "fr"
    assert language.identify(df.limit(0), docs, Scratch(spark, "t")).count() == 0


def test_licenses(spark, docs, empty):
    lines = [(1, "Some words.\nReleased under the MIT License.", "mit"), (2, "Licensed under the Apache License, Version 2.0.", "apache"), (3, "This work is licensed under the GNU General Public License, version 3.", "gpl"),
             (4, "He had a license to fish in the public lake and his driver's license too.", None), (5, None, None), (6, "", None)]
    df = spark.createDataFrame([x[:2] for x in lines], "doc_id long, text string")
    got = {r.doc_id: (r.family, r.confirmed) for r in licenses.scan(df).collect()}
    assert got == {d: (f, True) for d, _, f in lines if f}
    assert licenses.scan(empty).count() == 0 and licenses.scan(docs).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=90)) + "." for _ in range(12)]
    item = " ".join(rng.choices(words, k=20))
    texts += [texts[0], texts[1] + " tail", "too short", texts[2][:200] + " " + item + " " + texts[3][:300], texts[4] + ' token = "abcdef0123456789"', None]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path)).cache()
        assert docs.columns == before.columns, name
        seen.append({r.doc_id for r in docs.collect()})
    base = set(range(len(texts)))
    assert seen[0] == base - {14, 17}
    groups = brute_components([(d, texts[d]) for d in seen[0]], 5, 80)
    assert seen[1] == {d for d in seen[0] if groups[d][1] == d}
    assert seen[2] == seen[1] - {15} and seen[3] == seen[2]
    assert "abcdef0123456789" not in " ".join(r.text for r in docs.collect())
    mixed = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in mixed} == seen[3] and all(r.taken <= 2 * r.size for r in mixed)


def test_components_agree_with_union_find(spark):
    """A chain, stars from either end, a link of an id with itself, repeated links, and no links at all."""
    from inkspool.llm.graph import components

    links = [(i, i + 1) for i in range(40)] + [(500, 500 + i) for i in range(30)] + [(700 + i, 760) for i in range(30)] + [(7, 7), (3, 2), (3, 2), (900, 900)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = [tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"), "links").collect()]
    assert len(got) == len(dict(got)) and dict(got) == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test"), "links").isEmpty()


def test_licenses_in_short_forms(spark):
    lines = ["Licensed under CC BY-NC 4.0.", "Some words. Released under CC BY-SA 4.0", "licensed under CC BY 4.0.", "He was sent by the office of the city in a cc of the form."]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id: (r.family, r.confirmed) for r in licenses.scan(df).collect()} == dict.fromkeys(range(3), ("cc", True))
    # What the prefilter leaves out is unknown: all other features together do not reach it.
    weights, intercepts, _ = licenses.train(licenses.sample(df))
    needed = set(licenses.telling(weights, intercepts))
    rest = [np.maximum(w[1:] - w[0], 0) for g, w in weights.items() if not any(f" {x} " in f" {g} " for x in needed)]
    assert (sum(rest, intercepts[1:] - intercepts[0]) < 0).all()


def test_large_nodes_are_resolved_in_every_tree(spark, monkeypatch):
    rng = random.Random(11)
    passage = rng.choices("abcdefghij", k=200)  # most of every document, so that nearly all meet in large nodes only
    texts = []
    for _ in range(100):  # pairs just above the threshold, all others just below
        shared = [f"u{rng.randrange(10**6)}" for _ in range(4)]
        texts += [" ".join(passage + shared + [f"u{rng.randrange(10**6)}" for _ in range(24)]) for _ in range(2)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    roots = neardup._roots

    def late(trees, depth):
        def run(batches):
            for k, batch in enumerate(roots(trees, depth)(batches)):
                if k % trees >= 8:
                    yield batch

        return run

    monkeypatch.setattr(neardup, "_roots", late)
    for join in (neardup.Join(), neardup.Join(dense=30, part=16)):  # in one task, and in pairs of blocks
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, Scratch(spark, "t"), join).collect()}
        assert got == brute_components(rows, 5, 80)


def test_decontamination_finds_passages_of_long_items(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    item, other = words[:200], words[200:]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    passages = [item[50:120], item[50:63], item[50:62], item[20:28] + other[:9] + item[90:98], item[:8] + other[:1] + item[9:17]]
    df = spark.createDataFrame([(k, " ".join(other[:40] + p + other[40:])) for k, p in enumerate(passages)], "doc_id long, text string")
    for rules in (decontaminate.Rules(), decontaminate.Rules(broadcast=0)):
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, rules).collect()} == {(0, 1), (1, 1)}
    assert {r.doc_id for r in decontaminate.decontaminate(df, bench).collect()} == {2, 3, 4}


def test_decontamination_finds_exact_copies_of_every_item(spark):
    items = ["Compute 12 + 34 * 5", "page 7 of it", "3 1 4 1 5 9 2 6 5 3 5 8", "We met Anna, Bert, Carl, Dora, Emil, Fritz, Gerd, Hans, Ida there"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"and then {x} and on" for x in items] + ["compute 13 + 35 * 6", "page 8 of it", "2 7 1 8 2 8 1 8 2 8 4 5", items[3].replace("Bert", "Bob").replace("Dora", "Dan").replace("Gerd", "Gus")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rules in (decontaminate.Rules(), decontaminate.Rules(broadcast=0)):
        assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench, rules).collect()} == {(k, k) for k in range(4)}


def test_secrets_keep_what_the_model_adds_to_a_base_span(spark):
    texts = ['password = "hunter2xyz!Q9$kk"', "token=aB3dE6fG7hJ8!kL9mN0pQ2rS and more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.spans for r in secrets.scan(df).orderBy("doc_id").collect()] == ["assign:0:22,crf:22:28", "assign:0:18,crf:18:30"]
    out = [r.text for r in secrets.redact(df).orderBy("doc_id").collect()]
    assert not any(x in t for t in out for x in ("Q9", "kk", "kL9"))
    assert secrets.uncovered(0, 9, [(2, 3, ""), (1, 5, ""), (7, 20, "")]) == [(0, 2), (5, 7)] and secrets.uncovered(3, 5, [(0, 4, ""), (6, 9, "")]) == [(4, 5)]


def test_pipeline_keeps_rows_without_or_with_a_shared_doc_id(spark, tmp_path):
    import corpus_pipeline as pipeline

    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    a, b, c, d, e, item = (" ".join(rng.choices(words, k=40)) for _ in range(6))
    data = [(None, a), (None, b), (None, a), (1, c), (1, d), (1, c), (2, d), (0, e), (3, e), (4, ""), (4, None), (5, ""), (None, item), (6, item), (6, b)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    count = lambda df: collections.Counter((r.doc_id, r.text or "") for r in df.collect())
    kept = pipeline.near_dedup(spark, docs, str(tmp_path))
    assert count(kept) == collections.Counter([(None, a), (None, b), (None, a), (1, c), (1, d), (0, e), (4, ""), (5, ""), (None, item), (6, item), (6, b)])
    clean = pipeline.decontamination(spark, kept, str(tmp_path))
    assert count(clean) == count(kept) - collections.Counter([(None, item), (6, item)]) and clean.columns == docs.columns


def test_mixing_makes_the_shards(spark, docs, empty):
    rows = mixing.mixed(docs).collect()
    assert len({(r.shard, r.source, r.slot) for r in rows}) == len(rows)
    # Of every source, its words in their order, cut into blocks; a block is drawn as often as the plan says.
    sources, at, drawn, _ = mixing.mix(docs)
    assert len(rows) == drawn.count()
    texts = {}
    for r in at.join(docs.select("doc_id", "text").distinct(), "doc_id").distinct().orderBy("start").collect():
        texts.setdefault(r.source, []).extend(WORD.findall(r.text or ""))
    for r in rows:
        assert r.text.split(" ") == texts[r.source][r.block * 64 : (r.block + 1) * 64] and r.doc_ids
    counts = collections.Counter()
    for r in rows:
        counts[r.source] += len(r.text.split(" "))
    assert all(len(p.text.split(" ")) == p.n for r in mixing._mixed(at, drawn, mixing.mix(docs)[3]).collect() for p in r.parts)
    sums = mixing.taken(docs).alias("t").join(docs.select("doc_id", "source").distinct(), "doc_id").groupBy("source").sum("taken").collect()
    assert counts == {r[0]: r[1] for r in sums} and mixing.mixed(empty).count() == 0


def test_chat_renders_long_conversations_from_the_start(spark):
    def moves(turns):  # the first text goes into the last turn
        return "".join(f"<{t}>" for _, t in turns[1:-1]) + f"<{turns[0][1]}|{turns[-1][1]}>"

    turns = [("system", "rules")] + [("user", f"t{k}") for k in range(40)]
    assert [x[3] for x in chat.spans(turns, moves)] == [False] + [True] * 40
    assert [x[0] for x in chat.spans(turns, moves)][-1] == "t38><rules|t39>"
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    assert [r.span for r in chat.formatted(df, moves).orderBy("turn").collect()] == [x[0] for x in chat.spans(turns, moves)]
    assert list(chat.spans(turns)) == list(chat.spans(turns, lambda x: chat.render(x)))
