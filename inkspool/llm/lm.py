"""Operator 4: LM scoring by a log-bilinear model trained with noise contrast.

Token counts are taken over all training documents. The model predicts one of
OUTPUTS ids from the two ids before it: the most frequent words and the end have
ids of their own, all other words share ids by their endings and lengths and are
then told apart by their counts within the id, so that probabilities sum to one
over all known words and one unknown word per shared id.

Training is numpy, in rounds; each document is in one of them. A round's documents
are dealt to shards of about SHARD_TOKENS tokens by a hash of id and text, and lie
there in the order of that hash; every shard takes noise-contrastive gradient steps
from the same start, and the results are averaged by tokens in whole numbers. So the
model depends on the rows, not on their files or tasks, and a shard takes as many
steps whatever the size of the table.

As the model is log-bilinear in two context words, all its normalisers are one
matrix product: exp(scores by the one) times exp(scores by the other), transposed.
Tokens are scored by look-ups in these tables, which a worker makes once.

Texts are read twice, to count words and to encode them; the encoded tokens are a
table in the scratch folder, from which the rounds and the scores are made.

Cases: a null text is empty and has the end as its only token; a null doc_id
counts as held out; repeated rows are scored one by one, and learnt from once; an
empty table gives no rows. Extra columns are ignored.

Scale: the HEAD most frequent words (a fixed bound) go to every task; the counts
of the others are joined. The driver holds the head and the model only.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.llm.words import Chunk, as_signed, chunks, mix
from inkspool.session import Scratch

HEAD = 1 << 18
OWN, SHARED, WIDTH = 1280, 256, 32
OUTPUTS = OWN + SHARED
END_HASH, END = np.int64(-7_046_029_254_386_353_131), OWN - 1
NOISE, BATCH, RATE, ROUNDS = 64, 8192, 0.15, 2
SHARD_TOKENS = 2_000_000
SCALE = 1 << 20
_tables: dict = {}


def shared_id(chunk: Chunk) -> np.ndarray:
    """The shared id that each word would have: by its last two bytes and its length."""
    last = chunk.data[chunk.end - 1].astype(np.uint64)
    size = chunk.end - chunk.start
    before = np.where(size > 1, chunk.data[np.maximum(chunk.end - 2, 0)], 0).astype(np.uint64)
    return (OWN + mix(last * np.uint64(65536) + before * np.uint64(256) + np.minimum(size // 3, 5).astype(np.uint64)) % np.uint64(SHARED)).astype(np.int32)


def _count(batches):
    """(h, c, b): word hashes, their counts in a batch, their shared ids."""
    for batch in batches:
        for chunk in chunks(batch.column(0), 16 << 20):
            h, first, c = np.unique(as_signed(chunk.hashes()), return_index=True, return_counts=True)
            b = shared_id(chunk)[first] if len(first) else np.zeros(0, np.int32)
            h, c, b = np.append(h, END_HASH), np.append(c, len(chunk)), np.append(b, END).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c.astype(np.int64)), pa.array(b)], ["h", "c", "b"])


class Vocabulary:
    """hashes (sorted) and counts of the head; own: the model's ids of its first words."""

    def __init__(self, h: np.ndarray, c: np.ndarray):
        order = np.argsort(h)
        self.h, self.c = h[order], c[order]
        rank = np.lexsort((self.h, -self.c))
        rank = rank[self.h[rank] != END_HASH][: OWN - 1]
        self.id = np.full(len(h), -1, np.int32)
        self.id[rank] = np.arange(len(rank))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places in the head, or -1."""
        if not len(self.h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, at, -1)

    def ids(self, chunk: Chunk, place: np.ndarray) -> np.ndarray:
        out = shared_id(chunk)
        has = place >= 0
        own = np.where(has, self.id[place], -1) if len(self.id) else np.full(len(place), -1)
        return np.where(own >= 0, own, out)


def sequences(counts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, one before, two before, id) of all tokens of texts with so many words, ends included."""
    n, total = len(counts), len(ids) + len(counts)
    ends = np.cumsum(counts) + np.arange(n)
    token = np.full(total, END, np.int32)
    words = np.ones(total, bool)
    words[ends] = False
    token[words] = ids
    doc = np.repeat(np.arange(n), counts + 1)
    one = np.concatenate([[END], token[:-1]])  # an end stands before every text
    two = np.concatenate([[END, END], token[:-2]])[:total]
    two[np.concatenate([[0], ends[:-1] + 1])] = END
    return doc, one.astype(np.int32), two.astype(np.int32), token


def start_parameters(unigram: np.ndarray) -> list[np.ndarray]:
    rng = np.random.default_rng(4)
    return [rng.normal(0, 0.1, (OUTPUTS, WIDTH)).astype(np.float32) for _ in range(3)] + [np.log(unigram).astype(np.float32)]


def _scatter(at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, j], OUTPUTS) for j in range(WIDTH)], 1).astype(np.float32)


def contrast(parameters, squares, unigram, one, two, token, rng) -> None:
    """Noise-contrastive steps over the tokens, in place; squares: sums of squared gradients."""
    c1, c2, r, bias = parameters
    log_noise = np.log(NOISE * unigram).astype(np.float32)
    cdf = np.cumsum(unigram)
    for s in range(0, len(token), BATCH):
        x, y, w = one[s : s + BATCH], two[s : s + BATCH], token[s : s + BATCH]
        noise = np.minimum(np.searchsorted(cdf, rng.random(NOISE)), OUTPUTS - 1)
        q = c1[x] + c2[y]
        t = 1 / (1 + np.exp(log_noise[w] - (q * r[w]).sum(1) - bias[w]))
        n = 1 / (1 + np.exp(np.clip(log_noise[noise] - bias[noise] - q @ r[noise].T, -30, 30)))
        up = (1 - t).astype(np.float32)
        dq = up[:, None] * r[w] - n @ r[noise]
        dr = _scatter(w, up[:, None] * q)
        np.add.at(dr, noise, -(n.T @ q))
        db = np.bincount(w, up, OUTPUTS)
        np.add.at(db, noise, -n.sum(0))
        for p, g, v in zip(parameters, (_scatter(x, dq), _scatter(y, dq), dr, db.astype(np.float32)), squares, strict=True):
            g /= len(w)
            v += g * g
            p += RATE * g / (np.sqrt(v) + 1e-6) * np.float32(0.2)


def _tokens(batch, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, one before, two before, id) of the encoded texts of a batch."""
    texts = batch.column(column).to_pylist()
    ids = np.frombuffer(b"".join(texts), np.int16).astype(np.int32)
    return sequences(np.array([len(t) // 2 for t in texts], np.int64), ids)


def _train(start, unigram, number: int):
    """Sums of the shards' parameters by tokens, from (shard, key, ids) in that order."""

    def learnt(shard: int, held: list) -> tuple[np.ndarray, int]:
        one, two, token = (np.concatenate([x[j] for x in held]) for j in range(3))
        parameters = [p.copy() for p in start]
        contrast(parameters, [np.zeros_like(p) + np.float32(1e-8) for p in parameters], unigram, one, two, token, np.random.default_rng([11, number, shard]))
        flat = np.concatenate([p.ravel() for p in parameters])
        return np.round(np.clip(flat, -50, 50).astype(np.float64) * SCALE).astype(np.int64) * len(token), len(token)

    def run(batches):
        shard, held, total, tokens = None, [], 0, 0
        for batch in batches:
            shards = batch.column(0).to_numpy()
            if not len(shards):
                continue
            doc, one, two, token = _tokens(batch, 1)
            for s in np.unique(shards).tolist():
                if s != shard and held:
                    sums, n = learnt(shard, held)
                    total, tokens, held = total + sums, tokens + n, []
                shard, own = s, (shards == s)[doc]
                held.append((one[own], two[own], token[own]))
        if held:
            sums, n = learnt(shard, held)
            total, tokens = total + sums, tokens + n
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total) + 1, dtype=np.int32)), pa.array(np.append(total, tokens))], ["k", "x"])

    return run


def log_tables(parameters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Natural logs: scores of each id by the word before, by the word before that, and normalisers by both."""
    c1, c2, r, bias = parameters
    one, two = c1 @ r.T + bias, c2 @ r.T
    top_one, top_two = one.max(1, keepdims=True), two.max(1, keepdims=True)
    z = np.log(np.exp(one - top_one) @ np.exp(two - top_two).T) + top_one + top_two.T
    return one, two, z


def log_probabilities(tables, one: np.ndarray, two: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Natural log of the normalised probability of every token."""
    by_one, by_two, z = tables
    return by_one[one, token].astype(np.float64) + by_two[two, token] - z[one, two]


def _encode(vocabulary: Vocabulary, total: float, shared_log: np.ndarray):
    """One row per text: its ids, what the head gives, and the other words with their numbers."""

    def run(batches):
        end = vocabulary.find(np.array([END_HASH]))[0]
        end = vocabulary.c[end] if end >= 0 else 0
        for batch in batches:
            for chunk in chunks(batch.column(4)):
                h = as_signed(chunk.hashes())
                place = vocabulary.find(h)
                ids, n = vocabulary.ids(chunk, place), len(chunk)
                known = place >= 0
                own = np.where(known, np.log10(vocabulary.c[place] + 0.1), 0) if len(vocabulary.c) else np.zeros(len(place))
                doc = chunk.doc
                base = np.bincount(doc, own, n) + np.log10(end + 0.1) - (chunk.counts + 1) * total
                within = np.bincount(doc, np.where(ids >= OWN, own - shared_log[np.maximum(ids - OWN, 0)], 0), n)
                rest = np.flatnonzero(~known)
                order = rest[np.lexsort((h[rest], doc[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                at = np.searchsorted(doc[order[first]], np.arange(n + 1))
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x, kind))
                raw = ids.astype(np.int16)
                n_known = np.bincount(doc, known, n).astype(np.int64) + (end > 0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(j).slice(chunk.first, n) for j in range(4)), pa.array((chunk.counts + 1).astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(within),
                     pa.array([raw[chunk.word_at[i] : chunk.word_at[i + 1]].tobytes() for i in range(n)], pa.binary()), lists(h[order[first]], pa.int64()), lists(times, pa.int32())],
                    ["uid", "doc_id", "held_out", "key", "n_tokens", "n_known", "base", "within", "ids", "rest", "times"],
                )

    return run


ENCODED = "uid long, doc_id long, held_out boolean, key long, n_tokens long, n_known long, base double, within double, ids binary, rest array<long>, times array<int>"


def _score(parameters):
    name = hash(tuple(p.tobytes() for p in parameters))

    def run(batches):
        if name not in _tables:
            _tables.clear()
            _tables[name] = log_tables(parameters)
        for batch in batches:
            if not len(batch):
                continue
            doc, one, two, token = _tokens(batch, 7)
            score = np.bincount(doc, log_probabilities(_tables[name], one, two, token), len(batch)) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(6)), pa.array(score + batch.column(6).to_numpy())], ["uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"])

    return run


class Model(NamedTuple):
    """vocabulary: the head; parameters: of the bilinear model; shared_log: log10 of the
    mass of each shared id; counts: of all words; least: of the head's rarest; tokens:
    of all training documents."""

    vocabulary: Vocabulary
    parameters: list
    shared_log: np.ndarray
    counts: DataFrame
    least: int
    tokens: int


def fit(documents: DataFrame, scratch: Scratch, text: str = "text") -> tuple[Model, DataFrame]:
    """(the model, the encoded documents)."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10
    docs = documents.select(F.monotonically_increasing_id().alias("uid"), "doc_id", (crc == 0).alias("held_out"), F.xxhash64("doc_id", text).alias("key"), F.col(text).alias("text"))
    counts = docs.filter("not held_out").select("text").mapInArrow(_count, "h long, c long, b int").groupBy("h").agg(F.sum("c").alias("c"), F.min("b").alias("b"))
    counts = scratch.cut(counts, "counts")
    tokens, distinct = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    # The head: as many of the most frequent words as fit, in whole steps of frequency.
    steps, fits, least = counts.groupBy(F.floor(F.log2("c") * 16).alias("s")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("s")).collect(), 0, 1 << 62
    for row in steps:
        fits += row["n"]
        if fits > HEAD:
            break
        least = row["c"]
    head = counts.filter(F.col("c") >= least).toPandas()
    vocabulary = Vocabulary(head["h"].to_numpy(np.int64), head["c"].to_numpy(np.int64))
    # Counts of the model's ids: own words, and what is left for the shared ones.
    by_id = counts.groupBy("b").agg(F.sum("c").alias("c"), F.count("*").alias("v")).toPandas().set_index("b")
    mass, kinds = (np.array([by_id[k].get(OWN + j, 0) for j in range(SHARED)], float) for k in ("c", "v"))
    own_mass = np.zeros(OWN)
    shared_of = dict(zip(head["h"].tolist(), head["b"].tolist(), strict=True))
    for place in np.flatnonzero(vocabulary.id >= 0):
        own_mass[vocabulary.id[place]] = vocabulary.c[place]
        j = shared_of[int(vocabulary.h[place])] - OWN
        mass[j], kinds[j] = mass[j] - vocabulary.c[place], kinds[j] - 1
    own_mass[END] = by_id["c"].get(END, 0)
    unigram = np.concatenate([own_mass, mass]) + 0.5
    unigram /= unigram.sum()
    shared_log = np.log10(mass + 0.1 * (kinds + 1))
    total = float(np.log10(tokens + 0.1 * (distinct + 1)))
    encoded = scratch.cut(docs.mapInArrow(_encode(vocabulary, total, shared_log), ENCODED), "encoded")
    parameters = start_parameters(unigram)
    shapes = [p.shape for p in parameters]
    shards = max(1, -(-tokens // (ROUNDS * SHARD_TOKENS)))
    dealt = encoded.filter("not held_out").groupBy("key").agg(F.first("ids").alias("ids"))
    dealt = dealt.select(F.pmod("key", F.lit(ROUNDS)).alias("round"), F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "ids")
    for k in range(ROUNDS):
        part = dealt.filter(F.col("round") == k).repartition("shard").sortWithinPartitions("shard", "key").select("shard", "ids")
        sums = part.mapInArrow(_train(parameters, unigram, k), "k int, x long").groupBy("k").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).orderBy("k").toPandas()
        if len(sums):
            x = np.array([int(v) for v in sums["x"]], dtype=object)
            flat = (x[:-1] / int(x[-1]) / SCALE).astype(np.float32)
            parameters = [p.reshape(s) for p, s in zip(np.split(flat, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes, strict=True)]
    return Model(vocabulary, parameters, shared_log, counts, least, tokens), encoded


def score(documents: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    model, encoded = fit(documents, scratch, text)
    made = encoded.select("uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "within", "ids").mapInArrow(_score(model.parameters), "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double")
    rest = encoded.select("uid", F.explode(F.arrays_zip("rest", "times")).alias("r")).select("uid", F.col("r.rest").alias("h"), F.col("r.times").alias("n"))
    found = rest.join(model.counts.filter(F.col("c") < model.least).select("h", "c"), "h", "left").select("uid", "n", F.coalesce("c", F.lit(0)).alias("c"))
    rest = found.groupBy("uid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.1)).alias("x"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"))
    out = made.join(rest, "uid", "left")
    x = F.coalesce("x", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + x).alias("base_score"), (F.col("score") + x).alias("score"),
    )


def op4_lm(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "op4"))
