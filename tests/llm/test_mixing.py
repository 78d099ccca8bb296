"""Mixing: the draw, the permutations and the dealing."""

import collections
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from inkspool.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def test_permutations_are_whole_and_scattered(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        keys = F.array(*(F.struct((mixing.digits(F.lit(f"k{i}"), 1, 13) % n).alias("a"), mixing.digits(F.lit(f"k{i}"), 14, 7).alias("b")) for i in range(mixing.ROUNDS)))
        rows = spark.range(n).select("id", F.col("id").alias("x"), F.lit(n).cast("long").alias("blocks"), keys.alias("keys"))
        got = [r.x for r in mixing.permuted(rows).orderBy("id").collect()]
        assert sorted(got) == list(range(n))
    steps = collections.Counter((b - a) % 1000 for a, b in zip(got, got[1:]))
    assert max(steps.values()) < 20  # no stride
    first = sorted(got[:250])  # a part of a pass reads no lattice of blocks
    assert 30 < sum(x < 125 for x in first) * 4 < 250


def test_the_counts_of_the_shards_decide_the_result(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 70)
    data = [(k, "w " * 64, "abc"[k % 3]) for k in range(3000)]
    df = spark.createDataFrame(data, SCHEMA)
    rows = mixing.mixed(df).collect()
    counts = collections.Counter((r.shard, r.source) for r in rows)
    shards, targets = max(s for s, _ in counts) + 1, {r.source: r.slots for r in mixing.mix(df)[0].collect()}
    assert shards == 65 and sum(targets.values()) == 4500
    own = [counts[(s, "b")] - 70 * targets["b"] / 4500 for s in range(64)]
    assert all(abs(x) < 2 for x in own) and len(set(own)) > 1  # drawn, near the shard's share
    total = collections.Counter(r.source for r in rows)
    assert all(abs(total[x] - targets[x]) <= 2 * math.sqrt(shards) for x in "abc")
    taken = mixing.taken(df.withColumn("doc_id", F.col("doc_id") % 3)).groupBy("doc_id").agg(F.sum("taken")).collect()
    assert {"abc"[d]: n for d, n in taken} == {x: 64 * n for x, n in total.items()}


def test_targets_of_small_sources(spark):
    data = [(k % 20, "w " * (k * 37 % 300), f"s{k % 20}") for k in range(1000)]
    out = mixing.taken(spark.createDataFrame(data, SCHEMA)).groupBy("doc_id", "source_size", "target").agg(F.sum("taken").alias("n")).collect()
    assert len(out) == 20 and all(abs(r.n - r.target) <= 3 * 64 for r in out)


@pytest.mark.parametrize("stride", [1, 13])
def test_ranges_are_even_whatever_the_ids(spark, monkeypatch, stride):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 100)
    data = [(k * stride if k % 2 else None, f"a{k} b", "hot" if k % 3 else None) for k in range(1300)]
    df = spark.createDataFrame(data, SCHEMA)
    sized = df.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", mixing.words(F.col("text")).alias("size"), F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(2), "text").cast("binary")).alias("digest"), F.lit(0).alias("h1"), F.lit(0).alias("h2"))
    at = mixing.placed(sized, ["digest", "source"])
    ranges = at.groupBy("source", (F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % 13).alias("r")).count().collect()
    assert len(ranges) == 26 and max(r["count"] for r in ranges) < 120
    starts = collections.defaultdict(list)
    for r in at.collect():
        starts[r.source].append(r.start)
    assert all(sorted(v) == list(range(0, 2 * len(v), 2)) for v in starts.values())
    documents = df.toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    want = duckdb.connect().sql(f"select {', '.join(cols)} from ({mixing.mixing_sql('documents')})").fetchall()
    key = lambda r: [(x is None, x or 0) for x in r]
    got = sorted((tuple(r) for r in mixing.taken(df).select(*cols).collect()), key=key)
    assert got == sorted(want, key=key)


def test_reruns_agree_on_any_layout(spark):
    data = [(k, "v " * (k % 90), f"s{k % 4}") for k in range(400)]
    one, two = (sorted(map(tuple, mixing.taken(spark.createDataFrame(data, SCHEMA).repartition(n)).collect())) for n in (1, 5))
    assert one == two
