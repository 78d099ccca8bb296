"""The findings of round 2: rare rows that the smallest tables do not hold."""

import duckdb
import numpy as np
import pytest

from inkspool import queries
from inkspool.operators import assets


@pytest.fixture
def against_sql(spark, tmp_path):
    """The rows of a query and of its SQL over (vec_id, embedding, label) rows."""

    def both(name, vectors, kind="float"):
        spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
        con = duckdb.connect()
        con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
        return sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect()), key=str), sorted(con.sql(queries.SQL[name]).fetchall(), key=str)

    return both


def test_contents_that_share_an_svg_stay_one_row_each(spark):
    files = assets.hashed(spark.createDataFrame([(f"in/{c}.png", c.encode()) for c in "abcd"], "path string, content binary"))
    ids = {r.path[3]: r.asset_id for r in files.collect()}
    manifest = spark.createDataFrame([(ids["a"], "s.svg", True), (ids["b"], "s.svg", False), (ids["c"], "t.svg", True)], "asset_id string, svg string, passed boolean")
    metadata = spark.createDataFrame([("s.svg", "ai"), ("s.svg", "ai"), ("s.svg", "dummy"), ("t.svg", "dummy"), ("t.svg", None), ("d.svg", "ai")], "svg string, source string")
    outputs = spark.createDataFrame([("s.svg",), ("s.svg",), ("t.svg",), ("d.svg",)], "svg string")
    got = assets.repaired(files, manifest, metadata, outputs).collect()
    assert sorted((r.path, r.svg, r.status) for r in got) == [("in/a.png", "s.svg", "ready"), ("in/b.png", "s.svg", "needs_review"), ("in/c.png", "t.svg", "needs_metadata"), ("in/d.png", "d.svg", "needs_review")]


def test_histogram_takes_colours_in_single_precision(against_sql):
    steps = np.float32(np.arange(-40, 40) / 127)  # in double precision, half of them fall just below a whole colour
    got, want = against_sql("bucket_histogram", [(k, [float(v)] * 64, k % 3) for k, v in enumerate(steps)])
    assert got == want


def test_histogram_of_short_and_outlying_vectors(against_sql):
    got, want = against_sql("bucket_histogram", [(0, [-1.04, 0.0, -9.0], 1), (1, [0.5], 1), (2, [], 2), (3, None, 2), (4, [None, 0.1, 0.2], 0)])
    assert got == want


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("name", ["ink_box", "box_drift"])
def test_boxes_compare_in_the_type_of_the_numbers(against_sql, name, kind):
    at = np.float32(0.15)  # above 0.15 in double precision
    around = [float(x) for x in (np.nextafter(at, np.float32(0)), at, np.nextafter(at, np.float32(1)))]
    got, want = against_sql(name, [(k, [0.0] * 9 + [v] + [0.0] * 20 + [0.5] + [0.0] * 32 + [v], 0) for k, v in enumerate(around)], kind)
    assert got == want


@pytest.mark.parametrize("name", ["ink_box", "box_drift"])
def test_boxes_of_vectors_of_other_lengths(against_sql, name):
    got, want = against_sql(name, [(0, None, 0), (1, [], 0), (2, [0.5], 0), (3, [0.0] * 30 + [0.5] * 70, 0), (4, [None, 0.2, float("nan")] + [0.0] * 61, 0), (5, [0.0] * 64, 0)])
    assert got == want
