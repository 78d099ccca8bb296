"""Connected components of an edge table, without any of it on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.session import Scratch

#: Centres that are joined by broadcast, at most.
HOT_CENTRES = 16_384
#: A centre with fewer neighbours is never hot.
HOT_DEGREE = 4_096


def join_spread(rows: DataFrame, table: DataFrame, key: str | list[str], degree: str, total: int, how: str = "inner", hot_degree: int = HOT_DEGREE) -> DataFrame:
    """rows joined with a table of one row per key and its number of rows (degree).

    Keys with more than a HOT_CENTRES-th of all rows (total), of which there are no
    more than HOT_CENTRES, are joined by broadcast, so no task gets all rows of one.
    """
    keys = [key] if isinstance(key, str) else key
    hot, table = table.filter(F.col(degree) > max(hot_degree, total // HOT_CENTRES)).drop(degree), table.drop(degree)
    if hot.isEmpty():
        return rows.join(table, keys, how)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table, keys, how)
    return cold.unionByName(rows.join(F.broadcast(hot), keys))


def components(edges: DataFrame, scratch: Scratch, name: str, hot_degree: int = HOT_DEGREE) -> DataFrame:
    """(id, component) of all ids of the edges (a, b); component is the smallest id reached.

    Alternating large-star and small-star rounds: every round hangs the
    neighbours of an id under the smallest of them, until all ids hang directly
    under the smallest of their component. A star's centre has many edges;
    its neighbours are only ever aggregated and joined, those of a very large star
    by broadcast of its centre.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    for k in range(1, 100):
        both = now.union(now.select("v", "u"))
        least = scratch.cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"), "degree"), f"{name}-least-{k}")
        size = (least.agg(F.sum("degree")).first()[0] or 0) // 2
        # Neighbours above a centre, and the centre itself, go under its least neighbour.
        large = join_spread(now.select("u", F.col("v").alias("c")), least, "c", "degree", size, hot_degree=hot_degree)
        large = large.select("u", F.col("m").alias("v"))
        large = large.union(least.filter("m < c").select("c", F.col("m").alias("v")))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(smallest.select("u", F.col("m").alias("v")))
        now = scratch.cut(small.distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-least-{k}", f"{name}-{k - 1}")
        # Settled: no id hangs under two, none that hangs has others under it.
        ends = now.select(F.col("u").alias("id"), F.lit(1).alias("under"), F.lit(0).alias("over")).union(now.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("id").agg(F.sum("under").alias("under"), F.max("over").alias("over")).filter("under + over > 1 and under > 0").isEmpty():
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    raise RuntimeError("components did not settle")
