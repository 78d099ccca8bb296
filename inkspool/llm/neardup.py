"""Operator 6: near-duplicates by a chosen-path set similarity join.

Every document is the set of its word shingles, sketched by SIZE minwise
values. Documents with equal sets form a class, and one document stands for it.
A tree branches the classes: at a node, one or two coordinates are chosen (as
many as 1 / similarity on average), and a class goes to the child named by its
minwise value there. Classes that end in a node of their own are done; a small
node is compared exhaustively, first by sketches, then on the full sets; in a
large one every class is compared with the node's first; classes which that does
not unite meet all others of the node, by exact intersections of their full sets.
TREES independent trees repeat this: a pair at the threshold meets in a tree with
probability 0.64, so it is missed with probability 0.36 ** TREES, about 1e-9,
whatever the sizes of its nodes.

Links are confirmed on full sets of 64-bit shingle hashes, made of 64-bit word
hashes that have no built collisions. Pairs are dropped unconfirmed only if fewer
than SKETCH_SHARE of their minwise values agree, which lies 7 standard deviations
below the threshold.

Scale: nodes with more rows than a task should take are found by a tally of a
fixed number of counters; their rows are dealt by class, not by node, all through.
What meets in a large node is pairs of blocks of ``part`` classes, one of the two
not united with the node's first class; two blocks that are never meet. Joins by
a class or a star with very many rows broadcast that key's row.

Cases: a null or blank text has an empty set and is linked with nothing; a text
with fewer words than a shingle is one shingle; rows that share a doc_id are each
judged by their own text; a null doc_id is never linked. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspool.llm.graph import components, join_spread
from inkspool.llm.words import as_signed, chunks, mix
from inkspool.session import Scratch

SIZE = 128
_rng = np.random.default_rng(611)
FACTORS = _rng.integers(0, 1 << 31, SIZE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _rng.integers(0, 1 << 32, SIZE, dtype=np.uint32)


#: Elements with so many owners or fewer are counted pair by pair.
FEW_OWNERS = 16
#: Counters of the tally of nodes.
TALLY = 1 << 16


@dataclass(frozen=True)
class Join:
    """words: of a shingle; percent: similarity to reach; trees: independent
    trees; depth: levels before nodes are compared; small: classes of a node that
    is compared exhaustively; part: classes of a large node that one task compares
    with the node's first, or of one block of a pair of blocks; dense: classes of
    a large node that meet in one task; hot: rows of a node that one task may sort,
    or four times a counter's average, whatever is more."""

    words: int = 5
    percent: int = 80
    trees: int = 20
    depth: int = 3
    small: int = 24
    dense: int = 4096
    part: int = 2048
    hot: int = 4096
    sketch_share: float = 0.55


def shingle_sets(chunk, words: int):
    """(first, hashes): the sorted distinct shingle hashes of text i are hashes[first[i]:first[i + 1]]."""
    text, value = chunk.windows(chunk.hashes(), words)
    order = np.argsort(text, kind="stable")
    text, value = text[order], value[order]
    at = np.searchsorted(text, np.arange(len(chunk) + 1))
    for i in np.flatnonzero(np.diff(at) > 1):
        value[at[i] : at[i + 1]].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return np.concatenate([[0], np.cumsum(new)])[at], value[new]


def _sketch(words: int):
    def run(batches):
        for batch in batches:
            ids, marks = batch.column(0), batch.column(2)
            for chunk in chunks(batch.column(1)):
                first, value = shingle_sets(chunk, words)
                count = np.diff(first)
                some = np.flatnonzero(count)
                sketch = np.zeros((len(chunk), SIZE), np.uint16)
                keys = np.zeros((2, len(chunk)), np.uint64)
                if len(some):
                    low = (value >> np.uint64(32)).astype(np.uint32)
                    starts = first[:-1][some]
                    scratch = np.empty_like(low)
                    for j in range(SIZE):
                        np.multiply(low, FACTORS[j], out=scratch)
                        np.add(scratch, SHIFTS[j], out=scratch)
                        least = np.minimum.reduceat(scratch, starts)
                        sketch[some, j] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
                    keys[0, some] = np.add.reduceat(value * np.uint64(0x9E3779B97F4A7C15), starts)
                    keys[1, some] = np.add.reduceat(mix(value), starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(chunk.first, len(chunk)),
                        marks.slice(chunk.first, len(chunk)),
                        pa.array(count.astype(np.int64)),
                        pa.array(as_signed(keys[0])),
                        pa.array(as_signed(keys[1])),
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    ["doc_id", "h", "n_shingles", "k1", "k2", "sketch"],
                )

    return run


def _paths(nodes: np.ndarray, sketch: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children that the rows go to: one of each node, and of a quarter of the nodes two."""
    size = sketch.shape[1]
    one = mix(nodes + np.uint64(0x51))
    out = []
    for pick, here in ((one, slice(None)), (mix(one), (one >> np.uint64(40)) % np.uint64(4) == 0)):
        at = (pick[here] % np.uint64(size)).astype(np.int64)
        value = sketch[row[here], at].astype(np.uint64)
        out.append((mix(nodes[here] * np.uint64(0x9E3779B97F4A7C15) + (at.astype(np.uint64) << np.uint64(17)) + value + np.uint64(1)), row[here]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def _roots(trees: int, depth: int):
    """Every representative's nodes at the given depth of all trees."""

    def run(batches):
        for batch in batches:
            ids, sketch = batch.column(0).to_numpy(), _sketches(batch.column(1))
            n = len(ids)
            if not n:
                continue
            for tree in range(trees):
                nodes, row = np.full(n, mix(np.array([tree + 1], np.uint64))[0]), np.arange(n)
                for _ in range(depth):
                    nodes, row = _paths(nodes, sketch, row)
                nodes = nodes & ~np.uint64(31) | np.uint64(tree % 32)  # the tree stays readable in the node
                yield pa.RecordBatch.from_arrays([pa.array(as_signed(nodes)), pa.array(ids[row])], ["node", "id"])

    return run


def _tally(trees: int, depth: int):
    """(bucket, n): how many nodes begin with which bits."""
    roots = _roots(trees, depth)

    def run(batches):
        total = np.zeros(TALLY, np.int64)
        for batch in roots(batches):
            total += np.bincount((batch.column(0).to_numpy().view(np.uint64) >> np.uint64(48)).astype(np.int64), minlength=TALLY)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return run


def _runs(small: int, part: int):
    """Members of nodes with two documents or more, from (node, id) in that order.

    Output: node, part, id, first. A large node comes in parts, each with the
    node's first document in front. Only the rows of one small node are held.
    """

    def run(batches):
        held_node, held, count, first = None, [], 0, 0

        def cut(node, ids, first, at, out):
            """ids, at places at.. of the large node, to their parts."""
            for k in range(at // part, (at + len(ids) - 1) // part + 1):
                own = ids[max(0, k * part - at) : (k + 1) * part - at]
                if k * part >= at and k:
                    own = np.concatenate([[first], own])
                out.append((np.full(len(own), node), np.full(len(own), k), own, np.full(len(own), first), np.ones(len(own), bool)))

        def close(out):
            if held_node is not None and 1 < count <= small:
                ids = np.concatenate(held)
                out.append((np.full(len(ids), held_node), np.zeros(len(ids), np.int64), ids, np.full(len(ids), first), np.zeros(len(ids), bool)))

        for batch in batches:
            nodes, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(nodes):
                continue
            new = np.ones(len(nodes), bool)
            new[1:] = nodes[1:] != nodes[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(nodes))
            # Only a node at a batch's edge or with two rows or more needs a look.
            look = (ends - starts > 1) | (starts == 0) | (ends == len(nodes))
            out: list = []
            for s, e in zip(starts[look].tolist(), ends[look].tolist(), strict=True):
                own = ids[s:e]
                if nodes[s] == held_node:
                    if len(own) and held and own[0] == held[-1][-1]:
                        own = own[1:]
                else:
                    close(out)
                    held_node, held, count, first = nodes[s], [], 0, own[0]
                if len(own) > 1:
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                if not len(own):
                    continue
                if count <= small < count + len(own):  # it turns out to be large
                    every = np.concatenate([*held, own])
                    cut(held_node, every, first, 0, out)
                elif count > small:
                    cut(held_node, own, first, count, out)
                count += len(own)
                held = [*held, own] if count <= small else [own[-1:]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[j] for x in out])) for j in range(5)], ["node", "part", "id", "first", "large"])
        out = []
        close(out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[j] for x in out])) for j in range(5)], ["node", "part", "id", "first", "large"])

    return run


def _compare(small: int, share: float):
    """Pairs whose sketches agree enough, from (node, part, id, first, large, sketch) in that order.

    A small node's documents meet each other, a large one's its first. Held are
    one small node and the first document of a large one.
    """

    def run(batches):
        tail = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(j).to_numpy(zero_copy_only=False) for j in range(5)] + [_sketches(batch.column(5))]
            if tail is not None:
                columns = [np.concatenate([x, y]) for x, y in zip(tail, columns, strict=True)]
            node, part, ids, first, large, sketch = columns
            n = len(node)
            new = np.ones(n, bool)
            new[1:] = (node[1:] != node[:-1]) | (part[1:] != part[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            a, b = [], []
            least = share * SIZE
            # Of a large node, the part's leading row is the first document.
            rows = np.flatnonzero(large & ~new)
            for s in range(0, len(rows), 65536):
                r = rows[s : s + 65536]
                ok = (sketch[r] == sketch[start[r]]).sum(1) >= least
                a.append(ids[start[r[ok]]])
                b.append(ids[r[ok]])
            for d in range(1, small):
                r = np.flatnonzero(~large[d:] & (start[d:] <= np.arange(n - d))) + d
                if not len(r):
                    break
                ok = (sketch[r] == sketch[r - d]).sum(1) >= least
                a.append(ids[r[ok] - d])
                b.append(ids[r[ok]])
            last = start[-1]
            keep = np.array([last]) if large[-1] else np.arange(last, n)
            tail = [x[keep] for x in columns]
            a, b = np.concatenate(a), np.concatenate(b)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            pairs = pairs[:, pairs[0] != pairs[1]]
            if pairs.size:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return run


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of all pairs of sorted sets.

    Elements with the same owners are one column with a weight. Columns of few
    owners are counted pair by pair, the others by products of 0/1 matrices.
    """
    n = len(sets)
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    times = np.diff(np.append(first, len(value)))
    owners = np.add.reduceat(mix(np.arange(1, n + 1, dtype=np.uint64))[owner], first)
    shared = np.flatnonzero(times > 1)
    _, pick, weight = np.unique(owners[shared], return_index=True, return_counts=True)
    first, times, weight = first[shared][pick], times[shared][pick], weight.astype(np.float32)
    out = np.zeros((n, n), np.float32)
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for t in range(2, FEW_OWNERS + 1):
        own = owner[first[times == t][:, None] + np.arange(t)]
        for a, b in combinations(range(t), 2):
            codes.append(own[:, a] * n + own[:, b])
            counts.append(weight[times == t])
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    out.reshape(-1)[code] = np.bincount(at, np.concatenate(counts), len(code))
    out += out.T
    many = np.flatnonzero(times > FEW_OWNERS)
    for s in range(0, len(many), 512):
        own = many[s : s + 512]
        part = np.zeros((n, len(own)), np.float32)
        part[owner[np.concatenate([np.arange(f, f + t) for f, t in zip(first[own].tolist(), times[own].tolist(), strict=True)])], np.repeat(np.arange(len(own)), times[own])] = 1
        out += (part * weight[own]) @ part.T
    return out


def uniting(ids: np.ndarray, c: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between different components c that unite them all, as far as links of these sets do."""
    common, sizes = _intersections(sets), np.array([len(x) for x in sets])
    names, label = np.unique(c, return_inverse=True)
    parent, out = list(range(len(names))), []

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for s in range(0, len(ids), 512):
        here = common[s : s + 512]
        hit = (100 * here >= percent * (sizes[s : s + 512, None] + sizes[None, :] - here)) & (label[s : s + 512, None] < label[None, :])
        i, j = np.nonzero(hit)
        _, pick = np.unique(label[s + i] * len(names) + label[j], return_index=True)  # one link of two components is enough
        for x, y in zip((s + i[pick]).tolist(), j[pick].tolist(), strict=True):
            a, b = root(int(label[x])), root(int(label[y]))
            if a != b:
                parent[b] = a
                out.append((int(ids[x]), int(ids[y])))
    return out


def _meet(percent: int):
    """Links (a, b) that unite components, from (pair, id, c, shingles) with each pair's rows together."""

    def run(batches):
        pair, held = None, []

        def close():
            if held:
                found = uniting(*(np.concatenate([x[j] for x in held]) for j in range(2)), [y for x in held for y in x[2]], percent)
                if found:
                    a, b = np.array(found).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        for batch in batches:
            pairs, ids, c = (batch.column(j).to_numpy() for j in range(3))
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(3).to_pylist()]
            cuts = np.flatnonzero(np.diff(pairs)) + 1
            for s, e in zip(np.append(0, cuts), np.append(cuts, len(pairs)), strict=True):
                if s == e:
                    continue
                if pairs[s] != pair:
                    yield from close()
                    pair, held = pairs[s], []
                held.append((ids[s:e], c[s:e], sets[s:e]))
        yield from close()

    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for chunk in chunks(batch.column(1)):
                first, value = shingle_sets(chunk, words)
                yield pa.RecordBatch.from_arrays([ids.slice(chunk.first, len(chunk)), pa.array([value[first[i] : first[i + 1]].tobytes() for i in range(len(chunk))], pa.binary())], ["id", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = np.array(keep, bool)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    return run


def _members(sketches: DataFrame, scratch: Scratch, join: Join) -> DataFrame:
    """(node, part, id, first, large) of all nodes with two classes or more."""
    rows = sketches.mapInArrow(_roots(join.trees, join.depth), "node long, id long")
    tally = sketches.mapInArrow(_tally(join.trees, join.depth), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # TALLY rows at most
    limit = max(join.hot, 4 * sum(r["n"] for r in tally) // TALLY)
    hot = [r["bucket"] for r in tally if r["n"] > limit]
    dealt = None
    if hot:
        # Nodes above the limit lie in such a bucket; there are fewer than TALLY / 4 of them.
        counted = rows.filter(F.shiftrightunsigned("node", 48).isin(hot)).groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter(F.col("n") > limit)
        big = scratch.cut(counted.select("node", "first", F.ceil(F.col("n") / join.part).cast("long").alias("parts")), "big")
        if not big.isEmpty():
            dealt = rows.join(F.broadcast(big), "node").filter("id <> first").select("node", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", "first", F.lit(True).alias("large"))
            fronts = big.select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("first").alias("id"), "first", F.lit(True).alias("large"))
            dealt = dealt.union(fronts)
            rows = rows.join(F.broadcast(big.select("node")), "node", "left_anti")
    out = rows.repartition("node").sortWithinPartitions("node", "id").mapInArrow(_runs(join.small, join.part), "node long, part long, id long, first long, large boolean")
    return scratch.cut(out.union(dealt) if dealt is not None else out, "members")


def _open(members: DataFrame, found: DataFrame, scratch: Scratch, join: Join) -> DataFrame:
    """(pair, id, c): the classes of large nodes that are not one component by now, as the pairs of blocks that meet."""
    large = members.filter("large and (id <> first or part = 0)").distinct()
    large = large.join(found, "id", "left").select("node", "part", "id", "first", F.coalesce("component", "id").alias("c"))
    nodes = large.groupBy("node").agg(F.max(F.when(F.col("id") == F.col("first"), F.col("c"))).alias("own"), F.min("c").alias("low"), F.max("c").alias("high"), F.max("part").alias("parts"))
    # A node's row is repeated for each of its parts, so that no task gets a whole large node.
    nodes = nodes.filter("low < high").withColumn("part", F.explode(F.expr("sequence(0L, parts)")))
    rows = scratch.cut(large.join(nodes.select("node", "part", "own", "parts"), ["node", "part"]).withColumn("rest", F.col("c") != F.col("own")), "open")
    sides = rows.groupBy("node").agg(F.count_if("rest").alias("r"), F.count_if(~F.col("rest")).alias("o"), F.max("parts").alias("parts"))
    whole = F.col("r") + F.col("o") <= join.dense
    sides = sides.select("node", *(F.when(whole, 0).otherwise(F.ceil(F.col(x) / join.part)).cast("long").alias(x) for x in "ro"), F.explode(F.expr("sequence(0L, parts)")).alias("part"))
    dealt = rows.join(sides, ["node", "part"])
    # Blocks 0..r-1 are of classes not united with the first one: each meets all blocks, itself included; the others meet only these.
    block = F.when(F.col("r") == 0, 0).when(F.col("rest"), F.pmod(F.xxhash64("id"), F.col("r"))).otherwise(F.col("r") + F.pmod(F.xxhash64("id"), F.col("o")))
    dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.expr("case when r = 0 then array(0L) when rest then sequence(0L, r + o - 1) else sequence(0L, r - 1) end")))
    return dealt.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("pair"), "id", "c")


def near_duplicates(documents: DataFrame, scratch: Scratch, join: Join = Join(), text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id linked to it, over any number of links), kept."""
    texts = documents.select("doc_id", F.col(text).alias("text"))
    marked = texts.select("doc_id", "text", F.xxhash64("text").alias("h"))
    base = scratch.cut(marked.mapInArrow(_sketch(join.words), "doc_id long, h long, n_shingles long, k1 long, k2 long, sketch binary"), "base")
    some = base.filter("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct("doc_id", "h")).alias("of"), F.count("*").alias("copies"), F.min("sketch").alias("sketch"))
    classes = scratch.cut(classes.select("k1", "k2", "copies", "of.doc_id", "of.h", "sketch", F.monotonically_increasing_id().alias("id")), "classes")
    base = scratch.cut(base.drop("sketch", "h"), "keys")
    scratch.drop("base")
    sketches = classes.select("id", "sketch")
    members = _members(sketches, scratch, join)
    # The full sets of all classes that share a node; no later pair has others.
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "h")
    own = marked.join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("id", "text")
    sets = scratch.cut(own.mapInArrow(_sets(join.words), "id long, shingles binary"), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
        full = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
        return full.mapInArrow(_confirm(join.percent), "a long, b long")

    full = members.join(sketches, "id").select("node", "part", "id", "first", "large", "sketch")
    ordered = full.repartition("node", "part").sortWithinPartitions("node", "part", F.col("id") != F.col("first"), "id")
    near = ordered.mapInArrow(_compare(join.small, join.sketch_share), "a long, b long").distinct()
    found = components(scratch.cut(confirm(near), "edges"), scratch, "links")
    open_rows = _open(members, found, scratch, join)
    together = open_rows.join(sets, "id").select("pair", "id", "c", "shingles")
    met = together.repartition("pair").sortWithinPartitions("pair", "id").mapInArrow(_meet(join.percent), "a long, b long").distinct()
    # New links matter as far as they unite components: only those go into another search.
    left, right = (found.select(F.col("id").alias(c), F.col("component").alias(f"{c}_c")) for c in "ab")
    links = met.join(left, "a", "left").join(right, "b", "left")
    links = links.select(F.coalesce("a_c", "a").alias("a"), F.coalesce("b_c", "b").alias("b")).filter("a <> b")
    links = scratch.cut(links, "more")
    if not links.isEmpty():
        united = components(links, scratch, "more-links")
        onto = united.select(F.col("id").alias("component"), F.col("component").alias("to"))
        moved = found.join(onto, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        found = scratch.cut(moved.union(united), "components")
    scratch.drop("members", "open", "sets", "big")
    # A component's name is the least doc_id of its classes.
    named = classes.select("k1", "k2", "id", "doc_id", "copies").join(found, "id", "left").withColumn("c", F.coalesce("component", "id"))
    least = named.groupBy("c").agg(F.min("doc_id").alias("least"))
    named = scratch.cut(named.join(least, "c").filter("copies > 1 or least <> doc_id").select("k1", "k2", "copies", "least"), "named")
    total = base.count()
    out = join_spread(base, named, ["k1", "k2"], "copies", total, "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op6_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "op6"), Join(words=4))
