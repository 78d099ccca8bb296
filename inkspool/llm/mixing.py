"""Operator 7: mixing sources to target weights, as column expressions only.

The documents of a source are laid end to end and cut into blocks of a fixed
number of words. Every output shard has SHARD_SLOTS slots; each of them draws its
source by the sources' targets, slot i of n from the i-th of n equal strata of all
targets: a stratified multinomial draw, as plain multinomial counts miss the
targets of small sources by a quarter. The shards' counts alone decide how much of
a source is taken, about a block a shard from its target. The slots of a source are numbered
through, shard by shard; slot k reads block ``permutation[k mod blocks]``, by a
keyed pseudorandom permutation (ROUNDS rounds of swap-or-not) that is another one
for each pass over the source, so no block is read twice before all were read
once. Slots beyond MOST_PASSES passes stay empty. ``mixed`` makes the output: one
row per slot of a shard with the words of its block, joined by index. ``taken``
counts each document's words in those rows.

Cases: a null text has size 0, a null source is a source of its own that comes
last, a source without words has target 0 and is not drawn from; equal rows are
distinct documents. Extra columns are ignored. An empty table gives no rows.

Scale: prefix sums run in ranges of about RANGE_DOCS documents within a source,
dealt by a digest of id, size and the text's beginning, never over a whole source in one task; sources
are sorted in one task, one short row each, and so are the shards of a source
(their counts). Slots are dealt to a number of tasks that follows from their
number. Only one-row-per-source tables are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspool.session import Scratch

#: Words in a block.
BLOCK_WORDS = 64
#: Weights of the sources in their order, repeating, and the share of all words to take, in percent.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
#: A source is read so many times at most.
MOST_PASSES = 2
#: Documents in a range of the prefix sums, about.
RANGE_DOCS = 2_048
#: Characters of a text, beside its id and size, in the digest that deals and orders the documents of a source.
DIGEST_CHARS = 64
#: Slots of an output shard; slots that one task makes, about.
SHARD_SLOTS = 65_536
TASK_SLOTS = 262_144
#: Rounds of the permutations, and the prime of their round function.
ROUNDS = 16
PRIME = (1 << 31) - 1


def digits(text: Column, at: int, many: int) -> Column:
    """Some hexadecimal digits of the MD5 of a text, as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, many), 16, 10).cast("long")


def words(text: Column) -> Column:
    """The number of words, 0 for null."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, r"[\x20\x09-\x0D]+"))).otherwise(0).cast("long")


def spaced(text: Column) -> Column:
    """The words, one space apart."""
    for mark in "\n\r\t\x0b\f":
        text = F.replace(text, F.lit(mark), F.lit(" "))
    return F.trim(F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, "\x20{2,}", " ")).otherwise(text))


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, rank, source_size, weight, target, blocks, slots.

    What a source cannot take above MOST_PASSES times its size is shared again
    by weight; the fixed point is ``least(cap, level * weight)``, and the level
    is found by going through the sources in the order in which they fill up.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = each.withColumn("rank", rank).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")).cast("long"))
    each = each.withColumn("cap", F.col("source_size") * MOST_PASSES)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy(F.lit(0))
    each = each.withColumn("total", F.sum("source_size").over(everything) * (SHARE_PERCENT / 100))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    each = each.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    each = each.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(everything)["level"])
    each = each.withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.col("cap").cast("double")))
    each = each.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long"))
    slots = F.least(F.floor(F.col("target") / BLOCK_WORDS + 0.5).cast("long"), F.col("blocks") * MOST_PASSES)
    return each.select("source", "rank", "source_size", "weight", "target", "blocks", slots.alias("slots"))


def placed(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The documents with ``start``, the number of words of their source that come before them."""
    many = documents.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / RANGE_DOCS)).cast("long").alias("ranges"))
    docs = documents.join(F.broadcast(many)).withColumn("range", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % F.col("ranges"))
    # A hot source is spread over its ranges; only their sums meet.
    sums = docs.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "range", F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("source", "range").orderBy("digest", "h1", "h2", "row").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    docs = docs.alias("d").join(sums.alias("s"), (F.col("d.range") == F.col("s.range")) & F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", (F.col("before") + F.col("range_start")).alias("start"))
    return docs.select(*columns, "start")


def permuted(rows: DataFrame) -> DataFrame:
    """rows (x, blocks, keys) with x put in its place by the permutation of 0..blocks-1 that the
    keys (a, b) give: by each of them, x may be swapped with its mirror at a.

    Two projections a round, as each needs its values several times: column
    expressions that stay compiled, where a loop over the keys would not.
    """
    others = [c for c in rows.columns if c != "x"]
    for i in range(ROUNDS):
        if i % 4 == 0:  # moves no row, and ends a piece of compiled code that would become too long for the machine's compiler
            rows = rows.coalesce(1 << 20)
        rows = rows.withColumn("mirror", F.expr(f"pmod(keys[{i}].a - x, blocks)"))
        mixed = f"((greatest(x, mirror) % {PRIME}L + greatest(x, mirror) div {PRIME}L * 69621L + keys[{i}].b) % {PRIME}L)"
        rows = rows.select(*others, F.expr(f"if({mixed} * {mixed} % {PRIME}L * {mixed} % {PRIME}L div 4096L % 2L = 1L, mirror, x)").alias("x"))
    return rows


def draws(sources: DataFrame, seed: int = 0) -> DataFrame:
    """One row per drawn slot: rank, shard, slot (of its source), pass, block."""
    spark = sources.sparkSession
    total, many = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    drawn = sources.filter("slots > 0").select("rank", "slots", "blocks")
    # What the shares of the sources end at, in the order of their ranks: one short row per source.
    ends = drawn.agg(F.array_sort(F.collect_list(F.struct("rank", "slots"))).alias("all")).select("all.rank", F.expr("transform(all.slots, (x, i) -> aggregate(slice(all.slots, 1, i + 1), 0L, (a, y) -> a + y))").alias("ends"))
    tasks = max(1, -(-total // TASK_SLOTS))
    shard, chance = F.expr(f"id div {SHARD_SLOTS}"), digits(F.concat(F.lit(f"{seed}:"), F.col("id")), 1, 13) / float(1 << 52)
    size = F.least(F.lit(SHARD_SLOTS).cast("long"), F.lit(total) - shard * SHARD_SLOTS)
    slots = spark.range(0, total, 1, tasks).select(shard.alias("shard"), F.floor((F.col("id") % SHARD_SLOTS + chance) / size * F.lit(total)).alias("at"))
    # The first share that ends behind the drawn place, by halving.
    halve = lambda r, _: F.when(F.get("ends", ((r["lo"] + r["hi"]) / 2).cast("int")) > F.col("at"), F.struct(r["lo"].alias("lo"), ((r["lo"] + r["hi"]) / 2).cast("int").alias("hi"))).otherwise(F.struct((((r["lo"] + r["hi"]) / 2).cast("int") + 1).alias("lo"), r["hi"].alias("hi")))
    steps = F.array(*(F.lit(0) for _ in range(max(1, many).bit_length())))
    chosen = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), (F.size("ends") - 1).alias("hi")), lambda r, i: F.when(r["lo"] < r["hi"], halve(r, i)).otherwise(r))
    counts = slots.join(F.broadcast(ends)).select("shard", F.get("rank", chosen["lo"]).alias("rank")).groupBy("shard", "rank").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("from", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    # The keys of the permutations: a row per source and pass.
    name = lambda i: F.concat_ws(":", F.lit(str(seed)), "rank", "pass", i)
    keys = drawn.withColumn("pass", F.explode(F.expr(f"sequence(0L, {MOST_PASSES - 1}L)"))).select("rank", "pass", F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda i: F.struct((digits(name(i), 1, 13) % F.col("blocks")).alias("a"), digits(name(i), 14, 7).alias("b"))).alias("keys"))
    full = counts.join(F.broadcast(drawn.select("rank", "blocks")), "rank").withColumn("most", F.least(F.col("n"), F.col("blocks") * MOST_PASSES - F.col("from"))).filter("most > 0")
    full = full.repartition(tasks)  # a number of its own, which is not made smaller because these rows are few
    full = full.withColumn("slot", F.explode(F.expr("sequence(from, from + most - 1)")))
    full = full.withColumn("pass", F.expr("slot div blocks")).join(F.broadcast(keys), ["rank", "pass"])
    return permuted(full.select("rank", "shard", "slot", "pass", "blocks", "keys", F.expr("slot % blocks").alias("x"))).select("rank", "shard", "slot", "pass", F.col("x").alias("block"))


def pieces(documents: DataFrame) -> DataFrame:
    """One row per document and block that it has words in: rank, block, start, row, doc_id, text (the words, one space apart), n (their number)."""
    lead = F.expr(f"cast({BLOCK_WORDS} - start % {BLOCK_WORDS} as int)")  # words up to the next block
    head = F.call_function("substring_index", "words", F.lit(" "), lead)
    out = documents.filter("size > 0").withColumn("head", head)
    rest = F.regexp_extract_all(F.substring("words", F.length("head") + 2, F.length("words")), F.lit(f"((?:[^ ]++ ?+){{1,{BLOCK_WORDS}}}+)"), F.lit(1))
    out = out.select("rank", "start", "size", "row", "doc_id", F.posexplode(F.concat(F.array("head"), rest)).alias("at", "text"))
    out = out.withColumn("block", F.expr(f"start div {BLOCK_WORDS} + at"))
    n = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK_WORDS) - F.greatest("start", F.col("block") * BLOCK_WORDS)
    return out.select("rank", "block", "start", "row", "doc_id", F.rtrim("text").alias("text"), n.alias("n"))


def mix(documents: DataFrame, text: str = "text", seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(sources, placed documents, draws, words of the documents): together they say which words go where."""
    # Texts are read for their sizes, and again for the blocks, by doc_id and content: equal rows have equal texts.
    keys = [F.coalesce("doc_id", F.lit(-1)).alias("h0"), F.xxhash64(F.col(text)).alias("h1"), F.xxhash64(F.lit(1), F.col(text)).alias("h2")]
    begins = F.coalesce(F.substring(text, 1, DIGEST_CHARS), F.lit(""))
    sized = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", words(F.col(text)).alias("size"), begins.alias("begins"), *keys)
    sized = sized.withColumn("digest", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "begins").cast("binary"))).drop("begins")
    scratch = Scratch(documents.sparkSession, "mixing")
    short = scratch.cut(sized, "sizes")
    texts = documents.select(*keys, spaced(F.col(text)).alias("words")).filter("words <> ''")
    sources = scratch.cut(targets(short), "sources")
    at = placed(short, ["row", "doc_id", "source", "size", "h0", "h1", "h2"])
    # A table: a filter on blocks, pushed down into the rounds of the permutation, would double its size with each of them.
    drawn = scratch.cut(draws(sources, seed), "draws")
    at = at.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    return sources, at.select("d.*", "rank", "source_size", "target"), drawn, texts.groupBy("h0", "h1", "h2").agg(F.first("words").alias("words"))


def _mixed(at: DataFrame, drawn: DataFrame, texts: DataFrame) -> DataFrame:
    # The planner takes plans and draws for as small as the sources they come from; they grow with the words and must not be broadcast.
    placed_texts = at.select("row", "doc_id", "rank", "start", "size", "h0", "h1", "h2").hint("merge").join(texts, ["h0", "h1", "h2"])
    blocks = pieces(placed_texts).groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("start", "row", "doc_id", "text", "n"))).alias("parts"))
    return drawn.hint("merge").join(blocks, ["rank", "block"]).select("shard", "rank", "slot", "pass", "block", "parts")


def mixed(documents: DataFrame, text: str = "text", seed: int = 0) -> DataFrame:
    """shard, source, slot, pass, block, doc_ids, text: one row per slot of a source in an output shard, with the words of its block."""
    sources, at, drawn, texts = mix(documents, text, seed)
    rows = _mixed(at, drawn, texts).join(F.broadcast(sources.select("rank", "source")), "rank")
    return rows.select("shard", "source", "slot", "pass", "block", F.col("parts.doc_id").alias("doc_ids"), F.array_join("parts.text", " ").alias("text"))


def taken(documents: DataFrame, text: str = "text", seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words of each document in the rows of the mix."""
    _, at, drawn, texts = mix(documents, text, seed)
    parts = _mixed(at, drawn, texts).select(F.explode("parts").alias("part"))
    used = parts.groupBy("part.row").agg(F.sum("part.n").alias("used")).hint("merge")
    return at.join(used, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("used", F.lit(0)).cast("long").alias("taken"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixing_sql(documents: str = "documents", seed: int = 0) -> str:
    """The same in DuckDB over a table of documents."""
    key = lambda i, at, many: f"('0x' || substr(md5('{seed}:' || rnk || ':' || pass || ':{i}'), {at}, {many}))::bigint"
    rounds = ",\n".join(
        f"""x{i} as (
  select rnk, blocks, pass, case when mixed * mixed % {PRIME} * mixed % {PRIME} // 4096 % 2 = 1 then mirror else x end as x
  from (select *, (greatest(x, mirror) % {PRIME} + greatest(x, mirror) // {PRIME} * 69621 + {key(i, 14, 7)}) % {PRIME} as mixed
    from (select *, (({key(i, 1, 13)} % blocks - x) % blocks + blocks) % blocks as mirror from x{i - 1})))"""
        for i in range(1, ROUNDS + 1)
    )
    return rf"""
with sized as (
  select doc_id, source, own as size, md5(coalesce(cast(doc_id as varchar), '') || ':' || own || ':' || coalesce(substr(text, 1, {DIGEST_CHARS}), '')) as digest
  from (select doc_id, source, text, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as own from {documents})),
ranges as (select greatest(1, cast(ceil(count(*) / {RANGE_DOCS}) as bigint)) as n from sized),
each as (
  select *, case rnk % 3 when 0 then {WEIGHTS[0]} when 1 then {WEIGHTS[1]} else {WEIGHTS[2]} end as weight, {MOST_PASSES} * source_size as cap
  from (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by encode(source) nulls last) - 1 as rnk from sized group by source)),
levels as (
  select *, sum(source_size) over () * {SHARE_PERCENT / 100}::double as total,
    (sum(source_size) over () * {SHARE_PERCENT / 100}::double - coalesce(sum(cap) over (order by cap / weight, rnk rows between unbounded preceding and 1 preceding), 0))
      / cast(sum(weight) over (order by cap / weight, rnk rows between current row and unbounded following) as double) as lvl from each),
found as (select arg_min(lvl, (cap / weight, rnk)) as lvl from levels where lvl * weight <= cap),
sources as (
  select source, rnk, source_size, target, blocks, least(cast(floor(target / {BLOCK_WORDS} + 0.5) as bigint), blocks * {MOST_PASSES}) as slots
  from (select e.*, coalesce(least(cast(cap as double), f.lvl * weight), cast(cap as double)) as target, cast(ceil(source_size / {BLOCK_WORDS}) as bigint) as blocks from each e, found f)),
placed as (
  select d.*, coalesce(sum(size) over (partition by source order by ('0x' || substr(digest, 1, 8))::bigint % n, digest rows between unbounded preceding and 1 preceding), 0) as start
  from sized d, ranges),
shares as (select rnk, blocks, sum(slots) over (order by rnk) - slots as lo, sum(slots) over (order by rnk) as hi, sum(slots) over () as total from sources where slots > 0),
slots as (
  select id // {SHARD_SLOTS} as shard, cast(floor((id % {SHARD_SLOTS} + ('0x' || substr(md5('{seed}:' || id), 1, 13))::bigint / {float(1 << 52)}::double)
      / least({SHARD_SLOTS}, total - id // {SHARD_SLOTS} * {SHARD_SLOTS}) * total) as bigint) as place
  from (select unnest(range(coalesce(total, 0)::bigint)) as id, total from (select max(total) as total from shares))),
drawn as (select rnk, blocks, row_number() over (partition by rnk order by shard) - 1 as k from slots join shares on place >= lo and place < hi),
x0 as (select rnk, blocks, k // blocks as pass, k % blocks as x from drawn where k < blocks * {MOST_PASSES}),
{rounds},
copies as (select rnk, x as block, count(*) as n from x{ROUNDS} group by all),
pieces as (
  select p.doc_id, p.size, p.start, s.rnk, s.source_size, s.target, unnest(range(cast(start // {BLOCK_WORDS} as bigint), cast((start + size - 1) // {BLOCK_WORDS} + 1 as bigint))) as block
  from placed p join sources s on p.source is not distinct from s.source where size > 0),
used as (
  select p.*, (least(start + size, (p.block + 1) * {BLOCK_WORDS}) - greatest(start, p.block * {BLOCK_WORDS})) * coalesce(n, 0) as w
  from pieces p left join copies c on p.rnk = c.rnk and p.block = c.block)
select doc_id, size, source_size, target, cast(sum(w) as bigint) as taken from used group by doc_id, rnk, start, size, source_size, target
union all
select doc_id, size, source_size, target, 0 from sized join sources on sized.source is not distinct from sources.source where size = 0
"""
