"""The registered queries of the asset operators and their DuckDB equivalents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspool.functions import text as T
from inkspool import eps, raster, svg
from inkspool.operators import assets, observations, paths, pixels, report, rules, upsert
from inkspool.session import Scratch, table

QUERIES: dict = {}
SQL: dict = {}
AS_OF, DAYS, SLACK, LEAST = date(2024, 1, 30), 7, 2, 3


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.concat(F.lit("in/"), "source", F.lit("/Doc "), F.col("doc_id") % 40, F.lit(".x"), "doc_id", F.lit(".png")).alias("path"), F.col("text").alias("content"))


_FILES = "files as (select 'in/' || source || '/Doc ' || (doc_id % 40) || '.x' || doc_id || '.png' as path, sha256(text) as asset_id from documents where text is not null)"


@query(f"with {_FILES} select asset_id, count(*) as copies, arg_min(path, string_split(path, '/')) as first_source from files group by 1")
def content_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return assets.content_groups(_files(spark, d))[0]


@query(f"with {_FILES} select asset_id, path from files")
def content_members(spark, d):
    return assets.content_groups(_files(spark, d))[1]


@query(rf"""with {_FILES}, g as (select asset_id, count(*) as copies, arg_min(path, string_split(path, '/')) as first_source from files group by 1),
names as (select string_split(path, '/')[-1] as name, count(*) = 1 as uniq from files group by 1),
manifest as (select distinct sha256(text) as asset_id, 'saved_' || left(sha256(text), 4) as basename from documents where doc_id % 3 = 0 and text is not null)
select g.asset_id, copies, first_source, false as force, uniq as unique_source_name,
  coalesce(basename, left(trim(regexp_replace(regexp_replace(string_split(first_source, '/')[-1], '\.[^.]*$', ''), '[^A-Za-z0-9_-]+', '_', 'g'), '_'), 100) || '__' || left(g.asset_id, 12)) as basename
from g left join manifest using (asset_id) join names on string_split(first_source, '/')[-1] = name""")
def job_projection(spark, d):
    groups, members = assets.content_groups(_files(spark, d))
    saved = table(spark, d, "documents").filter("doc_id % 3 = 0 and text is not null").select(F.sha2("text", 256).alias("asset_id")).distinct()
    return assets.jobs(groups, members, saved.withColumn("basename", F.concat(F.lit("saved_"), F.substring("asset_id", 1, 4))))


@query("select p_partkey, p_name, count(*) over (partition by p_name) = 1 as unique_name from part")
def name_uniqueness(spark, d):
    return assets.unique_names(table(spark, d, "part").select("p_partkey", "p_name"), "p_name")


@query("""select p_name, arg_min(p_partkey, p_partkey) as p_partkey, arg_min(p_brand, p_partkey) as p_brand from part group by 1""")
def seen_once(spark, d):
    return assets.seen_once(table(spark, d, "part").select("p_name", "p_partkey", "p_brand"), "p_name", "p_partkey")


def _scrape(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("title"), F.lit("").alias("filename"), F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("x"), "c_custkey")).otherwise("").alias("external_id"))
    p = table(spark, d, "part").select((F.col("p_partkey") + 10_000_000).alias("seq"), F.upper("p_name").alias("title"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("part"), "p_partkey")).otherwise("").alias("filename"), F.lit("").alias("external_id"))
    return c.union(p)


@query("""
with log as (select 'cust' || c_custkey as filename, case when c_custkey % 3 = 0 then 'x' || (c_custkey + c_custkey % 2) else '' end as external_id from customer),
meta as (select 'cust' || c_custkey as filename, c_name as title from customer where c_custkey % 11 <> 0
         union all select 'part' || p_partkey, p_name from part),
rows as (select c_custkey as seq, c_name as title, '' as filename, case when c_custkey % 7 = 0 then 'x' || c_custkey else '' end as external_id from customer
         union all select p_partkey + 10000000, upper(p_name), case when p_partkey % 5 = 0 then 'part' || p_partkey else '' end, '' from part),
ids as (select external_id as k, count(distinct filename) as n, min(filename) as f from log where external_id <> '' group by 1),
files as (select filename from log union select filename from meta),
titles as (select trim(regexp_replace(lower(title), '\\s+', ' ', 'g')) as k, count(distinct filename) as n, min(filename) as f from meta group by 1),
found as (
  select r.*, case when i.n > 0 then i.n when fl.filename is not null then 1 else coalesce(t.n, 0) end as n,
    case when i.n > 0 then i.f when fl.filename is not null then fl.filename else t.f end as f
  from rows r left join ids i on r.external_id = i.k and r.external_id <> '' left join files fl on r.filename = fl.filename and r.filename <> ''
    left join titles t on trim(regexp_replace(lower(r.title), '\\s+', ' ', 'g')) = t.k)
select seq, case when n = 1 then f end as file,
  case when n = 0 then 'unmatched' when n > 1 or (found.external_id <> '' and l.external_id <> '' and l.external_id <> found.external_id) then 'ambiguous' else 'matched' end as outcome
from found left join log l on n = 1 and l.filename = f
""")
def staged_match(spark, d):
    c, p = table(spark, d, "customer"), table(spark, d, "part")
    log = c.select(F.concat(F.lit("cust"), "c_custkey").alias("filename"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("x"), F.col("c_custkey") + F.col("c_custkey") % 2)).otherwise("").alias("external_id"))
    meta = c.filter("c_custkey % 11 <> 0").select(F.concat(F.lit("cust"), "c_custkey").alias("filename"), F.col("c_name").alias("title")).union(p.select(F.concat(F.lit("part"), "p_partkey"), "p_name"))
    return observations.resolve(_scrape(spark, d), log, meta).select("seq", "file", "outcome")


def _manifest(spark, d):
    k = F.col("c_custkey")
    status = F.when(k % 4 == 0, "ready").when(k % 4 == 1, "needs_metadata").when(k % 4 == 2, "needs_review").otherwise("failed")
    return table(spark, d, "customer").select(k.alias("asset_id"), status.alias("status"), F.concat(F.lit("f"), k, F.lit(".svg")).alias("svg"), (k % 5 != 0).alias("svg_there"), (k % 3 == 0).alias("eps_named"), (k % 7 != 0).alias("eps_there"), F.when(k % 11 != 0, k % 2 == 1).alias("passed"), (k % 13 != 0).alias("preview_there"))


@query("""select c_custkey as asset_id, case when c_custkey % 5 = 0 then 'svg' when c_custkey % 3 = 0 and c_custkey % 7 = 0 then 'eps' when c_custkey % 11 = 0 then 'quality' end as error,
  not (c_custkey % 5 = 0 or (c_custkey % 3 = 0 and c_custkey % 7 = 0) or c_custkey % 11 = 0) and c_custkey % 13 = 0 as render from customer where c_custkey % 4 = 1""")
def resume_pending(spark, d):
    return assets.resumable(_manifest(spark, d)).select("asset_id", "error", "render")


@query("select c_custkey as asset_id from customer where c_custkey % 4 = 0")
def ready_assets(spark, d):
    return assets.ready(_manifest(spark, d)).select("asset_id")


@query("""with n as (select o_custkey as asset_id, arg_max(o_orderstatus, o_orderkey) as status, max(o_orderkey) as seq from orders group by 1)
select c_custkey as asset_id, 'old' as status, 0 as seq from customer where c_custkey not in (select asset_id from n) union all select asset_id, status, seq from n""")
def manifest_upsert(spark, d):
    old = table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.lit("old").alias("status"), F.lit(0).cast("long").alias("seq"))
    return upsert.put_latest(old, table(spark, d, "orders").select(F.col("o_custkey").alias("asset_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("seq")), "asset_id", "seq")


@query(r"""with files as (select sha256(text) as asset_id, 'd' || (doc_id % 2) || '/f' || doc_id || '.png' as path from documents where text is not null),
first as (select asset_id, arg_min(path, string_split(path, '/')) as path from files group by 1),
m as (select distinct sha256(text) as asset_id from documents where text is not null and length(text) % 3 = 0),
named as (select first.*, case when m.asset_id is not null then 's' || left(first.asset_id, 6) || '.svg' else regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', '') || '.svg' end as svg, m.asset_id is not null as known from first left join m using (asset_id)),
outs as (select 'f' || doc_id || '.svg' as svg from documents where doc_id % 4 <> 0 union select 's' || left(asset_id, 6) || '.svg' from m)
select asset_id, path, svg, case when not (ascii(asset_id) % 5 <> 0) then 'needs_metadata' when known and ascii(right(asset_id, 1)) % 2 = 0 then 'ready' else 'needs_review' end as status
from named where svg in (select svg from outs)""")
def repair_outputs(spark, d):
    docs = table(spark, d, "documents").filter("text is not null")
    files = assets.hashed(docs.select(F.concat(F.lit("d"), F.col("doc_id") % 2, F.lit("/f"), "doc_id", F.lit(".png")).alias("path"), F.col("text").alias("content")))
    digest = F.sha2("text", 256)
    own = docs.filter(F.length("text") % 3 == 0).select(digest.alias("asset_id")).distinct()
    manifest = own.select("asset_id", F.concat(F.lit("s"), F.substring("asset_id", 1, 6), F.lit(".svg")).alias("svg"), (F.ascii(F.substring("asset_id", -1, 1)) % 2 == 0).alias("passed"))
    outputs = docs.filter("doc_id % 4 <> 0").select(F.concat(F.lit("f"), "doc_id", F.lit(".svg")).alias("svg")).union(manifest.select("svg"))
    first = files.groupBy("asset_id").agg(F.min_by("path", "parts").alias("path")).join(manifest.select("asset_id", "svg"), "asset_id", "left")
    named = first.select("asset_id", F.coalesce("svg", F.concat(T.stem(F.col("path")), F.lit(".svg"))).alias("svg"))
    metadata = named.select("svg", F.when(F.ascii("asset_id") % 5 != 0, "ai").otherwise("dummy").alias("source"))
    return assets.repaired(files, manifest, metadata, outputs)


@query("""select 'f' || p_partkey || '.svg' as svg, 'f' || p_partkey || '.eps' as eps, case when p_partkey % 2 = 0 then p_name end as title,
  case when p_partkey % 2 = 0 then [p_brand, p_type] end as keywords, case when p_partkey % 2 = 0 then '' end as category from part""")
def eps_metadata_join(spark, d):
    part = table(spark, d, "part")
    name = F.concat(F.lit("f"), "p_partkey", F.lit(".svg"))
    metadata = part.filter("p_partkey % 2 = 0").select(name.alias("Filename"), F.col("p_name").alias("Title"), F.concat_ws(", ", "p_brand", "p_type").alias("Keywords"), F.lit("").alias("Category"))
    return assets.eps_conversion(part.select(name.alias("svg")), metadata)


@query("select max('adobe_scrape_' || strftime(o_orderdate, '%Y%m%d') || '.csv') as name from orders")
def newest_scrape(spark, d):
    names = table(spark, d, "orders").select(F.concat(F.when(F.col("o_orderkey") % 2 == 0, "zzz_").otherwise(""), F.lit("adobe_scrape_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("name"))
    return assets.newest(names.union(names.select(F.regexp_replace("name", "^zzz_", ""))))


@query("select 'm' || p_partkey || ':free' as id, p_partkey as position from part where p_partkey % 7 = 3 and p_size > 10 order by p_partkey limit 2")
def free_models(spark, d):
    part = table(spark, d, "part")
    models = part.select(F.concat(F.lit("m"), "p_partkey", F.when(F.col("p_partkey") % 7 == 3, ":free").otherwise("")).alias("id"), F.when(F.col("p_size") > 10, F.array(F.lit("text"), F.lit("image"))).otherwise(F.array(F.lit("text"))).alias("modalities"), F.col("p_partkey").alias("position"))
    return assets.free_models(models).select("id", "position")


@query("""select p_partkey, list_filter([case when p_size % 7 = 0 then 'blank' end, case when p_size / 300 > 0.10 then 'mae' end, case when p_size % 7 = 0 or p_size % 9 > 5 then 'drift' end,
  case when p_partkey % 5 = 0 then 'text' end, case when p_partkey % 11 = 0 then 'alpha' end], lambda x: x is not null) as warnings from part""")
def quality_warnings(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    return table(spark, d, "part").select("p_partkey", assets.quality_warnings(n % 7 == 0, n / 300, (n % 9) / 100, k % 5 == 0, k % 11 == 0).alias("warnings"))


@query("""select p_partkey, case when not (p_size * 1000.0 * 1000 / 1e6 between 15 and 65) then 'artboard' when p_partkey % 13 = 0 then 'view box' when p_partkey * 100000 > 45000000 then 'size'
  when p_partkey % 5 = 0 then 'raster image' when p_partkey % 7 = 0 then 'no path' end as error, p_partkey * 100000 > 45000000 as size_error from part""")
def quality_errors(spark, d):
    k = F.col("p_partkey")
    rows = assets.size_guard(table(spark, d, "part").withColumn("length", k * 100_000))
    return rows.select("p_partkey", rules.artboard_error(F.col("p_size") * 1000.0, F.lit(1000.0), F.when(k % 13 != 0, "0 0 1 1"), F.col("length"), F.when(k % 5 == 0, 1).otherwise(0), F.when(k % 7 == 0, 0).otherwise(3)).alias("error"), "size_error")


@query("""select p_partkey, p_partkey % 4 in (1, 2) as intact, p_partkey % 2 = 0 and p_size % 3 <> 0 and (p_size % 5 <> 0 or p_partkey % 3 = 0 or p_size % 7 = 0) as cached from part""")
def source_and_cache_checks(spark, d):
    k, n, none = F.col("p_partkey"), F.col("p_size"), F.array().cast("array<string>")
    digests = F.when(k % 4 == 0, none).when(k % 4 == 1, F.array(F.lit("a"))).when(k % 4 == 2, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit(None).cast("string")))
    cached = rules.cache_valid(k % 2 == 0, F.lit(True), F.lit(True), n % 3 == 0, n % 5 == 0, F.when(k % 3 == 0, F.array(F.lit("x"))).otherwise(none), n % 7 == 0)
    return table(spark, d, "part").select("p_partkey", rules.sources_intact(digests, F.lit("a")).alias("intact"), cached.alias("cached"))


@query("""select event_id, case when event_id % 3 = 0 then cast(event_id % 90 as double) when event_id % 3 = 1 then greatest(event_id % 50 + 0.5, event_id % 40) else least(60.0, pow(2, least(event_id % 9, 6))) end as seconds,
  case when event_id % 6 = 0 then 'daily' when event_id % 6 = 3 then 'zero' end as quota, case when event_id % 6 = 0 then 'model' else 'provider' end as scope from events""")
def response_rules(spark, d):
    k = F.col("event_id")
    details = F.when(k % 6 == 0, F.lit('[{"violations": [{"quotaId": "RequestsPerDay", "quotaDimensions": {"model": "m"}}]}]')).when(k % 6 == 3, F.lit('[{"violations": [{"quotaMetric": "m", "quotaValue": "0"}]}]')).when(k % 3 == 1, F.concat(F.lit('[{"retryDelay": "'), k % 50, F.lit('.5s"}]'))).otherwise("[]")
    body = F.concat(F.lit('{"error": {"details": '), details, F.when(k % 3 == 1, F.concat(F.lit(', "message": "please retry after '), k % 40, F.lit(' s"'))).otherwise(""), F.lit("}}"))
    header = F.when(k % 3 == 0, (k % 90).cast("string"))
    now = F.timestamp_seconds(F.lit(0))
    return table(spark, d, "events").select("event_id", rules.retry_delay(header, body, k % 9, now).alias("seconds"), rules.long_quota(body).alias("quota"), rules.quota_scope(body).alias("scope"))


@query("""select p_partkey, case when p_partkey % 5 = 0 then 'background' when p_partkey % 7 = 0 then 'palette' when p_size >= 45 then 'empty' when 200 + p_size >= 220 then 'pale' end as review from part""")
def icon_sources(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    color = F.array(n + 200, n + 200, n + 200)
    return table(spark, d, "part").select("p_partkey", rules.icon_review(k % 5 != 0, k % 7 != 0, F.array(F.array(F.lit(255), F.lit(250), F.lit(255)), color)).alias("review"))


@query("""select p_partkey, list_filter([p_brand, p_type, 'x', p_name], lambda v, i: list_position([p_brand, p_type, 'x', p_name], v) = i) as sources,
  list_filter([p_brand, 'fill', 'stroke', 'd'], lambda v: not list_contains(['fill', 'd'], v)) as others from part where p_brand <> p_type""")
def ordered_sets(spark, d):
    both = rules.merged_sources(F.array("p_brand", "p_type"), F.array("p_brand", F.lit("x"), "p_type", "p_name"))
    others = rules.not_among(F.array("p_brand", F.lit("fill"), F.lit("stroke"), F.lit("d")), ["fill", "d"])
    return table(spark, d, "part").filter("p_brand <> p_type").select("p_partkey", both.alias("sources"), others.alias("others"))


@query("""select p_partkey, left(sha256('{"a":"' || p_brand || '","size":' || p_size || '}'), 16) as signature, sha256(p_name || 'v1' || 'm1,m2') as cache_key from part""")
def hash_keys(spark, d):
    return table(spark, d, "part").select("p_partkey", T.signature({"size": F.col("p_size"), "a": F.col("p_brand")}).alias("signature"), T.cache_key(F.col("p_name"), "v1", ["m1", "m2"]).alias("cache_key"))


@query("""select c_custkey as item, case when c_custkey % 3 = 0 then c_custkey * 2 else greatest(case when c_custkey % 2 = 0 then c_custkey else 0 end, case when c_custkey % 5 = 0 then 7 else 0 end, 1) end as downloads,
  case when c_custkey % 4 = 0 then c_custkey / 8 end as royalty, case when c_custkey % 6 = 0 then date '2026-01-02' when c_custkey % 6 = 1 then date '2026-02-03' end as born from customer""")
def download_fallback(spark, d):
    k = F.col("c_custkey")
    text = lambda when, value: F.when(when, value.cast("string")).otherwise("")
    log = table(spark, d, "customer").select(k.alias("filename"), F.lit("n").alias("niche"), F.lit("accepted").alias("status"), text(k % 3 == 0, k * 2).alias("dl_latest"), text(k % 2 == 0, k).alias("dl_30d"), text(k % 5 == 0, F.lit(7)).alias("dl_60d"), F.lit("1").alias("dl_90d"),
                                             text(k % 4 == 0, k / 8).alias("royalty_usd"), text(k % 6 == 0, F.lit("2026-01-02")).alias("accepted_date"), text(k % 6 <= 1, F.lit("2026-02-03")).alias("first_seen_accepted"))
    return report.log_items(log).select("item", "downloads", "royalty", "born")


def _observations(spark, d):
    e = table(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("u"), "user_id").alias("file"), F.floor("value").cast("string").alias("downloads"), F.date_format("ts", "yyyy-MM-dd").alias("observed"),
        F.when(F.col("event_id") % 9 == 0, F.date_format(F.date_sub("ts", 3), "yyyy-MM-dd")).when(F.col("event_id") % 31 == 0, "2030-01-01").otherwise("").alias("accepted"),
        F.when(F.col("event_id") % 4 == 0, (F.col("event_id") % 1000 / 100).cast("string")).when(F.col("event_id") % 41 == 0, "nan").otherwise("").alias("royalty"),
        F.when(F.col("event_id") % 6 == 0, "rejected").when(F.col("event_id") % 10 == 0, "pending").otherwise("").alias("explicit"),
    )
    return observations.validate(e)


_OBS = """
raw as (
  select event_id as seq, 'u' || user_id as file, cast(floor(value) as bigint) as d, cast(ts as date) as dt,
    case when event_id % 9 = 0 then cast(ts as date) - 3 when event_id % 31 = 0 then date '2030-01-01' end as acc,
    case when event_id % 4 = 0 then cast(event_id % 1000 as double) / 100 end as roy, event_id % 4 <> 0 and event_id % 41 = 0 as nan,
    case when event_id % 6 = 0 then 'rejected' when event_id % 10 = 0 then 'pending' else '' end as explicit from events),
valid as (select *, d >= 0 and (acc is null or acc <= dt) and not nan and coalesce(roy, 0) >= 0 as valid from raw),
checked as (select *, coalesce(d >= max(d) over (partition by file, dt order by seq rows between unbounded preceding and 1 preceding), true) as ok from valid where valid)
"""


@query(f"""with {_OBS}
select case when not v.valid or not coalesce(c.ok, true) then 'invalid' else 'matched' end as outcome, count(*) as n
from valid v left join checked c using (seq) group by 1""")
def import_counts(spark, d):
    rows = _observations(spark, d)
    ok = observations.monotone(rows.filter("valid")).select(F.when(F.col("ok"), "matched").otherwise("invalid").alias("outcome"))
    return ok.union(rows.filter("not valid").select(F.lit("invalid"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"with {_OBS} select seq, file, d, ok from checked")
def monotone_guard(spark, d):
    return observations.monotone(_observations(spark, d).filter("valid")).select("seq", "file", "d", "ok")


@query(f"""with {_OBS},
kept as (select *, coalesce(dt >= max(dt) over (partition by file order by seq rows between unbounded preceding and 1 preceding), true) as rec,
  explicit = 'accepted' or acc is not null or d > 0 as ev from checked where ok),
said as (select *, case when explicit in ('accepted', 'rejected', 'submitted', 'pending') then explicit when ev then 'accepted' end as st from kept)
select file, count(*) as observations, max_by(d, seq) filter (rec) as dl_latest, max(dt) as dl_date, max_by(roy, seq) filter (rec and roy is not null) as royalty,
  min(dt) filter (ev) as first_seen, min_by(acc, seq) filter (acc is not null) as accepted_date, max_by(st, seq) filter (rec and st is not null) as status
from said group by file""")
def observation_fold(spark, d):
    return observations.fold(_observations(spark, d).filter("valid"))


@query(f"""with {_OBS} select file, dt, max_by(d, seq) as downloads, max_by(roy, seq) filter (roy is not null) as royalty from checked where ok group by 1, 2""")
def observation_history(spark, d):
    return observations.history(_observations(spark, d).filter("valid"))


def _points(spark, d):
    """Running event counts per user and day: dates and counts, one row each."""
    daily = table(spark, d, "events").groupBy(F.col("user_id").alias("item"), F.col("ts").cast("date").alias("dt")).agg(F.count("*").alias("c"))
    from pyspark.sql import Window

    return daily.select("item", "dt", F.sum("c").over(Window.partitionBy("item").orderBy("dt")).alias("n"))


_RATES = f"""
daily as (select user_id as item, cast(ts as date) as dt, count(*) as c from events group by 1, 2),
points as (select item, dt, sum(c) over (partition by item order by dt) as n from daily where dt <= date '{AS_OF}'),
ends as (select item, max(dt) as e, max_by(n, dt) as en from points group by 1),
starts as (select p.item, max(dt) as s, max_by(n, dt) as sn from points p join ends using (item) where dt between e - {DAYS + SLACK} and e - {DAYS} group by 1),
rates as (select ends.item, case when date '{AS_OF}' - e <= 7 and en >= sn then cast(en - sn as double) * {DAYS} / (e - s) end as rate from ends left join starts using (item))
"""


@query(f"with {_RATES} select item, round(rate, 6) as rate from rates")
def trailing_rate(spark, d):
    return report.trailing_rate(_points(spark, d), AS_OF, DAYS, SLACK).select("item", F.round("rate", 6).alias("rate"))


@query(f"""with {_RATES},
per as (select user_id as item, count(*) as downloads, min(cast(ts as date)) as born, count(*) filter (event_type = 'purchase') as bought,
          count(*) filter (event_type = 'click') as clicked from events group by 1),
items as (select item, c_mktsegment as niche, case when bought > 0 and item % 5 <> 0 then 'accepted' when clicked > 0 then 'rejected' else 'pending' end as status, downloads, born,
            case when item % 2 = 0 then cast(downloads as double) / 4 end as royalty from per join customer on item = c_custkey),
g as (select niche, count(*) as assets, count(*) filter (status = 'accepted') as accepted, count(*) filter (status = 'rejected') as rejected, cast(sum(downloads) as bigint) as downloads,
  coalesce(sum(royalty), 0) as royalty_usd, count(royalty) as royalty_known, count(*) filter (status = 'accepted' and rate is not null) as observed_assets,
  coalesce(sum(rate) filter (status = 'accepted'), 0) as recent_downloads, min(greatest(0, date '{AS_OF}' - born)) filter (status = 'accepted') as min_age_days
  from items left join rates using (item) group by 1),
r as (select *, case when accepted + rejected > 0 then accepted / (accepted + rejected) end as acceptance_rate, case when observed_assets > 0 then recent_downloads / observed_assets end as per_asset from g)
select niche, assets, accepted, rejected, downloads, royalty_usd, royalty_known, observed_assets, round(recent_downloads, 6) as recent_downloads, min_age_days,
  round(acceptance_rate, 6) as acceptance_rate, round(per_asset, 6) as downloads_per_asset,
  case when accepted + rejected >= {LEAST} and acceptance_rate < 0.4 then 'FIX QUALITY' when observed_assets < {LEAST} then 'HOLD: insufficient observations'
    when per_asset >= 1 and acceptance_rate >= 0.7 then 'EXPAND TEST' when per_asset = 0 then 'REVIEW NICHE' else 'HOLD: monitor demand' end as verdict
from r""")
def niche_report(spark, d):
    bought, clicked = F.count_if(F.col("event_type") == "purchase"), F.count_if(F.col("event_type") == "click")
    per = table(spark, d, "events").groupBy(F.col("user_id").alias("item")).agg(F.count("*").alias("downloads"), F.min(F.col("ts").cast("date")).alias("born"), bought.alias("bought"), clicked.alias("clicked"))
    status = F.when((F.col("bought") > 0) & (F.col("item") % 5 != 0), "accepted").when(F.col("clicked") > 0, "rejected").otherwise("pending")
    items = per.join(table(spark, d, "customer").select(F.col("c_custkey").alias("item"), F.col("c_mktsegment").alias("niche")), "item")
    items = items.select("item", "niche", status.alias("status"), "downloads", "born", F.when(F.col("item") % 2 == 0, F.col("downloads") / 4).alias("royalty"))
    out = report.niche_report(items, report.trailing_rate(_points(spark, d), AS_OF, DAYS, SLACK), AS_OF, LEAST)
    return out.withColumns({c: F.round(c, 6) for c in ("recent_downloads", "acceptance_rate", "downloads_per_asset")})


@query("""
with o as (select o_orderkey as k, o_orderstatus as status, o_orderpriority as category from orders where o_orderkey % 3 <> 0),
n as (select o_orderkey as k, 'N2' as status, case when o_orderkey % 4 = 0 then '' else o_orderpriority || '!' end as category from orders where o_orderkey % 2 = 0)
select coalesce(n.k, o.k) as k, case when n.k is not null then n.status else o.status end as status, coalesce(nullif(n.category, ''), o.category, n.category) as category
from o full join n on o.k = n.k""")
def sticky_category(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("category"))
    new = o.filter("k % 2 = 0").select("k", F.lit("N").alias("status"), F.when(F.col("k") % 4 == 0, "").otherwise(F.concat("category", F.lit("!"))).alias("category"))
    twice = new.withColumn("seq", F.lit(2)).withColumn("status", F.lit("N2")).union(new.withColumn("seq", F.lit(1)).withColumn("category", F.lit("first")))
    return upsert.upsert(o.filter("k % 3 <> 0"), twice, "k", ("category",), "seq")


@query("select o_orderkey, o_totalprice from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def delete_by_key(spark, d):
    gone = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.delete(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), gone, "o_orderkey")


@query("""select c_custkey as k, c_name as name, null as extra from customer where c_custkey % 3 <> 0
union all select c_custkey, c_name, 'added' from customer where c_custkey % 3 = 0""")
def insert_if_absent(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    new = c.select("k", "name", F.lit("added").alias("extra"), F.lit(1).alias("seq"))
    new = new.union(new.withColumn("extra", F.lit("again")).withColumn("seq", F.lit(2)))
    return upsert.insert_absent(c.filter("k % 3 <> 0"), new, "k", "seq").drop("seq")


@query("""
with o as (select c_custkey as filename, case c_custkey % 4 when 0 then 'ready' when 1 then 'accepted' when 2 then 'needs_review' else 'failed' end as status, case when c_custkey % 2 = 0 then c_mktsegment else '' end as niche, c_name as notes, c_acctbal as extra from customer where c_custkey % 3 <> 0),
n as (select c_custkey as filename, 'needs_metadata' as pipeline_status, 'new' as niche, 'n' as notes, c_nationkey as production_seconds from customer where c_custkey % 2 = 0 or c_custkey % 9 = 0)
select coalesce(o.filename, n.filename) as filename,
  case when o.filename is null then coalesce(pipeline_status, 'ready') when n.filename is not null and status in ('ready', 'needs_metadata', 'needs_review', 'failed') then pipeline_status else status end as status,
  coalesce(nullif(o.niche, ''), n.niche, o.niche) as niche, o.notes, extra, pipeline_status, production_seconds
from o full join n on o.filename = n.filename""")
def log_upsert(spark, d):
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    status = F.when(k % 4 == 0, "ready").when(k % 4 == 1, "accepted").when(k % 4 == 2, "needs_review").otherwise("failed")
    log = c.filter(k % 3 != 0).select(k.alias("filename"), status.alias("status"), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("niche"), F.col("c_name").alias("notes"), F.col("c_acctbal").alias("extra"))
    new = c.filter((k % 2 == 0) | (k % 9 == 0)).select(k.alias("filename"), F.lit("needs_metadata").alias("pipeline_status"), F.lit("new").alias("niche"), F.lit("n").alias("notes"), F.col("c_nationkey").alias("production_seconds"))
    return upsert.record(log, new)


@query("""
with manual as (select 'd' || doc_id as name, quality from labels union all select source, -1 from documents group by 1),
jobs as (select doc_id, 'd' || doc_id as svg, source, count(*) over (partition by source) = 1 as uniq from documents)
select doc_id, coalesce(a.quality, b.quality) as quality from jobs left join manual a on svg = a.name left join manual b on source = b.name and uniq""")
def manual_lookup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("svg"), "source")
    manual = table(spark, d, "labels").select(F.concat(F.lit("d"), "doc_id").alias("name"), "quality").union(docs.select("source", F.lit(-1)).distinct())
    return assets.manual_lookup(assets.unique_names(docs, "source", "unique"), manual, "svg", "source", "unique", "quality").select("doc_id", "quality")


@query("""select status, count(*) as n, count(*) filter (status = 'ready') as to_metadata, cast(sum(files) as bigint) as files from (
  select case when quality is null then 'needs_metadata' when quality = 1 then 'ready' else 'needs_review' end as status, 1 + (doc_id % 3 = 0)::int as files from documents left join labels using (doc_id)) group by 1""")
def status_route(spark, d):
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = rows.select(assets.status(F.when(F.col("quality").isNotNull(), "ai"), F.col("quality") == 1).alias("status"), F.when(F.col("doc_id") % 3 == 0, "x.eps").alias("eps"))
    return assets.routed(rows).groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("target") == "metadata").alias("to_metadata"), F.sum(F.size("files")).alias("files"))


@query("""
with w as (select doc_id, list_filter(list_transform(string_split(replace(text, chr(10), ' '), '. '), lambda k: trim(regexp_replace(lower(k), '\\s+', ' ', 'g'))),
  lambda k: k <> '' and not contains(k, ',') and len(string_split(k, ' ')) <= 3) as ks from documents),
d as (select doc_id, list_filter(ks, lambda k, i: list_position(ks, k) = i) as ks from w)
select doc_id, case when len(ks) >= 5 then ks[1:49] end as keywords from d""")
def keyword_clean(spark, d):
    raw = F.split(F.regexp_replace("text", "\n", " "), r"\. ")
    return table(spark, d, "documents").select("doc_id", T.clean_keywords(raw).alias("keywords"))


@query(r"""
with f as (select event_id, case event_id % 4 when 0 then 'Airline_Solid_' when 1 then 'cyber-outline ' when 2 then 'blue_line-' else '_' end || event_type || '_20' || (10000000 + event_id * 7919 % 2000000) % 1000000 + 240000
  || case when event_id % 3 = 0 then '__0123456789ab' else '' end || '.svg' as name from events),
s as (select event_id, name, regexp_replace(regexp_replace(lower(name), '\.[^.]*$', ''), '__[0-9a-f]{12,64}$', '') as stem from f),
w as (select *, regexp_split_to_array(stem, '[_\s-]+') as ws, regexp_extract(stem, '(?:^|[^0-9])(20[0-9]{6})(?:[0-9]{6})?(?:$|[^0-9])', 1) as ds from s)
select event_id, ws[1] as niche, case when list_contains(ws, 'blue') then 'blue' when list_contains(ws, 'line') then 'line' when list_contains(ws, 'solid') then 'solid' when list_contains(ws, 'outline') then 'outline' else '' end as style,
  coalesce(strftime(try_strptime(nullif(ds, ''), '%Y%m%d'), '%Y-%m-%d'), '') as batch_date from w""")
def filename_parse(spark, d):
    k = F.col("event_id")
    digits = (F.lit(10_000_000) + k * 7919 % 2_000_000) % 1_000_000 + 240_000
    lead = F.when(k % 4 == 0, "Airline_Solid_").when(k % 4 == 1, "cyber-outline ").when(k % 4 == 2, "blue_line-").otherwise("_")
    name = F.concat(lead, "event_type", F.lit("_20"), digits.cast("string"), F.when(k % 3 == 0, "__0123456789ab").otherwise(""), F.lit(".svg"))
    return table(spark, d, "events").select("event_id", *(c.alias(n) for n, c in T.file_parts(name).items()))


@query(r"select p_partkey, trim(regexp_replace(lower(' ' || upper(p_name) || chr(9) || p_brand || '  '), '\s+', ' ', 'g')) as title from part")
def title_norm(spark, d):
    return table(spark, d, "part").select("p_partkey", T.normal_title(F.concat(F.lit(" "), F.upper("p_name"), F.lit("\t"), "p_brand", F.lit("  "))).alias("title"))


@query(r"select p_partkey, left(trim(regexp_replace(replace(p_name, '_', ' ') || ' ' || p_brand, '\s+', ' ', 'g')), 90) as title from part")
def draft_title(spark, d):
    return table(spark, d, "part").select("p_partkey", T.draft_title(F.concat("p_name", F.lit("_20260101123456-"), "p_brand", F.lit(".svg"))).alias("title"))


@query("""select label as asset_id, (cast(floor(embedding[1] * 127 + 128) as int) // 8) as br, (cast(floor(embedding[2] * 127 + 128) as int) // 8) as bg, (cast(floor(embedding[3] * 127 + 128) as int) // 8) as bb, count(*) as pixels,
  avg(cast(floor(embedding[1] * 127 + 128) as int)) as r, avg(cast(floor(embedding[2] * 127 + 128) as int)) as g, avg(cast(floor(embedding[3] * 127 + 128) as int)) as b from embeddings group by 1, 2, 3, 4""")
def bucket_histogram(spark, d):
    """Colours of the first three numbers, in single precision throughout as in SQL: Spark takes a float times an integer in double."""
    single = lambda n: F.lit(n).cast("float")
    colors = (F.floor(F.get("embedding", j) * single(127) + single(128)).cast("int").alias(c) for j, c in enumerate("rgb"))
    return pixels.color_buckets(table(spark, d, "embeddings").select(F.col("label").alias("asset_id"), *colors))


def _pairs(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")


@query("""select a.vec_id, round(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: abs(cast(z[1] as double) - cast(z[2] as double)))) / 64 / 255, 9) as mae
from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""")
def mean_error(spark, d):
    return _pairs(spark, d).select("vec_id", F.round(pixels.mean_error(F.col("embedding"), F.col("other")), 9).alias("mae"))


_BOX = """px as (select vec_id, (i - 1) % 8 as x, (i - 1) // 8 as y, v from (select vec_id, unnest(embedding) as v, unnest(range(1, 65)) as i from embeddings)),
boxes as (select vec_id, min(x) filter (v > 0.15) / 8 as x0, min(y) filter (v > 0.15) / 8 as y0, max(x) filter (v > 0.15) / 8 as x1, max(y) filter (v > 0.15) / 8 as y1 from px group by 1)"""


def _boxes(spark, d):
    """Boxes of 8 x 8 pixels, a vector without any included; the bound has the type of the numbers, as in SQL."""
    e = table(spark, d, "embeddings")
    bound = F.lit(0.15).cast(e.schema["embedding"].dataType.elementType)
    px = e.select("vec_id", F.posexplode_outer(F.slice("embedding", 1, 64)).alias("i", "v"))
    px = px.select("vec_id", (F.col("i") % 8).alias("x"), F.floor(F.col("i") / 8).alias("y"), "v")
    return pixels.ink_box(px, ["vec_id"], F.col("v") > bound, 8, 8)


@query(f"with {_BOX} select * from boxes")
def ink_box(spark, d):
    return _boxes(spark, d)


@query(f"""with {_BOX} select a.vec_id, case when a.x0 is null or b.x0 is null then 1.0 else greatest(abs(a.x0 - b.x0), abs(a.y0 - b.y0), abs(a.x1 - b.x1), abs(a.y1 - b.y1)) end as drift
from boxes a join boxes b on b.vec_id = a.vec_id + 1""")
def box_drift(spark, d):
    a = _boxes(spark, d)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), *(F.col(c).alias(f"{c}_") for c in ("x0", "y0", "x1", "y1")))
    sides = ("x0", "y0", "x1", "y1")
    return a.join(b, "vec_id").select("vec_id", pixels.box_drift([F.col(c) for c in sides], [F.col(f"{c}_") for c in sides]).alias("drift"))


_PALETTE = [[0.25 if (k >> (j % 3)) & 1 else -0.25 for j in range(64)] for k in range(8)]


@query("""with c as (select unnest(range(8)) as k), d as (
  select vec_id, k, list_sum(list_transform(range(64), lambda j: pow(cast(embedding[j + 1] as double) - case when (k >> (j % 3)) & 1 = 1 then 0.25 else -0.25 end, 2))) as far from embeddings, c)
select vec_id, cast(arg_min(k, (round(far, 9), k)) as int) as nearest from d group by 1""")
def nearest_palette(spark, d):
    return table(spark, d, "embeddings").select("vec_id", pixels.nearest(F.col("embedding"), _PALETTE).alias("nearest"))


@query("select l_returnflag, round(quantile_cont(l_extendedprice, 0.95), 6) as p95 from lineitem group by 1")
def percentile_residual(spark, d):
    found = pixels.quantile(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", 0.95, Scratch(spark, "quantile"))
    return found.select("l_returnflag", F.round("quantile", 6).alias("p95"))


@query("select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.page') as page from events")
def json_fields(spark, d):
    read = T.answer(F.concat(F.lit("```json\n"), "props", F.lit("\n```")), "k string, page string")
    return table(spark, d, "events").select("event_id", read["k"].alias("k"), read["page"].alias("page"))


@query(r"""with v as (select l_orderkey, l_linenumber, cast(round_even(cast(l_linenumber % 3 || '.000' || (l_partkey % 3 * 5) || '00000000' || (l_suppkey % 2) as decimal(28,18)), 3) as decimal(28,3))::varchar as t from lineitem)
select l_orderkey, l_linenumber, case when regexp_replace(t, '\.?0+$', '') in ('', '-0', '-') then '0' else regexp_replace(t, '\.?0+$', '') end as number from v""")
def path_rounding(spark, d):
    text = F.concat(F.col("l_linenumber") % 3, F.lit(".000"), F.col("l_partkey") % 3 * 5, F.lit("00000000"), F.col("l_suppkey") % 2)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.short_number(text).alias("number"))


@query(r"""select l_orderkey, l_linenumber, case when l_quantity = l_linenumber then 3 else 4 end as chunks, 2 + 3 * 4 + 2 * 5 as tokens from lineitem""")
def path_chunks(spark, d):
    """A line chunk of one point goes where it repeats the one before; one of two points stays."""
    line = lambda c: F.concat(F.lit("L "), F.col(c).cast("bigint").cast("string"), F.lit(" 1"))
    chunks = F.array(line("l_quantity"), line("l_quantity"), line("l_linenumber"), line("l_linenumber"), F.lit("L 1 1 2 2"), F.lit("L 1 1 2 2"))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", chunks.alias("c"))
    tokens = F.size(paths.path_tokens(F.concat(F.lit("M 0"), F.lit(" "), F.array_join("c", " "))))
    return rows.select("l_orderkey", "l_linenumber", F.size(paths.without_repeats(F.col("c"))).alias("chunks"), tokens.alias("tokens"))


_BOARD = """s as (select p_partkey, cast(p_size as double) as w, 7.0::double as h, sqrt(15e6 / (p_size * 7.0::double)) as s from part),
r as (select p_partkey, greatest(1, cast(round_even(w * s, 0) as bigint)) as width, greatest(1, cast(round_even(h * s, 0) as bigint)) as height from s)"""


@query(f"""with {_BOARD} select p_partkey, case when width * height < 15e6 then cast(ceil(15e6 / height) as bigint) when width * height > 65e6 then cast(floor(65e6 / height) as bigint) else width end as width, height from r""")
def artboard_size(spark, d):
    size = paths.artboard(F.col("p_size").cast("double"), F.lit(7.0), 15.0)
    return table(spark, d, "part").select("p_partkey", size["width"].alias("width"), size["height"].alias("height"))


@query(f"""with {_BOARD} select p_partkey, case when width * height < 15e6 then cast(ceil(15e6 / height) as bigint) else width end as width, height, cast(2 as bigint) as paths from r""")
def svg_artboard(spark, d):
    """The same through documents: parsed, rounded, joined, sized and written."""
    n = F.col("p_size")
    path = lambda x: F.concat(F.lit('<path fill="#111" d="M '), x, F.lit(' 0 L 1.00049 2 L 1.00049 2 Z"/>'))
    text = F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" width="'), n, F.lit('px" height="7">'), path(F.lit("0")), path(F.lit("0.5")), path(F.lit("9")), F.lit("</svg>"))
    text = F.replace(text, F.lit('d="M 9 0 L 1.00049 2 L 1.00049 2 Z"'), F.lit('d="M 9 0 L 9 2 Z"'))
    docs = table(spark, d, "part").select(F.col("p_partkey").alias("asset_id"), text.alias("svg"))
    done = svg.rewritten(docs, lambda root: svg.sized(svg.optimised(root, join=True), 15.0))
    side = lambda name: F.regexp_extract("xml", f' {name}="([0-9]+)"', 1).cast("long").alias(name)
    return done.select(F.col("asset_id").alias("p_partkey"), F.decode("payload", "UTF-8").alias("xml")).select("p_partkey", side("width"), side("height"), F.regexp_count("xml", F.lit("<path")).cast("long").alias("paths"))


@query("""with px as (select vec_id, [cast(floor(cast(x as double) * 127 + 128) as int) for x in embedding[1:48]] as v from embeddings) select vec_id, 4 as height, 4 as width, cast(list_sum(v) as bigint) as total, v[4] as second_red from px""")
def raster_decode(spark, d):
    """PNG files of 4 x 4 pixels, decoded."""
    import numpy as np
    import pyarrow as pa

    def through(batches):
        for batch in batches:
            rows = []
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = raster.as_rgb(raster.read_png(raster.write_png(np.array(v, np.uint8).reshape(4, 4, 3))))
                rows.append((k, *got.shape[:2], int(got.sum()), int(got[0, 1, 0])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()), strict=True)], ["vec_id", "height", "width", "total", "second_red"])

    v = F.transform(F.slice("embedding", 1, 48), lambda x: F.floor(x.cast("double") * 127 + 128).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", v.alias("v")).mapInArrow(through, "vec_id long, height int, width int, total long, second_red int")


@query("""select p_partkey, case when p_partkey % 9 = 0 then 'head' when p_size % 10 = 0 then 'bounds' when not (p_size * 100 * 10000 / 1e6 between 15 and 65) then 'artboard' end as error from part""")
def eps_structure(spark, d):
    k, n = F.col("p_partkey"), F.col("p_size")
    text = F.concat(F.when(k % 9 == 0, "%!PS-Adobe-3.0").otherwise("%!PS-Adobe-3.0 EPSF-3.0"), F.lit("\n%%BoundingBox: 0 0 "), F.when(n % 10 == 0, 0).otherwise(n * 100), F.lit(" 10000\n"))
    return table(spark, d, "part").select("p_partkey", eps.structure(text.cast("binary"))["error"].alias("error"))


@query("""select p_partkey, case when p_partkey % 6 < 4 then round(p_size * case p_partkey % 4 when 0 then 1.0 when 1 then 96.0 / 72 when 2 then 96.0 else 96 / 25.4 end, 6) end as px from part""")
def length_pixels(spark, d):
    """Lengths below and at zero are none."""
    k = F.col("p_partkey")
    unit = F.element_at(F.array(*map(F.lit, ("px", "pt", "in", "mm"))), (k % 4 + 1).cast("int"))
    number = F.when(k % 6 == 4, "0").when(k % 6 == 5, F.concat(F.lit("-"), F.col("p_size"))).otherwise(F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", F.round(T.pixel_length(F.concat(number, unit)), 6).alias("px"))


@query()
def greedy_palette(spark, d):
    v = table(spark, d, "embeddings").select(F.col("label").alias("asset_id"), *((F.element_at("embedding", j) * 127 + 128).cast("double").alias(c) for j, c in enumerate("rgb", 1)))
    return pixels.greedy_palette(pixels.color_buckets(v))


@query()
def kmeans_colors(spark, d):
    return pixels.kmeans(table(spark, d, "embeddings"), "vec_id", "embedding")


@query(SQL["observation_fold"])
def observation_resume(spark, d):
    """Two imports, the second on top of the first, give what one import of all rows gives."""
    rows = _observations(spark, d).filter("valid")
    first = rows.filter("seq < 1000")
    return observations.resume(rows.filter("seq >= 1000"), observations.fold(first), observations.history(first))


@query("""select vec_id, round(abs(list_sum(list_transform(range(1, 33), lambda i: cast(embedding[2 * i - 1] as double) * embedding[case when i = 32 then 2 else 2 * i + 2 end] - cast(embedding[2 * i] as double) * embedding[case when i = 32 then 1 else 2 * i + 1 end]))) / 2, 6) as area
from embeddings""")
def polygon_area(spark, d):
    point = lambda at: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.get("embedding", i * 2 + at).cast("double"))
    return table(spark, d, "embeddings").select("vec_id", F.round(rules.polygon_area(point(0), point(1)), 6).alias("area"))


@query("""select p_partkey, case when p_size < 5 or p_size * 2 < 35 then 2 when p_size * 2 < 70 then 4 else 8 end as filter_speckle,
  case when p_size < 5 or p_size * 2 < 70 then 6 else 4 end as color_precision from part""")
def tracing_parameters(spark, d):
    chosen = rules.tracing_parameters(F.col("p_size") * 2, F.col("p_size") < 5)
    return table(spark, d, "part").select("p_partkey", chosen["filter_speckle"].alias("filter_speckle"), chosen["color_precision"].alias("color_precision"))


@query("""select p_partkey, case when p_partkey % 3 = 1 then 'f' || p_partkey || '__' || sha256(p_name) || '.png' else 'f' || p_partkey || '__' || left(sha256(p_name), 12) || '.png' end as name,
  case p_partkey % 3 when 0 then 'move' when 1 then case when p_partkey % 2 = 0 then 'conflict' else 'move' end else 'delete' end as action from part""")
def archive_targets(spark, d):
    k, digest = F.col("p_partkey"), F.sha2(F.col("p_name"), 256)
    chosen = rules.archive_target(F.concat(F.lit("in/f"), k, F.lit(".png")), digest, F.when(k % 3 == 1, "other").when(k % 3 == 2, digest), F.when(k % 2 == 0, "other"))
    return table(spark, d, "part").select("p_partkey", chosen["name"].alias("name"), chosen["action"].alias("action"))
