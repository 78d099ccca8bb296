"""The asset operators against small, written-out cases and a sequential model."""

import json
from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkspool import engines
from inkspool.functions import text as T
from inkspool.operators import assets, observations, paths, pixels, report, rules, upsert
from inkspool.sources import tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order or df.columns).collect()]


def test_text_functions(spark):
    df = spark.createDataFrame([("airline_solid_20260926060136.svg",), ("cyber_20261340.svg",), ("dir/a b-Blue__0123456789ab.svg",), ("_x.png",)], "f string")
    parts = T.file_parts(F.col("f"))
    got = [tuple(r) for r in df.select(*(parts[k] for k in ("niche", "style", "batch_date"))).collect()]
    assert got == [("airline", "solid", "2026-09-26"), ("cyber", "", ""), ("a", "blue", ""), ("", "", "")]
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(T.normal_title(F.lit(" A B\t c "))) == "a b c"
    assert value(T.iso_date(F.lit("2026-9-6"))) is None and value(T.iso_date(F.lit(" 2026-09-06T10:00"))) == date(2026, 9, 6)
    assert value(T.draft_title(F.lit("red_fox-20260926060136.svg"))) == "red fox"
    assert value(T.clean_keywords(F.array(*map(F.lit, ["A", "a ", "b,c", "one two three four", "d", "e", "f", "g"])))) == ["a", "d", "e", "f", "g"]
    assert value(T.clean_keywords(F.array(F.lit("a")))) is None
    assert [value(T.short_number(F.lit(x))) for x in ("1.0005", "1.0015", "-0.0001", "20", "2.500")] == ["1", "1.002", "0", "20", "2.5"]
    assert value(T.pixel_length(F.lit("1in"))) == 96 and value(T.pixel_length(F.lit("1em"))) is None
    assert value(T.unfenced(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'


def test_asset_groups_and_status(spark):
    files = spark.createDataFrame([("in/b.png", b"x"), ("in/a b.png", b"x"), ("in/a/z.png", b"y")], "path string, content binary")
    groups, members = assets.content_groups(files)
    assert sorted((r.first_source, r.copies) for r in groups.collect()) == [("in/a b.png", 2), ("in/a/z.png", 1)] and members.count() == 3
    got = spark.createDataFrame([("ai", True), ("ai", None), ("dummy", True), (None, False)], "s string, p boolean").select(assets.status(F.col("s"), F.col("p"))).collect()
    assert [r[0] for r in got] == ["ready", "needs_review", "needs_metadata", "needs_metadata"]
    names = spark.createDataFrame([("a",), ("a",), (None,)], "n string")
    assert sorted(map(str, rows(assets.unique_names(names, "n")))) == ["('a', False)", "('a', False)", "(None, True)"]


def test_upserts_keep_history(spark):
    log = spark.createDataFrame([("a", "accepted", "n", "mine", "x"), ("b", "ready", "", "", "y")], "filename string, status string, niche string, notes string, own string")
    new = spark.createDataFrame([("a", "needs_review", "m", "z"), ("b", "failed", "m", "z"), ("c", "ready", "m", "z")], "filename string, pipeline_status string, niche string, notes string")
    got = rows(upsert.record(log, new).select("filename", "status", "niche", "notes", "own"), "filename")
    assert got == [("a", "accepted", "n", "mine", "x"), ("b", "failed", "m", "", "y"), ("c", "ready", "m", None, None)]
    old = spark.createDataFrame([("a", "t", "c")], "k string, title string, category string")
    put = spark.createDataFrame([("a", "u", ""), ("b", "v", "")], "k string, title string, category string")
    assert rows(upsert.upsert(old, put, "k", ("category",)), "k") == [("a", "u", "c"), ("b", "v", "")]
    assert rows(upsert.delete(old, put, "k")) == []


def test_resolution_stages(spark):
    log = spark.createDataFrame([("f1", "id1"), ("f2", ""), ("f3", "id3")], "filename string, external_id string")
    meta = spark.createDataFrame([("f1", "One"), ("f2", "Two"), ("f3", "Three"), ("f4", "two  ")], "filename string, title string")
    scrape = spark.createDataFrame([(1, "x", "", "id1"), (2, "x", "f2", ""), (3, "one", "", ""), (4, "TWO", "", ""), (5, "nope", "", ""), (6, "three", "", "id9")], "seq long, title string, filename string, external_id string")
    got = {r.seq: (r.file, r.outcome) for r in observations.resolve(scrape, log, meta).collect()}
    assert got == {1: ("f1", "matched"), 2: ("f2", "matched"), 3: ("f1", "matched"), 4: (None, "ambiguous"), 5: (None, "unmatched"), 6: ("f3", "ambiguous")}


def model(seq):
    """The fold one row after the other."""
    state, days = {}, {}
    for dt, d, acc, roy, explicit in seq:
        if dt in days and d < days[dt]:
            continue
        days[dt] = d
        if acc and not state.get("acc"):
            state["acc"] = acc
        evidence = explicit == "accepted" or acc is not None or d > 0
        if evidence:
            state["first"] = min(state.get("first", dt), dt)
        if "date" not in state or dt >= state["date"]:
            state["latest"], state["date"] = d, dt
            if roy is not None:
                state["roy"] = roy
            if explicit in observations.EXPLICIT:
                state["status"] = explicit
            elif evidence:
                state["status"] = "accepted"
    return tuple(state.get(k) for k in ("latest", "date", "roy", "first", "acc", "status"))


DAY = st.integers(1, 6).map(lambda k: date(2026, 1, k))
ROW = st.tuples(DAY, st.integers(0, 4), st.none() | DAY, st.none() | st.sampled_from([0.5, 1.0]), st.sampled_from(["", "accepted", "rejected", "pending", "other"]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(ROW, min_size=1, max_size=10), min_size=8, max_size=20))
def test_fold_agrees_with_a_sequential_model(spark, many):
    data = [(f"f{k}", i, *r) for k, seq in enumerate(many) for i, r in enumerate(seq)]
    df = spark.createDataFrame(data, "file string, seq int, dt date, d long, acc date, roy double, explicit string")
    got = {r.file: (r.dl_latest, r.dl_date, r.royalty, r.first_seen, r.accepted_date, r.status) for r in observations.fold(df).collect()}
    assert got == {f"f{k}": model(seq) for k, seq in enumerate(many)}


def test_validation(spark):
    data = [("3", "2026-01-02", "", ""), ("x", "2026-01-02", "", ""), ("-1", "2026-01-02", "", ""), ("1", "2026-1-2", "", ""), ("1", "2026-01-02", "2026-01-03", ""), ("1", "2026-01-02", "", "nan"), ("1", "2026-01-02", "", "-1"), ("1", None, None, None)]
    df = spark.createDataFrame(data, "downloads string, observed string, accepted string, royalty string")
    assert [r.valid for r in observations.validate(df).collect()] == [True, False, False, False, False, False, False, False]


def test_trailing_rate(spark):
    end = date(2026, 9, 30)
    data = [("a", end - timedelta(30), 8), ("a", end, 10), ("b", end - timedelta(20), 1), ("b", end, 5), ("c", end - timedelta(30), 9), ("c", end, 5), ("d", end - timedelta(36), 0), ("d", end - timedelta(6), 6)]
    points = spark.createDataFrame(data, "item string, dt date, n long")
    assert dict(rows(report.trailing_rate(points, end))) == {"a": 2.0, "b": None, "c": None, "d": 6.0}
    assert dict(rows(report.trailing_rate(points, end + timedelta(8))))["a"] is None


def test_report_verdicts(spark):
    items = [(f"{n}{k}", n, s, d, None, date(2026, 1, 1)) for n, s, d in (("good", "accepted", 5), ("bad", "rejected", 0), ("", "pending", 0)) for k in range(3)]
    df = spark.createDataFrame(items, "item string, niche string, status string, downloads long, royalty double, born date")
    rates = spark.createDataFrame([(f"good{k}", 2.0) for k in range(3)], "item string, rate double")
    got = {r.niche: (r.verdict, r.royalty_known) for r in report.niche_report(df, rates, date(2026, 2, 1), 3).collect()}
    assert got == {"good": ("EXPAND TEST", 0), "bad": ("FIX QUALITY", 0), "unclassified": ("HOLD: insufficient observations", 0)}


def test_pixels_and_paths(spark):
    px = spark.createDataFrame([(1, 0, 0, 0.1), (1, 1, 1, 0.5), (2, 0, 0, 0.99)], "k int, x int, y int, v double")
    boxes = {r.k: tuple(r)[1:] for r in pixels.ink_box(px, ["k"], F.col("v") < 0.92, 2, 2).collect()}
    assert boxes == {1: (0.0, 0.0, 0.5, 0.5), 2: (None,) * 4}
    value = lambda c: spark.range(1).select(c).first()[0]
    assert value(paths.path_tokens(F.lit("M1-2.5e1 L.5,3z"))) == ["M", "1", "-2.5e1", "L", ".5", "3", "z"]
    assert value(paths.path_tokens(F.lit("M1 ?"))) is None
    assert value(paths.without_repeats(F.array(*map(F.lit, ["M 0 0", "L 1 1", "L 1 1", "l 1 1", "l 1 1"])))) == ["M 0 0", "L 1 1", "l 1 1", "l 1 1"]
    mask = np.array([[1, 1, 0], [0, 1, 0], [1, 0, 1]])
    assert len(np.unique(pixels.regions(mask))) == 6


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('﻿title,n\r\n"a ""b""\r\nc",\r\n007,x\r\n'.encode())
    got = [tuple(r) for r in tables.read_csv(spark, str(path)).collect()]
    assert [g[1] for g in got] == ["", "x"] and got[1][0] == "007" and 'a "b"' in got[0][0]
    assert tables.read_csv(spark, str(tmp_path / "none.csv"), ["x"]).count() == 0
    out = str(tmp_path / "t")
    tables.replace_parquet(spark.range(3), out)
    tables.replace_parquet(spark.read.parquet(out).filter("id > 0"), out)
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(Exception, match="duplicate"):
        tables.unique_manual(spark.createDataFrame([("a",), ("a",)], "Filename string")).collect()
    (tmp_path / "im").mkdir()
    for name in ("a.PNG", "b.txt"):
        (tmp_path / "im" / name).write_bytes(b"x")
    assert tables.read_images(spark, str(tmp_path / "im")).count() == 1


def test_engines_fail_visibly(spark):
    df = spark.createDataFrame([(1, b"ab")], "asset_id long, content binary")
    assert engines.apply(df).first().ok is False
    assert bytes(engines.apply(df, lambda b: b[::-1]).first().payload) == b"ba"


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(ROW, min_size=2, max_size=10), min_size=8, max_size=20))
def test_two_imports_agree_with_one(spark, many):
    data = [(f"f{k}", i, *r) for k, seq in enumerate(many) for i, r in enumerate(seq)]
    df = spark.createDataFrame(data, "file string, seq int, dt date, d long, acc date, roy double, explicit string")
    first = df.filter("seq < 4")
    out = observations.resume(df.filter("seq >= 4"), observations.fold(first), observations.history(first))
    got = {r.file: (r.dl_latest, r.dl_date, r.royalty, r.first_seen, r.accepted_date, r.status) for r in out.collect()}
    assert got == {f"f{k}": model(seq) for k, seq in enumerate(many)}


def test_response_rules(spark):
    body = lambda **e: json.dumps({"error": e})
    model_only = [{"violations": [{"quotaId": "x", "quotaDimensions": {"model": "m"}}]}]
    data = [
        (1, "7", body(details=[{"retryDelay": "12.5s"}], message="retry after 3 s")),
        (2, "Thu, 01 Jan 2026 00:01:30 GMT", body(message="x")),
        (3, None, None),
        (9, "soon", "no json"),
        (1, None, body(details=[{"retryDelay": "1s"}, *model_only])),
        (1, None, body(details=[{"violations": [{"quotaId": "RequestsPerDay"}]}])),
        (1, None, body(details=[{"violations": [{"quotaMetric": "m", "quotaValue": "0"}]}], message="per day")),
        (1, None, body(message="Daily quota reached")),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(data)], "k int, attempt int, header string, body string").orderBy("k")
    now = F.timestamp_seconds(F.lit(1767225600))
    got = df.select(rules.retry_delay(F.col("header"), F.col("body"), F.col("attempt"), now), rules.long_quota(F.col("body")), rules.quota_scope(F.col("body"))).collect()
    assert [r[0] for r in got] == [12.5, 90.0, 8.0, 60.0, 1.0, 2.0, 2.0, 2.0]
    assert [r[1] for r in got] == [None, None, None, None, None, "daily", "zero", "daily"]
    assert [r[2] for r in got] == ["provider"] * 4 + ["model"] + ["provider"] * 3


def test_asset_rules(spark):
    value = lambda c: spark.range(1).select(c).first()[0]
    lit = lambda v: F.lit(v)
    colors = lambda *cs: F.array(*(F.array(*map(F.lit, c)) for c in cs))
    icon = lambda *cs: value(rules.icon_review(lit(True), lit(True), colors((255, 255, 250), *cs)))
    assert (icon(), icon((10, 20, 30)), icon((230, 230, 230))) == ("empty", None, "pale")
    assert value(rules.icon_review(lit(False), lit(True), colors((0, 0, 0)))) == "background"
    board = lambda w, h, box="0 0 1 1", size=1, images=0, n=1, **kw: value(rules.artboard_error(lit(w), lit(h), lit(box), lit(size), lit(images), lit(n), **kw))
    assert [board(5000.0, 5000.0), board(100.0, 100.0), board(5000.0, 5000.0, ""), board(5000.0, 5000.0, size=45_000_001), board(5000.0, 5000.0, images=1), board(5000.0, 5000.0, n=0), board(2000.0, 500.0, sides=(400, 4000))] == [None, "artboard", "view box", "size", "raster image", "no path", None]
    target = lambda short, full: tuple(value(rules.archive_target(lit("d/a b.png"), lit("0123456789abcdef"), lit(short), lit(full))))
    own, other = "0123456789abcdef", "zz"
    assert target(None, None) == ("a b__0123456789ab.png", "move") and target(own, None)[1] == "delete"
    assert target(other, None) == ("a b__0123456789abcdef.png", "move") and target(other, own)[1] == "delete" and target(other, other)[1] == "conflict"
    digests = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    assert [value(rules.sources_intact(digests(*x), lit("a"))) for x in (("a", "a"), (), ("a", None), ("b",))] == [True, False, False, False]
    assert value(rules.merged_sources(digests("a", "b"), digests("b", "c"))) == ["a", "b", "c"]
    cache = lambda issues, alpha, forced=False: value(rules.cache_valid(lit(True), lit(True), lit(True), lit(forced), lit(True), digests(*issues), lit(alpha)))
    assert (cache((), True), cache((), False), cache(("x",), False), cache((), True, True)) == (True, False, True, False)
    ring = lambda *v: F.array(*map(F.lit, map(float, v)))
    assert value(rules.polygon_area(ring(0, 2, 2, 0), ring(0, 0, 3, 3))) == 6 and not value(rules.shape_kept(ring(0, 1), ring(0, 9)))
    assert value(rules.quarantine_path(lit("in/x.png"), lit("0123456789abcdef"))) == "quarantine/0123456789ab/x.png"
