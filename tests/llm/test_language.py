"""Language identification: addresses, hostile pages, own shares left out, and a slow model."""

import math
import random
import time

import numpy as np
from pyspark.sql import functions as F

from inkspool.llm import language
from inkspool.session import Scratch

WORDS = {"en": "the cat and the dog went to house with them of", "de": "der hund und die katze gingen zu dem haus mit ihnen", "fr": "le chat et les chiens sont dans la maison avec eux"}


def tables(spark):
    rng = random.Random(5)
    text = lambda lang, n: " ".join(rng.choices(WORDS[lang].split(), k=n))
    docs = [(k, text(lang, 30), lang) for k, lang in enumerate(["en", "de", "fr"] * 20)]
    pages = []
    for k in range(80):
        lang = rng.choice(["en", "de", "fr"])
        said = rng.choice([f' lang="{lang}"', "", ' lang="xx"', f" class=x LANG='{rng.choice(list(WORDS))}-AT'"])
        host = rng.choice([f"www.{lang}site.com", "mixed.org", f"{lang}.wiki.org", "shop.co.uk"])
        path = rng.choice(["/", f"/{lang}/x", "/about"])
        pages.append((k, f"https://{host}{path}", f"<html{said}><body>{text(lang, rng.choice([0, 1, 3, 40]))}</body></html>"))
    pages += [(100, None, None), (101, "x", ""), (102, "//user@Host.Example.COM:80/FR-be", "<p>"), (5, *pages[5][1:])]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), pages


def slow(rows, names, n):
    """The fusion one page after the other, each judged by all others. rows: (host, domain, suffix, code, declared, p)."""
    out = []
    for i, (host, domain, suffix, code, declared, p) in enumerate(rows):
        others = [r for k, r in enumerate(rows) if k != i]
        prior = [1 / n] * n
        for weight, own in ((n, others), (language.WEIGHT, [r for r in others if r[2] == suffix]), (language.WEIGHT, [r for r in others if r[1:3] == (domain, suffix)]), (language.WEIGHT, [r for r in others if r[:3] == (host, domain, suffix)])):
            sums = [sum(r[5][j] for r in own) for j in range(n)]
            prior = [(s + weight * q) / (sum(sums) + weight) for s, q in zip(sums, prior)]
        z = [math.log(prior[j]) + math.log(p[j] + 1e-12) for j in range(n)]
        for at, value in ((4, declared), (3, code)):
            if value in names:
                for j in range(n):
                    # The page itself is among all pages with a value; its own share is left out of both sums.
                    said = sum(r[5][j] for r in others if r[at] == value)
                    total = sum(r[5][j] for r in others if r[at] in names)
                    z[j] += math.log((said + language.DOUBT / n + (language.DOUBT if value == names[j] else 0)) / (total + 2 * language.DOUBT))
        top = max(z)
        out.append((names[max(range(n), key=lambda j: (z[j], -j))], 1 / sum(math.exp(x - top) for x in z)))
    return out


def test_agrees_with_a_slow_fusion(spark):
    docs, pages = tables(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    names, table = language.train(docs)
    parts = df.select("page_id", *(c.alias(k) for k, c in language.address(F.col("url")).items()), language.declared(F.col("html")).alias("declared"), "html").collect()
    rows = []
    for r in parts:
        bins = language.trigrams(np.frombuffer(language.plain((r.html or "").encode()), np.uint8))
        s = table[:, bins].mean(1) * min(len(bins), language.EVIDENCE) if len(bins) else np.zeros(len(names))
        p = np.exp(s - s.max())
        rows.append((r.host, r.domain, r.suffix, r.code, r.declared, (p / p.sum()).tolist()))
    want = sorted((r.page_id, *x) for r, x in zip(parts, slow(rows, names, len(names))))
    got = sorted((r.page_id, r.lang, r.probability) for r in language.identify(df.repartition(3), docs, Scratch(spark, "t")).collect())
    assert len(got) == len(pages) and all(a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-6) for a, b in zip(got, want))


def test_addresses_and_declarations(spark):
    urls = ["https://www.a.co.uk/de/x?y", "//user@Host.Example.COM:80/FR-be", "http://de.wiki.org", "http://x.fr", None, "no address", "http://localhost/en"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [tuple(r) for r in df.select(*language.address(F.col("u")).values()).collect()]
    assert got == [("www.a.co.uk", "a.co.uk", "uk", "de"), ("host.example.com", "example.com", "com", "fr"), ("de.wiki.org", "wiki.org", "org", "de"), ("x.fr", "x.fr", "fr", "fr"), ("", "", "", ""), ("", "", "", ""), ("localhost", "localhost", "localhost", "en")]
    pages = ["<HTML class=x LANG = 'DE-at'>", "<html>", None, '<p lang="fr">', "<html lang=eng>"]
    said = spark.createDataFrame([(p,) for p in pages], "h string").select(language.declared(F.col("h"))).collect()
    assert [r[0] for r in said] == ["de", "", "", "", "en"]


def test_plain_text_of_any_page_in_one_scan():
    text = lambda x: b" ".join(language.plain(x).split()).decode()
    assert text(b"<p>a</p><SCRIPT x='<b>'>no</script >b<!-- <i> no -->c<style>no</style><nav>no<a>no</a></nav>d&amp;e<navy>f") == "a b c d e f"
    assert text(b"a < b") == "a b" and text(b"x<script>y") == "x y" and text(b"<!-- never closed <b>z</b>") == "z" and text(b"") == ""
    begun = time.time()
    for piece in (b"<script ", b"<!--", b"<nav>", b"<", b"<style>x</sty", b"&a", b"<html lang "):
        language.plain(piece * (1 << 17))
    assert time.time() - begun < 8


def test_without_labelled_documents(spark):
    docs, pages = tables(spark)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = language.identify(df, docs.limit(0), Scratch(spark, "t")).collect()
    assert len(out) == len(pages) and all(r.lang is None and r.probability is None for r in out)
    assert language.identify(df.limit(0), docs.limit(0), Scratch(spark, "t")).count() == 0
