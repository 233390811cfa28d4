"""URL verdicts against a plain version; no Python worker on the main path."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casecurve.llm import url_filter as u
from casecurve.llm.queries import QUERIES, UNWANTED_HOST, URL_RULES

SCHEMA = "page_id long, url string"


def parts_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host = rest[: ends[0]] if ends else rest
    host = "".join(c.lower() if c.isascii() else c for c in host)
    tail = rest[len(host) :]
    stops = [i for i, c in enumerate(tail) if c in "?#"]
    path = tail[: stops[0]] if stops else tail
    before = url.split("#", 1)[0]
    query = before.split("?", 1)[1] if "?" in before else ""
    origin = ("ref", "fbclid", "gclid")
    kept = sorted(x for x in query.split("&") if x and not (x.startswith("utm_") or x in origin or x.startswith(tuple(o + "=" for o in origin))))
    site = host.removeprefix("www.") if host.startswith("www.") else host.removeprefix("m.")
    return host, path, site + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def judged_by_hand(rows, listed):
    known = {parts_by_hand(x)[2] for x in listed} - {None}
    out = Counter()
    for page, url in rows:
        host, path, canonical = parts_by_hand(url)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        verdict = best.verdict if best else "block" if canonical in known else "allow"
        out[page, host, path, best and best.name, verdict] += 1
    return out


def odd_urls(seed=2, n=600):
    rng = random.Random(seed)
    hosts = ["example.org", "a.Example.ORG", "xexample.org", "org", "x.com", "com", "m.ads-track.example.net", "WWW.ads-track.example.net", "b.net", "Ünder.net", "www.b.net", ""]
    paths = ["", "/", "//", "/es/", "/es", "/en/1", "/en/12/", "/fr/x", "/de/", "/de/7.html", "/a\nb/", "/q://z"]
    tails = ["", "#top", "?utm_source=feed", "?page=2&ref=x", "?b=2&a=1", "?a=1&b=2", "?ref", "?reference=1", "#x?y=1", "?a=1#b", "?&&"]
    rows = [(i, f"{rng.choice(['http', 'https', 'x y'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}") for i in range(n)]
    rows += [(None, "http://b.net/x"), (1, None), (2, ""), (3, "no scheme/es/"), (4, "://"), (5, "http://b.net/" + "y" * 200000), (6, "a://b://c.net/d")]
    rows += [(7000 + i, "http://hot.b.net/same?b=1") for i in range(400)]
    return rows + rows[:3]


@pytest.mark.parametrize("blocks", [1, 2, 1 << 16])
def test_verdicts(spark, blocks):
    rows = odd_urls()
    listed = [x for _, x in rows[::7]] + ["https://www.hot.b.net/same/?b=1#z"]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "'x' AS id", "'y' AS host", "1 AS block", "2 AS canonical", "3 AS maybe")
    got = u.judged(pages, URL_RULES, spark.createDataFrame([(x,) for x in listed], "url string"), most_blocks=blocks)
    assert Counter(map(tuple, got.collect())) == judged_by_hand(rows, listed)


def test_registered_query(spark, tmp_path):
    rows = odd_urls(9)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op13_url_filter"](spark, str(tmp_path))
    listed = [x for _, x in rows if "ads-track" in parts_by_hand(x)[0]]
    assert listed and UNWANTED_HOST
    assert Counter(map(tuple, got.collect())) == judged_by_hand(rows, listed)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "http://b.net/x")], SCHEMA)
    assert u.judged(none, URL_RULES, some).collect() == []
    assert [tuple(r) for r in u.judged(some, URL_RULES, none).collect()] == [(1, "b.net", "/x", None, "allow")]


def test_filter_never_loses_a_key_and_passes_few_others(spark):
    keys = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 1 << (20000 * u.BITS_PER_URL // 512).bit_length()
    filled = u.bloom_blocks(keys, "key", blocks)
    assert u.possible(keys, "key", filled, blocks).filter("NOT maybe").count() == 0
    others = spark.range(20000).select(F.concat(F.lit("o"), "id").alias("key"))
    assert u.possible(others, "key", filled, blocks).filter("maybe").count() < 400


def test_no_python_worker(spark, small):
    plan = QUERIES["op13_url_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Scan ExistingRDD"))
