"""The cascade against plain rule matching."""

import random

import pytest

from shoreline.llm import urlfilter

SCHEMA = "page_id long, url string, host string, rule int"
URLS = [
    None,
    "",
    "no scheme.com/en/",
    "http://",
    "http://EXAMPLE.com/en/x?y=/en/",
    "https://www.Example.com/en/#t",
    "https://a.www.example.com/en/",
    "https://example.com/EN/",
    "https://xexample.com/en/",
    "https://example.com",
    "https://example.com?/en/",
    "ftp://b.net/fr/1",
    "ftp://b.net/fr",
    "ftp://net/es/",
    "http://a..com/",
    "http://com:80/",
    "http://é.com/é/",
    "x://y.net/es/://z.com/",
    "http://h.org/" + "p" * 100_000,
    "http://" + "a." * 50_000 + "net/fr/",
]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best[3] if best else None, best[4] if best else "allow")


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_cases(spark, max_bytes):
    rng = random.Random(1)
    many = [(f"h{i}.org", f"/{'ab'[i % 2] * (i % 3)}", rng.choice(["allow", "block"])) for i in range(300)]
    urls = URLS + [f"http://x.h{i}.org/{rng.choice('ab') * rng.randint(0, 4)}" for i in range(1500)]
    pages = spark.createDataFrame([(i, u, "h", 7) for i, u in enumerate(urls)] + [(0, None, "h", 7)], SCHEMA)
    for given in (RULES, RULES + many):
        rules = spark.createDataFrame(given, "host string, path string, verdict string")
        found, names = urlfilter.judged(pages, rules, max_bytes=max_bytes)
        assert found.columns[:4] == pages.columns
        rows = sorted((r.page_id, r.host, r.rule, *(r[n] for n in names)) for r in found.collect())
        expected = sorted((i, "h", 7, *brute(u, given)) for i, u in enumerate(urls))
        assert sorted(map(str, rows)) == sorted(map(str, [*expected, (0, "h", 7, *brute(None, given))]))


def test_levels_are_exact(spark):
    keys = spark.range(2000).selectExpr("concat('k', id) AS key")
    universe = spark.range(50_000).selectExpr("concat('k', id) AS key")
    levels = urlfilter.cascade(keys, universe)
    assert len(levels) > 1
    import numpy as np

    rows = urlfilter._hashed(universe).toPandas()
    found = urlfilter.listed(levels, rows.h1.to_numpy(), rows.h2.to_numpy())
    assert set(rows.key[found]) == {f"k{i}" for i in range(2000)} and np.sum(found) == 2000


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    none = spark.createDataFrame([], SCHEMA)
    assert urlfilter.judged(none, rules)[0].collect() == []
    pages = spark.createDataFrame([(1, URLS[4], "h", 7)], SCHEMA)
    found, names = urlfilter.judged(pages, rules.limit(0))
    assert found.first()[names[2]] is None and found.first()[names[3]] == "allow"
