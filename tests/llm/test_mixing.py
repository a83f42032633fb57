"""Rates against brute force, shares against targets, and held-out accuracy of the domains."""

import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shoreline.llm import mixing
from shoreline.llm.queries import DOMAIN, DOMAIN_SHARES, op1_mixing

SCHEMA = "doc_id long, text string, rate string, n_tokens int, tag int"
LABELS = "doc_id long, quality int, toxic int"


def bucket(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return (value - (1 << 64) if value >> 63 else value) % mixing.BUCKETS


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(mixing.BLANK, lowered) if w]


def brute(rows, labels, shares):
    """Probabilities, by dictionaries."""
    domains = list(shares)
    of = {}
    for doc_id, quality, toxic in labels:
        d = "toxic" if toxic == 1 else "poor" if quality == 0 else "good" if quality == 1 else None
        if doc_id is not None and d:
            of[doc_id] = max(of.get(doc_id, d), d)
    counts, totals = Counter(), Counter()
    for doc_id, text in rows:
        if doc_id in of:
            for w in words(text):
                for kind, feature in ((0, w), (1, w[-2:])):
                    counts[kind, bucket(feature), of[doc_id]] += 1
                    totals[kind, of[doc_id]] += 1
    prior = Counter(of.values())
    known = {(k, b) for k, b, _ in counts}
    p, n = [], []
    for _, text in rows:
        ws = words(text)
        logits = []
        for d in domains:
            total = 0.0
            for w in ws:
                for kind, feature in ((0, w), (1, w[-2:])):
                    b = bucket(feature)
                    if (kind, b) in known:
                        total += math.log((counts[kind, b, d] + 0.5) / (totals[kind, d] + 0.5 * mixing.BUCKETS))
            logits.append(min(len(ws), mixing.EVIDENCE) / max(len(ws), 1) * total + math.log((prior[d] + 1) / (len(of) + len(domains))))
        e = np.exp(np.array(logits) - max(logits))
        p.append(e / e.sum())
        n.append(len(ws))
    return [(doc_id, int(k), *q) for (doc_id, _), k, q in zip(rows, n, p)]


def non_negative(a, b):
    """The least squares solution of 0 or more by active sets (Lawson and Hanson)."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(10 * a.shape[1]):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        if free.all() or slope.max() <= 1e-11 * np.abs(a.T @ b).max():
            break
        free[slope.argmax()] = True
        while True:
            inner = np.zeros_like(x)
            inner[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (inner <= 0)
            if not low.any():
                break
            x = x + (x[low] / (x[low] - inner[low])).min() * (inner - x)
            free &= x > 1e-13
            x[~free] = 0
        x = inner
    return x


def best_tokens(p, n, shares):
    """The domains' shares of tokens nearest to the targets, by a solver that shares nothing with ``mixing``."""
    weighted = (p * n[:, None]).T / n.sum()
    return weighted @ non_negative(weighted, np.array(shares) / sum(shares))


@pytest.mark.parametrize("shares", [DOMAIN_SHARES, {"good": 1, "toxic": 9, "poor": 0}, {"good": 1}])
def test_cases(spark, shares):
    texts = [None, "", " \n", "nice words " * 50, "bad!!! worse!!!", "vile idiot", "É ü " * 10, "x" * 100_000] + [f"nice text {i}" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "nice text"), (3, "another text"), (4, "bad!!! worse!!!"), (4, "bad!!! worse!!!")]
    labels = [(3, 1, 0), (4, 0, 0), (5, 1, 1), (6, 1, 0), (6, 1, 0), (7, None, None), (None, 1, 1), (99, 1, 1)] + [(10 + i, 1, i % 2) for i in range(9)]
    docs = spark.createDataFrame([(i, t, "r", 1, 2) for i, t in rows], SCHEMA)
    found, names = mixing.mixed(docs, spark.createDataFrame(labels, LABELS), shares, F.expr(DOMAIN))
    assert found.columns[:5] == docs.columns and len(set(found.columns)) == len(found.columns)
    got = [tuple(r) for r in found.select("doc_id", *names.values()).collect()]
    expected = brute(rows, [x for x in labels], shares)
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    assert np.allclose([r[2:-1] for r in got], [r[2:] for r in expected], atol=1e-6)
    p, n, rate = np.array([r[2:-1] for r in got]), np.array([r[1] for r in got], float), np.array([r[-1] for r in got])
    assert (rate >= 0).all()
    assert np.allclose((n * rate) @ p / n.sum(), best_tokens(p, n, list(shares.values())), atol=1e-4)


SHARES = [[0.5, 0.3, 0.2], [0.8, 0.1, 0.1], [0.1, 0.9, 0], [1, 0, 0], [0.999, 0.0005, 0.0005], [0, 0, 7]]


@pytest.mark.parametrize("spread", [1, 5])
def test_optimum(spark, spread):
    """Tokens against the independent solver, also for targets that no rates meet; least change where they are met."""
    random = np.random.default_rng(spread)
    p = np.exp(random.normal(size=(300, 3)) * spread)
    p /= p.sum(axis=1, keepdims=True)
    n = random.integers(0, 500, 300).astype(float)
    rows = spark.createDataFrame([(int(k), *map(float, q)) for k, q in zip(n, p)], "n_tokens int, p_0 double, p_1 double, p_2 double").cache()
    for shares in SHARES:
        fit = mixing.fitted(rows, shares)
        rate = np.array([r.rate for r in rows.select(fit.rate.alias("rate")).collect()])
        tokens, target = (n * rate) @ p / n.sum(), np.array(shares) / sum(shares)
        assert fit.residual <= mixing.TOLERANCE and fit.looks < mixing.MAX_LOOKS
        assert (rate >= 0).all() and np.allclose(tokens - target, fit.gaps, atol=1e-7)
        best = best_tokens(p, n, shares)
        # The pull towards rate 1 costs no more than it could gain at the best rates.
        assert np.linalg.norm(tokens - target) <= np.linalg.norm(best - target) + 1e-4
        if np.linalg.norm(best - target) < 1e-9:
            assert np.abs(tokens - target).max() < 1e-5
            # Any other way to the same tokens moves the rates further from 1.
            live = (n > 0) & (rate > 0)
            shift = random.normal(size=300) * live
            weighted = (p * n[:, None])[live]
            shift[live] -= p[live] @ np.linalg.lstsq(weighted.T @ p[live], weighted.T @ shift[live], rcond=None)[0]
            other = rate + shift * 1e-3
            assert np.allclose((n * other) @ p, (n * rate) @ p, atol=1e-6 * n.sum())
            assert (n * (other - 1) ** 2).sum() > (n * (rate - 1) ** 2).sum()


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([(1, "a b", "r", 1, 2)], SCHEMA), spark.createDataFrame([(1, 1, 0)], LABELS)
    assert mixing.mixed(docs.limit(0), labels, DOMAIN_SHARES, F.expr(DOMAIN))[0].collect() == []
    assert mixing.mixed(docs, labels.limit(0), DOMAIN_SHARES, F.expr(DOMAIN))[0].count() == 1


def test_targets_and_accuracy(spark, tables):
    sf_dir = "/root/testdata/sf0.1"
    rows = op1_mixing(spark, sf_dir).toPandas()
    assert len(rows) == tables("documents", sf_dir).count()
    tokens = np.array([(rows.n_tokens * rows.rate * rows[f"p_{d}"]).sum() for d in DOMAIN_SHARES])
    assert np.allclose(tokens / rows.n_tokens.sum(), list(DOMAIN_SHARES.values()), atol=1e-6) and (rows.rate >= 0).all()
    docs, labels = tables("documents", sf_dir).select("doc_id", "text"), tables("labels", sf_dir)
    known = labels.where("doc_id % 4 <> 0")
    held = labels.where("doc_id % 4 = 0").select(F.col("doc_id").alias("held"), F.expr(DOMAIN).alias("domain"))
    p = mixing.posteriors(docs, known, list(DOMAIN_SHARES), F.expr(DOMAIN))
    judged = p.join(held, p.doc_id == held.held).toPandas()
    best = judged[["p_0", "p_1", "p_2"]].to_numpy().argmax(axis=1)
    assert np.mean([list(DOMAIN_SHARES)[i] == d for i, d in zip(best, judged.domain)]) > 0.85
