"""Held-out accuracy of the toxicity scores, brute force, and edge cases."""

import math
import zlib

import numpy as np
import pytest
import xxhash

from shoreline.llm import toxicity
from shoreline.llm.queries import op2_toxicity

DOCS = "doc_id long, text string, score string, label int, rank int"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, tables):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in tables("labels", sf_dir).collect()}
    rows = op2_toxicity(spark, sf_dir).collect()
    assert len(rows) == tables("documents", sf_dir).count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert np.mean([p for p, y in held if y == 1]) > 0.7


def test_edge_cases(spark):
    texts = [None, "", " \n", "awful", "x" * 200_000, "Ä ö " * 50_000]
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in enumerate(texts)] + [(None, "awful", "s", 1, 2), (3, "awful", "s", 1, 2)], DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(6)] + [(3, 1, None), (None, 1, 1), (3, 1, 0), (77, 1, 1)], LABELS)
    for given in (labels, labels.where("toxic = 1"), labels.limit(0)):
        model = toxicity.fit(docs, given)
        rows = toxicity.scored(docs, model, "_score").collect()
        assert len(rows) == docs.count() and rows[0].score == "s"
        by_text = {}
        for r in rows:
            by_text.setdefault((r.text or "").strip(), set()).add(r._score)
            assert 0 <= r._score <= 1
        assert all(len(v) == 1 for v in by_text.values())
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []


def test_over_long_labelled_text(spark, monkeypatch):
    """A text above the bound is passed over, wherever it comes in the order, and uses nothing up."""
    monkeypatch.setattr(toxicity, "MAX_BYTES", 1000)
    texts = {i: "awful words" if i % 2 else "fine words" for i in range(1, 60)}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in texts], LABELS)
    plain = {r.doc_id for r in toxicity.sampled_labels(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), labels).collect()}
    first = min(plain, key=lambda i: spark.sql(f"SELECT xxhash64({i}L)").first()[0])
    docs = spark.createDataFrame([(i, "x" * 2000 if i == first else t) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in toxicity.sampled_labels(docs, labels).collect()} == plain - {first}


def test_features_do_not_cross_documents():
    words = np.arange(1, 7, dtype=np.uint64) << np.uint64(50)
    joined, row = toxicity.occurrences(words, np.array([2, 0, 3, 1]))
    apart = [toxicity.occurrences(words[a:b], np.array([b - a]))[0] for a, b in ((0, 2), (2, 2), (2, 5), (5, 6))]
    assert [sorted(joined[row == i]) for i in range(4)] == [sorted(a) for a in apart]


U64 = (1 << 64) - 1


def scramble(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & U64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & U64
    return x ^ x >> 31


def features(text):
    """Buckets of a text's words, pairs and skip-pairs, one word after the other."""
    plain = "".join(c.lower() if "A" <= c <= "Z" else c if ord(c) > 127 or c.isalnum() else " " for c in text or "")
    hashes = [xxhash.xxh64_intdigest(w.encode()) for w in plain.split(" ") if w]
    found = set(hashes)
    found |= {scramble((a * 3 + b) & U64) for a, b in zip(hashes, hashes[1:])}
    found |= {scramble((a * 5 + b + 11) & U64) for a, b in zip(hashes, hashes[2:])}
    return {h >> 64 - toxicity.FEATURE_BITS for h in found}


def sigmoid(x):
    return 1 / (1 + math.exp(-min(max(x, -30), 30)))


def learned(rows):
    """FTRL-proximal over dictionaries, a coordinate at a time: weights that are not 0, and the offset."""
    z, n, offset, offset_n = {}, {}, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2
        return (math.copysign(toxicity.L1, z[i]) - z[i]) / rate

    order = np.random.default_rng(1)
    for _ in range(toxicity.EPOCHS):
        for at in order.permutation(len(rows)):
            own, y = rows[at]
            weights = {i: weight(i) for i in own}
            g = sigmoid(math.fsum(weights.values()) + offset) - y
            for i, w in weights.items():
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / toxicity.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w, before + g * g
            offset_n += g * g
            offset -= toxicity.ALPHA * g / (toxicity.BETA + math.sqrt(offset_n))
    return {i: weight(i) for i in z if weight(i)}, offset


def test_against_brute_force(spark, tables):
    """Weights, calibration and every score, from texts to numbers without a line of the operator."""
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in tables("documents", sf_dir).collect()}
    toxic = {r.doc_id: r.toxic for r in tables("labels", sf_dir).collect() if r.toxic is not None}
    usable = [i for i in toxic if i in texts and zlib.crc32(str(i).encode()) % 5]
    ranks = spark.createDataFrame([(i,) for i in usable], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) AS rank").collect()
    ordered = [r.doc_id for r in sorted(ranks, key=lambda r: (r.rank, r.doc_id))]
    assert 100 < len(ordered) <= toxicity.MAX_LABELLED
    held = [i for i in ordered if zlib.crc32(str(i).encode()) % 10 in toxicity.CALIBRATION_PARTS]
    weights, offset = learned([(features(texts[i]), toxic[i]) for i in ordered if i not in set(held)])
    model = toxicity.fit(tables("documents", sf_dir), tables("labels", sf_dir))
    assert 0 < len(weights) < 1 << 16
    assert dict(zip(model.index.tolist(), model.weight.tolist())) == pytest.approx(weights, abs=1e-9)
    margin = {i: math.fsum(weights.get(f, 0.0) for f in features(t)) for i, t in texts.items()}
    # Slope and shift are where the logistic loss of the part held back, with its ridge, is flat.
    shift = model.offset - model.slope * offset
    miss = [(sigmoid(model.slope * margin[i] + model.offset) - toxic[i], margin[i] + offset) for i in held]
    assert abs(math.fsum(e * m for e, m in miss) + 0.1 * (model.slope - 1)) < 1e-6
    assert abs(math.fsum(e for e, _ in miss) + 0.1 * shift) < 1e-6
    scores = {r.doc_id: r.score for r in op2_toxicity(spark, sf_dir).collect()}
    assert scores == pytest.approx({i: sigmoid(model.slope * m + model.offset) for i, m in margin.items()}, abs=1e-9)
