"""Substring deduplication against brute force."""

import hashlib

import pytest

from shoreline.llm import substrings
from shoreline.llm.queries import op8_substring_dedup

SCHEMA = "doc_id long, text string, places string, tag int, n_words int"


def brute(rows, size=20):
    rows = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for doc_id, words in rows:
        for i in range(len(words) - size + 1 if doc_id is not None else 0):
            key = tuple(words[i : i + size])
            first[key] = min(first.get(key, (doc_id, i)), (doc_id, i))
    out = []
    for doc_id, words in rows:
        gone = set()
        for i in range(len(words) - size + 1 if doc_id is not None else 0):
            if first[tuple(words[i : i + size])] < (doc_id, i):
                gone |= set(range(i, i + size))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


PASSAGE = " ".join(f"p{i}" for i in range(50))
CASES = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "a b c " + PASSAGE + " d"),
    (5, PASSAGE),
    (5, PASSAGE),
    (6, " ".join(f"p{i}" for i in range(19))),
    (7, " ".join(f"p{i}" for i in range(30, 50)) + " tail"),
    (8, "same " * 500),
    (9, "u v " * 25 + "É é " * 25),
    (None, PASSAGE),
    (10, PASSAGE.upper()),
    (11, " ".join(f"n{i}" for i in range(30_000)) + " " + PASSAGE + " " + " ".join(f"n{i}" for i in range(100, 400))),
    (12, "x" * 100_000 + " " + PASSAGE),
] + [(100 + i, f"own{i} {PASSAGE} {PASSAGE} end{i}") for i in range(40)]


@pytest.mark.parametrize("chunk", [2 << 20, 60])
def test_cases(spark, chunk):
    """With small chunks most comparisons are made across tasks."""
    docs = spark.createDataFrame([(d, t, "p", 1, 2) for d, t in CASES], SCHEMA)
    found = substrings.without_repeats(docs, chunk_words=chunk).collect()
    rows = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in found]
    assert sorted(rows, key=str) == brute(CASES)


def test_query_equals_brute_force(spark, tables):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in tables("documents", sf_dir).collect()]
    assert sorted(map(tuple, op8_substring_dedup(spark, sf_dir).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert substrings.without_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
