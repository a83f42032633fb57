"""License scans against a comparison of every block with every template."""

import random
import re

import numpy as np
import pytest

from shoreline.llm import common, licenses
from shoreline.llm.licenses import NOTICES, PHRASES, Template

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEMPLATES = PHRASES + NOTICES


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, templates):
    """Word count and per template label, places, first, last and containment."""
    w, found = words(text), []
    for t in templates:
        own = words(t.text)
        reach = 1
        while reach < len(own):
            reach *= 2
        if t.phrase:
            at, share = [s for s in range(len(w)) if w[s : s + len(own)] == own], 1.0
        else:
            shares = {}
            for k in range(-(-len(w) // reach)):
                n = len(set(own) & set(w[k * reach : (k + 2) * reach]))
                if n >= t.need:
                    shares[k * reach] = n / len(set(own))
            at, share = sorted(shares), max(shares.values(), default=0)
        if at:
            found.append((t.label, t.phrase, len(at), at[0], at[-1], share))
    return len(w), found


def scan(spark, texts, templates=TEMPLATES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows, n_words, matches = licenses.scanned(docs, templates)
    return {r.doc_id: (r[n_words], [tuple(m) for m in r[matches]]) for r in rows.collect()}


CASES = [
    None,
    "",
    " \t\n",
    "--- ,,,",
    "Released under the MIT License.",
    "under the mit license under the mit license\nunder THE mit license",
    "under the mit. License under-the-MIT-license",
    "CC BY-NC 4.0 cc, by, nc; cc by ncé cc by nc",
    "nc by cc",
    "Apache License, Version 2.0 and apache license version 2",
    "gnu general public license version 3",
    "version 3 of the License, GNU General one two Public",
    "General Public License version",
    *[t.text for t in TEMPLATES],
    *[" ".join(words(t.text)[::-1]) for t in NOTICES],
    *[" ".join(words(t.text)[: len(words(t.text)) * 3 // 4]) for t in NOTICES],
    *["filler " * 61 + t.text + " filler" * 7 + t.text for t in NOTICES],
]


def test_cases_equal_brute_force(spark):
    assert scan(spark, CASES) == {i: brute(text, TEMPLATES) for i, text in enumerate(CASES)}


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(4)
    pool = sorted({w for t in TEMPLATES for w in words(t.text)})[:40] + ["cc", "by", "nc", "mit", "under", "the", "license"]
    texts = [" ".join(rng.choices(pool, k=rng.randrange(400))) for _ in range(60)]
    own = (*PHRASES, Template("a", "the license of this software is under the file", 0.6), Template("b", "mit by cc", 0.5), Template("c", "the the the", 1.0))
    assert scan(spark, texts, own) == {i: brute(text, own) for i, text in enumerate(texts)}


def test_prefix_length_and_positional_filters_lose_nothing():
    rng = random.Random(5)
    own = tuple(Template(str(i), " ".join(rng.choices("abcdefghijkl", k=rng.randrange(1, 12))), rng.choice([0.4, 0.7, 1.0])) for i in range(40))
    counts = {w: rng.randrange(5) for w in sorted({w for t in own for w in t.words})}
    index = licenses.Index(own, counts)
    names = sorted(index.rank, key=index.rank.get)
    for _ in range(300):
        block = sorted(rng.sample(range(len(names)), rng.randrange(1, len(names) + 1)))
        for reach in index.postings:
            expected = {}
            for i, t in enumerate(own):
                shared = len(set(t.words) & {names[r] for r in block})
                if t.reach == reach and shared >= t.need:
                    expected[i] = shared
            assert dict(index.joined(np.array(block), reach)) == expected


def test_long_texts_are_taken_in_pieces(spark, monkeypatch):
    text = "é" * 50 + " gnu general public license version 3 " * 40 + "x" * 3000 + " under the mit license"
    whole = scan(spark, [text])
    monkeypatch.setattr(licenses, "SLICE_BYTES", 64)
    monkeypatch.setattr(common, "SLICE_BYTES", 64)
    assert scan(spark, [text, None, text])[2] == whole[0] == brute(text, TEMPLATES)


def test_rows_of_their_own_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "under the mit license", 5, "x"), (1, "under the mit license", 5, "x"), (None, None, None, None), (1, "cc by nc", 6, "y")],
        "doc_id bigint, text string, n_words int, matches string",
    )
    rows, n_words, matches = licenses.scanned(docs)
    assert rows.columns == ["doc_id", "n_words", "matches", n_words, matches]
    got = sorted((r.doc_id or 0, r.n_words or 0, r.matches or "", r[n_words], [m.label for m in r[matches]]) for r in rows.collect())
    assert got == [(0, 0, "", 0, []), (1, 5, "x", 4, ["mit"]), (1, 5, "x", 4, ["mit"]), (1, 6, "y", 3, ["cc-by-nc"])]


def test_empty_table(spark):
    rows, *_ = licenses.scanned(spark.createDataFrame([], "doc_id bigint, text string"))
    assert rows.count() == 0


def test_templates_without_words_and_too_many(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    for templates in ((), (Template("x", " - "),)):
        with pytest.raises(ValueError, match="needs words"):
            licenses.scanned(docs, templates)
    monkeypatch.setattr(licenses, "MAX_WORDS", 2)
    with pytest.raises(ValueError, match="are allowed"):
        licenses.scanned(docs, PHRASES)


def test_no_shuffle_of_documents(spark, tables):
    rows, *_ = licenses.scanned(tables("documents"))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
