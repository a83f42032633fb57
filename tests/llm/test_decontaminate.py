"""Decontamination on small cases against brute force."""

import re

import pytest

from shoreline.llm import decontaminate

DOCS = "doc_id long, text string, lang string, source string, n_chars long, item_id long, words string"
ITEMS = "item_id long, text string, words string, length int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items):
    rows = []
    for doc_id, text in docs:
        doc, hit, ids = words(text), set(), set()
        for item_id, item_text in items:
            item = words(item_text)
            size = min(10, len(item))
            wanted = {tuple(item[i : i + size]) for i in range(len(item) - size + 1)} if size else set()
            starts = [i for i in range(len(doc) - size + 1) if tuple(doc[i : i + size]) in wanted] if size else []
            hit |= {p for s in starts for p in range(s, s + size)}
            if starts and item_id is not None:
                ids.add(str(item_id))
        rows.append((doc_id, len(doc), len(hit), sorted(ids)))
    return sorted(rows, key=str)


ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen"
CASES = [
    (1, None),
    (1, ""),
    (2, "prefix " + ITEM.upper() + " suffix"),
    (3, "two three, four five six seven eight nine ten; eleven"),
    (4, "two three four five six seven eight nine ten"),
    (5, "same " * 40),
    (5, "same " * 40),
    (5, "unlike"),
    (None, "x " + ITEM),
    (6, "É" + ITEM),
    (7, "short item here and Short ITEM again"),
    (8, "w " * 60_000 + ITEM + " w" * 10),
    (9, "\x00a\x01b\U0001f600c é́ ü"),
    (10, ("a b " * 30)),
]
BENCH = [
    (1, ITEM),
    (1, ITEM),
    (20, "same " * 12),
    (3, "short item"),
    (4, None),
    (5, ""),
    (None, "unlike"),
    (6, "b\U0001f600c"),
    (7, "a b a b a b a b a b a"),
]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_cases(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", limit)
    docs = spark.createDataFrame([(d, t, "en", "s", 0, 1, "w") for d, t in CASES], DOCS)
    items = spark.createDataFrame([(i, t, "w", 1) for i, t in BENCH], ITEMS)
    found = decontaminate.contamination(docs, items).select("doc_id", "n_words", "n_hit", "item_ids").collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str) == brute(CASES, BENCH)
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, t in CASES if not gone(t, BENCH)), key=str)


def test_items_of_every_length_in_one_reading(spark, monkeypatch):
    """Items of 1 to 12 words; the five words of one are also a gram of longer windows."""
    names = ITEM.lower().split()
    items = [(n, " ".join(names[:n])) for n in range(1, 13)] + [(50, " ".join(names[4:9])), (51, "nowhere at all")]
    texts = [" ".join(names[a:b]) for a in range(0, 12, 3) for b in range(a + 1, 14, 2)]
    docs = list(enumerate([*texts, "", None, "thirteen " + ITEM + " and one", "one two one two three"]))
    tables = spark.createDataFrame([(d, t, "en", "s", 0, 1, "w") for d, t in docs], DOCS), spark.createDataFrame([(i, t, "w", 1) for i, t in items], ITEMS)
    passes = []
    seeded = decontaminate._seeded
    monkeypatch.setattr(decontaminate, "_seeded", lambda *given: passes.append(given[1]) or seeded(*given))
    found = decontaminate.contamination(*tables).select("doc_id", "n_words", "n_hit", "item_ids").collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=str) == brute(docs, items)
    assert passes == [list(range(1, 11))]


def gone(text, bench):
    """A whole window of ten words occurs, or half of the words are hit."""
    _, n_words, n_hit, _ = brute([(0, text)], bench)[0]
    long = [(i, t) for i, t in bench if len(words(t)) >= 10]
    return brute([(0, text)], long)[0][2] > 0 or (n_hit > 0 and 2 * n_hit >= n_words)


def test_an_item_of_one_word_removes_no_corpus(spark):
    texts = ["yes we can do this today", "no and yes", "yes", "yes yes no", "", None, "say yes " + ITEM]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 1, "w") for i, t in enumerate(texts)], DOCS)
    items = spark.createDataFrame([(1, "Yes.", "w", 1), (2, ITEM, "w", 1)], ITEMS)
    assert sorted(r.doc_id for r in decontaminate.clean_documents(docs, items).collect()) == [0, 1, 4, 5]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some_docs = spark.createDataFrame([(1, ITEM, "en", "s", 0, 1, "w")], DOCS)
    some_items = spark.createDataFrame([(1, ITEM, "w", 1)], ITEMS)
    assert decontaminate.contamination(docs, some_items).collect() == []
    assert decontaminate.contamination(some_docs, items).first().n_hit == 0
    assert decontaminate.contamination(docs, items).collect() == []
