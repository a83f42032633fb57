"""SimHash fingerprints and components against brute force."""

import random

import xxhash

from shoreline.llm import simhash
from shoreline.llm.queries import op3_simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    """Smallest id reachable for every row, by repeated passes over all pairs of fingerprints."""
    fps = sorted({fp for _, fp in rows})
    label = {fp: fp for fp in fps}
    near = {fp: [o for o in fps if (fp ^ o).bit_count() <= radius] for fp in fps}
    changed = True
    while changed:
        changed = False
        for fp in fps:
            least = min(label[o] for o in near[fp])
            changed |= least < label[fp]
            label[fp] = least
    first = {}
    for doc_id, fp in rows:
        if doc_id is not None:
            first[label[fp]] = min(first.get(label[fp], doc_id), doc_id)
    return sorted(((d, f"{fp:016x}", first.get(label[fp])) for d, fp in rows), key=str)


def check(docs, result):
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    assert sorted(map(tuple, result.collect()), key=str) == brute_components(rows)


def test_query_equals_brute_force(spark, tables):
    check(tables("documents", "/root/testdata/sf0.01"), op3_simhash(spark, "/root/testdata/sf0.01"))


def test_edge_cases(spark):
    near = " ".join(f"word{i}" for i in range(400))
    rows = [
        (5, None, "en", "a", 0),
        (4, "", "en", "a", 0),
        (9, " \t\n\x0b\x0c\r", None, None, None),
        (None, "one two", "en", "a", 0),
        (7, "ONE two", "en", "a", 0),
        (7, "ONE two", "en", "a", 0),
        (3, "É one", "en", "a", 0),
        (2, "é one", "en", "a", 0),
        (1, near, "en", "a", 0),
        (6, near + " more", "en", "a", 0),
        (8, "x" * 200_000 + " " + near, "en", "a", 0),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = simhash.near_duplicates(docs.withColumn("fp", docs.doc_id).withColumn("component_id", docs.lang))
    check(docs, found.select("doc_id", simhash.fingerprint_text(found.fp), "component_id"))
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    leading = {c for d, _, c in brute_components([(r[0], brute_fingerprint(r[1])) for r in rows])}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(leading - {None})


def test_leader_without_text(spark):
    """A null text can lead, and its row keeps its other columns."""
    rows = [(4, None, "en", "a", 0), (5, "", "de", "b", 0), (6, None, "de", "b", 0)]
    assert [tuple(r) for r in simhash.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()] == rows[:1]


def test_one_id_with_unrelated_texts(spark):
    """Both texts of the id stay; the near copy of an earlier document goes, whatever its id holds else."""
    words = [f"word{i}" for i in range(400)]
    first, copy, other, third = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words)), " ".join(words[::2])
    rows = [(1, first, "en", "a", 0), (2, copy, "en", "a", 0), (2, other, "en", "a", 0), (2, third, "en", "a", 0), (2, other, "en", "a", 0)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, first), (2, other), (2, third)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []


def test_shards_hold_every_link():
    """Links inside one shard connect exactly what comparing all pairs connects."""
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(200)}
    while len(values) < 500:
        x = centre
        for _ in range(rng.randint(1, 9)):
            x ^= 1 << rng.randrange(64)
        values.add(x)
    values = sorted(values)
    expected = brute_components([(v, v) for v in values])
    label = {v: v for v in values}
    found = simhash.shard_links(values, 4)
    for _ in range(len(values)):
        for a, b in found:
            label[a] = label[b] = min(label[a], label[b])
    assert sorted(((v, f"{v:016x}", label[v]) for v in values), key=str) == expected


def test_hot_shards_are_split(spark):
    """Many near copies that share their shards, with chunks far below their number."""
    rng = random.Random(5)
    centre = rng.getrandbits(63)
    values = sorted({centre ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(400)})
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    rows = simhash.split_hot(simhash.shard_rows(fps, len(values), 4), limit=50)
    largest = rows.groupBy("shard").count().agg({"count": "max"}).first()[0]
    assert largest < 200
    found = {tuple(r) for r in rows.mapInArrow(simhash._link_batches(4), "a long, b long").collect()}
    whole = simhash.components(simhash.links(fps, len(values), 4)).collect()
    assert {r.root for r in whole} == {min(values)} and len(whole) == len(values) - 1
    assert found


def test_block_plan_covers_the_radius():
    for n in (10, 10**6, 10**8, 10**10):
        blocks, choices = simhash.block_plan(n, 4)
        assert blocks >= 5 and all(len(c) == blocks - 4 for c in choices)
