"""Ledgers of offset ranges against sets of offsets."""

import random

import pytest

from shoreline.operators.offsets import coverage, gaps, islands, not_landed, starting_positions

LEDGER = "topic string, partition int, from_offset bigint, until_offset bigint"


def ledger(spark, rows):
    return spark.createDataFrame(rows, LEDGER)


def runs(offsets):
    """Unbroken ranges of a set of numbers."""
    found = []
    for n in sorted(offsets):
        if found and found[-1][1] == n:
            found[-1][1] = n + 1
        else:
            found.append([n, n + 1])
    return [tuple(r) for r in found]


def test_a_hole_is_where_reading_goes_on(spark):
    """0 to 4 and 9 to 11 landed: 5 to 8 never did."""
    rows = ledger(spark, [("t", 0, 0, 5), ("t", 0, 9, 12)])
    known = spark.createDataFrame([("t", 0), ("t", 1)], "topic string, partition int")
    assert sorted(tuple(r) for r in starting_positions(rows, known).collect()) == [("t", 0, 5), ("t", 1, 0)]
    assert [tuple(r) for r in gaps(rows).collect()] == [("t", 0, 5, 9)]
    records = spark.createDataFrame([("t", 0, n) for n in range(14)] + [("t", 1, 3)], "topic string, partition int, offset bigint")
    left = sorted(tuple(r) for r in not_landed(records, rows).collect())
    assert left == [("t", 0, 5), ("t", 0, 6), ("t", 0, 7), ("t", 0, 8), ("t", 0, 12), ("t", 0, 13), ("t", 1, 3)]


@pytest.mark.parametrize("seed", range(4))
def test_random_ranges_equal_sets_of_offsets(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(60):
        start = rng.randrange(300)
        rows.append((rng.choice("ab"), rng.randrange(2), start, start + rng.choice([0, 1, 2, 5, 20, -3])))
    rows += rows[:5]
    expected_islands, expected_gaps, expected_times = [], [], []
    for key in sorted({r[:2] for r in rows}):
        times = {}
        for *_, begin, end in [r for r in rows if r[:2] == key]:
            for n in range(begin, end):
                times[n] = times.get(n, 0) + 1
        whole = runs(times)
        for begin, end in whole:
            expected_islands.append((*key, begin, end, sum(times[n] > 1 for n in range(begin, end))))
        expected_gaps += [(*key, a[1], b[0]) for a, b in zip(whole, whole[1:])]
        expected_times += [(*key, n, t) for n, t in times.items()]
    found = ledger(spark, rows)
    assert sorted(tuple(r) for r in islands(found).collect()) == sorted(expected_islands)
    assert sorted(tuple(r) for r in gaps(found).collect()) == sorted(expected_gaps)
    spread = [(r.topic, r.partition, n, r.times) for r in coverage(found).collect() for n in range(r.from_offset, r.until_offset) if r.times]
    assert sorted(spread) == sorted(expected_times)


def test_an_empty_ledger(spark):
    empty = ledger(spark, [])
    known = spark.createDataFrame([("t", 0)], "topic string, partition int")
    assert [tuple(r) for r in starting_positions(empty, known).collect()] == [("t", 0, 0)]
    assert islands(empty).count() == gaps(empty).count() == 0
