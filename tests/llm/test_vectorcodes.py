"""Vector codes against a comparison of every part with every entry."""

import hashlib
import random

import numpy as np
import pytest

from shoreline.llm import vectorcodes
from shoreline.llm.vectorcodes import PARTS, ROUNDS, coded, fit, nearest, staged_integers, with_group_sums


def brute(rows, entries):
    """Code and error of each (id, integers), and the codebooks, by plain loops."""
    def closest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), number) for number, entry in enumerate(book))

    size = len(rows[0][1]) // PARTS if rows else 0
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[list(v[p * size : (p + 1) * size]) for _, v in ordered[:entries]] for p in range(PARTS)]
    for _ in range(ROUNDS):
        for p, book in enumerate(books):
            members = {}
            for _, v in rows:
                part = v[p * size : (p + 1) * size]
                members.setdefault(closest(part, book)[1], []).append(part)
            for number, parts in members.items():
                book[number] = [sum(column) // len(parts) for column in zip(*parts)]
    result = []
    for key, v in rows:
        found = [closest(v[p * size : (p + 1) * size], book) for p, book in enumerate(books)]
        result.append((key, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found)))
    return result, books


def run(spark, rows, schema="vec_id bigint, embedding array<double>"):
    staged = staged_integers(spark.createDataFrame(rows, schema).repartition(3))
    books = fit(staged)
    found, code, error = coded(staged, books)
    return [(r.vec_id, r[code], r[error]) for r in found.collect()], books


@pytest.mark.parametrize("spread", [1, 6, 1000])
@pytest.mark.parametrize("dimension", [1, 3, 16])
def test_search_equals_all_comparisons(spread, dimension):
    rng = np.random.default_rng(spread + dimension)
    for entries in (1, 2, 40):
        book = rng.integers(-spread, spread + 1, (entries, dimension))
        parts = np.concatenate((rng.integers(-2 * spread, 2 * spread + 1, (200, dimension)), book))
        every = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        number, distance = nearest(parts, book)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_search_at_the_limit():
    top = vectorcodes.LIMIT // 64 - 1
    book = np.array([[top] * 16, [-top] * 16])
    number, distance = nearest(np.array([[top] * 16, [-top] * 16, [-top] * 15 + [top]]), book)
    assert number.tolist() == [0, 1, 1] and distance.tolist() == [0, 0, (2 * top) ** 2]


@pytest.mark.parametrize("count", [1, 5, 60])
def test_codes_equal_brute_force(spark, monkeypatch, count):
    monkeypatch.setattr(vectorcodes, "ENTRIES", 8)
    rng = random.Random(count)
    rows = [(rng.choice([None, *range(count)]), [rng.randrange(-40, 40) / 64 for _ in range(8)]) for _ in range(count)]
    rows += rows[: count // 4]
    expected, books = brute([(i, [int(1024 * x // 1) for x in v]) for i, v in rows], 8)
    found, fitted = run(spark, rows)
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert fitted.entries.tolist() == books
    joined = ",".join(str(x) for book in books for entry in book for x in entry)
    assert fitted.digest() == hashlib.sha256(joined.encode()).hexdigest()


def test_ties_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "ENTRIES", 4)
    rows = [(i, [0.5, -0.5, 0.25, 0.0]) for i in range(9)] + [(9, [-0.5, 0.5, 0.25, 1.0])]
    expected, books = brute([(i, [int(1024 * x // 1) for x in v]) for i, v in rows], 4)
    found, fitted = run(spark, rows)
    assert sorted(found) == sorted(expected) and fitted.entries.tolist() == books


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 8, 0.0, 1.0, -1.0]) for i in range(6)]
    gone = [(10, None), (11, [1.0, None, 0.0, 0.0]), (12, [nan, 0.0, 0.0, 0.0]), (13, [0.0, -inf, 0.0, 0.0])]
    uncoded = [(20, []), (21, [1.0]), (22, [0.0] * 8), (23, [1e300, 0.0, 0.0, 0.0]), (24, [0.0, -1e9, 0.0, 0.0])]
    found, books = run(spark, good + gone + uncoded)
    alone, same = run(spark, good)
    assert sorted(found) == sorted(alone + [(i, None, None) for i, _ in uncoded])
    assert (books.entries == same.entries).all()


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [0.0, 1.0])]])
def test_nothing_to_code(spark, rows):
    found, books = run(spark, rows)
    assert sorted(found) == [(i, None, None) for i, v in rows if v is not None]
    assert books.digest() == hashlib.sha256(b"").hexdigest()


def test_clashing_columns_go_through(spark):
    rows = [(1, [1.0] * 4, "a", 5, 6, 7), (2, [0.0] * 4, None, 5, 6, 7)]
    staged = staged_integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, code string, error int, ints int, length int"))
    found, code, error = coded(staged, fit(staged))
    assert found.columns == ["vec_id", "embedding", "code", "error", "ints", "length", code, error]
    assert sorted((r.vec_id, r.code, r[code], r[error]) for r in found.collect()) == [(1, "a", "00000000", 0), (2, None, "01010101", 0)]


def test_sums_over_equal_labels_with_nulls(spark):
    rows = spark.createDataFrame([(1, "a", 2), (2, "a", 3), (3, None, 4), (4, None, None), (5, "b", None)], "id int, label string, error bigint")
    found = {r.id: r.total for r in with_group_sums(rows, "error", "label", "total").collect()}
    assert found == {1: 5, 2: 5, 3: 4, 4: 4, 5: None}
