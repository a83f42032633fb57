"""Fill-in-the-middle texts against a plain rewriting of each text."""

import hashlib
import re

import pytest

from shoreline.llm import common, infill

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, plain=10, spm=20, seed=1):
    """n, form, prefix and middle characters, output."""
    text = text or ""
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = [
    None,
    "",
    "x",
    "\n",
    "one two  three\r\nfour",
    "Grüße, 你好 🙂🙂 naïve",
    "a<P>b",
    "almost <P and <S and <M and <",
    "<S<P<M>",
    "<" * 50,
    "<M" * 40 + "P>",
    "letters" * 300,
    "ab1" * 500,
    "é" * 700 + "z" * 700 + "\u0000\u007f" * 30,
]


@pytest.fixture(params=[None, 16])
def sized(request, monkeypatch):
    """Once as built, once with tiny pieces and slices so that everything is cut."""
    if request.param:
        for module in (common, infill):
            monkeypatch.setattr(module, "SLICE_BYTES", 40)
        monkeypatch.setattr(infill, "PIECE_BYTES", request.param)


def rows_for(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return infill.output_pieces(docs, **settings)


@pytest.mark.parametrize("settings", [{}, {"plain": 0, "spm": 0}, {"plain": 0, "spm": 100, "seed": 9}, {"plain": 100}])
def test_outputs_and_digests_equal_brute_force(spark, sized, settings):
    rows = [(100 * k + i if i % 5 else -i, text) for k in range(4) for i, text in enumerate(TEXTS)]
    rows += [(None, "no id"), (None, "no id"), (7, "twice"), (7, "twice"), (7, "another text")]
    pieces = rows_for(spark, rows, **settings)
    expected = sorted(((i, *brute(i, t, **settings), t or "") for i, t in rows), key=repr)
    found = sorted(((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in infill.outputs(pieces).collect()), key=repr)
    assert found == sorted((row[:6] for row in expected), key=repr)
    digests = infill.digests(pieces).collect()
    found = [(r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in digests]
    assert sorted(found, key=repr) == sorted(((*row[:5], sha(row[5]), sha(row[6])) for row in expected), key=repr)


def test_all_forms_occur(spark):
    rows = rows_for(spark, [(i, "some words to cut") for i in range(300)])
    counts = {r.form: r["count"] for r in infill.digests(rows).groupBy("form").count().collect()}
    assert set(counts) == {"plain", "psm", "spm"}
    assert 15 <= counts["plain"] <= 50 and counts["spm"] < counts["psm"]


@pytest.mark.parametrize("text", ["ab cd" * 30, "é" * 90, "word " + "w" * 200 + " end", "x" * 17, "🙂" * 33 + "tail"])
def test_chunks_are_whole_units_and_characters(text):
    data = text.encode()
    parts = list(infill.chunks(data, 0, len(data), 16))
    assert b"".join(parts) == data and all(0 < len(p) <= 16 for p in parts)
    for part in parts:
        part.decode()
    joins = [(a[-1:] + b[:1]) for a, b in zip(parts, parts[1:]) if len(a) < 13]
    assert not any(j.isalpha() and j.isascii() for j in joins if "w" * 16 not in text)


def test_marks_across_pieces():
    output = b"<P>pre<<S>suf<M<M>mid<P"
    for size in range(1, 8):
        splitter, parts = infill.Splitter("psm"), {0: b"", 1: b"", 2: b""}
        for at in range(0, len(output), size):
            for part, data in splitter.feed(output[at : at + size]):
                parts[part] += data
        for part, data in splitter.rest():
            parts[part] += data
        assert parts == {0: b"pre<", 1: b"mid<P", 2: b"suf<M"}


def test_one_shuffle_of_texts(spark, tables):
    digests = infill.digests(infill.output_pieces(tables("documents")))
    assert digests._jdf.queryExecution().sparkPlan().toString().count("RepartitionByExpression") <= 1
    assert digests._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 1


def test_text_ids_other_columns_and_empty_table(spark):
    docs = spark.createDataFrame([("k", "some text", 3, 4)], "name string, text string, row int, n int")
    (row,) = infill.outputs(infill.output_pieces(docs, "name")).collect()
    assert (row.id, row.n, row.output) == ("k", 3, brute("k", "some text")[4])
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert infill.digests(infill.output_pieces(none)).count() == 0
