"""Line deduplication on small cases against brute force."""

from shoreline.llm import linededup

SCHEMA = "doc_id long, text string, keep string, n_lines string, tag int"
BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10 and doc_id is not None:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders.get(key(x), ())) < 2 or doc_id == min(holders[key(x)])]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


HOT = "A line that a third of all documents hold"
CASES = [
    (1, None),
    (2, ""),
    (3, "short\nshort\n" + HOT + "\n" + HOT),
    (4, "\t" + HOT.upper() + " \r\nother words here\n\n"),
    (4, "\t" + HOT.upper() + " \r\nother words here\n\n"),
    (4, "other words here\ntail of another text\n" + HOT),
    (5, "OTHER words here\n" + HOT),
    (None, HOT + "\nother words here"),
    (6, " not a blank at the ends \nÉclair au chocolat"),
    (7, "not a blank at the ends\néclair au chocolat\nÉclair au chocolat"),
    (8, "a repeated line inside\n" * 3000 + "x" * 300_000),
    (9, "a repeated line inside\n" * 5 + "x" * 300_000),
    (10, "ten chars!\nnine char"),
    (11, "ten chars!\nnine char"),
] + [(100 + i, f"own line number {i}\n{HOT}\n{HOT} ") for i in range(60)]


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, "k", "n", 1) for d, t in rows], SCHEMA)
    kept, n_lines, n_dropped = linededup.without_repeats(docs)
    assert kept.columns[: len(docs.columns)] == docs.columns
    found = kept.select("doc_id", "text", n_lines, n_dropped, "keep", "tag").collect()
    assert all((r[4], r[5]) == ("k", 1) for r in found)
    return sorted(((r[0], r[1] or "", r[2], r[3]) for r in found), key=str)


def test_cases(spark):
    assert run(spark, CASES) == brute(CASES)


def test_a_hash_over_many_partitions(spark):
    """One line per partition or so: the hot line is cut by most ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert run(spark, CASES) == brute(CASES)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_table(spark):
    assert run(spark, []) == []
