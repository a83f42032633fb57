"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.llm import (
    decontaminate,
    infill,
    licenses,
    linededup,
    mixing,
    pagetext,
    simhash,
    substrings,
    topk,
    toxicity,
    urlfilter,
    vectorcodes,
    warczip,
)
from shoreline.llm.common import table, written

Runner = Callable[[SparkSession, str], DataFrame]

RUNNERS: dict[str, Runner] = {}
TWINS: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a function under its own name; ``sql`` gives the same rows."""

    def register(run: Runner) -> Runner:
        RUNNERS[run.__name__] = run
        if sql is not None:
            TWINS[run.__name__] = sql
        return run

    return register


@query()
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
item AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM item, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(s) WHERE len(w) > 0
),
placed AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM doc, (SELECT DISTINCT n FROM wanted), unnest(range(1, len(w) - n + 2)) AS t(s)
),
found AS (SELECT r, s, n, item_id FROM placed JOIN wanted USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(s, s + n)) AS t(p) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


@query(OP5_SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP9_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT r, doc_id, p, lines[p] AS line,
    translate(regexp_replace(lines[p], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM doc, unnest(range(1, len(lines) + 1)) AS t(p)
),
firsts AS (
  SELECT key, min(doc_id) AS first_id FROM line WHERE length(key) >= 10 AND doc_id IS NOT NULL
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
judged AS (SELECT r, p, line, first_id IS NOT NULL AND doc_id > first_id AS gone FROM line LEFT JOIN firsts USING (key))
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, n_dropped, sha256(kept) AS kept_sha256
FROM doc JOIN (
  SELECT r, count(*) FILTER (WHERE coalesce(gone, false)) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT coalesce(gone, false)), '') AS kept
  FROM judged GROUP BY r
) USING (r)
"""


@query(OP9_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept, n_lines, n_dropped = linededup.without_repeats(docs)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_dropped).alias("n_dropped"), digest.alias("kept_sha256"))


@query()
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

OP7_SQL = r"""
WITH rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
page AS (
  SELECT row_number() OVER () AS r, page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
part AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM page
),
fit AS (
  SELECT r, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC) AS n
  FROM part JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM part LEFT JOIN (SELECT * FROM fit WHERE n = 1) USING (r)
"""


@query(OP7_SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged, names = urlfilter.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", *(F.col(n).alias(w) for n, w in zip(names, ("host", "path", "rule", "verdict"))))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 20
"""


@query(OP6_SQL)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP4_SQL = """
WITH page AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT h, max(page_id) AS first_id FROM page GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS BIGINT) >> (15 - i % 4 * 5)) & 31) AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM page JOIN firsts USING (h)
"""


@query(OP4_SQL)
def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warczip.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pagetext.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


#: Domains of the labelled rows and the shares of all tokens that they are to have.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' WHEN quality = 1 THEN 'good' END"
DOMAIN_SHARES = {"good": 0.85, "poor": 0.1, "toxic": 0.05}


@query()
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed, names = mixing.mixed(docs, table(spark, sf_dir, "labels"), DOMAIN_SHARES, F.expr(DOMAIN))
    return mixed.select("doc_id", names["n_tokens"], *(names[d] for d in DOMAIN_SHARES), names["rate"])


def _license_rows() -> str:
    rows = []
    for number, t in enumerate(licenses.PHRASES + licenses.NOTICES):
        words = "[" + ", ".join(f"'{w.decode()}'" for w in t.words) + "]"
        rows.append(f"({number}, '{t.label}', {words}, {t.need}, {t.reach}, {str(t.phrase).lower()})")
    return ", ".join(rows)


OP11_SQL = f"""
WITH tpl(id, label, words, need, reach, phrase) AS (VALUES {_license_rows()}),
doc AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
place AS (
  SELECT r, label, s FROM doc, tpl, unnest(range(0, len(w) - len(words) + 1)) AS t(s)
  WHERE phrase AND w[s + 1:s + len(words)] = words
),
block AS (
  SELECT r, label, len(list_intersect(list_distinct(w[k * reach + 1:(k + 2) * reach]), words)) AS shared,
    need, len(list_distinct(words)) AS size
  FROM doc, tpl, unnest(range(0, (len(w) - 1) // reach + 1)) AS t(k) WHERE NOT phrase AND len(w) > 0
),
found AS (
  SELECT r, label, CAST(1 AS DOUBLE) AS share FROM place
  UNION ALL SELECT r, label, CAST(shared AS DOUBLE) / size FROM block WHERE shared >= need
),
base AS (
  SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM place GROUP BY r
),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM doc LEFT JOIN base USING (r) LEFT JOIN named USING (r)
"""


@query(OP11_SQL)
def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned, n_words, matches = licenses.scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    phrases = F.filter(matches, lambda m: m["phrase"])

    def names(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")

    def each(found, name):
        return F.transform(found, lambda m: m[name])

    return scanned.select(
        "doc_id",
        F.col(n_words).alias("n_words"),
        F.aggregate(each(phrases, "places"), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n_base"),
        F.array_min(each(phrases, "first")).alias("first_word"),
        F.array_max(each(phrases, "last")).alias("last_word"),
        names(phrases).alias("base_labels"),
        names(F.col(matches)).alias("labels"),
        F.coalesce(F.array_max(each(F.col(matches), "containment")), F.lit(0.0)).alias("score"),
    )


OP12_SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents
),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM doc
),
cut AS (
  SELECT doc_id, t, n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
    array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
    array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


@query(OP12_SQL)
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.digests(infill.output_pieces(table(spark, sf_dir, "documents"), "doc_id", plain=10, spm=20, seed=1))
    return found.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


def _op13_sql() -> str:
    """Every part against every entry, in rounds; entries are lists of integers."""
    steps = ["""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
part AS MATERIALIZED (SELECT r, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM kept, unnest(range(0, 4)) AS t(p)),
book0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM part
  JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept QUALIFY e < 256) USING (r)
)"""]
    for i in range(vectorcodes.ROUNDS + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, p, x, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT r, p, x, e, CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM part JOIN book{i} USING (p)
  ) GROUP BY r, p, x
)""")
        if i < vectorcodes.ROUNDS:
            steps.append(f"""
book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n.c, b.c) AS c FROM book{i} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY j) AS c FROM (
      SELECT p, e, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS m FROM near{i}, unnest(range(1, len(x) + 1)) AS t(j) GROUP BY p, e, j
    ) GROUP BY p, e
  ) n USING (p, e)
)""")
    last = vectorcodes.ROUNDS
    return ",".join(steps) + f""",
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{last} GROUP BY r),
summed AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN coded USING (r) GROUP BY label)
SELECT vec_id, code, error, label_error,
  (SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) FROM book{last}) AS codebooks_sha256
FROM kept JOIN coded USING (r) JOIN summed ON summed.label IS NOT DISTINCT FROM kept.label
"""


@query(_op13_sql())
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = vectorcodes.staged_integers(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    books = vectorcodes.fit(staged)
    coded, code, error = vectorcodes.coded(staged, books)
    rows = written(coded.select("vec_id", "label", F.col(code).alias("code"), F.col(error).alias("error")), "vector-codes")
    digest = F.lit(books.digest()).alias("codebooks_sha256")
    return vectorcodes.with_group_sums(rows, "error", "label", "label_error").select("vec_id", "code", "error", "label_error", digest)
