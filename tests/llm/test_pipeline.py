"""The stages in a row against brute-force versions of what each decides."""

import pytest
from test_decontaminate import brute as contaminated
from test_linededup import brute as lines_kept
from test_simhash import brute_components, brute_fingerprint

import corpus_pipeline
from shoreline.llm.common import written

SF_DIR = "/root/testdata/sf0.01"


def test_stages_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert [n.split()[0] for n in names] == ["toxicity", "line", "SimHash", "benchmark", "mixing"]


def test_each_stage_on_its_own_input(spark, tables):
    docs = tables("documents", SF_DIR)
    columns = docs.columns
    items = [(r.item_id, r.text) for r in tables("benchmark", SF_DIR).collect()]
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(written(stage(spark, results[-1], SF_DIR), "test"))
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in results]
    assert all(d.columns == columns for d in results[:-1]) and results[-1].columns[: len(columns)] == columns
    scored = {r.doc_id: r.predicted for r in __import__("shoreline.llm.queries", fromlist=["x"]).op2_toxicity(spark, SF_DIR).collect()}
    assert sorted(rows[1]) == sorted(r for r in rows[0] if scored[r[0]] == 0)
    assert sorted(rows[2]) == sorted(r[:2] for r in lines_kept(rows[1]))
    components = brute_components([(d, brute_fingerprint(t)) for d, t in rows[2]])
    leading = {c for _, _, c in components}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] in leading)
    clean = {d for d, _, n, _ in contaminated(rows[3], items) if n == 0}
    assert sorted(rows[4]) == sorted(r for r in rows[3] if r[0] in clean)
    last = results[-1].toPandas()
    assert (last.rate > 0).all() and len(last) > 0.99 * len(rows[4])
    good = (last.n_tokens * last.rate * last.p_good).sum() / last.n_tokens.sum()
    assert good == pytest.approx(corpus_pipeline.SHARES["good"], abs=0.01)


def test_a_run_leaves_its_result_alone(spark, tmp_path, monkeypatch):
    """Every stage's own tables and input are gone once the next result is written."""
    monkeypatch.setattr("shoreline.session.shared_folder", lambda _: str(tmp_path))
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [folder.name for folder in (tmp_path / "shoreline").iterdir()]
    assert [name.rsplit("-", 1)[0] for name in left] == ["mixing-to-target-weights"]
    assert result.count() > 0 and "rate" in result.columns


def test_edge_cases(spark):
    """Nulls, empty and repeated rows, clashing names and an empty table pass through every stage."""
    rows = [(1, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (None, "a b", "en", "s", 3, 1), (2, "a b", "en", "s", 3, 1), (2, "a b", "en", "s", 3, 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score int"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, "/root/testdata/sf0.001"), "test")
            assert docs.columns[: len(columns)] == columns, name


def test_without_labelled_text_nothing_is_toxic(spark, monkeypatch):
    """No labels, labels of other documents, or none whose text fits: no document goes."""
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(1, 9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    for given, bound in ((labels.limit(0), 1 << 20), (labels.selectExpr("doc_id + 100 AS doc_id", "quality", "toxic"), 1 << 20), (labels, 1)):
        monkeypatch.setattr(corpus_pipeline, "table", lambda *_, given=given: given)
        monkeypatch.setattr(corpus_pipeline.toxicity, "MAX_BYTES", bound)
        assert corpus_pipeline.drop_toxic(spark, docs, "").count() == 8
