import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoreline.operators.dedup import latest_rows, latest_rows_counted, number_rows

SCHEMA = "k1 string, k2 string, t string, u string, v string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df):
    return sorted(map(repr, df.collect()))


def brute_force(rows):
    """Highest (t, u, v) per key; null is lowest."""
    best = {}
    for row in rows:
        rank = [(value is not None, value or "") for value in row[2:]]
        if row[:2] not in best or rank > best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    return [row for _, row in best.values()]


value = st.one_of(st.none(), st.sampled_from(["a", "b", "10", "9", " "]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(value, value, value, value, value), min_size=1, max_size=40), parts=st.integers(1, 5))
def test_equals_brute_force_however_partitioned(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    expected = as_set(spark.createDataFrame(brute_force(rows), SCHEMA))
    latest = latest_rows(df, ["k1", "k2"], ["t", "u"])
    assert as_set(latest) == expected
    assert as_set(latest_rows(latest, ["k1", "k2"], ["t", "u"])) == expected
    counted = latest_rows_counted(df, ["k1", "k2"], ["t", "u"])
    assert as_set(counted.drop("_source_rows")) == expected
    assert counted.agg(F.sum("_source_rows")).first()[0] == len(rows)


def test_numbering_order(spark):
    df = spark.createDataFrame([("a", None), ("a", "9"), ("a", "10")], "k string, t string")
    by_text = {row.t: row.row_number for row in number_rows(df, ["k"], ["t"], 3).collect()}
    assert by_text == {"9": 1, "10": 2, None: 3}
    by_number = {row.t: row.row_number for row in number_rows(df, ["k"], ["t"], 3, casts={"t": "int"}).collect()}
    assert by_number == {"10": 1, "9": 2, None: 3}
    assert {row.t for row in number_rows(df, ["k"], ["t"], 2).collect()} == {"9", "10"}


def test_equal_casts_are_decided_by_the_text(spark):
    df = spark.createDataFrame([("a", "07"), ("a", "7"), ("a", "x")], "k string, t string").repartition(3)
    assert latest_rows(df, ["k"], ["t"], casts={"t": "int"}).first().t == "7"
    assert latest_rows_counted(df, ["k"], ["t"], casts={"t": "int"}).first() == ("a", "7", 3)


def test_rows_with_maps(spark):
    df = spark.createDataFrame([("a", 1, {"x": 1}), ("a", 1, {"x": 2}), ("b", 1, None)], "k string, t int, m map<string,int>")
    assert as_set(latest_rows(df, ["k"], ["t"])) == as_set(latest_rows_counted(df, ["k"], ["t"]).drop("_source_rows"))
    assert latest_rows(df, ["k"], ["t"]).filter("k = 'a'").first().m == {"x": 2}


def test_one_shuffle_with_map_side_reduction(spark):
    df = spark.range(10).selectExpr("cast(id % 3 as string) k", "cast(id as string) t", "'x' v")
    window_plan = plan(latest_rows(df, ["k"], ["t"]))
    assert window_plan.count("Exchange") == 1
    assert "Partial" in window_plan.split("Exchange")[1]
    counted_plan = plan(latest_rows_counted(df, ["k"], ["t"]))
    assert counted_plan.count("Exchange") == 1
    assert "partial_max" in counted_plan.split("Exchange")[1]


@pytest.mark.parametrize("operator", [latest_rows, latest_rows_counted])
def test_hot_key_reaches_the_shuffle_reduced(spark, operator):
    """A key with a third of all rows crosses as one row per map task."""
    df = spark.range(0, 90_000, 1, 6).selectExpr(
        "case when id % 3 = 0 then null else id % 1000 end as k", "id as t", "repeat('x', 20) as v"
    )
    keys = df.select("k").distinct().count()
    result = operator(df, ["k"], ["t"])
    result.collect()
    written = [
        metric.value()
        for metric in _exchange_metrics(result, "shuffleRecordsWritten")
    ]
    assert sum(written) <= 6 * keys
    assert result.filter("k is null").first().t == 89_997


def _exchange_metrics(df, name):
    """Metrics of the exchanges in the plan that ran."""
    found = []

    def walk(node):
        kind = node.nodeName()
        if kind == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in kind:
            return walk(node.plan())
        if "Exchange" in kind:
            found.append(node.metrics().apply(name))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_order_of_input_does_not_matter(spark):
    rows = [("a", "1", str(i % 3), None, str(i)) for i in range(50)]
    seen = set()
    for _ in range(3):
        random.shuffle(rows)
        seen.add(latest_rows(spark.createDataFrame(rows, SCHEMA).repartition(7), ["k1"], ["t"]).first())
    assert len(seen) == 1
