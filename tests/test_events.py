import json

import pytest
from pyspark.sql import functions as F

from shoreline.operators.events import (
    EVENT_SCHEMA,
    explode_child,
    flatten_struct,
    parse_events,
    project_paths,
    record_text,
    route_events,
)
from shoreline.operators.offsets import offset_ledger, starting_offsets_json, starting_positions
from shoreline.sources.kafka import kafka_options, text_records
from shoreline.sources.records import field_type, inferred_schema, is_one_document, narrow_schema, read_json_records


def event(event_id, entities=(), **fields):
    return json.dumps(
        {
            "jsonVersion": 1,
            "originatingEvent": {
                "eventId": event_id,
                "eventTime": "2020-05-04T03:02:01.123Z",
                "accountNumber": f"ACCT-{event_id}",
                "internalAmount": {"value": 1.5, "currency": "USD"},
                **fields,
            },
            "entities": list(entities),
        }
    )


CARD = {"entityType": "card", "entityId": "C1", "models": [{"modelId": "m1", "score": 0.5, "tags": ["t"]}, {"modelId": "m2"}]}
SHOP = {"entityType": "merchant", "entityId": "M1", "models": []}
VALUES = {
    "chargeback": event("1", [CARD, SHOP], chargebackId="CB", caseId="CS"),
    "fraud": event("2", [SHOP], fraudTransactionId="FR"),
    "neither": event("3"),
    "both": event("4", chargebackId="CB", fraudTransactionId="FR"),
    "null field": event("5", chargebackId=None),
    "malformed": event("6")[:-1],
    "no json": "hello",
    "two documents": event("7", chargebackId="CB") + event("8"),
    "trailing text": event("7", chargebackId="CB") + " x",
    "bad type": event("9", chargebackId="CB", schemaVersion="x"),
    "missing": None,
}
ROUTES = {
    "chargeback": "chargeback",
    "fraud": "fraud",
    "neither": "asyncout",
    "both": "chargeback",
    "null field": "asyncout",
    "malformed": "quarantine",
    "no json": "quarantine",
    "two documents": "quarantine",
    "trailing text": "quarantine",
    "bad type": "quarantine",
    "missing": "quarantine",
}


@pytest.fixture
def records(spark):
    return spark.createDataFrame(list(VALUES.items()), "name string, value string")


def test_each_record_has_one_route(records):
    """Whichever fields are picked."""
    routed = route_events(parse_events(records))
    assert {row.name: row.route for row in routed.collect()} == ROUTES
    picked = project_paths(routed, {"name": "name", "route": "route"})
    assert {row.name: row.route for row in picked.collect()} == ROUTES
    assert routed.where("route = 'quarantine' AND event.originatingEvent IS NOT NULL").count() == 0


def test_rules_are_the_callers(records):
    rules = [("cases", "originatingEvent.caseId")]
    routed = route_events(parse_events(records), rules=rules, default="rest")
    assert {row.name for row in routed.filter("route = 'cases'").collect()} == {"chargeback"}


def test_filters_do_not_parse_twice(records):
    routed = route_events(parse_events(records)).filter("route = 'fraud'")
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    children = explode_child(parse_events(records), "event.entities", ["name"])
    assert children._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_named_fields(records):
    paths = {"name": "name", "account": "event.originatingEvent.accountNumber", "card": "event.originatingEvent.cardPr"}
    rows = {row.name: row for row in project_paths(parse_events(records), paths).collect()}
    assert rows["fraud"].account == "ACCT-2" and rows["fraud"].card is None
    assert rows["no json"].account is None


def test_wide_row(records):
    wide = flatten_struct(parse_events(records).filter("name = 'fraud'"), "event.originatingEvent", keep=["name"])
    row = wide.first()
    assert row.internalAmount_value == 1.5 and row.fraudTransactionId == "FR" and row.cardType_product is None
    assert str(row.eventTime) == "2020-05-04 03:02:01.123000"
    assert "_metadata_entities_card" in wide.columns and not any(t.startswith("struct") for _, t in wide.dtypes)


def test_children(records):
    parsed = parse_events(records)
    entities = explode_child(parsed, "event.entities", {"id": "event.originatingEvent.eventId"}, ordinal="entity")
    assert sorted((r.id, r.entity, r.entityType) for r in entities.collect()) == [
        ("1", 0, "card"),
        ("1", 1, "merchant"),
        ("2", 0, "merchant"),
    ]
    models = explode_child(entities, "models", ["id", "entity"])
    assert sorted((r.id, r.entity, r.ordinal, r.modelId, r.score) for r in models.collect()) == [
        ("1", 0, 0, "m1", 0.5),
        ("1", 0, 1, "m2", None),
    ]
    tags = explode_child(models, "tags", ["id", "modelId"])
    assert [tuple(row) for row in tags.collect()] == [("1", "m1", 0, "t")]
    outer = explode_child(parsed, "event.entities", ["name"], outer=True)
    assert outer.count() == 3 + 3  # parents without entities; none that is quarantined
    with pytest.raises(ValueError):
        explode_child(parsed, "event.versions", ["name"])


def test_narrow_schema(spark):
    narrow = narrow_schema(EVENT_SCHEMA, ["originatingEvent.merchant.city", "originatingEvent.cardPr", "versions", "nope"])
    assert narrow.simpleString() == (
        "struct<originatingEvent:struct<merchant:struct<city:string>>,"
        "versions:struct<modelGraph:int,configGroups:array<struct<type:string,version:string>>>>"
    )
    assert narrow_schema(EVENT_SCHEMA, ["originatingEvent.cardPr"]).names == []


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": {"c": "x"}}\n{"a": 2\n')
    inferred = read_json_records(spark, str(tmp_path)).cache()
    assert inferred.filter("_corrupt_record is not null").count() == 1
    fixed = read_json_records(spark, str(tmp_path), "a int, b struct<c: string>").cache()
    assert fixed.filter("b.c = 'x'").first().a == 1
    assert fixed.filter("_corrupt_record is not null").count() == 1


def test_schema_of_texts(records):
    schema = inferred_schema(records)
    assert field_type(schema, "originatingEvent.internalAmount.value").simpleString() == "double"
    assert field_type(schema, "entities").elementType.names == ["entityId", "entityType", "models"]
    routed = route_events(parse_events(records, schema))  # a version of another type fits this schema
    assert {row.name: row.route for row in routed.collect()} == {**ROUTES, "bad type": "chargeback"}


def test_offsets(spark):
    records = spark.createDataFrame([("a", 0, 5), ("a", 0, 9), ("a", 10, 1), ("b", 0, 0)], "topic string, partition int, offset bigint")
    ledger = offset_ledger(records)
    assert sorted(tuple(row) for row in ledger.collect()) == [("a", 0, 5, 10), ("a", 10, 1, 2), ("b", 0, 0, 1)]
    known = spark.createDataFrame([("a", 0), ("a", 2), ("a", 10), ("b", 0)], "topic string, partition int")
    text = starting_offsets_json(starting_positions(ledger, known)).first()[0]
    assert text == '{"a":{"0":10,"2":0,"10":2},"b":{"0":1}}'


def test_kafka_options():
    options = kafka_options("h:1", "a, b", max_offsets_per_trigger=10, client={"security.protocol": "SSL"})
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "kafka.security.protocol": "SSL",
        "maxOffsetsPerTrigger": "10",
    }


def test_records_as_text(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"two\nlines"), "t", 0, 1)], "key binary, value binary, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2020-01-01 00:00:00.000001").cast("timestamp"))
    line = text_records(raw).select(record_text().alias("line")).first().line
    assert "\n" not in line
    assert json.loads(line) == {
        "topic": "t",
        "partition": 0,
        "offset": 1,
        "timestamp": "2020-01-01T00:00:00.000001Z",
        "key": "k",
        "value": "two\nlines",
    }


def test_text_behind_a_document_is_found(spark):
    whole = ['{"a":1}', ' {"a":[{"b":"]"}]} \n', '{"a":"x] y"}', "{}"]
    more = ['{"a":1}] junk', '{"a":1}],[{"b":2}', '{"a":1}{"a":1}', '{"a":1},0', '{"a":1},0] junk', '{"a":1} x', '{"a":1}]', "", "junk", '{"a":', '{"a":1}],0]']
    rows = spark.createDataFrame([(t, t in whole) for t in whole + more] + [(None, False)], "value string, expected boolean")
    assert rows.where(is_one_document("value") != F.col("expected")).collect() == []
    parsed = route_events(parse_events(rows, "a string, originatingEvent struct<chargebackId: string, fraudTransactionId: string>"))
    assert {r.value: r.route for r in parsed.collect()} == {t: "asyncout" for t in whole} | {t: "quarantine" for t in more} | {None: "quarantine"}
