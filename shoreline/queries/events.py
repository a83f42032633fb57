"""Queries over nested events and offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.operators.events import (
    explode_child,
    flatten_struct,
    parse_events,
    project_paths,
    record_envelope,
    route_events,
)
from shoreline.operators.offsets import gaps, islands, offset_ledger, starting_offsets_json, starting_positions
from shoreline.queries.inputs import FEED_SQL, feed, plain_feed, table
from shoreline.queries.registry import query
from shoreline.session import scratch_path, spread
from shoreline.sources.delimited import schema_from_names
from shoreline.sources.kafka import text_records
from shoreline.sources.schemas import VERSION_COLUMN, SchemaVersions, read_versions
from shoreline.sources.records import inferred_schema, parse_json, read_json_records

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("parsed", parse_json("props", "k int"))
    return events.select("event_id", "parsed.k")


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS other FROM events
""")
def event_parse_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text fields by a list of names; a name no record has is null."""
    parsed = table(spark, sf_dir, "events").withColumn("parsed", parse_json("props", schema_from_names("k other")))
    return parsed.select("event_id", "parsed.k", "parsed.other")


@query(f"""
WITH {FEED_SQL}
SELECT CAST(f.user_id AS VARCHAR) AS key, e.props AS value, f.topic, f.part AS partition, f.event_id AS offset
FROM feed f JOIN events e USING (event_id)
""")
def record_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values as a topic holds them, bytes, turned into text."""
    records = plain_feed(table(spark, sf_dir, "events"))
    stored = records.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")})
    return text_records(stored).drop("timestamp")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def event_parse_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    schema = inferred_schema(events, "props")
    return events.withColumn("parsed", parse_json("props", schema)).select("event_id", "parsed.k")


@query("""
SELECT event_id, user_id, event_type, value FROM events
""")
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines and read with an inferred schema."""
    path = scratch_path(spark, "json")
    table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return read_json_records(spark, path).select("event_id", "user_id", "event_type", "value")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_events(feed(spread(table(spark, sf_dir, "events"))))


@query(f"""
WITH {FEED_SQL}
SELECT event_id, topic, route,
       CASE WHEN NOT broken THEN 'ACCT-' || user_id END AS account, CAST(NULL AS VARCHAR) AS card,
       CASE WHEN NOT broken THEN amount END AS amount,
       CASE WHEN NOT broken THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_time
FROM routed
""")
def event_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "account": "originatingEvent.accountNumber",
        "card": "originatingEvent.cardPr",
        "amount": "originatingEvent.internalAmount.value",
        "at": "originatingEvent.eventTime",
    }
    routed = route_events(_parsed(spark, sf_dir))
    paths = {name: f"event.{path}" for name, path in fields.items()}
    named = project_paths(routed, {"event_id": "offset", "topic": "topic", "route": "route", **paths})
    return named.withColumn("event_time", F.date_format("at", MICROS)).drop("at")


@query(f"""
WITH {FEED_SQL}
SELECT event_id, chargeback_id AS "chargebackId", fraud_id AS "fraudTransactionId", event_type AS "eventType",
       amount AS "internalAmount_value", 'USD' AS "internalAmount_currency",
       event_type AS "merchant_merchantId", 'City ' || event_type AS "merchant_city",
       CAST(NULL AS VARCHAR) AS "cardType_product"
FROM routed WHERE NOT broken
""")
def event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = _parsed(spark, sf_dir).filter(F.col("event.originatingEvent").isNotNull())
    wide = flatten_struct(whole, "event.originatingEvent", keep=["offset"])
    return wide.select(
        F.col("offset").alias("event_id"),
        "chargebackId",
        "fraudTransactionId",
        "eventType",
        "internalAmount_value",
        "internalAmount_currency",
        "merchant_merchantId",
        "merchant_city",
        "cardType_product",
    )


@query(f"""
WITH {FEED_SQL}
SELECT event_id, CAST(ordinal AS INTEGER) AS ordinal, entity_type AS "entityType", entity_id AS "entityId",
       'no-risk' AS "riskStatus"
FROM entities
""")
def entities_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = explode_child(_parsed(spark, sf_dir), "event.entities", {"event_id": "offset"})
    return child.select("event_id", "ordinal", "entityType", "entityId", "riskStatus")


@query(f"""
WITH {FEED_SQL}
SELECT event_id, CAST(ordinal AS INTEGER) AS entity, CAST(m.i AS INTEGER) AS ordinal, 'model-' || m.i AS "modelId",
       amount * (m.i + 1) AS score, e.event_type AS tag
FROM entities JOIN (SELECT event_id AS id, event_type FROM events) e ON e.id = event_id
JOIN (VALUES (0), (1), (2)) m(i) ON m.i < n_models
""")
def models_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = explode_child(_parsed(spark, sf_dir), "event.entities", {"event_id": "offset"}, ordinal="entity")
    models = explode_child(entities, "models", ["event_id", "entity"])
    return models.select("event_id", "entity", "ordinal", "modelId", "score", F.col("tags")[0].alias("tag"))


@query("""
SELECT o_orderkey, CAST(i AS INTEGER) AS ordinal, i + 1 AS item_no, o_totalprice * (i + 1) AS amount,
       o_orderstatus || i AS label
FROM orders JOIN (VALUES (0), (1), (2)) t(i) ON i < o_orderkey % 4
UNION ALL
SELECT o_orderkey, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 4 = 0
""")
def line_items_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A child array whose schema the caller supplies; parents without items stay."""
    items = F.transform(
        F.slice(F.array(*map(F.lit, range(3))), 1, (F.col("o_orderkey") % 4).cast("int")),
        lambda i: F.struct(
            (i + 1).alias("item_no"),
            (F.col("o_totalprice") * (i + 1)).alias("amount"),
            F.concat("o_orderstatus", i.cast("string")).alias("label"),
        ),
    )
    value = F.to_json(F.struct(items.alias("lineItems"))).alias("value")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", value)
    schema = "lineItems array<struct<item_no: int, amount: double, label: string>>"
    return explode_child(parse_events(orders, schema), "event.lineItems", ["o_orderkey"], outer=True)


@query("""
SELECT event_id, CAST(CASE event_id % 3 WHEN 0 THEN floor(value) ELSE value END AS DOUBLE) AS amount,
  CASE event_id % 3 WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN 'U' || user_id END AS who,
  CASE WHEN event_id % 3 = 2 THEN event_type END AS tag, CAST(event_id % 3 + 1 AS INTEGER) AS schema_version
FROM events
""")
def event_schema_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose records get more fields, wider numbers and a type that does not fit the earlier one."""
    events = table(spark, sf_dir, "events")
    versions, path = SchemaVersions(spark, scratch_path(spark, "schemas")), scratch_path(spark, "versions")
    fields = [
        [F.floor("value").alias("amount")],
        [F.col("value").alias("amount"), F.struct(F.col("user_id").alias("id")).alias("who")],
        [
            F.col("value").alias("amount"),
            F.struct(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("id")).alias("who"),
            F.array("event_type").alias("tags"),
        ],
    ]
    for number, columns in enumerate(fields):
        batch = events.where(F.col("event_id") % 3 == number)
        records = batch.select(F.to_json(F.struct("event_id", *columns)).alias("value"))
        version, schema = versions.grow(inferred_schema(records))
        parsed = records.select(parse_json("value", schema).alias("record")).select(*[f"record.{name}" for name in schema.names])
        parsed.write.parquet(f"{path}/{VERSION_COLUMN}={version}")
    rows = read_versions(spark, path, versions)
    return rows.select(
        F.col("event_id").cast("bigint"), F.col("amount").cast("double"), F.col("who.id").alias("who"), F.col("tags")[0].alias("tag"), VERSION_COLUMN
    )


@query("""
SELECT props AS value, event_id AS offset, strftime(ts, '%H:%M:%S') AS handled_time,
       strftime(ts, '%Y-%m-%d') AS handled_date
FROM events
""")
def record_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_envelope(plain_feed(table(spark, sf_dir, "events")), F.col("timestamp"))


LEDGER_SQL = f"""
WITH {FEED_SQL},
ledger AS (
  SELECT topic, part, min(event_id) AS from_offset, max(event_id) + 1 AS until_offset FROM feed GROUP BY topic, part
)
"""


@query(LEDGER_SQL + """
SELECT topic, part AS partition, from_offset, until_offset FROM ledger
""")
def offset_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_ledger(plain_feed(table(spark, sf_dir, "events")))


@query(f"""
WITH {FEED_SQL},
ledger AS (
  SELECT topic, part, event_id // 40 AS batch, min(event_id) AS lo, max(event_id) + 1 AS hi FROM feed
  WHERE event_id // 40 % 5 <> 3 GROUP BY ALL
  UNION ALL
  SELECT topic, part, event_id // 250, min(event_id), max(event_id) + 1 FROM feed
  WHERE event_id // 250 % 4 = 1 GROUP BY ALL
),
reached AS (
  SELECT *, max(hi) OVER (PARTITION BY topic, part ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM ledger
),
numbered AS (
  SELECT *, count(*) FILTER (WHERE before IS NULL OR lo > before) OVER (PARTITION BY topic, part ORDER BY lo, hi) AS island FROM reached
),
merged AS (SELECT topic, part, island, min(lo) AS lo, max(hi) AS hi FROM numbered GROUP BY ALL),
points AS (SELECT topic, part, lo AS pos FROM ledger UNION SELECT topic, part, hi FROM ledger),
stretches AS (SELECT topic, part, pos AS lo, lead(pos) OVER (PARTITION BY topic, part ORDER BY pos) AS hi FROM points),
twice AS (
  SELECT s.topic, s.part, s.lo, s.hi FROM stretches s JOIN ledger l
    ON l.topic = s.topic AND l.part = s.part AND l.lo <= s.lo AND l.hi >= s.hi
  GROUP BY ALL HAVING count(*) > 1
)
SELECT 'landed' AS kind, m.topic, m.part AS partition, m.lo AS from_offset, m.hi AS until_offset,
  CAST((SELECT coalesce(sum(t.hi - t.lo), 0) FROM twice t WHERE t.topic = m.topic AND t.part = m.part AND t.lo >= m.lo AND t.hi <= m.hi) AS BIGINT) AS offsets
FROM merged m
UNION ALL
SELECT 'missing', topic, part, lo, hi, hi - lo FROM (
  SELECT topic, part, hi AS lo, lead(lo) OVER (PARTITION BY topic, part ORDER BY lo) AS hi FROM merged
) WHERE hi IS NOT NULL
""")
def ledger_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbroken ranges of two runs' ledgers with their repeated offsets, and the holes between.

    The first run has small batches of which every fifth did not land, the second few large ones.
    """
    records = plain_feed(table(spark, sf_dir, "events"))
    kinds = []
    for size, landed in ((40, "batch % 5 <> 3"), (250, "batch % 4 = 1")):
        batches = records.withColumn("batch", F.floor(F.col("offset") / size)).where(landed)
        topic = F.concat_ws("#", "topic", "batch").alias("topic")
        kinds.append(offset_ledger(batches.select(topic, "partition", "offset")))
    ledger = kinds[0].union(kinds[1]).withColumn("topic", F.split_part("topic", F.lit("#"), F.lit(1)))
    found = islands(ledger).withColumnRenamed("repeated", "offsets").withColumn("kind", F.lit("landed"))
    size = (F.col("until_offset") - F.col("from_offset")).alias("offsets")
    missing = gaps(ledger).select("*", size, F.lit("missing").alias("kind"))
    return found.unionByName(missing)


@query(LEDGER_SQL + """
SELECT t.topic, p.part AS partition, coalesce(l.until_offset, 0) AS start_offset
FROM (SELECT DISTINCT topic FROM feed) t CROSS JOIN (SELECT DISTINCT CAST(user_id % 5 AS INTEGER) AS part FROM events) p
LEFT JOIN ledger l ON l.topic = t.topic AND l.part = p.part
""")
def starting_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(spark, sf_dir)


@query(LEDGER_SQL + """,
positions AS (
  SELECT t.topic, p.part, coalesce(l.until_offset, 0) AS start_offset
  FROM (SELECT DISTINCT topic FROM feed) t
  CROSS JOIN (SELECT DISTINCT CAST(user_id % 5 AS INTEGER) AS part FROM events) p
  LEFT JOIN ledger l ON l.topic = t.topic AND l.part = p.part
),
texts AS (
  SELECT topic, '"' || topic || '":{' || string_agg('"' || part || '":' || start_offset, ',' ORDER BY part) || '}' AS t
  FROM positions GROUP BY topic
)
SELECT '{' || string_agg(t, ',' ORDER BY topic) || '}' AS starting_offsets FROM texts
""")
def starting_offsets_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return starting_offsets_json(_positions(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics with five partitions, of which the ledger knows four."""
    events = table(spark, sf_dir, "events")
    known = F.explode(F.array(F.lit("account"), F.lit("browse"))).alias("topic")
    partitions = events.select((F.col("user_id") % 5).cast("int").alias("partition")).distinct().select(known, "partition")
    return starting_positions(offset_ledger(plain_feed(events)), partitions)
