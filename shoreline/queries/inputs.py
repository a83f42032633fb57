"""Inputs derived from the given tables by row-wise expressions, and the same in SQL.

Each ``*_SQL`` text is a ``WITH`` entry that derives the rows its neighbour derives in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Batches that a stream over a table arrives in, and one more without a record.
BATCHES = 3
#: Files that a batch arrives in, at least.
FILES = 4
#: Rows of a file from which a batch arrives in more files, as a file is the work of one task.
ROWS_PER_FILE = 50_000
#: Rows that each file of the smallest batch has on average where a batch has more than ``FILES`` files; then none is empty.
LEAST_ROWS = 100


def arrivals(spark: SparkSession, sf_dir: str, name: str, key: str, *, mixed: bool = False) -> DataFrame:
    """A table as a stream of several batches of several files, the last one without records.

    A batch holds a range of the integer ``key``; with ``mixed`` every batch holds keys of the
    whole range, so that the later ones bring records older than what is there. The files
    land once per application, as a topic would hold them already.
    """
    rows = table(spark, sf_dir, name)
    path, files = _landed(spark, sf_dir, name, key, mixed)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{path}/chunk=*")


_LANDED: dict[tuple, tuple[str, int]] = {}


def _landed(spark: SparkSession, sf_dir: str, name: str, key: str, mixed: bool) -> tuple[str, int]:
    """Where they are and the files per batch, batch after batch in the order of their times.

    Batches are written one after the other, as file streams take the oldest files first. Each
    has the same number of files, which grows with the table.
    """
    rows = table(spark, sf_dir, name)
    found = (spark.sparkContext.applicationId, sf_dir, name, key, mixed)
    if found in _LANDED:
        return _LANDED[found]
    path = scratch_path(spark, "arriving")
    top = rows.agg(F.max(key)).first()[0] or 0
    chunk = F.col(key) % BATCHES if mixed else F.floor(F.col(key) * BATCHES / F.lit(top + 1)).cast("int")
    counts = {row.chunk: row["count"] for row in rows.groupBy(chunk.alias("chunk")).count().where(F.col("chunk").between(0, BATCHES - 1)).collect()}
    files = _files([counts.get(number, 0) for number in range(BATCHES)])
    for number in range(BATCHES):
        rows.where(chunk == number).repartition(files).write.parquet(f"{path}/chunk={number}")
    rows.limit(0).write.parquet(f"{path}/chunk={BATCHES}")
    _LANDED[found] = path, files
    return path, files


def _files(counts: list[int]) -> int:
    """Files that each batch is written in, given the rows of each."""
    return max(FILES, min(-(-max(counts) // ROWS_PER_FILE), min(counts) // LEAST_ROWS))


def text_of(name: str) -> Column:
    """A money column as text without exponent."""
    return F.col(name).cast("decimal(18,2)").cast("string")


# --- orders with the order time as text in every layout that lands -----------------------

ORDER_TIME_TEXT_SQL = """
order_times AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS placed_at
  FROM orders
),
order_texts AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
    CASE o_orderkey % 8
      WHEN 0 THEN strftime(placed_at, '%Y-%m-%d')
      WHEN 1 THEN strftime(placed_at, '%Y-%m-%d:%H:%M:%S')
      WHEN 2 THEN strftime(placed_at, '%Y-%m-%d %H:%M:%S')
      WHEN 3 THEN strftime(placed_at, '%Y-%m-%d:%H:%M:%S') || '.123456'
      WHEN 4 THEN strftime(placed_at, '%Y-%m-%d %H:%M:%S') || '.123456'
      WHEN 5 THEN strftime(placed_at, '%Y-%m-%dT%H:%M:%S')
      WHEN 6 THEN 'unknown'
    END AS order_time
  FROM order_times
)
"""


def order_texts(orders: DataFrame) -> DataFrame:
    at = F.expr("timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)")
    layout = F.col("o_orderkey") % 8
    colon, blank = "yyyy-MM-dd:HH:mm:ss", "yyyy-MM-dd HH:mm:ss"
    text = (
        F.when(layout == 0, F.date_format(at, "yyyy-MM-dd"))
        .when(layout == 1, F.date_format(at, colon))
        .when(layout == 2, F.date_format(at, blank))
        .when(layout == 3, F.concat(F.date_format(at, colon), F.lit(".123456")))
        .when(layout == 4, F.concat(F.date_format(at, blank), F.lit(".123456")))
        .when(layout == 5, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(layout == 6, F.lit("unknown"))
    )
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", text.alias("order_time"))


# --- line items as they land: all text, several layouts of the shipping time --------------

LANDED_LINES_SQL = """
landed AS (
  SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS supplier,
    CASE l_orderkey % 4
      WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d:%H:%M:%S')
      WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '.000000'
    END AS shipped,
    CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS line_no,
    CASE WHEN l_returnflag = 'R' THEN 'it''s back; ' || chr(7) || '"' || l_linestatus || '"'
         ELSE l_returnflag || '\\' || l_linestatus END AS note,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price
  FROM lineitem
),
clean AS (
  SELECT part, supplier,
    CASE WHEN length(shipped) = 10 THEN shipped || ' 00:00:00.000000'
         WHEN length(shipped) = 19 THEN substr(shipped, 1, 10) || ' ' || substr(shipped, 12) || '.000000'
         WHEN length(shipped) = 26 THEN shipped
         ELSE '00-00-00 00:00:00.000000' END AS shipped,
    order_no, line_no, note, price
  FROM landed
)
"""


def landed_lines(lineitem: DataFrame) -> DataFrame:
    layout = F.col("l_orderkey") % 4
    shipped = (
        F.when(layout == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .when(layout == 1, F.date_format("l_shipdate", "yyyy-MM-dd:HH:mm:ss"))
        .when(layout == 2, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    note = F.when(
        F.col("l_returnflag") == "R",
        F.concat(F.lit("it's back; \u0007\""), "l_linestatus", F.lit('"')),
    ).otherwise(F.concat("l_returnflag", F.lit("\\"), "l_linestatus"))
    return lineitem.select(
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_suppkey").cast("string").alias("supplier"),
        shipped.alias("shipped"),
        F.col("l_orderkey").cast("string").alias("order_no"),
        F.col("l_linenumber").cast("string").alias("line_no"),
        note.alias("note"),
        text_of("l_extendedprice").alias("price"),
    )


# --- events as records of a topic, the value a nested JSON text ---------------------------

FEED_SQL = """
feed AS (
  SELECT event_id, user_id, event_type, value AS amount, ts,
    CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE 'account' END AS topic,
    CAST(user_id % 4 AS INTEGER) AS part,
    event_id % 50 >= 47 AS broken,
    CASE WHEN event_type = 'purchase' THEN 'CB' || event_id END AS chargeback_id,
    CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND event_id % 10 = 0)
         THEN 'FR' || event_id END AS fraud_id
  FROM events
),
routed AS (
  SELECT *,
    CASE WHEN broken THEN 'quarantine' WHEN chargeback_id IS NOT NULL THEN 'chargeback'
         WHEN fraud_id IS NOT NULL THEN 'fraud' ELSE 'asyncout' END AS route
  FROM feed
),
entities AS (
  SELECT event_id, 0 AS ordinal, 'card' AS entity_type, CAST(user_id AS VARCHAR) AS entity_id,
         event_id % 3 AS n_models, amount
  FROM feed WHERE NOT broken AND event_type <> 'signup'
  UNION ALL
  SELECT event_id, 1, 'merchant', event_type, 0, amount
  FROM feed WHERE NOT broken AND event_type <> 'signup'
)
"""


def feed(events: DataFrame) -> DataFrame:
    """Records of two topics.

    Malformed are those without closing brackets, with two documents in one text, with text
    after a bracket behind the document, and with a number that is none.
    """
    event_id = F.col("event_id").cast("string")
    event_time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    kind, number = F.col("event_type"), F.col("event_id")
    models = F.transform(
        F.slice(F.array(*map(F.lit, range(3))), 1, (number % 3).cast("int")),
        lambda i: F.struct(
            F.concat(F.lit("model-"), i.cast("string")).alias("modelId"),
            (F.col("value") * (i + 1)).alias("score"),
            F.array(kind).alias("tags"),
        ),
    )

    def entity(entity_type: str, entity_id: Column, entity_models: Column) -> Column:
        return F.struct(
            F.lit(entity_type).alias("entityType"),
            entity_id.alias("entityId"),
            entity_models.alias("models"),
            F.lit("no-risk").alias("riskStatus"),
        )

    card = entity("card", F.col("user_id").cast("string"), models)
    merchant = entity("merchant", kind, F.slice(models, 1, 0))
    both = F.array(card, merchant)
    event = F.struct(
        F.when(kind == "purchase", F.concat(F.lit("CB"), event_id)).alias("chargebackId"),
        F.when(
            (kind == "error") | ((kind == "purchase") & (number % 10 == 0)), F.concat(F.lit("FR"), event_id)
        ).alias("fraudTransactionId"),
        F.concat(F.lit("E-"), event_id).alias("eventId"),
        kind.alias("eventType"),
        event_time.alias("eventTime"),
        F.struct(F.col("value").alias("value"), F.lit("USD").alias("currency")).alias("internalAmount"),
        F.struct(kind.alias("merchantId"), F.concat(F.lit("City "), kind).alias("city")).alias("merchant"),
        F.concat(F.lit("ACCT-"), F.col("user_id").cast("string")).alias("accountNumber"),
    )
    record = F.to_json(
        F.struct(
            F.lit(1).alias("jsonVersion"),
            F.lit("feed").alias("processorId"),
            event_time.alias("outputTime"),
            event.alias("originatingEvent"),
            F.when(kind == "signup", F.slice(both, 1, 0)).otherwise(both).alias("entities"),
        )
    )
    events = events.select("*", record.alias("record"))  # a step of its own: the cases below would each hold the whole expression
    record = F.col("record")
    value = (
        F.when(number % 50 == 49, F.rtrim(record, F.lit("}")))
        .when(number % 150 == 48, F.concat(record, record))
        .when(number % 150 == 98, F.concat(record, F.lit("],["), record))
        .when(number % 150 == 148, F.concat(record, F.lit("] trailing")))
        .when(number % 50 == 47, F.replace(record, F.lit('"jsonVersion":1'), F.lit('"jsonVersion":"one"')))
        .otherwise(record)
    )
    return _as_records(events, value)


def plain_feed(events: DataFrame) -> DataFrame:
    """The same records with the short ``props`` text as value."""
    return _as_records(events, F.col("props"))


def _as_records(events: DataFrame, value: Column) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.when(F.col("event_type").isin("click", "view"), "browse").otherwise("account").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
