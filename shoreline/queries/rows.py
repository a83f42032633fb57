"""Queries over ranking, timestamps, profiles, unions and descriptors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.stamps import base_name, dir_name, event_date, file_stamp, joined_path, trimmed_list
from shoreline.functions.timestamps import (
    BLANK_MODE,
    SENTINEL_MODE,
    STRICT,
    canonical_timestamps,
    reformat_timestamp,
)
from shoreline.operators.dedup import latest_rows, latest_rows_counted, number_rows
from shoreline.operators.manifest import job_table, match_companions, number_files
from shoreline.operators.profile import column_profile, partition_profile, replaced_profile
from shoreline.operators.union import union_requests
from shoreline.queries.inputs import ORDER_TIME_TEXT_SQL, order_texts, table
from shoreline.queries.registry import query
from shoreline.sources.landing import landed_kind
from shoreline.sources.properties import job_properties, property_lines

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("""
SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_rows(table(spark, sf_dir, "events"), ["user_id"], ["ts"])
    return latest.select("event_id", "user_id", "event_type", "value", "props", F.date_format("ts", MICROS).alias("at"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS shipped
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_partkey, l_suppkey
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC,
           l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1
""")
def dedup_latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    latest = latest_rows(lines, ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return latest.withColumn("shipped", F.date_format("l_shipdate", "yyyy-MM-dd")).drop("l_shipdate")


@query("""
SELECT user_id, event_type, event_id, source_rows
FROM (SELECT user_id, event_type, event_id, ts, count(*) OVER (PARTITION BY user_id, event_type) AS source_rows
      FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def dedup_latest_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_rows_counted(
        table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts"], count_as="source_rows"
    )
    return latest.select("user_id", "event_type", "event_id", "source_rows")


@query("""
SELECT o_custkey, o_orderkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS place
FROM orders
QUALIFY place <= 3
""")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    numbered = number_rows(orders, ["o_custkey"], ["o_orderdate", "o_totalprice"], 3, into="place")
    return numbered.select("o_custkey", "o_orderkey", F.col("place").cast("bigint"))


@query("""
SELECT o_custkey, o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_text
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1
""")
def dedup_numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderkey").cast("string").alias("order_text")
    )
    return latest_rows(orders, ["o_custkey"], ["order_text"], casts={"order_text": "bigint"})


CANONICAL_SQL = """
SELECT o_orderkey,
  CASE WHEN length({text}) = 10 THEN {text} || ' 00:00:00.000000'
       WHEN length({text}) = 19 AND substr({text}, 11, 1) = ':'
         THEN substr({text}, 1, 10) || ' ' || substr({text}, 12) || '.000000'
       WHEN length({text}) = 19 THEN {text} || '.000000'
       WHEN length({text}) = 26 AND substr({text}, 11, 1) = ':'
         THEN substr({text}, 1, 10) || ' ' || substr({text}, 12)
       WHEN length({text}) = 26 THEN {text}
       ELSE '{replacement}' END AS order_time
FROM order_texts
"""


def _canonical_sql(replacement: str, text: str = "order_time") -> str:
    return f"WITH {ORDER_TIME_TEXT_SQL}" + CANONICAL_SQL.format(text=text, replacement=replacement)


@query(_canonical_sql("00-00-00 00:00:00.000000", "coalesce(order_time, '')"))
def ts_canonical_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(table(spark, sf_dir, "orders")).fillna("", ["order_time"])
    return canonical_timestamps(texts, ["order_time"], STRICT).select("o_orderkey", "order_time")


@query(_canonical_sql("00-00-00 00:00:00.000000"))
def ts_canonical_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(table(spark, sf_dir, "orders"))
    return canonical_timestamps(texts, ["order_time"], SENTINEL_MODE).select("o_orderkey", "order_time")


@query(_canonical_sql(" "))
def ts_canonical_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(table(spark, sf_dir, "orders"))
    return canonical_timestamps(texts, ["order_time"], BLANK_MODE).select("o_orderkey", "order_time")


@query(f"""
WITH {ORDER_TIME_TEXT_SQL}
SELECT o_orderkey, strftime(try_strptime(order_time, '%Y-%m-%d:%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS order_time
FROM order_texts
""")
def ts_reformat_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(table(spark, sf_dir, "orders"))
    return texts.select(
        "o_orderkey",
        reformat_timestamp("order_time", "yyyy-MM-dd:HH:mm:ss", "yyyy-MM-dd HH:mm:ss").alias("order_time"),
    )


@query(f"""
WITH {ORDER_TIME_TEXT_SQL}
SELECT o_orderkey, '/out/' || strftime(placed_at, '%Y-%m-%d') AS folder,
       strftime(placed_at, '%Y-%m-%d_%H_%M_%S') || '.csv' AS file_name, 'data' AS kind, o_orderstatus || '/' || o_orderpriority AS listed
FROM order_times
""")
def stamped_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths from run stamps, taken apart again."""
    at = F.expr("timestampadd(SECOND, CAST(o_orderkey % 86400 AS INT), o_orderdate)")
    name = F.concat(file_stamp(at), F.lit(".csv"))
    paths = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        joined_path(F.lit("/out"), event_date(at), name).alias("path"),
        F.concat(F.lit(" "), "o_orderstatus", F.lit(" ,"), "o_orderpriority", F.lit(" ")).alias("list"),
    )
    return paths.select(
        "o_orderkey",
        dir_name("path").alias("folder"),
        base_name("path").alias("file_name"),
        landed_kind("path", {"data": "*.csv"}).alias("kind"),
        F.array_join(trimmed_list("list"), "/").alias("listed"),
    )


@query(f"""
WITH {ORDER_TIME_TEXT_SQL}
SELECT 'order_time' AS column_name, count(*) AS rows,
       count(*) FILTER (order_time IS NULL) AS nulls,
       count(*) FILTER (length(order_time) = 10) AS dates,
       count(*) FILTER (length(order_time) = 19) AS seconds,
       count(*) FILTER (length(order_time) = 26) AS micros,
       count(*) FILTER (length(order_time) NOT IN (10, 19, 26)) AS unknown
FROM order_texts
UNION ALL
SELECT 'o_orderpriority', count(*), count(*) FILTER (o_orderpriority IS NULL),
       count(*) FILTER (length(o_orderpriority) = 10), count(*) FILTER (length(o_orderpriority) = 19),
       count(*) FILTER (length(o_orderpriority) = 26),
       count(*) FILTER (length(o_orderpriority) NOT IN (10, 19, 26))
FROM order_texts
""")
def column_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_profile(order_texts(table(spark, sf_dir, "orders")), ["order_time", "o_orderpriority"])


@query(f"""
WITH {ORDER_TIME_TEXT_SQL}
SELECT 'order_time' AS column_name, count(*) AS rows,
       count(*) FILTER (order_time IS NULL OR length(order_time) NOT IN (10, 19, 26)) AS replaced
FROM order_texts
""")
def replaced_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = order_texts(table(spark, sf_dir, "orders"))
    return replaced_profile(canonical_timestamps(texts, ["order_time"]), ["order_time"])


@query("SELECT count(*) AS rows, 4 AS partitions FROM orders")
def partition_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = table(spark, sf_dir, "orders").select("o_orderkey").repartition(4, "o_orderkey")
    return partition_profile(spread).agg(
        F.sum("rows").alias("rows"), F.count("partition").cast("int").alias("partitions")
    )


@query("""
SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS props, 'bought' AS source
FROM events WHERE event_type = 'purchase'
UNION ALL
SELECT event_id, user_id, CAST(NULL AS DOUBLE), props, 'failed' FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, user_id, value, props, 'large' FROM events WHERE value > 50
""")
def union_of_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    sources = {
        "bought": events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "value"),
        "failed": events.filter(F.col("event_type") == "error").select("event_id", "user_id", "props"),
        "large": events.filter(F.col("value") > 50).select("event_id", "user_id", "value", "props"),
        "joined": events.filter(F.col("event_type") == "signup"),
    }
    return union_requests(sources, "bought, failed,large")


@query("""
SELECT s_name AS job, '/in|part/' || s_suppkey AS "SRC_FILE_PATH", s_name || '_data.dsv' AS "SRC_FILE_NM",
       'NATION_' || s_nationkey AS "TBL_NAME", '' AS "TIME_COLS", '_c0, _c1' AS "Dedup_Key",
       CAST(NULL AS VARCHAR) AS "PART_CAL_VAL"
FROM supplier
""")
def properties_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["SRC_FILE_PATH", "SRC_FILE_NM", "TBL_NAME", "TIME_COLS", "Dedup_Key", "PART_CAL_VAL"]
    return job_properties(_supplier_descriptors(spark, sf_dir), "|", keys).drop("properties")


@query("""
SELECT s_name AS job, CAST(line AS INTEGER) AS line, key,
       CASE line WHEN 1 THEN '/in|part/' || s_suppkey WHEN 2 THEN s_name || '_data.dsv'
                 WHEN 6 THEN 'NATION_' || s_nationkey ELSE fixed END AS value
FROM supplier CROSS JOIN (VALUES
  (0, 'TBL_NAME', 'first'), (1, 'SRC_FILE_PATH', NULL), (2, 'SRC_FILE_NM', NULL), (3, 'TIME_COLS', ''),
  (5, 'Dedup_Key', '_c0, _c1'), (6, 'TBL_NAME', NULL)) p(line, key, fixed)
""")
def properties_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return property_lines(_supplier_descriptors(spark, sf_dir), "|")


def _supplier_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One descriptor text per supplier, with a repeated key and a line that is no property."""
    name, number = F.col("s_name"), F.col("s_suppkey").cast("string")
    lines = [
        F.lit("TBL_NAME|first"),
        F.concat(F.lit("SRC_FILE_PATH|/in|part/"), number),
        F.concat(F.lit("SRC_FILE_NM|"), name, F.lit("_data.dsv")),
        F.lit("TIME_COLS|"),
        F.lit("a line without separator"),
        F.lit("Dedup_Key|_c0, _c1"),
        F.concat(F.lit("TBL_NAME|NATION_"), F.col("s_nationkey").cast("string")),
    ]
    return table(spark, sf_dir, "supplier").select(name.alias("job"), F.concat_ws("\n", *lines).alias("text"))


LANDED_PARTS_SQL = """
names AS (
  SELECT p_partkey, p_size, p_brand, upper(replace(p_name, ' ', '_')) AS tbl,
    '/landing/' || p_brand || '/' AS folder,
    CASE WHEN p_partkey % 10 = 9 THEN 'short_' || p_partkey
         ELSE 'ab_' || p_size || '_' || upper(replace(p_name, ' ', '_')) || '_20190101_120000_' || p_partkey END AS stem
  FROM part
),
named AS (
  SELECT *, folder || stem || '_data.dsv' AS path,
    CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE tbl END AS table_name
  FROM names
),
with_schema AS (SELECT DISTINCT folder, tbl FROM named WHERE p_size > 45)
"""


@query(f"""
WITH {LANDED_PARTS_SQL}
SELECT row_number() OVER (ORDER BY path) || '00' AS tbl_id, stem || '_data.dsv' AS file_name,
       table_name, 'PROD4.' || table_name || '.schema' AS schema_name, stem || '.stats' AS stats_name,
       EXISTS (SELECT 1 FROM with_schema w WHERE w.folder = named.folder AND w.tbl = named.table_name) AS has_schema,
       p_size > 10 AS has_stats,
       p_size > 48 AS zero_byte
FROM named
""")
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_files(match_companions(_landed_parts(spark, sf_dir))).select(
        "tbl_id", "file_name", "table_name", "schema_name", "stats_name", "has_schema", "has_stats", "zero_byte"
    )


@query(f"""
WITH {LANDED_PARTS_SQL}
SELECT row_number() OVER (ORDER BY path) || '00' AS tbl_id, stem || '_data.dsv' AS "SRC_FILE_NM",
       'PROD4.' || table_name || '.schema' AS "SRC_FILE_SCHEMA_NM", stem || '.stats' AS "SRC_FILE_STATS_NM",
       '/out' AS "TAR_FILE_PATH", '/copies' AS "SRC_FILE_PATH", table_name AS "TBL_NAME",
       '/copies/' || stem || '_data.dsv' AS source_file
FROM named
""")
def job_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_table(match_companions(_landed_parts(spark, sf_dir)), "/copies", "/out")


def _landed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory with one data file per part; some partners are missing."""
    number = F.col("p_partkey").cast("string")
    tbl = F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    stem = F.when(F.col("p_partkey") % 10 == 9, F.concat(F.lit("short_"), number)).otherwise(
        F.concat_ws("_", F.lit("ab"), F.col("p_size").cast("string"), tbl, F.lit("20190101_120000"), number)
    )
    parts = table(spark, sf_dir, "part").select(
        "p_size", tbl.alias("tbl"), F.concat(F.lit("/landing/"), "p_brand", F.lit("/")).alias("folder"), stem.alias("stem")
    )
    data = parts.select(
        F.concat("folder", "stem", F.lit("_data.dsv")).alias("path"),
        F.lit("data").alias("kind"),
        (F.col("p_size") > 48).alias("zero_byte"),
    )
    stats = parts.filter(F.col("p_size") > 10).select(
        F.concat("folder", "stem", F.lit(".stats")).alias("path"), F.lit("stats").alias("kind"), F.lit(False)
    )
    schemas = parts.filter(F.col("p_size") > 45).select(
        F.concat("folder", F.lit("PROD4."), "tbl", F.lit(".schema")), F.lit("schema"), F.lit(False)
    )
    return data.union(stats).union(schemas)
