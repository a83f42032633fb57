"""Nested JSON events: parsing, routing, wide rows and child tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from shoreline.sources.records import CORRUPT_FIELD, field_type, is_one_document, parse_json, with_corrupt_field

# The event layout.
EVENT_SCHEMA = """
    jsonVersion int,
    processorId string,
    outputTime timestamp,
    originatingEvent struct<
        originalTransactionDate: timestamp,
        caseId: string,
        chargebackId: string,
        chargebackReasonCode: string,
        chargebackType: string,
        fraud: boolean,
        fraudReasonCodeId: string,
        fraudTransactionId: string,
        schemaVersion: int,
        eventId: string,
        eventType: string,
        eventTime: timestamp,
        transactionId: string,
        transactionType: string,
        internalAmount: struct<value: double, currency: string, baseValue: double, baseCurrency: string>,
        mop: string,
        mcc: string,
        merchant: struct<
            merchantId: string, city: string, countryCode: string, name: string,
            postalCode: string, state: string, street: string>,
        tenantId: string,
        tenantHierarchy: struct<orgId: string, pgId: string>,
        cardType: struct<fundingSource: string, product: string, reloadable: string>,
        accountNumber: string,
        bin: string,
        expDate: string,
        issuerCountryId: string,
        descriptor: string,
        _metadata: struct<
            systemEventId: string, receivedTime: timestamp, eventTime: timestamp,
            eventId: string, eventType: string, tenantId: string, tenantGroupId: string,
            execution: struct<expectResponse: boolean>,
            searchable: struct<merchantId: string, bin: string, tenantId: string, fraudTransactionId: string>,
            accountNumber: string,
            entities: struct<merchant: array<string>, card: array<string>>>>,
    entities array<struct<
        entityType: string,
        entityId: string,
        overallScore: struct<overallScore: double>,
        models: array<struct<modelId: string, score: double, confidence: double, tags: array<string>>>,
        outputTags: array<string>,
        riskStatus: string,
        configGroups: array<string>>>,
    versions struct<modelGraph: int, configGroups: array<struct<type: string, version: string>>>
"""
# Which non-null field sends an event where, in this order.
ROUTES = (
    ("chargeback", "originatingEvent.chargebackId"),
    ("fraud", "originatingEvent.fraudTransactionId"),
)
DEFAULT_ROUTE = "asyncout"
QUARANTINE = "quarantine"


def parse_events(
    records: DataFrame, schema: StructType | str = EVENT_SCHEMA, value: str = "value", into: str = "event"
) -> DataFrame:
    """Add the parsed record as one struct column; the text stays for the quarantine.

    A text with anything after its JSON document, or with a value that does not fit the
    schema, is malformed as a whole: it has no fields, only its text. The one-element
    array makes Spark parse in an operator of its own. As a plain column, any filter on the
    parsed fields would be pushed below it and parse every record once more.
    """
    both = F.struct(parse_json(value, schema).alias("event"), is_one_document(value).alias("whole"))
    parsed = records.select("*", F.explode_outer(F.array(both)).alias(into))
    corrupt = F.coalesce(F.col(f"{into}.event.{CORRUPT_FIELD}"), F.when(~F.col(f"{into}.whole"), F.col(value)))
    without_fields = F.from_json(F.lit("{}"), with_corrupt_field(schema)).withField(CORRUPT_FIELD, corrupt)
    return parsed.withColumn(into, F.when(corrupt.isNull(), F.col(f"{into}.event")).otherwise(without_fields))


def route_of(
    event: str = "event",
    rules: Sequence[tuple[str, str]] = ROUTES,
    default: str = DEFAULT_ROUTE,
) -> Column:
    """The first route whose field is present. Malformed and missing records are quarantined."""
    broken = F.col(event).isNull() | F.col(f"{event}.{CORRUPT_FIELD}").isNotNull()
    route = F.when(broken, F.lit(QUARANTINE))
    for name, path in rules:
        route = route.when(F.col(f"{event}.{path}").isNotNull(), F.lit(name))
    return route.otherwise(F.lit(default))


def route_events(
    events: DataFrame,
    event: str = "event",
    rules: Sequence[tuple[str, str]] = ROUTES,
    default: str = DEFAULT_ROUTE,
) -> DataFrame:
    """Add ``route``: one pass for all routes, and every record has exactly one."""
    return events.withColumn("route", route_of(event, rules, default))


def project_paths(df: DataFrame, paths: Mapping[str, str], missing_type: str = "string") -> DataFrame:
    """Select ``{alias: dotted path}``; a path the schema lacks becomes a typed null."""
    return df.select(*[path_column(df, path, missing_type).alias(alias) for alias, path in paths.items()])


def path_column(df: DataFrame, path: str, missing_type: str = "string") -> Column:
    if field_type(df.schema, path) is None:
        return F.lit(None).cast(missing_type)
    return F.col(path)


def flatten_struct(df: DataFrame, root: str, *, keep: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """A wide row: every field below ``root`` that is no struct, named by its path with ``_``.

    Arrays stay as they are; :func:`explode_child` makes tables of them.
    """
    struct = field_type(df.schema, root)
    if not isinstance(struct, StructType):
        raise ValueError(f"{root} is no struct")
    leaves = [F.col(f"{root}.{path}").alias(prefix + path.replace(".", "_")) for path in _leaf_paths(struct)]
    return _accepted(df, root).select(*keep, *leaves)


def _accepted(df: DataFrame, path: str) -> DataFrame:
    """Without the records that are quarantined: wide rows and child tables hold none of them."""
    root = path.split(".")[0]
    if field_type(df.schema, f"{root}.{CORRUPT_FIELD}") is None:
        return df
    return df.where(F.col(root).isNotNull() & F.col(f"{root}.{CORRUPT_FIELD}").isNull())


def _leaf_paths(struct: StructType, below: str = "") -> list[str]:
    paths = []
    for field in struct:
        if isinstance(field.dataType, StructType):
            paths += _leaf_paths(field.dataType, f"{below}{field.name}.")
        else:
            paths.append(below + field.name)
    return paths


def explode_child(
    df: DataFrame,
    path: str,
    parent_keys: Mapping[str, str] | Sequence[str],
    *,
    ordinal: str = "ordinal",
    outer: bool = False,
) -> DataFrame:
    """A child table: parent keys, the element's place from 0, and the element's fields.

    ``parent_keys`` are column names, or ``{alias: dotted path}``. With ``outer`` a parent
    without elements keeps one row of nulls. Works on its own result for arrays inside elements.
    """
    array = field_type(df.schema, path)
    if not isinstance(array, ArrayType):
        raise ValueError(f"{path} is no array")
    keys = parent_keys.items() if isinstance(parent_keys, Mapping) else [(key, key) for key in parent_keys]
    elements = F.posexplode_outer(path).alias(ordinal, "_element")
    rows = _accepted(df, path).select(*[F.col(source).alias(name) for name, source in keys], elements)
    if not outer:
        # Dropping them afterwards keeps Spark from evaluating the array twice, once to
        # filter for elements and once to explode them.
        rows = rows.filter(F.col(ordinal).isNotNull())
    if isinstance(array.elementType, StructType):
        element = [F.col(f"_element.{name}").alias(name) for name in array.elementType.names]
    else:
        element = [F.col("_element").alias("value")]
    return rows.select(*[name for name, _ in keys], ordinal, *element)


def record_envelope(records: DataFrame, at: Column | None = None) -> DataFrame:
    """Value and offset with the time and date of handling."""
    clock = at if at is not None else F.current_timestamp()
    return records.select(
        "value",
        "offset",
        F.date_format(clock, "HH:mm:ss").alias("handled_time"),
        F.date_format(clock, "yyyy-MM-dd").alias("handled_date"),
    )


def record_text() -> Column:
    """A whole record as one JSON line; line feeds inside a value are escaped."""
    record = F.struct("topic", "partition", "offset", "timestamp", "key", "value")
    return F.to_json(record, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"})
