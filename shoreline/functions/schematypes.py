"""Type names of schema files translated to Spark DDL types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and the type each becomes, applied in this order.
TYPE_PATTERNS = (
    (r".*int\d{0,}", "int"),
    (r".*string\[.*\]", "string"),
    (r".*timestamp\[.*\]", "timestamp"),
    (r".*date\d{0,}", "date"),
)
# Ours: a decimal written with brackets becomes valid DDL instead of staying as it is.
DECIMAL_PATTERN = (r".*decimal\[\s*(\d+)\s*,\s*(\d+)\s*\]", "decimal($1,$2)")


def ddl_type(type_text: Column | str) -> Column:
    result = F.col(type_text) if isinstance(type_text, str) else type_text
    for pattern, replacement in (*TYPE_PATTERNS, DECIMAL_PATTERN):
        result = F.regexp_replace(result, pattern, replacement)
    return result
