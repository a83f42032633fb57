"""One result from several requested sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_requests(sources: Mapping[str, DataFrame], requests: str, tag: str = "source") -> DataFrame:
    """All rows of the requested sources, tagged with the source's name.

    ``requests`` is a comma list. Columns match by name and a missing one is null. It is one
    plan, so Spark runs all branches side by side.
    """
    names = [name.strip() for name in requests.split(",") if name.strip()]
    unknown = sorted(set(names) - set(sources))
    if unknown or not names:
        raise ValueError(f"no such source: {', '.join(unknown) or '(empty request list)'}")
    parts = [sources[name].withColumn(tag, F.lit(name)) for name in names]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
