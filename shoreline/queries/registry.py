"""Where queries and their SQL twins are registered by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

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
