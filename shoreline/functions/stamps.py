"""Run stamps, partition dates and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layouts of run stamps.
FILE_STAMP_PATTERN = "yyyy-MM-dd_HH_mm_ss"


def file_stamp(at: Column | None = None) -> Column:
    """A stamp that is safe inside a path."""
    return F.date_format(at if at is not None else F.current_timestamp(), FILE_STAMP_PATTERN)


def arrival_date() -> Column:
    """Today as text.

    In a streaming plan Spark evaluates this to the batch time kept in the offset log, so a
    replayed batch gets the date of its first run.
    """
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def event_date(at: Column | str) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def joined_path(*parts: Column | str) -> Column:
    return F.concat_ws("/", *parts)


def base_name(path: Column | str) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column | str) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def trimmed_list(text: Column | str, separator: str = ",") -> Column:
    """Split a configured list and trim each entry."""
    return F.transform(F.split(text, f"\\Q{separator}\\E"), lambda entry: F.trim(entry))
