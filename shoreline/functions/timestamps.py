"""Textual timestamps: one canonical 26-character layout, and pattern reformatting."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the canonical layout looks like and what stands for "no timestamp".
CANONICAL_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_LENGTH = 10
SECONDS_LENGTH = 19
MICROS_LENGTH = 26
MIDNIGHT_SUFFIX = " 00:00:00.000000"
MICROS_SUFFIX = ".000000"
SENTINEL = "00-00-00 00:00:00.000000"
BLANK = " "


@dataclass(frozen=True)
class TimestampMode:
    """What replaces a text that has none of the known lengths, and whether null may."""

    replacement: str
    null_fails: bool = False


STRICT = TimestampMode(SENTINEL, null_fails=True)
SENTINEL_MODE = TimestampMode(SENTINEL)
BLANK_MODE = TimestampMode(BLANK)
MODES = {"strict": STRICT, "sentinel": SENTINEL_MODE, "blank": BLANK_MODE}


def canonical_timestamp(
    text: Column | str, mode: TimestampMode = SENTINEL_MODE, *, validate: bool = False
) -> Column:
    """Bring a timestamp text to ``yyyy-MM-dd HH:mm:ss.SSSSSS``.

    Only the length decides the layout; a ``:`` between date and time becomes a blank. With
    ``validate`` a text of known length that is no calendar timestamp is replaced as well.
    """
    raw = F.col(text) if isinstance(text, str) else text
    length = F.char_length(raw)
    spaced = F.when(F.substring(raw, 11, 1) == ":", F.overlay(raw, F.lit(" "), 11)).otherwise(raw)
    known = (
        F.when(length == DATE_LENGTH, F.concat(raw, F.lit(MIDNIGHT_SUFFIX)))
        .when(length == SECONDS_LENGTH, F.concat(spaced, F.lit(MICROS_SUFFIX)))
        .when(length == MICROS_LENGTH, spaced)
    )
    if validate:
        known = F.when(as_timestamp(known).isNotNull(), known)
    result = F.coalesce(known, F.lit(mode.replacement))
    if mode.null_fails:
        result = F.when(raw.isNull(), F.raise_error(F.lit("timestamp text is null"))).otherwise(result)
    return result


def canonical_timestamps(
    df: DataFrame, columns: Iterable[str], mode: TimestampMode = SENTINEL_MODE, *, validate: bool = False
) -> DataFrame:
    """Replace every listed column by its canonical form, in one projection."""
    return df.withColumns({name: canonical_timestamp(name, mode, validate=validate) for name in columns})


def as_timestamp(text: Column | str, pattern: str = CANONICAL_PATTERN) -> Column:
    """The typed value, or null where the text does not fit the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def reformat_timestamp(text: Column | str, source_pattern: str, target_pattern: str) -> Column:
    """Parse with one pattern and print with another; null where parsing fails."""
    return F.date_format(as_timestamp(text, source_pattern), target_pattern)
