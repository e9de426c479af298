"""Column expressions shared by the layers.

All of them are built-in Spark functions, so they stay inside whole-stage
codegen; none needs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

# Text formats the upstream systems use.
WATCHLIST_TIME_FORMAT = "dd-MMM-yyyy HH:mm:ss"
OPEN_DATE_FORMAT = "yyyy-MM-dd"
WATCHLIST_ID_PATTERN = r"^WL([0-9]+)$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def alert_id(prefix: str, *parts: str | Column) -> Column:
    """``PREFIX-part1-part2``; a NULL part is skipped, as ``concat_ws`` does."""
    return F.concat_ws("-", F.lit(prefix), *[_col(p) for p in parts])


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name joined by a space, NULL parts skipped."""
    return F.concat_ws(" ", _col(first), _col(last))


def parse_watchlist_time(c: str | Column) -> Column:
    """Watchlist ``effective_from`` text to a timestamp; bad text gives NULL.

    ``try_`` keeps one malformed record from stopping a stream under ANSI
    mode (the default in Spark 4).
    """
    return F.try_to_timestamp(_col(c), F.lit(WATCHLIST_TIME_FORMAT))


def parse_open_date(c: str | Column) -> Column:
    """Customer ``account_open_date`` text to a date; bad text gives NULL."""
    return F.try_to_date(_col(c), OPEN_DATE_FORMAT)


def watchlist_number(c: str | Column) -> Column:
    """Numeric part of a ``WL<digits>`` id as a long, else NULL."""
    digits = F.regexp_extract(_col(c), WATCHLIST_ID_PATTERN, 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def money(c: str | Column) -> Column:
    """Thousands separators and two decimals, e.g. ``12,345.60``."""
    return F.format_number(_col(c), 2)


def yes_no(c: str | Column) -> Column:
    """``Yes`` for true, ``No`` for false or NULL."""
    return F.when(_col(c), F.lit("Yes")).otherwise(F.lit("No"))


def html_text(c: str | Column) -> Column:
    """Escape ``& < > "`` so a field value cannot break the markup.

    NULL renders as the empty string.
    """
    escaped = _col(c).cast("string")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(entity))
    return F.coalesce(escaped, F.lit(""))


def event_time(c: str | Column) -> Column:
    """A wall-clock ``timestamp_ntz`` as an instant (watermarks need one)."""
    return _col(c).cast(TimestampType())


def wall_clock(df: DataFrame) -> DataFrame:
    """Turn every timestamp column back into ``timestamp_ntz``.

    Used on the way out so results compare with engines that keep
    timestamps without a zone.
    """
    return df.select([
        F.col(f"`{f.name}`").cast(TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
