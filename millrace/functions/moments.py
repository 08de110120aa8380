"""Dates, times and window bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WALL_CLOCK = "yyyy-MM-dd HH:mm:ss"


def from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds to an event-time timestamp."""
    return F.timestamp_millis(F.col(ms) if isinstance(ms, str) else ms)


def from_millis_whole_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_seconds(F.floor(ms / 1000))


def from_wall_clock(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp; unreadable text gives null."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(WALL_CLOCK))


def event_time(df: DataFrame, name: str) -> Column:
    """A time column as a timestamp, whether it is stored as text or as a timestamp."""
    kind = df.schema[name].dataType.typeName()
    return from_wall_clock(name) if kind == "string" else F.col(name).cast("timestamp")


def to_wall_clock(ts: Column | str) -> Column:
    return F.date_format(ts, WALL_CLOCK)


def day_of(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_of(ts: Column | str) -> Column:
    return F.date_format(ts, "HH")


def day_of_text(text: Column | str) -> Column:
    """Day part of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.split_part(F.col(text) if isinstance(text, str) else text, F.lit(" "), F.lit(1))


def hour_of_text(text: Column | str) -> Column:
    """Hour part of a ``yyyy-MM-dd HH:mm:ss`` text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))


def age_in_years(birthday: Column | str, as_of: Column | str) -> Column:
    """Whole 365-day spans between two dates."""
    birthday = F.col(birthday) if isinstance(birthday, str) else birthday
    as_of = F.lit(as_of) if isinstance(as_of, str) else as_of
    days = F.datediff(as_of.cast("date"), birthday.try_cast("date"))
    return F.floor(days / 365).cast("int")


def minute_bucket(ms: Column | str) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(ms / 60000)


def wall_clock_now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def with_window_bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window struct by its text bounds ``stt`` and ``edt``."""
    return df.select(
        to_wall_clock(F.col(window)["start"]).alias("stt"),
        to_wall_clock(F.col(window)["end"]).alias("edt"),
        *[c for c in df.columns if c != window],
    )
