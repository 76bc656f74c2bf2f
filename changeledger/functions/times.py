"""Epoch, date and bucket conversions. All of them read the session zone as UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats understood or produced by the conversions below.
DATE_FORMAT = "yyyy-MM-dd"
DATE_TIME_NANOS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSSSS"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"
STAMP_FORMATS = ["yyyyMMddHH", "yyyyMMdd", "yyyyMM", "yyyy"]
BUCKET_UNITS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]
BUCKET_UNIT_SYNONYMS = ["dd", "mon", "mm", "yy", "yyyy"]


# The seconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59Z, the years that dates are written in.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def _micros(units: Column, each_second: int) -> Column:
    """A timestamp, or null outside the years 1 to 9999: an odd value must not end a job or read as a date."""
    whole = units.cast("bigint")
    in_years = whole.between(F.lit(FIRST_SECOND * each_second), F.lit(LAST_SECOND * each_second + each_second - 1))
    return F.timestamp_micros(F.when(in_years, whole * F.lit(1_000_000 // each_second).cast("bigint")))


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return _micros(ms, 1_000)


def epoch_seconds_to_timestamp(seconds: Column) -> Column:
    return _micros(seconds, 1)


def epoch_ms_to_second(ms: Column) -> Column:
    """Timestamp of the whole second, truncated toward zero."""
    return epoch_seconds_to_timestamp(F.call_function("div", ms, F.lit(1000)))


def now() -> Column:
    return F.current_timestamp()


def time_bucket(ms: Column, unit: str = "hour") -> Column:
    if unit.lower() not in BUCKET_UNITS + BUCKET_UNIT_SYNONYMS:
        raise ValueError(f"unknown time unit '{unit}', expected one of {', '.join(BUCKET_UNITS)}")
    return F.date_trunc(unit.lower(), epoch_ms_to_second(ms))


def epoch_ms_to_iso(ms: Column) -> Column:
    """ISO-8601 UTC text without milliseconds, such as 2017-07-14T02:40:00Z."""
    return F.date_format(epoch_ms_to_second(ms), ISO_FORMAT)


def epoch_ms_to_stamp(ms: Column, pattern: str) -> Column:
    """Compact UTC text in one of STAMP_FORMATS."""
    if pattern not in STAMP_FORMATS:
        raise ValueError(f"unknown format '{pattern}', expected one of {', '.join(STAMP_FORMATS)}")
    return F.date_format(epoch_ms_to_timestamp(ms), pattern)


def text_to_epoch_ms(text: Column, pattern: str = DATE_TIME_NANOS_FORMAT) -> Column:
    """UTC epoch milliseconds; null when the text does not have the pattern or lacks a time."""
    if not set("HhKk") & set(pattern):
        return F.lit(None).cast("bigint")
    return F.unix_millis(F.try_to_timestamp(text, F.lit(pattern)))


def text_to_date(text: Column, pattern: str = DATE_FORMAT) -> Column:
    """Date; null when the text does not have the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def local_to_epoch_ms(local: Column) -> Column:
    """A wall-clock value read as UTC, in epoch milliseconds."""
    return F.unix_millis(local.cast("timestamp"))


def bound_or_none(bound: Column) -> Column:
    """The date of a bound; the zero timestamp means there is no bound."""
    return F.nullif(bound, F.timestamp_seconds(F.lit(0))).cast("date")


def parse_bound(value: str | dt.date | None) -> dt.date | None:
    """A `since` / `until` argument as a date; a bad one is an error."""
    if value is None or isinstance(value, dt.date):
        return value
    try:
        return dt.datetime.strptime(value, "%Y-%m-%d").date()
    except ValueError as error:
        raise ValueError(f"invalid date '{value}', expected format is '{DATE_FORMAT}'") from error


def start_of_day_ms(day: dt.date) -> int:
    midnight = dt.datetime.combine(day, dt.time(), tzinfo=dt.timezone.utc)
    return int(midnight.timestamp()) * 1000


def within_range(
    ms: Column, since: str | dt.date | None = None, until: str | dt.date | None = None, whole_last_day: bool = False
) -> Column:
    """start of `since` <= ms <= start of `until`, each bound optional.

    The upper bound is the first instant of the `until` day, so later events of that day are out,
    unless the `whole_last_day` is asked for.
    """
    condition = F.lit(True)
    lower, upper = parse_bound(since), parse_bound(until)
    if lower is not None:
        condition = condition & (ms >= F.lit(start_of_day_ms(lower)))
    if upper is not None:
        last = start_of_day_ms(upper + dt.timedelta(days=1)) - 1 if whole_last_day else start_of_day_ms(upper)
        condition = condition & (ms <= F.lit(last))
    return condition
