import datetime as dt

import pytest
from pyspark.sql import functions as F

from changeledger.functions import times

NOON = 1514808000000  # 2018-01-01T12:00Z


@pytest.fixture
def value(spark):
    def compute(column):
        return spark.range(1).select(column).collect()[0][0]

    return compute


@pytest.mark.parametrize(
    "unit, expected",
    [
        ("second", dt.datetime(2019, 5, 15, 13, 47, 9)),
        ("minute", dt.datetime(2019, 5, 15, 13, 47)),
        ("hour", dt.datetime(2019, 5, 15, 13)),
        ("day", dt.datetime(2019, 5, 15)),
        ("week", dt.datetime(2019, 5, 13)),
        ("month", dt.datetime(2019, 5, 1)),
        ("QUARTER", dt.datetime(2019, 4, 1)),
        ("year", dt.datetime(2019, 1, 1)),
        ("mon", dt.datetime(2019, 5, 1)),
    ],
)
def test_buckets(value, unit, expected):
    ms = int(dt.datetime(2019, 5, 15, 13, 47, 9, 987000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert value(times.time_bucket(F.lit(ms), unit).cast("timestamp_ntz")) == expected


def test_times_before_1970_truncate_toward_zero(value):
    assert value(times.epoch_ms_to_second(F.lit(-1500)).cast("timestamp_ntz")) == dt.datetime(1969, 12, 31, 23, 59, 59)


def test_iso_text(value):
    assert value(times.epoch_ms_to_iso(F.lit(1500000000999))) == "2017-07-14T02:40:00Z"


@pytest.mark.parametrize(
    "pattern, expected", [("yyyyMMddHH", "2018010112"), ("yyyyMMdd", "20180101"), ("yyyyMM", "201801"), ("yyyy", "2018")]
)
def test_stamps(value, pattern, expected):
    assert value(times.epoch_ms_to_stamp(F.lit(NOON), pattern)) == expected


def test_unknown_stamp():
    with pytest.raises(ValueError):
        times.epoch_ms_to_stamp(F.lit(NOON), "MMM")


def test_text_to_epoch(value):
    text = F.lit("2018-01-01 12:00:00.000000000")
    assert value(times.text_to_epoch_ms(text)) == NOON
    assert value(times.text_to_epoch_ms(text, times.DATE_FORMAT)) is None
    assert value(times.text_to_epoch_ms(F.lit("2018-01-01"), times.DATE_FORMAT)) is None
    assert value(times.text_to_epoch_ms(F.lit("soon"))) is None


def test_text_to_date(value):
    assert value(times.text_to_date(F.lit("2018-01-01"))) == dt.date(2018, 1, 1)
    assert value(times.text_to_date(F.lit("2018-02-31"))) is None
    assert value(times.text_to_date(F.lit("01/01/2018"))) is None


def test_local_time_is_read_as_utc(value):
    assert value(times.local_to_epoch_ms(F.lit(dt.datetime(2018, 1, 1, 12)).cast("timestamp_ntz"))) == NOON


def test_epoch_to_timestamp(value):
    assert value(times.epoch_ms_to_timestamp(F.lit(NOON + 7)).cast("timestamp_ntz")) == dt.datetime(2018, 1, 1, 12, 0, 0, 7000)
    assert value(times.epoch_seconds_to_timestamp(F.lit(NOON // 1000)).cast("timestamp_ntz")) == dt.datetime(2018, 1, 1, 12)


def test_now(value):
    assert abs(value(F.unix_millis(times.now())) - dt.datetime.now().timestamp() * 1000) < 60_000


def test_zero_bound(value):
    assert value(times.bound_or_none(F.timestamp_millis(F.lit(0)))) is None
    assert value(times.bound_or_none(F.timestamp_millis(F.lit(NOON)))) == dt.date(2018, 1, 1)


def test_bad_bound_is_an_error():
    assert times.parse_bound(None) is None
    assert times.parse_bound("2018-01-01") == dt.date(2018, 1, 1)
    with pytest.raises(ValueError, match="invalid date"):
        times.parse_bound("01/01/2018")


def test_times_out_of_range_become_null(spark):
    """A nanosecond stamp in place of milliseconds must not end a job."""
    df = spark.createDataFrame([(1_700_000_000_123_456_789,), (-9_223_372_036_854_775_808,), (1_700_000_000_123,)], "ms long")
    shown = df.select(
        times.time_bucket(F.col("ms"), "day").alias("bucket"), times.epoch_ms_to_iso(F.col("ms")).alias("iso"),
        times.epoch_ms_to_stamp(F.col("ms"), "yyyyMMdd").alias("stamp"), times.epoch_seconds_to_timestamp(F.col("ms")).alias("seconds"),
    ).collect()
    assert [r.bucket is None for r in shown] == [True, True, False] and [r.iso is None for r in shown] == [True, True, False]
    assert shown[2].stamp == "20231114" and shown[0].seconds is None
