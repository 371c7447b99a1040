from datetime import datetime, timezone

import pytest
from helpers import at
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from servicerank.functions import clock

ZONES = ["UTC", "Europe/Lisbon", "America/New_York"]


def one(spark, column):
    """Value as text, so that the client's zone plays no part."""
    return spark.range(1).select(column.cast("string")).first()[0]


@pytest.mark.parametrize("zone", ZONES)
def test_parsing_does_not_depend_on_the_zone(spark, time_zone, zone):
    time_zone(zone)
    # 01:30 did not exist in Lisbon, 02:30 not in New York on these days.
    for text, want in [
        ("24/03/31 01:30:05", "2024-03-31 01:30:05"),
        ("24/03/10 02:30:05", "2024-03-10 02:30:05"),
    ]:
        for strict in (True, False):
            assert one(spark, clock.parse_snapshot_time(F.lit(text), strict)) == want
        assert one(spark, clock.minute_floor(clock.parse_snapshot_time(F.lit(text)))) == want[:-2] + "00"
        assert one(spark, clock.day_floor(clock.parse_snapshot_time(F.lit(text)))) == want[:10] + " 00:00:00"
        assert one(spark, clock.format_snapshot_time(clock.ntz(at(want)))) == text


def test_two_digit_years_pivot_at_69(spark):
    for text, year in [("68", "2068"), ("69", "1969"), ("99", "1999"), ("00", "2000")]:
        assert one(spark, clock.parse_snapshot_time(F.lit(f"{text}/02/03 00:00:00")))[:4] == year


def test_bad_text_fails_or_is_null(spark):
    for text in ["None", "24/13/01 00:00:00", "2024-03-04 10:00:00", "24/02/30 00:00:00"]:
        with pytest.raises(PySparkException):
            one(spark, clock.parse_snapshot_time(F.lit(text)))
        assert one(spark, clock.parse_snapshot_time(F.lit(text), strict=False)) is None


def test_epoch_nanos_round_to_the_second(spark):
    nanos = 1_709_546_399_500_000_000
    assert one(spark, clock.from_epoch_nanos(F.lit(nanos))) == "2024-03-04 10:00:00"
    assert one(spark, clock.from_epoch_nanos(F.lit(nanos - 1_000_000))) == "2024-03-04 09:59:59"


def test_minute_floor_before_1970(spark):
    assert one(spark, clock.minute_floor(clock.ntz(at("1969-12-31 23:59:30")))) == "1969-12-31 23:59:00"


def test_sunday_week(spark):
    # 2017 began on a Sunday, 2018 on a Monday.
    for day, week in [("2017-01-01", "1"), ("2018-01-01", "0"), ("2018-01-07", "1"), ("2017-12-31", "53")]:
        assert one(spark, clock.sunday_week(F.lit(day).cast("date"))) == week


def test_sunday_week_equals_strftime(spark):
    days = spark.sql("SELECT explode(sequence(date'2016-01-01', date'2030-12-31')) AS d")
    for r in days.select("d", clock.sunday_week(F.col("d")).alias("w")).collect():
        assert r.w == int(r.d.strftime("%U"))


def test_utc_now_ignores_the_zone(spark, time_zone):
    time_zone("Asia/Tokyo")
    got = at(one(spark, clock.utc_now()))
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - got).total_seconds()) < 60


@pytest.mark.parametrize("lo,hi", [
    ("2024-03-04 00:00:00", "2024-03-22 00:00:00"),
    ("2024-03-04 10:00:00.5", "2024-03-04 10:00:01.5"),
    ("1995-01-01 00:00:00", "2024-01-01 00:00:00"),
    ("1995-01-01 00:00:00", "2000-01-01 00:00:00"),
    ("1900-01-01 00:00:00", "2100-01-01 00:00:00"),
    ("2000-01-01 00:00:00", "2100-01-01 00:00:00"),
    ("1900-01-01 00:00:00", "1980-01-01 00:00:00"),
    ("2030-01-01 00:00:00", "2020-01-01 00:00:00"),
])
def test_text_range_equals_parsed_range(spark, lo, hi):
    texts = [
        f"{y:02d}/{m} {t}" for y in (0, 1, 20, 24, 68, 69, 70, 80, 95, 99) for m in ("01/01", "03/04", "12/31")
        for t in ("00:00:00", "10:00:00", "10:00:01", "10:00:02", "23:59:59")
    ]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    lo, hi = at(lo), at(hi)
    parsed = clock.parse_snapshot_time(F.col("x"))
    want = df.filter((parsed >= clock.ntz(lo)) & (parsed < clock.ntz(hi)))
    got = df.filter(clock.snapshot_time_between(F.col("x"), lo, hi))
    assert sorted(r.x for r in got.collect()) == sorted(r.x for r in want.collect())
