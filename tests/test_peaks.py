import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from servicerank.operators.imputation import impute_group_mean
from servicerank.operators.peaks import (
    daily_max_in_peak, metric_in_peak, peak_bucket, ranked_buckets, rush_wait,
)
from servicerank.plans.catalog import QUERIES

BY = {"entity": "id", "period": "dow", "bucket": "hour", "day": "day"}


def frame(spark, data):
    return spark.createDataFrame(data, "id long, day int, dow int, hour int, load long, wait long")


def brute_force_peaks(data):
    daily = defaultdict(list)
    for i, day, dow, hour, load, _ in data:
        daily[i, dow, hour, day].append(load)
    means = defaultdict(list)
    for (i, dow, hour, _), loads in daily.items():
        known = [x for x in loads if x is not None]
        means[i, dow, hour].append(max(known) if known else None)
    best = {}
    for (i, dow, hour), maxima in means.items():
        known = [x for x in maxima if x is not None]
        mean = Fraction(sum(known), len(known)) if known else None
        rank = (mean is None, -mean if mean is not None else 0, hour)
        best[i, dow] = min(best.get((i, dow), rank), rank)
    return {key: rank[2] for key, rank in best.items()}


def brute_force_waits(data):
    known = defaultdict(list)
    for *_, load, wait in data:
        if wait is not None:
            known[load].append(wait)
    peaks = brute_force_peaks(data)
    daily = defaultdict(list)
    for i, day, dow, hour, load, wait in data:
        if peaks[i, dow] != hour:
            continue
        if wait is None and known[load]:
            wait = Fraction(sum(known[load]), len(known[load]))
        daily[i, day].append(wait)
    result = defaultdict(list)
    for (i, _), waits in daily.items():
        filled = [w for w in waits if w is not None]
        result[i].append(max(filled) if filled else None)
    return {
        i: math.ceil(Fraction(sum(filled), 60 * len(filled))) if (filled := [w for w in waits if w is not None]) else None
        for i, waits in result.items()
    }


def sample(seed, n=3000, hot=False):
    """Random rows; with `hot`, a third of them are one point, hour and load."""
    rng = random.Random(seed)
    data = []
    for row in range(n):
        day = rng.randrange(21)
        data.append((
            rng.randrange(6), day, day % 7 + 1, rng.randrange(4),
            rng.choice([None, -3, *range(9), 10**9]), rng.choice([None, None, 60 * rng.randrange(30), rng.randrange(900)]),
        ))
        if hot and row % 2 == 0:
            data.append((1, 3, 4, 2, 10**9, None))
    return data


def steps(df, **options):
    filled = impute_group_mean(df, "wait", "load", "filled", scale=1, **options)
    return metric_in_peak(filled, peak_bucket(df, **BY, metric="load"), **BY, metric="filled", output="out", scale=60)


def fused(df, **_):
    # Hours numbered as day, day of week and hour, one digit and two digits.
    slots = df.withColumn("slot", (F.col("day") * 10 + F.col("dow")) * 100 + F.col("hour"))
    period, bucket = F.floor(F.col("slot") / 100) % 10, F.col("slot") % 100
    return rush_wait(slots, "id", "slot", period, bucket, "load", "wait", "out")


def test_equal_hours_go_to_the_smaller(spark):
    data = [(1, 1, 2, 9, 5, 0), (1, 1, 2, 8, 5, 0), (1, 1, 2, 10, 4, 0), (1, 2, 3, 7, 1, 0)]
    assert rows(peak_bucket(frame(spark, data), **BY, metric="load")) == [(1, 2, 8), (1, 3, 7)]


def test_unknown_loads_rank_last(spark):
    data = [(1, 1, 2, 8, None, 0), (1, 1, 2, 9, 0, 0), (2, 1, 2, 9, None, 0), (2, 1, 2, 8, None, 0)]
    assert rows(peak_bucket(frame(spark, data), **BY, metric="load")) == [(1, 2, 9), (2, 2, 8)]


def test_days_count_by_their_maximum(spark):
    # Hour 8: maxima 10 and 2, mean 6. Hour 9: maxima 7 and 7, though fewer rows.
    data = [(1, 1, 2, 8, 10, 0), (1, 1, 2, 8, 9, 0), (1, 8, 2, 8, 2, 0), (1, 1, 2, 9, 7, 0), (1, 8, 2, 9, 7, 0)]
    assert rows(peak_bucket(frame(spark, data), **BY, metric="load")) == [(1, 2, 9)]


def test_one_peak_per_entity_and_period(spark):
    df = frame(spark, sample(1))
    peaks = peak_bucket(df, **BY, metric="load")
    assert peaks.groupBy("id", "dow").count().filter("count > 1").count() == 0
    ranked = ranked_buckets(df, **BY, metric="load")
    assert rows(ranked.filter("ranked_rush = 1").select("id", "dow", "hour")) == rows(peaks)


def test_mean_rush_wait_is_rounded_up(spark):
    # Daily maxima of 10 and 10.5 minutes.
    data = [(1, 1, 2, 8, 5, 600), (1, 8, 2, 8, 5, 630), (1, 8, 2, 8, 1, 10), (1, 1, 2, 9, 1, 9000)]
    for form in (steps, fused):
        assert rows(form(frame(spark, data))) == [(1, 11)]


def test_whole_mean_is_not_rounded_up_by_float_noise(spark):
    # 6 and 1234 seconds and so on: the fractions of minutes do not add up exactly, the seconds do.
    waits = [6, 1234, 7, 353, 999, 1]
    waits.append(600 * (len(waits) + 1) - sum(waits))
    data = [(1, 7 * d, 2, 8, 5, w) for d, w in enumerate(waits)]
    for form in (steps, fused):
        assert rows(form(frame(spark, data))) == [(1, 10)]


def test_entity_without_any_wait_keeps_a_null(spark):
    for form in (steps, fused):
        assert rows(form(frame(spark, [(1, 1, 2, 8, 5, None), (2, 1, 2, 8, 6, 30)]))) == [(1, None), (2, 1)]


@pytest.mark.parametrize("seed,hot,dense_keys", [(1, False, 65_536), (2, True, 65_536), (3, True, 4), (4, False, 0)])
def test_forms_equal_brute_force(spark, seed, hot, dense_keys):
    data = sample(seed, hot=hot)
    df = frame(spark, data).repartition(5).cache()
    assert {(r.id, r.dow): r.hour for r in peak_bucket(df, **BY, metric="load").collect()} == brute_force_peaks(data)
    want = brute_force_waits(data)
    for form in (steps, fused):
        assert {r.id: r.out for r in form(df, dense_keys=dense_keys, salts=4).collect()} == want
    df.unpersist()


def test_maximum_before_join_equals_join_before_maximum(spark):
    df = frame(spark, sample(5))
    peaks = peak_bucket(df, **BY, metric="load")
    keys = ["id", "dow", "hour"]
    want = df.join(peaks, keys).groupBy("day", *keys).agg(F.max("wait").alias("top"))
    got = daily_max_in_peak(df, peaks, **BY, metric="wait", output="top")
    assert rows(got.select(want.columns)) == rows(want)


def test_snapshots_are_folded_before_every_shuffle(spark, tmp_path):
    frame(spark, sample(6)).write.parquet(str(tmp_path / "t"))
    shown = plan(fused(spark.read.parquet(str(tmp_path / "t"))))
    assert "Window" not in shown and "SinglePartition" not in shown and "Cartesian" not in shown
    peaks = plan(peak_bucket(spark.read.parquet(str(tmp_path / "t")), **BY, metric="load"))
    assert "partial_max" in peaks and "SinglePartition" not in peaks and "Join" not in peaks


def test_peaks_join_above_the_maxima(spark, tables):
    optimized = QUERIES["rush_wait_by_day"](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    join = optimized.index("Join Inner")
    assert "LeftSemi" not in optimized and optimized.index("Aggregate", join) > join


def test_rush_chain_scans_the_fact_twice_at_most(spark, tables):    # The formatted plan names each scan in the tree and in the details.
    assert plan(QUERIES["rush_wait"](spark, tables)).count("Scan parquet") <= 2 * 2
