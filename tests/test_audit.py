from datetime import datetime

from helpers import plan, rows

from servicerank.operators.audit import audit_keys, duplicate_keys, null_keys, orphan_keys, orphan_time_ids
from servicerank.operators.calendar import Calendar


def fact(spark):
    return spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (2, 1), (9, 1), (9, 5), (None, 1), (None, 1)], "id long, time_id long"
    )


def dim(spark):
    return spark.createDataFrame([(1,), (2,)], "point long")


def test_duplicates_and_nulls(spark):
    assert rows(duplicate_keys(fact(spark), ["id", "time_id"])) == [(1, 1, 2), (None, 1, 2)]
    assert null_keys(fact(spark), ["id", "time_id"]).count() == 2


def test_orphans_exempt_nulls(spark):
    assert rows(orphan_keys(fact(spark), ["id"], dim(spark), ["point"])) == [(9, 2)]


def test_orphan_times(spark):
    assert rows(orphan_time_ids(fact(spark), Calendar(datetime(2024, 1, 1), 2))) == [(5, 1)]
    assert "Join" not in plan(orphan_time_ids(fact(spark)))


def test_summary(spark):
    got = audit_keys(fact(spark), ["id", "time_id"], {"id": (dim(spark), "point")})
    assert rows(got) == [("duplicate primary key", 2, 4), ("null primary key", 1, 2), ("orphan id", 1, 2)]
    clean = audit_keys(dim(spark), ["point"])
    assert rows(clean) == [("duplicate primary key", 0, 0), ("null primary key", 0, 0)]
