import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from servicerank import session as session_module
from servicerank.operators.calendar import Calendar, time_dimension
from servicerank.plans.report import ranked_report, register_views, service_point_matrix
from servicerank.schemas import MATRIX_CRITERIA, queue_fact_schema, reviews_fact_schema, service_point_schema
from servicerank.session import materialize, new_work_path, shared_dir


@pytest.fixture(scope="module")
def star(spark):
    rng = random.Random(7)
    queue = [
        (p, 3_700_000 + rng.randrange(30_000), rng.randrange(50), rng.choice([None, 60 * rng.randrange(1, 30)]), 1,
         rng.choice([True, True, False, None]))
        for p in (1, 2, 3) for _ in range(400)
    ]
    reviews = [(i, i % 4 + 1, 3_700_000, i % 5 + 1, i % 3, "text") for i in range(60)]
    points = [
        (p, f"Point {p} ® S", "POINT(0 0)", None, None, None, None, None, None, 40 + p, p) for p in (1, 2, 4)
    ]
    return (
        spark.createDataFrame(queue, queue_fact_schema()),
        spark.createDataFrame(reviews, reviews_fact_schema()),
        spark.createDataFrame(points, service_point_schema()),
    )


def test_points_without_queue_or_row_drop_out(star):
    assert [r.service_point_id for r in service_point_matrix(*star).orderBy("service_point_id").collect()] == [1, 2]


def test_report_reads_a_stored_matrix(star):
    report = ranked_report(*star, label_pattern=" ® S")
    got = report.collect()
    assert {r.name for r in got} == {"Point 1", "Point 2"}
    assert [r.performance_score for r in got] == sorted((r.performance_score for r in got), reverse=True)
    # Stored rows and extremes: no aggregation of the facts is left in the plan.
    assert "customers_currently_waiting" not in plan(report)


def test_entity_may_have_another_name(spark, star):
    queue, reviews, points = (df.withColumnRenamed("service_point_id", "place") for df in star)
    want = rows(service_point_matrix(*star))
    assert rows(service_point_matrix(queue, reviews, points, entity="place")) == want
    assert ranked_report(queue, reviews, points, entity="place").columns[0] == "place"


def test_views_answer_sql(spark, star):
    register_views(*star, time=time_dimension(spark, Calendar(minutes=10)))
    by_sql = spark.sql(f"SELECT service_point_id, {', '.join(MATRIX_CRITERIA)} FROM view_decision_matrix")
    assert rows(by_sql) == rows(service_point_matrix(*star))
    assert spark.sql("SELECT max(time_id) FROM dim_time").first()[0] == 10


def test_materialize_keeps_rows_and_schema(spark):
    df = spark.range(5).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"))
    stored = materialize(df, "test")
    assert stored.schema.names == df.schema.names and rows(stored) == rows(df)


class FakeSession:
    """A session of a cluster, or a local one, that names no shared folder."""

    def __init__(self, master):
        self.sparkContext = self
        self.conf = self
        self.master = master
        self.folder = None

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_cluster_without_shared_folder_is_refused(monkeypatch, tmp_path):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(FakeSession("spark://host:7077"))
    monkeypatch.setattr(session_module.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    local = FakeSession("local[2]")
    assert shared_dir(local) == str(tmp_path) == shared_dir(local)


def test_work_paths_are_fresh_and_in_the_named_folder(spark):
    a, b = new_work_path(spark, "x"), new_work_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark) + "/x-")
