"""Plan shapes that must hold for every registered query."""

import pytest
from helpers import plan

from servicerank.plans.catalog import QUERIES

# Numbering offsets and the full ranking are windows by design; the first over one row per partition.
WINDOWS = {"fact_reviews", "reviews_key_audit", "ranked_hours"}
NARROW = {
    "lake_snapshot_rows", "staged_queue", "time_dimension", "queue_calendar", "fact_queue_backfill",
    "fact_queue_daily", "cleaned_labels",
}


@pytest.mark.parametrize("name", QUERIES)
def test_plan(spark, tables, name):
    shown = plan(QUERIES[name](spark, tables))
    for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in shown
    assert name in WINDOWS or "Window" not in shown
    assert name not in NARROW or "Exchange" not in shown
