"""Registered queries: each takes (spark, folder of the test tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.functions.text import spell
from servicerank.operators.audit import audit_keys, duplicate_keys, orphan_keys, orphan_time_ids, rejected_times
from servicerank.operators.calendar import DEFAULT_CALENDAR, Calendar, attach_calendar, join_calendar, time_dimension
from servicerank.operators.decision import clean_labels, normalize_criteria
from servicerank.operators.facts import queue_fact, queue_fact_of_day
from servicerank.operators.imputation import impute_group_mean
from servicerank.operators.peaks import (
    daily_max, daily_max_in_peak, mean_daily_max, metric_in_peak, peak_bucket, ranked_buckets,
)
from servicerank.operators.staging import queue_spec, stage_typed
from servicerank.plans import bindings as b
from servicerank.plans.report import (
    PEAK, RUSH_WAIT, imputed_wait, open_queue, ranked_report, ranked_report_of_views, register_views, review_ratings,
    rush_hour_waits, rush_hour_waits_of_state, service_point_matrix,
)
from servicerank.schemas import ENTITY, LOAD, MATRIX_CRITERIA, REPORT_CRITERIA, SNAPSHOT_COLUMNS, WAIT
from servicerank.session import materialize, new_work_path
from servicerank.sources.lake import append_lake, ingest_snapshots, read_lake
from servicerank.sources.ledger import BatchLake
from servicerank.sources.snapshots import feed_schema, ingest_time, to_lake_rows
from servicerank.sources.warehouse import (
    load_day, load_queue_fact, load_reviews_fact, load_time_dimension, read_queue_fact, read_reviews_fact,
    read_rush_state, read_time_dimension, refresh_rush_state, replace_table, store_bucketed,
)
from servicerank.streaming.ingest import stream_snapshots

Query = Callable[[SparkSession, str], DataFrame]

BATCH_TIME = datetime(2024, 3, 4, 10, 0, 0)
FAR_DAY = date(2030, 1, 1)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Means to six digits: engines differ in the last bits."""
    return df.withColumns({n: F.round(n, 6) for n in names})


# Ingest and lake ---------------------------------------------------------------


def lake_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events")
    rows = to_lake_rows(b.feed(events).drop("time"), ingest_time(batch_time=BATCH_TIME))
    return rows.select(SNAPSHOT_COLUMNS)


def _land_feed(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """The feed as JSON files, and their types."""
    landed = new_work_path(spark, "landed")
    typed = b.feed(b.table(spark, sf_dir, "events")).drop("time")
    typed.write.json(landed)
    known = {f.name: f.dataType for f in typed.schema}
    return landed, T.StructType([T.StructField(f.name, known.get(f.name, f.dataType)) for f in feed_schema()])


def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, schema = _land_feed(spark, sf_dir)
    lake = new_work_path(spark, "lake")
    ingest_snapshots(spark, landed, lake, schema, BATCH_TIME, multi_line=False)
    return read_lake(spark, lake).select(SNAPSHOT_COLUMNS)


def array_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as one JSON array a day, each read by as many tasks as it has splits."""
    landed = new_work_path(spark, "landed")
    typed = b.feed(b.table(spark, sf_dir, "events"))
    known = {f.name: f.dataType for f in typed.schema}
    objects = typed.select(F.substring("time", 1, 8).alias("day"), F.to_json(F.struct(*typed.drop("time").columns)).alias("o"))
    arrays = objects.groupBy("day").agg(F.concat(F.lit("["), F.array_join(F.collect_list("o"), ", "), F.lit("]")).alias("a"))
    arrays.select("a").write.option("maxRecordsPerFile", 1).text(landed)
    schema = T.StructType([T.StructField(f.name, known.get(f.name, f.dataType)) for f in feed_schema()])
    lake = new_work_path(spark, "lake")
    ingest_snapshots(spark, landed, lake, schema, BATCH_TIME, batch="arrays", split=True)
    return read_lake(spark, lake).select(SNAPSHOT_COLUMNS)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, schema = _land_feed(spark, sf_dir)
    lake, checkpoint = new_work_path(spark, "lake"), new_work_path(spark, "stream")
    run = stream_snapshots(spark, landed, lake, checkpoint, schema, BATCH_TIME, multi_line=False)
    run.awaitTermination()
    return read_lake(spark, lake).select(SNAPSHOT_COLUMNS)


def _batches(spark: SparkSession, sf_dir: str, n: int = 3) -> BatchLake:
    """The lake rows, appended in `n` batches of points."""
    lake = BatchLake(spark, new_work_path(spark, "lake"))
    rows = b.lake(spark, sf_dir)
    for k in range(n):
        lake.append(rows.filter(F.col("id").cast("bigint") % n == k), f"points-{k}")
    return lake


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lake holds after two loads, the second of them run twice."""
    lake = _batches(spark, sf_dir, 2)
    lake.append(b.lake(spark, sf_dir), "points-1")
    return lake.summary()


def batch_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batches(spark, sf_dir).batches().drop("committed_at", "files", "bytes")


def repeated_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of which one ran again, and one died before it was committed and ran again."""
    lake = _batches(spark, sf_dir, 2)
    rows = b.lake(spark, sf_dir)
    rows.write.partitionBy("ingest_date").parquet(f"{lake.data}/batch=points-2.died")
    lake.append(rows, "points-0")
    return lake.read().select(SNAPSHOT_COLUMNS)


def packed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake whose days were packed, grew by one batch, and were packed again."""
    lake = _batches(spark, sf_dir)
    lake.pack()
    again = b.lake(spark, sf_dir).filter(F.col("id").cast("bigint") % 3 == 0)
    lake.append(again.withColumn("name", F.lit("again")), "again")
    lake.pack()
    lake.vacuum(timedelta(0))
    return lake.read().withColumn("ingest_date", F.col("ingest_date").cast("string"))


def staged_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_typed(b.lake(spark, sf_dir), queue_spec())


# Calendar ----------------------------------------------------------------------


def _events_calendar(spark: SparkSession, sf_dir: str) -> Calendar:
    """The days the events span, from the minimum and maximum in the file footers."""
    ts = b.table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    start = ts[0].replace(hour=0, minute=0, second=0, microsecond=0)
    days = (ts[1] - start) // timedelta(days=1) + 1
    return Calendar(origin=start, minutes=days * 24 * 60)


def time_dimension_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_dimension(spark, _events_calendar(spark, sf_dir))


def queue_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_calendar(b.queue(spark, sf_dir).select(ENTITY, "time_id", LOAD))


def queue_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and attributes of all events by one join with the dimension of all 10 million minutes."""
    typed = stage_typed(b.lake(spark, sf_dir), queue_spec()).select(ENTITY, F.col("time_format").alias("full_date"))
    joined = typed.join(time_dimension(spark), "full_date")
    return joined.select(ENTITY, "time_id", "full_date", "day_of_week", "hour", "weekday_flag")


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The queue fact and the time dimension of its days, both dealt into buckets by time id."""
    days = _events_calendar(spark, sf_dir)
    first = (days.origin - DEFAULT_CALENDAR.origin) // timedelta(minutes=1)
    dim = time_dimension(spark).filter(F.col("time_id").between(first + 1, first + days.minutes))
    made = [("queue", b.queue(spark, sf_dir)), ("time", dim)]
    return tuple(
        store_bucketed(df, f"{label}_{uuid.uuid4().hex}", new_work_path(spark, f"bucketed-{label}"), ["time_id"], 8)
        for label, df in made
    )


def queue_time_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's calendar by a join of buckets; neither side is shuffled."""
    queue, time = _bucketed(spark, sf_dir)
    joined = join_calendar(queue.select(ENTITY, "time_id", LOAD), time.hint("merge"))
    return joined.select(queue_calendar(spark, sf_dir).columns)


# Facts -------------------------------------------------------------------------


def fact_queue_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.queue_from_lake(spark, sf_dir)


def fact_queue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_fact_of_day(b.unpartitioned_lake(spark, sf_dir), date(2024, 1, 16))


def fact_queue_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake to stored fact, one day of it loaded a second time."""
    lake_path, fact_path = new_work_path(spark, "lake"), new_work_path(spark, "queue")
    append_lake(b.lake(spark, sf_dir), lake_path)
    lake = read_lake(spark, lake_path)
    span = _events_calendar(spark, sf_dir)
    load_queue_fact(lake, fact_path, span.origin, span.end, vouched=True)
    load_day(lake, fact_path, as_of=date(2024, 1, 16), vouched=True)
    return read_queue_fact(spark, fact_path).drop("fact_date")


def fact_queue_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' times of day as yesterday's, ingested now and loaded by a day's run without a date."""
    feed = b.feed(b.table(spark, sf_dir, "events"))
    yesterday = F.date_format(F.date_sub(F.current_date(), 1), "yy/MM/dd")
    rows = to_lake_rows(feed.withColumn("time", F.concat(yesterday, F.substring("time", 9, 9))), F.col("time"))
    fact = new_work_path(spark, "queue")
    load_day(rows, fact)
    stamped = to_lake_rows(feed.drop("time").limit(1), ingest_time()).first()["ingest_date"]
    loaded = spark.read.parquet(fact).withColumn("minute_of_day", ((F.col("time_id") - 1) % 1440).cast("int"))
    today = F.datediff(F.lit(stamped), F.col("fact_date")) == 1
    return loaded.withColumn("stamped_a_day_later", today).drop("time_id", "fact_date")


def fact_queue_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of a lake with a ledger, which vouches for two of its batches, not for the third."""
    lake = _batches(spark, sf_dir, 2)
    misplaced = b.lake(spark, sf_dir).filter(F.col("is_open") == "False").withColumn("ingest_date", F.lit(FAR_DAY))
    lake.append(misplaced, "misplaced")
    return queue_fact(lake, date(2024, 1, 10), date(2024, 1, 20))


def fact_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.reviews(spark, sf_dir)


# Rush hours --------------------------------------------------------------------


def imputed_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(imputed_wait(b.queue(spark, sf_dir)), "expected_wait_time_imputed")


def _open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_queue(b.queue(spark, sf_dir))


def daily_hour_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_max(_open(spark, sf_dir), [ENTITY, "day_of_week", "hour"], "cday", LOAD, "max_cust_wait")


def avg_hour_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_daily_max(_open(spark, sf_dir), [ENTITY, "day_of_week", "hour"], "cday", LOAD, "avg_max_cust_wait")
    return _rounded(means, "avg_max_cust_wait")


def ranked_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_buckets(_open(spark, sf_dir), ENTITY, **PEAK, metric=LOAD).drop("avg_max")


def rush_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peak_bucket(_open(spark, sf_dir), ENTITY, **PEAK, metric=LOAD)


def _filled_and_peaks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    opened = _open(spark, sf_dir).select(ENTITY, *PEAK.values(), LOAD, WAIT)
    return impute_group_mean(opened, WAIT, LOAD, "wait", scale=1), peak_bucket(opened, ENTITY, **PEAK, metric=LOAD)


def rush_wait_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled, peaks = _filled_and_peaks(spark, sf_dir)
    days = daily_max_in_peak(filled, peaks, ENTITY, **PEAK, metric="wait", output="max_wait_time_in_rush_hour")
    return _rounded(days, "max_wait_time_in_rush_hour")


def rush_wait_by_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled, peaks = _filled_and_peaks(spark, sf_dir)
    return metric_in_peak(filled, peaks, ENTITY, **PEAK, metric="wait", output=RUSH_WAIT, scale=60)


def rush_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rush_hour_waits(b.queue(spark, sf_dir))


def rush_wait_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the state kept beside a fact to which the last days were loaded one by one, one of them twice."""
    lake = _batches(spark, sf_dir, 2)
    span = _events_calendar(spark, sf_dir)
    fact, state = new_work_path(spark, "queue"), new_work_path(spark, "state")
    backfilled = span.end - timedelta(days=2)
    load_queue_fact(lake, fact, span.origin, backfilled)
    refresh_rush_state(spark, fact, state)
    for days in (1, 1, 2):
        load_day(lake, fact, backfilled.date() + timedelta(days=days), state=state)
    return rush_hour_waits_of_state(read_rush_state(spark, state))


def imputed_by_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing waits by a key of any size: the point and its open counters, a third of them one key."""
    queue = b.queue(spark, sf_dir)
    hot = F.when(F.col(ENTITY) % 3 == 0, 0).otherwise(F.col(ENTITY))
    rows = queue.select(((hot + 1) * 1_000_003 + F.col("active_counters")).alias("key"), "time_id", WAIT)
    return _rounded(impute_group_mean(rows, WAIT, "key", "wait", salt_rows=16), "wait")


# Ratings and ranking -----------------------------------------------------------


def weighted_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_ratings(b.rating_rows(spark, sf_dir))


def _facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return b.queue(spark, sf_dir), b.rating_rows(spark, sf_dir), b.service_points(spark, sf_dir)


def decision_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service_point_matrix(*_facts(spark, sf_dir))


def decision_matrix_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix and its names through SQL on the registered views."""
    register_views(*_facts(spark, sf_dir), time=time_dimension(spark, _events_calendar(spark, sf_dir)))
    return spark.sql(f"""
        SELECT {ENTITY}, p.name, {", ".join(f"m.{c}" for c in MATRIX_CRITERIA)}
        FROM view_decision_matrix m JOIN dim_service_point p USING ({ENTITY})
        ORDER BY {ENTITY}
    """)


def swapped_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix read by its name, after a first version of some points was replaced as a whole."""
    matrix = service_point_matrix(*_facts(spark, sf_dir))
    path, name = new_work_path(spark, "matrix"), f"matrix_{uuid.uuid4().hex}"
    replace_table(matrix.filter(F.col(ENTITY) % 2 == 0), path, name=name)
    replace_table(matrix, path, name=name)
    return spark.table(name)


def normalized_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = materialize(service_point_matrix(*_facts(spark, sf_dir)), "matrix")
    return _rounded(normalize_criteria(matrix), *["normalized_" + c for c in MATRIX_CRITERIA])


def _rounded_report(report: DataFrame) -> DataFrame:
    return _rounded(report, *REPORT_CRITERIA, "performance_score")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_report(ranked_report(*_facts(spark, sf_dir), label_pattern=b.LABEL_PATTERN))


def warehouse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from the views over stored tables: feed, lake, facts and dimensions are written first."""
    paths = {n: new_work_path(spark, n) for n in ("lake", "queue", "reviews", "points", "time")}
    append_lake(b.lake(spark, sf_dir), paths["lake"])
    span = _events_calendar(spark, sf_dir)
    load_queue_fact(read_lake(spark, paths["lake"]), paths["queue"], span.origin, span.end, vouched=True)
    load_reviews_fact(b.raw_reviews(spark, sf_dir), paths["reviews"], b.REVIEW_CALENDAR)
    replace_table(b.service_points(spark, sf_dir), paths["points"])
    load_time_dimension(spark, paths["time"], span)

    queue, reviews = read_queue_fact(spark, paths["queue"]), read_reviews_fact(spark, paths["reviews"])
    points = spark.read.schema(b.service_points(spark, sf_dir).schema).parquet(paths["points"])
    register_views(queue, reviews, points, read_time_dimension(spark, paths["time"]))
    return _rounded_report(ranked_report_of_views(spark, label_pattern=b.LABEL_PATTERN))


def cleaned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_labels(b.service_points(spark, sf_dir), b.LABEL_PATTERN)


# Audits ------------------------------------------------------------------------


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(b.queue(spark, sf_dir), [ENTITY, "time_id"])


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_keys(b.queue(spark, sf_dir), [ENTITY], b.service_points(spark, sf_dir), [ENTITY])


def time_fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the default calendar checked against one that ends in mid-January."""
    until = (datetime(2024, 1, 16) - Calendar.origin) // timedelta(minutes=1)
    return orphan_time_ids(b.queue(spark, sf_dir), Calendar(minutes=until))


def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = b.service_points(spark, sf_dir)
    foreign = {ENTITY: (points, ENTITY)}
    return audit_keys(b.queue(spark, sf_dir), [ENTITY, "time_id"], foreign, {"time_id": DEFAULT_CALENDAR})


def bucketed_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key_audit of the fact in buckets by time id, whose keys stay where they are."""
    queue, _ = _bucketed(spark, sf_dir)
    foreign = {ENTITY: (b.service_points(spark, sf_dir), ENTITY)}
    return audit_keys(queue, [ENTITY, "time_id"], foreign, {"time_id": DEFAULT_CALENDAR})


def reviews_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews against customers who are known, and a calendar that ends in 1998."""
    customers = b.table(spark, sf_dir, "customer")
    until = (datetime(1998, 1, 1) - b.REVIEW_CALENDAR.origin) // timedelta(minutes=1)
    calendar = Calendar(origin=b.REVIEW_CALENDAR.origin, minutes=until)
    return audit_keys(b.reviews(spark, sf_dir), ["review_id"], {ENTITY: (customers, "c_custkey")}, {"time_id": calendar})


def time_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_keys(time_dimension_of_events(spark, sf_dir), ["time_id"])


def rejected_snapshot_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_times(b.unclean_lake(spark, sf_dir))


def spelled_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles from 0.0001 up to some billions as the extractor spells them."""
    value = F.col("value")
    numbers = {"small": 0.0001 + value / 1e6, "large": value * 1000003.5, "whole": F.floor(value).cast("double") * 1e7}
    return b.table(spark, sf_dir, "events").select(
        "event_id", *(spell(n, T.DoubleType()).alias(name) for name, n in numbers.items())
    )


def spelled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, maps and structs of texts with quotes, escapes and gaps as the extractor spells them."""
    kind, k = F.col("event_type"), F.col("user_id") % 10
    odd = [F.concat(F.lit("it's "), kind), F.lit('say "x"'), F.lit("both ' and \""), F.lit("line\nend\tback\\slash"), F.lit(None)]
    values = {
        "texts": F.array(*odd),
        "pairs": F.create_map(kind, F.array(k > 4, F.lit(None)), F.lit("it's"), F.array(k == 0)),
        "record": F.struct(kind.alias("kind"), F.when(k > 2, k).alias("k"), F.array(F.struct(odd[0].alias("a"))).alias("more")),
    }
    events = b.table(spark, sf_dir, "events").select("event_id", *(v.alias(n) for n, v in values.items()))
    return events.select("event_id", *(spell(F.col(n), events.schema[n].dataType).alias(n) for n in values))


QUERIES: dict[str, Query] = {
    "lake_snapshot_rows": lake_snapshot_rows,
    "batch_ingest": batch_ingest,
    "array_ingest": array_ingest,
    "stream_ingest": stream_ingest,
    "load_summary": load_summary,
    "batch_summaries": batch_summaries,
    "repeated_ingest": repeated_ingest,
    "packed_lake": packed_lake,
    "staged_queue": staged_queue,
    "time_dimension": time_dimension_of_events,
    "queue_calendar": queue_calendar,
    "queue_time_join": queue_time_join,
    "queue_time_bucketed": queue_time_bucketed,
    "fact_queue_backfill": fact_queue_backfill,
    "fact_queue_daily": fact_queue_daily,
    "fact_queue_stored": fact_queue_stored,
    "fact_queue_yesterday": fact_queue_yesterday,
    "fact_queue_pruned": fact_queue_pruned,
    "fact_reviews": fact_reviews,
    "imputed_wait": imputed_waits,
    "daily_hour_max": daily_hour_max,
    "avg_hour_max": avg_hour_max,
    "ranked_hours": ranked_hours,
    "rush_hours": rush_hours,
    "rush_wait_by_day": rush_wait_by_day,
    "rush_wait_by_steps": rush_wait_by_steps,
    "rush_wait": rush_wait,
    "rush_wait_maintained": rush_wait_maintained,
    "imputed_by_point": imputed_by_point,
    "weighted_rating": weighted_rating,
    "decision_matrix": decision_matrix,
    "decision_matrix_view": decision_matrix_view,
    "swapped_matrix": swapped_matrix,
    "normalized_matrix": normalized_matrix,
    "ranked_report": report,
    "warehouse_report": warehouse_report,
    "cleaned_labels": cleaned_labels,
    "pk_duplicates": pk_duplicates,
    "fk_orphans": fk_orphans,
    "time_fk_orphans": time_fk_orphans,
    "key_audit": key_audit,
    "bucketed_key_audit": bucketed_key_audit,
    "reviews_key_audit": reviews_key_audit,
    "time_key_audit": time_key_audit,
    "rejected_times": rejected_snapshot_times,
    "spelled_numbers": spelled_numbers,
    "spelled_values": spelled_values,
}
