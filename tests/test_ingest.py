import json
import os
from datetime import datetime

import pytest
from helpers import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.schemas import SNAPSHOT_COLUMNS
from servicerank.sources.lake import ingest_snapshots, read_lake
from servicerank.sources.snapshots import feed_schema, ingest_time, read_snapshots, to_lake_rows
from servicerank.streaming.ingest import stream_snapshots

STAMP = datetime(2024, 3, 4, 10, 0, 0)


def land(folder, name, *points):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(list(points)))


def point(key, **more):
    return {"id": str(key), "name": f"Point {key}", "stops": ["1", "2"], "is_open": True, "currently_waiting": 4, **more}


def test_batch_ingest_appends_text(spark, tmp_path):
    land(tmp_path / "src", "a.json", point(1), point(2, currently_waiting=None))
    lake = str(tmp_path / "lake")
    summary = ingest_snapshots(spark, str(tmp_path / "src"), lake, batch_time=STAMP)
    assert rows(summary) == [(2, 32)]
    got = read_lake(spark, lake)
    assert all(isinstance(got.schema[c].dataType, T.StringType) for c in SNAPSHOT_COLUMNS)
    picked = got.select("id", "stops", "is_open", "currently_waiting", "lat", "time", F.col("ingest_date").cast("string"))
    assert rows(picked) == [
        ("1", '["1", "2"]', "true", "4", "None", "24/03/04 10:00:00", "2024-03-04"),
        ("2", '["1", "2"]', "true", "None", "None", "24/03/04 10:00:00", "2024-03-04"),
    ]
    ingest_snapshots(spark, str(tmp_path / "src"), lake, batch_time=STAMP)
    assert got.sparkSession.read.parquet(lake).count() == 4


def test_declared_types_are_spelled(spark, tmp_path):
    land(tmp_path / "src", "a.json", point(1))
    types = {"stops": T.ArrayType(T.StringType()), "is_open": T.BooleanType(), "currently_waiting": T.LongType()}
    schema = T.StructType([T.StructField(f.name, types.get(f.name, f.dataType)) for f in feed_schema()])
    feed = read_snapshots(spark, str(tmp_path / "src"), schema)
    got = to_lake_rows(feed, ingest_time(batch_time=STAMP)).select("stops", "is_open", "currently_waiting")
    assert rows(got) == [("['1', '2']", "True", "4")]


def test_bad_json_fails(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text('[{"id": "1"')
    with pytest.raises((PySparkException, Py4JJavaError), match="FAILFAST"):
        read_snapshots(spark, str(tmp_path / "src")).collect()


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="not in the lake schema"):
        to_lake_rows(spark.range(1).select(F.lit("x").alias("colour")), ingest_time())


def test_stamps(spark, tmp_path, time_zone):
    time_zone("Asia/Tokyo")
    land(tmp_path / "src", "a.json", point(1))
    os.utime(tmp_path / "src" / "a.json", (1_709_546_400, 1_709_546_400))  # 2024-03-04 10:00:00 UTC
    feed = read_snapshots(spark, str(tmp_path / "src"))
    assert to_lake_rows(feed, ingest_time("file")).first()["time"] == "24/03/04 10:00:00"
    now = to_lake_rows(feed, ingest_time()).first()["time"]
    assert len(now) == 17 and now > "24/12/31"
    with pytest.raises(ValueError, match="stamp"):
        ingest_time("now")


def test_stream_reads_each_file_once(spark, tmp_path):
    src, lake, checkpoint = (str(tmp_path / n) for n in ("src", "lake", "checkpoint"))

    def run():
        stream_snapshots(spark, src, lake, checkpoint, batch_time=STAMP, files_per_batch=1).awaitTermination()

    land(tmp_path / "src", "a.json", point(1), point(2))
    land(tmp_path / "src", "b.json", point(3))
    run()
    assert read_lake(spark, lake).count() == 3
    run()
    assert read_lake(spark, lake).count() == 3
    land(tmp_path / "src", "c.json", point(4))
    run()
    ingest_snapshots(spark, src, str(tmp_path / "batch"), batch_time=STAMP)
    assert rows(read_lake(spark, lake)) == rows(read_lake(spark, str(tmp_path / "batch")))


def test_stream_stamps_each_file(spark, tmp_path):
    for name, key, second in (("a.json", 1, 0), ("b.json", 2, 60)):
        land(tmp_path / "src", name, point(key))
        os.utime(tmp_path / "src" / name, (1_709_546_400 + second,) * 2)
    stream_snapshots(
        spark, str(tmp_path / "src"), str(tmp_path / "lake"), str(tmp_path / "checkpoint"), stamp="file"
    ).awaitTermination()
    got = read_lake(spark, str(tmp_path / "lake")).select("id", "time")
    assert rows(got) == [("1", "24/03/04 10:00:00"), ("2", "24/03/04 10:01:00")]


def test_streamed_and_appended_folders_do_not_mix(spark, tmp_path):
    land(tmp_path / "src", "a.json", point(1))
    src, streamed, appended = (str(tmp_path / n) for n in ("src", "streamed", "appended"))
    ingest_snapshots(spark, src, appended, batch_time=STAMP)
    stream_snapshots(spark, src, streamed, str(tmp_path / "c1"), batch_time=STAMP).awaitTermination()
    with pytest.raises(ValueError, match="written by a stream"):
        ingest_snapshots(spark, src, streamed)
    with pytest.raises(ValueError, match="appended files"):
        stream_snapshots(spark, src, appended, str(tmp_path / "c2"))
    assert read_lake(spark, streamed, appended).count() == 2
