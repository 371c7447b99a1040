import json
import random
from datetime import datetime

import pytest
from helpers import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from servicerank.schemas import lake_schema
from servicerank.sources.json_arrays import array_objects, read_arrays
from servicerank.sources.lake import ingest_snapshots, read_lake
from servicerank.sources.snapshots import feed_schema, read_snapshots

TEXTS = ["},{", "a}, {\"b\": 1}", "\\", "\\\"}", "it's [", "]}", "line\nend", "é 😀 }", "", "plain", "\\\\", '"', "{", None]


@pytest.fixture
def small_splits(spark):
    sizes = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    before = {k: spark.conf.get(k) for k in sizes}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def points(seed, n):
    draw = random.Random(seed)
    return [
        {
            "id": str(i), "name": draw.choice(TEXTS), "stops": [draw.choice(TEXTS) for _ in range(draw.randrange(4))],
            "hours_special": draw.choice([None, {"a": {"b": [{}, {"c": "}"}]}}, [], "x" * draw.randrange(900)]),
            "is_open": draw.random() < 0.5, "currently_waiting": draw.randrange(9),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize("form", [{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}])
def test_objects_equal_those_of_a_whole_read(spark, tmp_path, small_splits, form):
    src = tmp_path / "src"
    src.mkdir()
    for k, n in enumerate((60, 1, 0, 25)):
        (src / f"{k}.json").write_text(json.dumps(points(k, n), **form) + "\n" * (k % 2), encoding="utf-8")
    got = array_objects(spark, str(src))
    key = lambda o: json.dumps(o, sort_keys=True)
    assert sorted(key(json.loads(r.value)) for r in got.collect()) == sorted(key(o) for k, n in enumerate((60, 1, 0, 25)) for o in points(k, n))
    assert rows(read_arrays(spark, str(src), feed_schema())) == rows(read_snapshots(spark, str(src)))
    assert rows(read_snapshots(spark, str(src), split=True)) == rows(read_snapshots(spark, str(src)))


def test_one_file_is_read_by_several_tasks(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text(json.dumps(points(3, 100)))
    text = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert text.rdd.getNumPartitions() > 10
    assert read_arrays(spark, str(tmp_path), lake_schema()).count() == 100


@pytest.mark.parametrize(
    "text",
    ['[{"id": "1"', '[{"id": "1"}', '[{"id": "1"} {"id": "2"}]', '{"id": "1"}', '[1, 2]', '[{"id": "1"}, 2]', '[{"id": "1"}] x',
     '[{"id": "1"}}]', '[{"id": "1}]', '[{"id": }]', 'x'],
)
def test_malformed_files_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_arrays(spark, str(tmp_path), feed_schema()).collect()


def test_ingest_splits_arrays_and_leaves_no_work_table(spark, tmp_path, small_splits):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.json").write_text(json.dumps(points(3, 40)))
    made, src, stamp = [], str(tmp_path / "src"), datetime(2024, 3, 4)
    for k, split in enumerate((False, True)):
        ingest_snapshots(spark, src, str(tmp_path / str(k)), batch_time=stamp, split=split)
        made.append(rows(read_lake(spark, str(tmp_path / str(k)))))
    assert made[0] == made[1] and len(made[0]) == 40
    with pytest.raises(ValueError, match="stamp"):
        ingest_snapshots(spark, src, str(tmp_path / "x"), stamp="file", split=True)
