import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.functions.text import safe_bool, safe_long, spell, strict_long, strip_pattern
from servicerank.operators.staging import stage_typed
from servicerank.sources.snapshots import stringify


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")


def test_safe_long(spark):
    df = column(spark, ["12", "12.0", "None", "nan", "", "-3", None, "9223372036854775807", "9223372036854775808"])
    got = [r.y for r in df.select("i", safe_long(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [12, None, None, None, None, -3, None, 9223372036854775807, None]


def test_safe_bool_takes_only_true_and_false(spark):
    df = column(spark, ["True", "false", "TRUE", "yes", "1", "t", "None", None])
    got = [r.y for r in df.select("i", safe_bool(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [True, False, True, None, None, None, None, None]


def test_strict_long_fails_on_text(spark):
    with pytest.raises(PySparkException):
        column(spark, ["1", "abc"]).select(strict_long(F.col("x"))).collect()


def test_strip_pattern_removes_every_match(spark):
    df = column(spark, ["A ® S ® S", "B"])
    assert rows(df.select(strip_pattern(F.col("x"), " ® S"))) == [("A",), ("B",)]


def test_stringify_spells_like_the_extractor(spark):
    df = spark.createDataFrame(
        [(1, True, ["a", "b"], [1, 2], 1.5, None), (None, None, None, [], -2.0, "x")],
        "a long, b boolean, c array<string>, d array<int>, e double, f string",
    )
    assert rows(stringify(df)) == [
        ("1", "True", "['a', 'b']", "[1, 2]", "1.5", "None"),
        ("None", "None", "None", "[]", "-2.0", "x"),
    ]


def test_stage_typed_refuses_unknown_kinds(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        stage_typed(column(spark, ["1"]), {"y": ("x", "number")})


def test_stage_typed_kinds(spark):
    df = spark.createDataFrame(
        [("7", "24/03/04 10:20:59", "x")], "id string, time string, bad string"
    )
    spec = {
        "id": ("id", "strict_long"), "t": ("time", "time"), "m": ("time", "minute"),
        "st": ("bad", "safe_time"), "sm": ("bad", "safe_minute"), "raw": ("bad", "text"),
    }
    got = stage_typed(df, spec).select("id", F.col("t").cast("string"), F.col("m").cast("string"), "st", "sm", "raw")
    assert rows(got) == [(7, "2024-03-04 10:20:59", "2024-03-04 10:20:00", None, None, "x")]


def test_doubles_are_spelled_as_python_does(spark):
    values = [0.0001, 12345678.5, 1e-05, 1.5e-7, 123456789012345.0, 1e16, 1.25e20, 0.0, -0.0001, -3.0, 0.1 + 0.2, 1e7, 100.0]
    values += [float("nan"), float("inf"), float("-inf"), 0.00012345678901234567]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(spell(F.col("x"), T.DoubleType())).collect()] == [str(v) for v in values]


ODD_TEXTS = [
    "it's", 'say "x"', "both ' and \"", "line\nend\r\ttab", "back\\slash", "\\'", "", " ", "\x00\x1f\x7f\x85\xa0", "é ü ß \u200b\u2028\u3000",
    "😀 \U000e0001", "],[ {}", "a\xadb", "plain",
]


def test_nested_values_are_spelled_as_python_does(spark):
    lists = [[t] for t in ODD_TEXTS] + [ODD_TEXTS, [None, "x", None], [], None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, x array<string>")
    assert [r.s for r in df.select("i", spell(F.col("x"), df.schema["x"].dataType).alias("s")).orderBy("i").collect()] == list(
        map(str, lists)
    )
    kind = "i int, x struct<name:string, tags:array<struct<k:string,v:double>>, flags:map<string,array<boolean>>, n:bigint>"
    values = [
        {"name": "O'Neil", "tags": [{"k": "a\nb", "v": 1e-07}, {"k": None, "v": None}], "flags": {"it's": [True, None]}, "n": 5},
        {"name": None, "tags": None, "flags": {}, "n": None},
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], kind)
    got = [r.s for r in df.select("i", spell(F.col("x"), df.schema["x"].dataType).alias("s")).orderBy("i").collect()]
    assert got == [str(v) for v in [*values, None]]


def test_text_of_its_own_is_not_quoted(spark):
    df = column(spark, ODD_TEXTS)
    assert [r.s for r in df.select("i", spell(F.col("x"), T.StringType()).alias("s")).orderBy("i").collect()] == ODD_TEXTS
