"""Large JSON arrays of objects, read by many tasks.

Spark gives a file that is one array to one task. Here the file is read as text
that ends at every `}`, which splits anywhere, and the objects are put together
again from these pieces. Whether a piece begins inside a string, and how deep it
is nested, follows from the quotes and braces before it: numbers that add up, so
they are summed within each split of a file, then over the splits (one row for
each split), and given to the pieces. No escape can straddle a `}`: one follows
a backslash in no valid string.

The pieces of a split go to one task, and objects cut by the end of a split are
put together afterwards; so the text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.session import new_work_path

_SPLIT = ("_file", "_block")
#: Stands in no JSON text, not even between values, where line ends may.
_SEPARATOR = "\x1e"


def array_objects(spark: SparkSession, src: str) -> DataFrame:
    """The objects of all arrays under `src`, as JSON text: one row per object, `value`.

    Every file must hold one array of objects in UTF-8; anything else, such as a
    file cut off, other items, or text around the array, fails the query.
    """
    text = spark.read.option("lineSep", "}").text(src)
    pieces = text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_piece"),
    )
    # Escapes out, then every second part between quotes lies inside strings.
    parts = F.split(F.regexp_replace("_piece", r"\\.", ""), '"')
    counted = pieces.select(
        *_SPLIT,
        "_at",
        "_piece",
        (F.size(parts) - 1).alias("_quotes"),
        _braces(parts, 0).alias("_opened_outside"),
        _braces(parts, 1).alias("_opened_inside"),
    )

    quoted = _before_splits(counted, F.sum("_quotes"), "_quotes_before")
    begun = _with(_with(counted, quoted), _last_pieces(counted))
    so_far = F.col("_quotes_before") + F.coalesce(F.sum("_quotes").over(_earlier()), F.lit(0))
    inside = so_far % 2 == 1
    closes = ((so_far + F.col("_quotes")) % 2 == 0).cast("int")
    stepped = begun.withColumns(
        {
            "_opens": F.when(inside, F.col("_opened_inside")).otherwise(F.col("_opened_outside")),
            # No brace stands behind the last piece.
            "_closes": F.when(F.col("_at") == F.col("_last"), 0).otherwise(closes),
        }
    )
    step = F.col("_opens") - F.col("_closes")

    nested = _before_splits(stepped, F.sum(step), "_depth_before")
    depth = F.col("_depth_before") + F.sum(step).over(_earlier().rowsBetween(Window.unboundedPreceding, 0))
    ended = _with(stepped, nested).withColumn("_ends", ((F.col("_closes") == 1) & (depth == 0)).cast("int"))

    finished = _before_splits(ended, F.sum("_ends"), "_ended_before")
    number = F.col("_ended_before") + F.coalesce(F.sum("_ends").over(_earlier()), F.lit(0))
    numbered = _with(ended, finished).withColumn("_number", number)

    # Objects within a split first, without another shuffle; then the few that go on in the next one.
    of_split = numbered.groupBy(*_SPLIT, "_number").agg(
        _joined("_at", "_piece").alias("_text"),
        F.max("_ends").alias("_ends"),
        F.max(F.col("_at") == F.col("_last")).alias("_last"),
        F.min("_at").alias("_at"),
    )
    whole = of_split.groupBy("_file", "_number").agg(
        _joined("_at", "_text").alias("_text"), F.max("_ends").alias("_ends"), F.max("_last").alias("_last")
    )
    return whole.select(_checked().alias("value")).filter("value IS NOT NULL")


def read_arrays(spark: SparkSession, src: str, schema: T.StructType) -> DataFrame:
    """The objects of all arrays under `src` as rows, equal to those of spark.read.json with `multiLine`.

    Malformed ones fail the query. Writes the objects to a work folder when
    called, from which Spark's JSON source reads them: unlike from_json it keeps
    the text of nested values in text columns as it is.
    """
    path = new_work_path(spark, "array-objects")
    array_objects(spark, src).write.option("lineSep", _SEPARATOR).text(path)
    return spark.read.schema(schema).options(mode="FAILFAST", lineSep=_SEPARATOR).json(path)


def _braces(parts: Column, inside: int) -> Column:
    """Opening braces in the parts outside of strings, if the piece begins inside one or not."""
    held = F.filter(parts, lambda _, i: i % 2 == inside)
    return F.aggregate(held, F.lit(0).cast("bigint"), lambda n, p: n + F.length(p) - F.length(F.replace(p, F.lit("{"))))


def _earlier():
    """The pieces before one in its split."""
    return Window.partitionBy(*_SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)


def _before_splits(pieces: DataFrame, total: Column, name: str) -> DataFrame:
    """What the splits of a file add up to before each of them: one row for each split."""
    sums = pieces.groupBy(*_SPLIT).agg(total.alias("_total"))
    before = _splits().rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*_SPLIT, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(name))


def _last_pieces(pieces: DataFrame) -> DataFrame:
    """The last piece of each file, with its split; it holds what follows the last brace."""
    last = pieces.groupBy(*_SPLIT).agg(F.max("_at").alias("_last"))
    return last.select(*_SPLIT, F.when(F.lead("_block").over(_splits()).isNull(), F.col("_last")).alias("_last"))


def _splits():
    return Window.partitionBy("_file").orderBy("_block")


def _with(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    return pieces.join(splits, list(_SPLIT))


def _joined(order: str, text: str) -> Column:
    """The texts in order, with the braces at which they were cut."""
    pieces = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(pieces, lambda p: p[text]), "}")


def _checked() -> Column:
    """An object without what stands before it; NULL for the end of an array."""
    first = F.col("_number") == 0
    begin = F.when(first, F.lit(r"^\s*\[\s*\{")).otherwise(F.lit(r"^\s*,\s*\{"))
    end = F.when(first, F.lit(r"^\s*\[\s*\]\s*$")).otherwise(F.lit(r"^\s*\]\s*$"))
    fine, over = F.regexp_like("_text", begin), F.regexp_like("_text", end)
    bad = F.raise_error(F.concat(F.lit("not a JSON array of objects: "), F.col("_file"))).cast("string")
    item = F.concat(F.regexp_replace("_text", r"^\s*[\[,]\s*", ""), F.lit("}"))
    # The last piece is the end of the array, and nothing else is.
    inner = (F.col("_ends") == 1) & ~F.coalesce("_last", F.lit(False))
    return F.when(inner & fine, item).when((F.col("_ends") == 0) & F.col("_last") & over, F.lit(None)).otherwise(bad)
