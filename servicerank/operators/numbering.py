"""Dense row ids in a natural order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicerank.session import materialize

#: Rows that a task sorts and numbers.
ROWS_PER_TASK = 1 << 18


def ordered_row_ids(
    df: DataFrame,
    order_by: list[str],
    id_column: str,
    partitions: int | None = None,
    settle: bool = False,
) -> DataFrame:
    """Number the rows 1..N by `order_by`, then by the remaining columns.

    The ids depend on the rows alone, not on files or partitions. Runs jobs when
    called: the rows are dealt out by ranges whose bounds Spark samples from the
    order columns, in the one shuffle there is; sorted and numbered within their
    range, written once, and shifted by the row counts of the ranges before them
    (one count for each range, the only thing broadcast). Equal rows are told
    apart by where they stand in the input, so a range can end between them,
    however many there are; which of them gets which id makes no difference.

    `partitions` is by default the number of rows over ROWS_PER_TASK; a scan is
    counted by its footers. Where a row stands must not change when a lost task
    is run again. That holds for scans and narrow steps over them; give
    `settle=True` for other inputs, which are then written as a work table first.
    """
    if settle:
        df = materialize(df, "numbered-rows")
    partitions = partitions or max(1, -(-df.count() // ROWS_PER_TASK))
    rest = [c for c in df.columns if c not in order_by]
    order = [*order_by, *rest, "_at"]

    ranged = (
        df.withColumn("_at", F.monotonically_increasing_id())
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        # Partition number in the upper bits, position in the lower 33.
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_at")
    )
    placed = materialize(ranged, "row-ids")
    partition = F.shiftright("_place", 33)
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))

    counts = placed.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select((F.col("_offset") + position + 1).alias(id_column), *df.columns)
    )
