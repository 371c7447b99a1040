"""Sends this package to the executors, whose Python workers import it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import servicerank


#: Rows and bytes of a batch that goes to a Python worker; whole texts make the defaults large.
ROWS_PER_BATCH, BYTES_PER_BATCH = 1_000, 16 << 20


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once for each context, and bound its batches.

    A cluster gets the sources anyway if it was submitted with `--py-files`.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= ROWS_PER_BATCH:
        spark.conf.set(setting, str(ROWS_PER_BATCH))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    context = spark.sparkContext
    if getattr(context, "_servicerank_shipped", False):
        return
    root = Path(servicerank.__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="servicerank-")), "servicerank_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    context._servicerank_shipped = True
