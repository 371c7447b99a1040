"""A lake to which batches are appended once each, and the ledger that says which.

    <lake>/data/batch=<attempt>/ingest_date=<day>/*.parquet
    <lake>/ledger/append-<batch>.json, pack-<number>.json

An append writes its files into a folder of its own and then publishes one entry
under the name of its batch. The entry is what counts: readers go by the ledger,
so an attempt that died midway is not read, and a rerun finds the entry of its
batch and changes nothing. Packing merges the small files of a day into a new
folder and publishes which folders' days it replaces; the replaced files stay
until `vacuum`, so readers that began before it go on.

Entries also hold what was counted while the batch was written: rows, and how
many times could not be parsed or belong to another day than their folder. Days
are pruned, and times compared as text, only in batches without any; the rows of
other batches are all parsed, and malformed ones fail the load.

Readers hold one path for each folder and day that is live, on the driver;
packing keeps their number near the number of days.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from datetime import time as day_time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicerank.functions.clock import parse_snapshot_time
from servicerank.operators.facts import snapshot_window
from servicerank.schemas import SNAPSHOT_COLUMNS, lake_schema
from servicerank.sources import files

#: Bytes of a packed file, about, and its rows: a task sorts them in memory, where they take many times their bytes in the file.
FILE_BYTES, FILE_ROWS = 128 << 20, 1 << 20
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
ENTRY = (
    "kind string, batch string, folder string, committed_at string, rows bigint, malformed bigint, misplaced bigint, "
    "first_time string, last_time string, days array<struct<day:string,files:bigint,bytes:bigint>>, "
    "replaces array<struct<folder:string,day:string>>"
)


@dataclass(frozen=True)
class Part:
    """The live files of one folder and day; `rows` are estimated, as those of the folder by the share of its bytes."""

    folder: str
    day: str
    files: int
    bytes: int
    rows: int
    verified: bool


class ConflictError(RuntimeError):
    """Somebody else packed the same lake in the meantime; nothing was changed."""


class BatchLake:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.data, self.ledger = f"{self.path}/data", f"{self.path}/ledger"

    # Writing -------------------------------------------------------------------

    def append(self, rows: DataFrame, batch: str) -> bool:
        """Append rows of to_lake_rows under the name of their batch; False if that batch is there already.

        Give a name that a rerun gives, too: a scheduler's run, or `landed_batch`.
        Of two attempts that run at once one is committed, and the other one's
        files are removed.
        """
        entry = f"{self.ledger}/append-{_checked(batch)}.json"
        if files.exists(self.spark, entry):
            return False
        folder = f"{batch}.{uuid.uuid4().hex[:12]}"
        counts = self._write(rows, folder)
        record = {"kind": "append", "batch": batch, **self._described(folder, counts), "replaces": []}
        return self._commit(entry, record)

    def pack(self, file_bytes: int = FILE_BYTES, days: list[date] | None = None) -> int:
        """Merge small files, day by day, into files of about `file_bytes`; gives the number of files replaced.

        Files of narrow rows are smaller, with about FILE_ROWS rows, which is what a task holds at a time.
        A day is packed if at least half of its files could be saved. Rows are dealt out by ranges of (day, time), so a file
        holds a short span of times, and a busy day several files. Batches that
        are not verified stay as they are, lest they spoil the others. Raises
        ConflictError if another packing was committed meanwhile.
        """
        number = self._last_pack() + 1
        wanted = None if days is None else {d.isoformat() for d in days}
        small = [
            part
            for day, parts in self._by_day().items()
            if (wanted is None or day in wanted) and _worth_packing(parts, file_bytes)
            for part in parts
        ]
        if not small:
            return 0
        rows = self._read(small)
        held = rows.count()
        n = _n_files(sum(p.bytes for p in small), held, file_bytes)
        # Equal times are told apart by the rows' hash, so that a range can end between them.
        order = ["ingest_date", "time", F.xxhash64(*SNAPSHOT_COLUMNS)]
        dealt = rows.repartitionByRange(n, *order).sortWithinPartitions("ingest_date", "time")
        folder = f"pack-{number:06d}.{uuid.uuid4().hex[:12]}"
        counts = self._write(dealt, folder)
        if held != counts["rows"]:
            files.remove(self.spark, f"{self.data}/batch={folder}")
            raise RuntimeError(f"{held} rows to pack, {counts['rows']} written")
        replaces = [{"folder": p.folder, "day": p.day} for p in small]
        record = {"kind": "pack", "batch": f"{number:06d}", **self._described(folder, counts), "replaces": replaces}
        if not self._commit(f"{self.ledger}/pack-{number:06d}.json", record):
            raise ConflictError(f"pack {number} of {self.path} was committed by another job")
        return sum(p.files for p in small)

    def vacuum(self, older_than: timedelta = timedelta(days=1)) -> int:
        """Remove files that no entry names, or that were replaced; gives their number.

        Only files unchanged for `older_than`: younger ones may belong to an
        append under way, or to a reader that began before a packing.
        """
        live = {(p.folder, p.day) for p in self._parts()}
        limit = (time.time() - older_than.total_seconds()) * 1000
        gone = 0
        for file in files.stored(self.spark, self.data, hidden=True):
            if _place(file.path) not in live and file.changed <= limit:
                gone += files.remove(self.spark, file.path)
        return gone

    def _write(self, rows: DataFrame, folder: str) -> dict:
        seen = Observation()
        taken = parse_snapshot_time(F.col("time"), strict=False)
        counted = rows.select(*SNAPSHOT_COLUMNS, "ingest_date").observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(taken.isNull()).alias("malformed"),
            F.count_if(taken.isNotNull() & ~taken.cast("date").eqNullSafe(F.col("ingest_date"))).alias("misplaced"),
            F.min(taken).cast("string").alias("first_time"),
            F.max(taken).cast("string").alias("last_time"),
        )
        counted.write.mode("overwrite").partitionBy("ingest_date").parquet(f"{self.data}/batch={folder}")
        return seen.get

    def _described(self, folder: str, counts: dict) -> dict:
        days: dict[str, list[int]] = {}
        for file in files.stored(self.spark, f"{self.data}/batch={folder}"):
            day = days.setdefault(_place(file.path)[1], [0, 0])
            day[0] += 1
            day[1] += file.size
        listed = [{"day": d, "files": n, "bytes": b} for d, (n, b) in sorted(days.items())]
        now = datetime.now().astimezone().isoformat(timespec="seconds")
        return {"folder": folder, "committed_at": now, **counts, "days": listed}

    def _commit(self, entry: str, record: dict) -> bool:
        done = files.publish(self.spark, entry, record)
        if not done:
            files.remove(self.spark, f"{self.data}/batch={record['folder']}")
        return done

    # Reading -------------------------------------------------------------------

    def entries(self) -> DataFrame:
        """The ledger: one row for each append and packing that was committed."""
        if not files.exists(self.spark, self.ledger):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(self.ledger)

    def read(self) -> DataFrame:
        """Rows of all committed batches, and their `ingest_date`."""
        return self._read(self._parts())

    def window(self, lo: date | datetime, hi: date | datetime) -> DataFrame:
        """Snapshots taken in [lo, hi), as snapshot_window gives them, pruned where the ledger vouches for it."""
        lo, hi = (d if isinstance(d, datetime) else datetime.combine(d, day_time()) for d in (lo, hi))
        first, last = lo.date().isoformat(), (hi - timedelta(microseconds=1)).date().isoformat()
        parts = self._parts()
        checked = [p for p in parts if p.verified and first <= p.day <= last]
        rest = [p for p in parts if not p.verified]
        vouched = snapshot_window(self._read(checked), lo, hi, vouched=True)
        return vouched.unionByName(snapshot_window(self._read(rest), lo, hi)) if rest else vouched

    def summary(self) -> DataFrame:
        """Row and column count of the whole lake, from the ledger and the stored schema; reads no data."""
        appended = self.entries().filter("kind = 'append'")
        parts = self._parts()
        stored = self.spark.read.parquet(self._paths(parts)[0]).columns if parts else SNAPSHOT_COLUMNS
        return appended.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.lit(len(stored)).cast("bigint").alias("column_count"),
        )

    def batches(self) -> DataFrame:
        """What each append added: batch, rows, span of times, files and bytes."""
        total = lambda name: F.aggregate("days", F.lit(0).cast("bigint"), lambda a, d: a + d[name])
        return self.entries().filter("kind = 'append'").select(
            "batch", "rows", "malformed", "misplaced", "first_time", "last_time", "committed_at",
            total("files").alias("files"), total("bytes").alias("bytes"),
        )

    def _read(self, parts: list[Part]) -> DataFrame:
        schema = lake_schema().add("ingest_date", T.DateType())
        if not parts:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", self.data).parquet(*self._paths(parts))
        return rows.select(schema.names)

    def _paths(self, parts: list[Part]) -> list[str]:
        return [f"{self.data}/batch={p.folder}/ingest_date={p.day}" for p in parts]

    def _parts(self) -> list[Part]:
        """What readers read, in a steady order."""
        entries = self.entries()
        gone = entries.select(F.explode("replaces").alias("_r")).select("_r.folder", "_r.day")
        size = F.aggregate("days", F.lit(0).cast("bigint"), lambda a, d: a + d["bytes"])
        held = entries.select(
            "folder", ((F.col("malformed") == 0) & (F.col("misplaced") == 0)).alias("verified"),
            (F.col("rows") / F.greatest(size, F.lit(1))).alias("per_byte"), F.explode("days").alias("_d"),
        ).select("folder", "verified", "_d.day", "_d.files", "_d.bytes", F.ceil(F.col("per_byte") * F.col("_d.bytes")).alias("rows"))
        live = held.join(gone, ["folder", "day"], "left_anti").orderBy("day", "folder").collect()
        return [Part(r.folder, r.day, r.files, r.bytes, r.rows, r.verified and r.day != _NO_DAY) for r in live]

    def _by_day(self) -> dict[str, list[Part]]:
        days: dict[str, list[Part]] = {}
        for part in self._parts():
            if part.verified:
                days.setdefault(part.day, []).append(part)
        return days

    def _last_pack(self) -> int:
        packs = self.entries().filter("kind = 'pack'").agg(F.max(F.col("batch").cast("int")))
        return packs.first()[0] or 0


def landed_batch(spark: SparkSession, src: str) -> str:
    """A name for the landed files under `src`, by their paths, sizes and times: the same for a rerun, new once one changes."""
    found = sorted((f.path, f.size, f.changed) for f in files.stored(spark, src))
    return f"landed-{uuid.uuid5(uuid.NAMESPACE_URL, repr(found)).hex}"


def is_batch_lake(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/ledger")


def _checked(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {batch!r}")
    return batch


def _place(path: str) -> tuple[str, str]:
    """Folder and day of a data file; no day if it is none, such as a mark of the writer's."""
    steps = dict(s.split("=", 1) for s in path.split("/") if s.startswith(("batch=", "ingest_date=")))
    return steps.get("batch", ""), "" if path.rpartition("/")[2].startswith(("_", ".")) else steps.get("ingest_date", "")


def _worth_packing(parts: list[Part], file_bytes: int) -> bool:
    """Whether at least half of a day's files, and one, could be saved.

    Files with half the rows they may have are left: where ranges of rows don't end with days, a day's are cut in two.
    """
    now = sum(p.files for p in parts)
    return now > 1 and now >= 2 * _n_files(sum(p.bytes for p in parts), 2 * sum(p.rows for p in parts), file_bytes)


def _n_files(size: int, rows: int, file_bytes: int) -> int:
    return max(1, -(-size // file_bytes), -(-rows // FILE_ROWS))
