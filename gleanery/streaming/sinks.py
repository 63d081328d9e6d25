"""Sinks that a replayed batch doesn't change: a table of batches with a ledger, and an archive by content.

A batch is written beside the others first, and counts once its entry stands in the ledger, a file that is made in one step and never overwritten. What a stopped run
left behind without an entry is never read. Files live in a folder that all machines share.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.operators.durable import hadoop_path, release, settle


class BatchTable:
    """Rows by key in numbered batches: the last batch that holds a key tells its row.

    Reading merges what the ledger lists: rows of batches after the last fold, and the fold. Number of batches between folds bounds the ledger that the driver lists.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def _ledger(self) -> dict[str, str]:
        """Entries by name, each with the folder that holds its rows."""
        where, files = hadoop_path(self.spark, f"{self.path}/_ledger")
        if not files.exists(where):
            return {}
        names = (status.getPath().getName() for status in files.listStatus(where))
        return dict(sorted(name.split("=", 1) for name in names if "=" in name))

    def _enter(self, name: str, folder: str) -> bool:
        """Put an entry into the ledger, unless its name is there: one of several runs wins. The file's name says it all, so that it can't be seen half written."""
        if name in self._ledger():
            return False
        where, files = hadoop_path(self.spark, f"{self.path}/_ledger/{name}={folder}")
        files.mkdirs(where.getParent())
        return files.createNewFile(where)

    def committed(self, batch_id: int) -> bool:
        ledger = self._ledger()
        folds = [int(name.split("-")[1]) for name in ledger if name.startswith("fold-")]
        return f"batch-{batch_id:012d}" in ledger or any(batch_id <= f for f in folds)

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Write a batch once: False, and no change, if it is committed. Of rows of one key in a batch the last by all columns stays."""
        if self.committed(batch_id):
            return False
        folder = f"rows-{batch_id:012d}-{uuid.uuid4().hex}"
        names = self.schema.fieldNames()
        last = batch.select(*names).groupBy(*self.keys).agg(F.max(F.struct(*[c for c in names if c not in self.keys])).alias("r")).select(*self.keys, "r.*").select(*names)
        last.withColumn("_batch", F.lit(batch_id).cast("long")).write.parquet(f"{self.path}/{folder}")
        return self._enter(f"batch-{batch_id:012d}", folder)

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        """For foreachBatch."""
        self.write(batch, batch_id)

    def _rows(self) -> DataFrame:
        ledger = self._ledger()
        folds = sorted(name for name in ledger if name.startswith("fold-"))
        upto = int(folds[-1].split("-")[1]) if folds else -1
        folders = [ledger[name] for name in ledger if name.startswith("batch-") and int(name.split("-")[1]) > upto] + [ledger[f] for f in folds[-1:]]
        whole = StructType(list(self.schema)).add("_batch", "long")
        if not folders:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(*[f"{self.path}/{f}" for f in folders])

    def _merged(self) -> DataFrame:
        names = self.schema.fieldNames()
        rest = [c for c in names if c not in self.keys]
        last = self._rows().groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "_batch"), "_batch").alias("r"))
        return last.select(*self.keys, *[F.col(f"r.{c}").alias(c) for c in [*rest, "_batch"]]).select(*names, "_batch")

    def read(self) -> DataFrame:
        """The table: for each key the row of its last batch."""
        return self._merged().drop("_batch")

    def fold(self) -> None:
        """Write the merged rows as one, which stands for all batches up to the last; older folders aren't deleted, since a reader may be at them."""
        ids = [int(name.split("-")[1]) for name in self._ledger() if name.startswith(("batch-", "fold-"))]
        if ids:
            folder = f"fold-rows-{uuid.uuid4().hex}"
            self._merged().write.parquet(f"{self.path}/{folder}")
            self._enter(f"fold-{max(ids):012d}", folder)

    def snapshot(self) -> BatchTable:
        """This version of the table with its own, empty place for writes: what a dry run writes there is seen by it alone, and goes with drop()."""
        return _Draft(self)


class _Draft(BatchTable):
    """A table on top of a fixed list of another one's folders."""

    def __init__(self, base: BatchTable):
        super().__init__(base.spark, f"{base.path}/_draft-{uuid.uuid4().hex}", base.schema, base.keys)
        self.base = base._merged()
        self.hidden: Column | None = None

    def forget(self, rows: Column) -> None:
        """Hide rows of the base, as if they had never been written."""
        self.hidden = rows if self.hidden is None else self.hidden | rows

    def _rows(self) -> DataFrame:
        base = self.base if self.hidden is None else self.base.where(~F.coalesce(self.hidden, F.lit(False)))
        later = super()._rows()
        top = self.base.agg(F.coalesce(F.max("_batch"), F.lit(-1)).alias("top"))
        return base.unionByName(later.crossJoin(F.broadcast(top)).withColumn("_batch", F.col("_batch") + F.col("top") + 1).drop("top"))  # one row

    def drop(self) -> None:
        where, files = hadoop_path(self.spark, self.path)
        files.delete(where, True)


_ARCHIVE = "body string, hash string, seen long, captured date, day date, source_id string"


def archive(batch: DataFrame, path: str, period: str = "day") -> None:
    """Add captures (day, source_id, body, seen) to the archive, a folder for each day and source: one row for each day, source and distinct body, with the first time it was seen.

    Where days hold little, a folder holds a "month" of a source, and is named by the month's first day: every folder costs a file to write and to read. Folders in which the batch tells a new body, or an earlier time, are read, merged with the batch by hash, and take the place of the old ones by dynamic overwrite; others
    stay, so the same batch again writes nothing. Rows without a day or source have no folder and are left out; a null body is none.
    """
    if period not in ("day", "month"):
        raise ValueError(f"a folder holds a day or a month, not {period}")
    spark = batch.sparkSession
    fresh = batch.where("day is not null and source_id is not null and body is not null").select(F.col("day").cast("date").alias("captured"), F.col("source_id").cast("string").alias("source_id"), F.sha2("body", 256).alias("hash"), F.col("seen").cast("long").alias("seen"), "body")
    row, folder = ["captured", "source_id", "hash"], ["day", "source_id"]
    first = [F.min("seen").alias("seen"), F.first("body").alias("body")]
    held = settle(fresh.groupBy(*row).agg(*first).withColumn("day", F.trunc("captured", "month") if period == "month" else F.col("captured")))
    both, temporary = held, [held]
    where, files = hadoop_path(spark, path)
    if files.exists(where):
        stored = _stored(spark, path)
        known = stored.join(held.select(*folder).distinct(), folder, "left_semi").select(*row, F.col("seen").alias("since"), F.lit(True).alias("known"))
        news = F.col("known").isNull() | (F.col("seen") < F.col("since")) | (F.col("since").isNull() & F.col("seen").isNotNull())
        changed = settle(held.drop("body").join(known, row, "left").where(news).select(*folder).distinct())
        temporary.append(changed)
        both = held.unionByName(stored).join(changed, folder, "left_semi")
    merged = both.groupBy(*row, "day").agg(*first).select("body", "hash", "seen", "captured", *folder)
    # one file for a folder, several only where it is large
    merged.hint("rebalance", *map(F.col, folder)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folder).parquet(path)
    release(*temporary)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ARCHIVE).parquet(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive; filters on source_id read only its folders, filters on day skip files by their least and greatest day."""
    return _stored(spark, path).select("source_id", "body", "hash", "seen", F.col("captured").alias("day"))


def archived_days(spark: SparkSession, path: str, newest: int) -> DataFrame:
    """The newest days that the archive holds, in rising order."""
    days = read_archive(spark, path).select("day").distinct().orderBy(F.desc("day")).limit(newest)
    return days.orderBy("day")


def archived_sources(spark: SparkSession, path: str, first: Column, last: Column) -> DataFrame:
    """Sources with captures in a range of days: how many days, and how many distinct bodies."""
    begun = F.col("day").between(F.date_sub(first, 31), last)  # folders whose day or month can meet the range
    return _stored(spark, path).where(begun & F.col("captured").between(first, last)).groupBy("source_id").agg(F.count_distinct("captured").alias("n_days"), F.count_distinct("hash").alias("n_bodies"))


def latest_captures(spark: SparkSession, path: str) -> DataFrame:
    """The last capture of each source."""
    newest = Window.partitionBy("source_id").orderBy(F.desc("seen"), "hash")
    narrow = read_archive(spark, path).select("source_id", "day", "seen", "hash")
    return narrow.withColumn("r", F.row_number().over(newest)).where("r = 1").drop("r")


def append_usage(spark: SparkSession, line: DataFrame, path: str, run_id: str) -> bool:
    """Append a run's usage as JSON lines, once: False, and no change, for a run whose folder is there."""
    target = f"{path.rstrip('/')}/run={run_id}"
    where, files = hadoop_path(spark, target + "/_SUCCESS")
    if files.exists(where):
        return False
    line.write.mode("overwrite").json(target)  # what a stopped run left goes
    return True


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str, object]]:
    """Numbered pointers to the folders of snapshots, the newest last."""
    where, files = hadoop_path(spark, f"{path.rstrip('/')}/_current")
    if not files.exists(where):
        return []
    told = ((s.getPath().getName().split("=", 1), s.getPath()) for s in files.listStatus(where))
    return sorted(((int(name[0]), name[1], p) for name, p in told if len(name) == 2), key=lambda x: x[0])


def save_snapshot(events: DataFrame, path: str) -> None:
    """The published events as a whole: readers see the old ones until all new ones are written, then the new ones."""
    spark = events.sparkSession
    old = _pointers(spark, path)
    folder = f"events-{uuid.uuid4().hex}"
    events.write.parquet(f"{path.rstrip('/')}/{folder}")
    pointer, files = hadoop_path(spark, f"{path.rstrip('/')}/_current/{(old[-1][0] if old else 0) + 1}={folder}")
    files.mkdirs(pointer.getParent())
    files.createNewFile(pointer)
    for _, _, p in old:
        files.delete(p, False)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """What save_snapshot wrote last."""
    return spark.read.parquet(f"{path.rstrip('/')}/{_pointers(spark, path)[-1][1]}")
