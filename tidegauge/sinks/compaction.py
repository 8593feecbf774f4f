"""Fewer, larger files for a lake that many micro-batches append to.

Nothing is changed in place. Small files of a day are dealt to bins by their size, every
bin is rewritten as a file in a folder beside the lake, and a snapshot then names the
files that were replaced and those that replace them. A snapshot is one Parquet write, seen
when it has committed, so a reader has the files before or after a compaction and never a
mixture. Files that arrive later belong to every snapshot. Replaced files may be deleted when
no reader holds an older snapshot any more; that is left to the deployment.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge import schemas
from tidegauge.sinks.listing import LISTED, exists, files, same_path

TARGET = 128 * 2**20
SNAPSHOT = f"{LISTED}, folder string, replaced boolean"


class CompactedLake:
    """A lake at ``path`` with compacted files and snapshots below ``store``."""

    def __init__(self, spark: SparkSession, path: str, store: str):
        self.spark, self.path, self.store = spark, path, store

    def _snapshots(self) -> list[int]:
        """Numbers of the snapshots that are complete, oldest first."""
        if not exists(self.spark, self.store, "snapshots"):
            return []
        root = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.store, "snapshots"))
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in system.listStatus(root)]
        done = [int(name) for name in names if exists(self.spark, self.store, "snapshots", name, "_SUCCESS")]
        return sorted(done)

    def _changes(self) -> DataFrame:
        """What the newest snapshot says of files: replaced, or added in a folder."""
        numbers = self._snapshots()
        if not numbers:
            return self.spark.createDataFrame([], SNAPSHOT)
        return self.spark.read.schema(SNAPSHOT).parquet(os.path.join(self.store, "snapshots", str(numbers[-1])))

    def live(self) -> DataFrame:
        """(path, modificationTime, length, dt, folder) of the files that make up the lake now."""
        changes = self._changes()
        held = files(self.spark, self.path).withColumn("folder", F.lit(self.path))
        held = held.unionByName(changes.filter("not replaced").drop("replaced"))
        gone = changes.filter("replaced").select(same_path("path").alias("key"))
        return held.withColumn("key", same_path("path")).join(gone, "key", "left_anti").drop("key")

    def read(self, schema: str = schemas.ARCHIVED_MESSAGE) -> DataFrame:
        """The rows of the lake; day filters reach the folders as in any table."""
        return self._rows(self.live(), schema)

    def _rows(self, held: DataFrame, schema: str, with_key: bool = False) -> DataFrame:
        # the list of files, which a scan plans on the driver in any case
        folders: dict[str, list[str]] = {}
        for r in held.select("path", "folder").toLocalIterator():
            folders.setdefault(r.folder, []).append(r.path)
        rows = self.spark.createDataFrame([], f"{schema}, key string" if with_key else schema)
        for folder, paths in folders.items():
            part = self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)
            rows = rows.unionByName(part.select("*", same_path("_metadata.file_path").alias("key")) if with_key else part)
        return rows

    def plan(self, target: int = TARGET) -> DataFrame:
        """(path, length, dt, folder, bin) of the files to rewrite: small ones that share a bin with others."""
        in_order = Window.partitionBy("dt").orderBy("length", "path").rowsBetween(Window.unboundedPreceding, 0)
        small = self.live().filter(F.col("length") < target * 0.75)
        dealt = small.withColumn("bin", F.floor((F.sum("length").over(in_order) - 1) / target))
        alone = Window.partitionBy("dt", "bin")
        return dealt.withColumn("n", F.count("*").over(alone)).filter("n > 1").drop("n")

    def compact(self, target: int = TARGET, schema: str = schemas.ARCHIVED_MESSAGE) -> int:
        """Rewrite small files; the number of files replaced.

        Two compactions at once do not mix: the snapshot of the second one fails.
        """
        numbers = self._snapshots()
        folder = os.path.join(self.store, "data", uuid.uuid4().hex)
        planned = self.plan(target).withColumn("key", same_path("path")).persist()
        try:
            n = planned.count()
            if not n:
                return 0
            bins = planned.select("dt", "bin").distinct().count()
            (
                self._rows(planned, schema, with_key=True)
                .join(planned.select("key", "bin"), "key")
                .repartition(bins, F.col("dt"), "bin")
                .drop("key", "bin")
                .write.partitionBy("dt")
                .parquet(folder)
            )
            added = files(self.spark, folder).withColumn("folder", F.lit(folder)).withColumn("replaced", F.lit(False))
            before = self._changes()
            gone = planned.select("path", "modificationTime", "length", "dt", "folder", "key").withColumn("replaced", F.lit(True))
            # a file a compaction made and this one replaced is no longer an added one
            kept = before.withColumn("key", same_path("path")).join(gone.select("key"), "key", "left_anti").drop("key")
            following = kept.unionByName(gone.filter(F.col("folder") == self.path).drop("key")).unionByName(added)
            number = numbers[-1] + 1 if numbers else 0
            following.coalesce(1).write.mode("errorifexists").parquet(os.path.join(self.store, "snapshots", str(number)))
            return n
        finally:
            planned.unpersist()
