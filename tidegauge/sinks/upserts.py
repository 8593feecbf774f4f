"""Windows that are still open, kept in a table by key.

A stream in update mode gives a window again whenever readings changed it. Every
micro-batch is one folder, replaced if the batch is repeated; a reader takes of each key
the row of the newest batch. ``fold`` rewrites the folders read so far into one, so that a
table that is written for ever stays as large as it has keys.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks.listing import exists


class KeyedTable:
    """Rows by ``keys`` under ``path``; ``schema`` is theirs as DDL text."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys

    def writer(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch`` of a stream in update mode, whose micro-batch has a key once."""

        def write(rows: DataFrame, batch_id: int) -> None:
            rows.write.mode("overwrite").parquet(os.path.join(self.path, f"batch_id={batch_id}"))

        return write

    def _versions(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        return self.spark.read.schema(f"{self.schema}, batch_id bigint").parquet(self.path)

    def read(self) -> DataFrame:
        """The newest row of each key."""
        versions = self._versions()
        names = [c for c in versions.columns if c != "batch_id"]
        rest = [c for c in names if c not in self.keys]
        newest = F.max_by(F.struct(*rest), "batch_id").alias("row")
        return versions.groupBy(*self.keys).agg(newest).select(*self.keys, "row.*").select(*names)

    def fold(self, up_to: int) -> None:
        """Leave of the batches up to one only the newest rows, in that batch's folder.

        Run it between micro-batches. What is folded is written before anything is
        replaced; a batch that stays beside its fold does not change what is read.
        """
        old = self._versions().filter(F.col("batch_id") <= up_to)
        folded = KeyedTable(self.spark, self.path, self.schema, self.keys)
        folded._versions = lambda: old
        held = os.path.join(os.path.dirname(self.path.rstrip("/")), f"fold-{os.path.basename(self.path.rstrip('/'))}-{up_to}")
        folded.read().write.mode("overwrite").parquet(held)
        numbers = [r.batch_id for r in old.select("batch_id").distinct().collect()]
        rows = self.spark.read.schema(self.schema).parquet(held)
        rows.write.mode("overwrite").parquet(os.path.join(self.path, f"batch_id={up_to}"))
        for number in numbers:
            if number < up_to:
                empty = self.spark.createDataFrame([], self.schema)
                empty.write.mode("overwrite").parquet(os.path.join(self.path, f"batch_id={number}"))
