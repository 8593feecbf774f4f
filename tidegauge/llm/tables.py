"""Reading inputs and keeping intermediate tables where every executor sees them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(columns: list[str]) -> list[Column]:
    """Columns by their names, whatever characters those hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def unused(columns: list[str], name: str) -> str:
    """``name``, or that with underscores behind it, so that no column has it."""
    while name in columns:
        name += "_"
    return name


class Workspace:
    """A fresh folder below ``spark.checkpoint.dir`` for one run of an operator.

    Tables written here cut the lineage: a lost executor costs the tasks that
    ran on it, not the stages before the written table.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = scratch_dir(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        """Delete a table nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        conf = self.spark._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)

    def close(self) -> None:
        """Delete the whole folder, when no result that reads from it is needed any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 5; labels of fold 0 are held out."""
    return F.crc32(doc_id.cast("string")) % 5


def training_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text, label): one row for each labelled document.

    Of rows that repeat an id the text with the smallest hash counts, chosen on the map
    side, so there are no more rows than labels however often an id occurs. ``known`` comes
    from ``known_labels``, which bounds it; the texts stay where they are read.
    """
    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return joined.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def known_labels(labels: DataFrame, name: str, bound: int) -> DataFrame:
    """(doc_id, label) of at most about ``bound`` documents outside fold 0.

    Rows without id or label are ignored and the largest label of a repeated id
    counts. Beyond ``bound`` documents an even share is kept, chosen by a hash of
    the id, so that every size is treated alike.
    """
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
        .filter(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max(name).cast("int").alias("label"))
    )
    n = usable.count()
    if n > bound:
        share = int(2**31 * bound / n)
        usable = usable.filter(F.xxhash64("doc_id", F.lit(name)).bitwiseAND(2**31 - 1) < share)
    return usable
