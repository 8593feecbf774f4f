"""A lake laid out so that a filter on a device or a stretch of time skips files.

Within a day rows are ordered by a key that interleaves the bits of the device's bucket
and of the time of day, so a row group holds few devices over a short stretch. Their
least and largest values are in the file's footer, where the scan looks before it reads a
row group; devices that share a bucket are told apart by a Bloom filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import with_settings

#: Devices fall into 2^BITS buckets, and a day into as many stretches.
BITS = 12
ROW_GROUP = 32 * 2**20
DAY = 86_400_000_000


def device_bucket(device: Column) -> Column:
    return F.pmod(F.xxhash64(device), F.lit(1 << BITS)).cast("int")


def interleaved(a: Column, b: Column, bits: int = BITS) -> Column:
    """The bits of two numbers in turns, those of ``a`` in the higher places."""
    key = F.lit(0).cast("long")
    for i in range(bits):
        for number, place in ((a, 2 * i + 1), (b, 2 * i)):
            bit = F.shiftright(number.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, place))
    return key


def write_clustered(
    rows: DataFrame, path: str, ts: str = "ts", device: str = "device_id", row_group: int = ROW_GROUP, mode: str = "append"
) -> None:
    """Write rows in day folders, each in the order of the interleaved key; adds ``device_bucket``.

    Ranges of (day, key) go to tasks by sampled bounds, so a day or device with a large
    share of the rows spans many files.
    """
    stretch = F.expr(f"pmod(unix_micros({ts}), {DAY}) * {1 << BITS} div {DAY}")
    placed = rows.withColumns({"dt": F.to_date(ts), "device_bucket": device_bucket(F.col(device))})
    placed = placed.withColumn("key", interleaved(F.col("device_bucket"), stretch))
    ordered = placed.repartitionByRange("dt", "key", ts).sortWithinPartitions("dt", "key", ts).drop("key")
    # the older 96-bit form of an instant has no least and largest value in a footer
    with with_settings(rows.sparkSession, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
        (
            ordered.write.mode(mode)
            .option("parquet.block.size", row_group)
            .option("parquet.page.size", min(row_group // 8, 2**20))
            .option(f"parquet.bloom.filter.enabled#{device}", "true")
            .partitionBy("dt")
            .parquet(path)
        )


def of_device(lake: DataFrame, device_id: str, device: str = "device_id") -> DataFrame:
    """The rows of one device; its bucket is what the footers are searched for."""
    bucket = device_bucket(F.lit(device_id))
    return lake.filter((F.col("device_bucket") == bucket) & (F.col(device) == device_id))


def between(lake: DataFrame, since: Column, until: Column, ts: str = "ts") -> DataFrame:
    """Rows from ``since`` on and before ``until``, with the days they can lie in."""
    days = F.col("dt").between(since.cast("date"), until.cast("date"))
    return lake.filter(days & (F.col(ts) >= since) & (F.col(ts) < until))
