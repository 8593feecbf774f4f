"""Registry tables: references, inserts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.times import before, instant

#: A position as a whole number.
PLACES = {kind: "cast({} as decimal(19,0))" for kind in ("byte", "short", "integer", "long")}
PLACES |= {"date": "cast(unix_date({}) as decimal(19,0))", "timestamp": "cast(unix_micros({}) as decimal(19,0))"}
#: Behind every position: 2^62, which keeps the codes within 38 digits.
LAST = 2**62
CODE = "__code"


def lookup(rows: DataFrame, dimension: DataFrame, key: str, wanted: str) -> DataFrame:
    """Add ``wanted`` of the dimension row with the same ``key`` (null if none).

    Not for a dimension in which ``key`` repeats.
    """
    return rows.join(dimension.select(key, wanted), key, "left")


def first_per_key(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Per key the row with the smallest position, rows without one last.

    ``position`` is a whole number, a date or an instant. Position and a hash of the row
    make one number of fixed width, whose least value a hash aggregate finds in every task
    before the shuffle; the row it belongs to is joined back. Of rows of one position the
    one with the smallest hash counts, of equal rows one.
    """
    kind = rows.schema[position].dataType.typeName()
    if kind not in PLACES:
        raise TypeError(f"a position is one of {', '.join(PLACES)}, not {kind}")
    place = F.coalesce(F.expr(PLACES[kind].format(f"`{position}`")), F.lit(LAST).cast("decimal(19,0)"))
    # 2^64 numbers for each position, which may reach from -2^62 to 2^62
    code = place * F.lit(str(2**64)).cast("decimal(20,0)") + F.xxhash64(*rows.columns).cast("decimal(19,0)")
    coded = rows.withColumn(CODE, code.cast("decimal(38,0)"))
    least = coded.groupBy(key).agg(F.min(CODE).alias(CODE))
    once = Window.partitionBy(key).orderBy(CODE)
    return (
        coded.join(least, [key, CODE])
        .withColumn("__n", F.row_number().over(once))
        .filter("__n = 1")
        .select(*rows.columns)
    )


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: str, position: str
) -> DataFrame:
    """Rows to append: first of each new key; keys already present are left alone.

    Rows without a key are left out, as the registry tables forbid them.
    """
    candidates = first_per_key(incoming.filter(F.col(key).isNotNull()), key, position)
    return candidates.join(existing.select(key), key, "left_anti").drop(position)


def valid_references(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return rows.join(parents.select(key), key, "left_semi")


def orphan_rows(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null or not among the parents."""
    return rows.join(parents.select(key), key, "left_anti")


def orphan_report(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Unknown keys with their number of rows; counted before the join."""
    return orphan_rows(rows.groupBy(key).agg(F.count("*").alias("n")), parents, key)


def anomaly_columns(found: DataFrame) -> DataFrame:
    """The columns kept in the anomaly registry."""
    return found.select("ts", "device_id", "metric", "value", "score", "method", "severity")


def latest_anomalies(found: DataFrame, n: int = 50) -> DataFrame:
    """The newest anomalies; ties are ordered by device, metric, value and score."""
    order = [F.desc("ts"), F.asc("device_id"), F.asc("metric"), F.asc("value"), F.asc("score")]
    return anomaly_columns(found).orderBy(*order).limit(n)


def recent(found: DataFrame, as_of: str | Column, span: str = "24 hours") -> DataFrame:
    ts = F.col("ts")
    return found.filter((ts >= before(as_of, span)) & (ts < instant(as_of)))


def anomaly_count(
    found: DataFrame, as_of: str | Column | None = None, span: str = "24 hours"
) -> DataFrame:
    """Anomalies per device, of the last ``span`` before ``as_of`` if that is given."""
    picked = found if as_of is None else recent(found, as_of, span)
    return picked.groupBy("device_id").agg(F.count("*").alias("n"))


def top_devices(
    found: DataFrame, as_of: str | Column, span: str = "24 hours", n: int = 10
) -> DataFrame:
    """Devices with the most recent anomalies; equal counts are ordered by device."""
    return anomaly_count(found, as_of, span).orderBy(F.desc("n"), "device_id").limit(n)


def anomalies_by(found: DataFrame, devices: DataFrame, *attributes: str) -> DataFrame:
    """Anomaly counts by device attributes such as zone or model.

    Counted per device first, so the join sees one row per device whatever a
    single device produced. Anomalies of unknown devices count under null.
    """
    per_device = anomaly_count(found)
    known = devices.select("device_id", *attributes)
    return (
        per_device.join(known, "device_id", "left")
        .groupBy(*attributes)
        .agg(F.sum("n").alias("n"))
    )


def before_after_maintenance(
    found: DataFrame, schedules: DataFrame, days: int = 30
) -> DataFrame:
    """Anomalies in the ``days`` days before and from each maintenance date.

    The date range is turned into an equality: anomalies are counted per device
    and day, and each schedule lists the 2 x ``days`` days it looks at. So neither
    a noisy device nor one with many schedules pairs all its rows.
    """
    daily = found.groupBy("device_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("c"))
    offsets = F.sequence(F.lit(-days), F.lit(days - 1))
    looked_at = schedules.select(
        "schedule_id", "device_id", "last_maintained", F.explode(offsets).alias("offset")
    ).withColumn("day", F.date_add("last_maintained", F.col("offset")))
    joined = looked_at.join(daily, ["device_id", "day"], "left")
    count = F.coalesce("c", F.lit(0))
    return joined.groupBy("schedule_id", "device_id", "last_maintained").agg(
        F.sum(F.when(F.col("offset") < 0, count).otherwise(0)).alias("n_before"),
        F.sum(F.when(F.col("offset") >= 0, count).otherwise(0)).alias("n_after"),
    )


def declared_metrics(devices: DataFrame) -> DataFrame:
    """One row per metric in the comma-separated list of each device."""
    return devices.select(
        "device_id", F.explode(F.split(F.trim("metrics"), r"\s*,\s*")).alias("metric")
    ).filter(F.col("metric") != "")


def declared_vs_observed(devices: DataFrame, rows: DataFrame) -> DataFrame:
    """Device metrics that are declared, observed or both, with the observed count."""
    observed = rows.groupBy("device_id", "metric").agg(F.count("*").alias("n"))
    declared = declared_metrics(devices).distinct().withColumn("declared", F.lit(True))
    status = (
        F.when(F.col("declared").isNull(), F.lit("undeclared"))
        .when(F.col("n").isNull(), F.lit("silent"))
        .otherwise(F.lit("ok"))
    )
    return declared.join(observed, ["device_id", "metric"], "full").select(
        "device_id", "metric", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status")
    )
