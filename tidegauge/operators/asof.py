"""What was in force when a reading was taken: as-of lookup in versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.functions.times import micros


def as_of(
    rows: DataFrame,
    versions: DataFrame,
    keys: tuple[str, ...],
    ts: str = "ts",
    valid_from: str = "valid_from",
    block: str = "1 day",
) -> DataFrame:
    """``rows`` with the columns of the newest version of their key at their time; null if there is none.

    A version holds from ``valid_from`` on, until the next one of its key. Rows and versions
    are put in one order and the last version is carried forward. A key is cut into blocks of
    time, each with the version that enters it, so a key with many rows spans tasks and none
    sees more than a block of it. Rows without time or with an incomplete key find nothing.
    Of versions of one instant the one with the largest columns holds. Static input.
    """
    width = micros(block)
    others = [c for c in versions.columns if c not in (*keys, valid_from)]
    whole = F.lit(True)
    for c in (*keys, ts):
        whole = whole & F.col(c).isNotNull()

    def blocked(df: DataFrame, at: str) -> DataFrame:
        return df.withColumn("block", F.expr(f"(unix_micros({at}) - pmod(unix_micros({at}), {width})) div {width}"))

    held = (
        versions.select(*keys, F.col(valid_from).alias("at"), F.struct(valid_from, *others).alias("version"))
        .na.drop(subset=[*keys, "at"])
        .groupBy(*keys, "at")
        .agg(F.max("version").alias("version"))
    )
    held = blocked(held, "at")
    known = blocked(rows.filter(whole).select(*keys, F.col(ts).alias("at"), F.struct("*").alias("row")), "at")

    # the version that enters a block: the newest of all earlier blocks, over one row a block
    newest = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    used = known.select(*keys, "block").distinct().withColumn("used", F.lit(True))
    ends = held.groupBy(*keys, "block").agg(F.max_by("version", "at").alias("last"))
    entering = (
        used.join(ends, [*keys, "block"], "full")
        .withColumn("version", F.last("last", ignorenulls=True).over(newest))
        .filter("used and version is not null")
    )

    nothing = F.lit(None).cast(known.schema["row"].dataType)
    order = ("at", "kind")
    events = (
        known.select(*keys, "block", "at", F.lit(1).alias("kind"), "row", F.lit(None).cast(held.schema["version"].dataType).alias("version"))
        .unionByName(held.select(*keys, "block", "at", F.lit(0).alias("kind"), nothing.alias("row"), "version"))
        .unionByName(
            entering.select(*keys, "block", F.lit(None).cast("timestamp").alias("at"), F.lit(0).alias("kind"), nothing.alias("row"), "version")
        )
    )
    so_far = Window.partitionBy(*keys, "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        events.withColumn("version", F.last("version", ignorenulls=True).over(so_far))
        .filter("kind = 1")
        .select("row.*", *(F.col(f"version.{c}").alias(c) for c in (valid_from, *others)))
    )
    return found.unionByName(rows.filter(~whole), allowMissingColumns=True)
