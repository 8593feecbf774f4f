"""Session settings the library relies on.

``build_session`` is for jobs that own their session; ``tune`` puts the same
SQL settings on a session somebody else created. Both only touch settings that
change results (time zone) or let Spark choose plans by measured size.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
SQL_SETTINGS = {
    # day keys, windows and text timestamps must not depend on the host
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a device-metric-window holding a large share of the rows is split into
    # several join tasks, also when that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # joins against per-window statistics: hash the statistics instead of
    # sorting the readings when every statistics partition is measured below
    # this size, and stay with the spilling sort-merge join when one is not
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # of a key that a JSON object repeats the last value counts, as other readers have it
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # upload changed keys per batch rather than whole RocksDB snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """SQL settings for a while; what the session had comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The parent is the folder named by ``spark.checkpoint.dir``. A local session that names
    none keeps scratch tables in its warehouse; on a cluster, where that may be a folder of
    the driver's machine, it has to be named.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "tidegauge-scratch")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
