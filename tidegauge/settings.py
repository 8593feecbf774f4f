"""Job settings read from environment variables.

Credentials have no defaults: a job that needs one and does not find it fails
at start instead of connecting with a well-known password.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Variable names and defaults a deployment already uses.
TOPIC_RAW = "iot.sensor.raw"
TOPIC_ANOMALY = "iot.sensor.anomaly"
DEFAULT_LOCATION = "farm-zone-1"
DEFAULT_MODEL = "ESP32"
SOURCE_REST = "ingress-rest-api"
SOURCE_MQTT = "ingress-mqtt"
MEASUREMENT_METRICS = "sensor_metrics"
MEASUREMENT_ANOMALIES = "sensor_anomalies"
WINDOW = "1 minute"
WATERMARK = "2 minutes"
Z_THRESHOLD = 2.0
MIN_STD = 0.05
ALERT_THRESHOLD = 3.0

class MissingSetting(RuntimeError):
    """A required setting is not in the environment."""


def flag(env: Mapping[str, str], name: str, default: bool) -> bool:
    return env.get(name, str(default)).strip().lower() == "true"


def require(env: Mapping[str, str], name: str) -> str:
    value = env.get(name)
    if not value:
        raise MissingSetting(f"set {name} in the environment")
    return value


def checkpoint_location(job: str, env: Mapping[str, str] | None = None) -> str:
    """Checkpoint folder of a job.

    ``<JOB>_CHECKPOINT_DIR`` names the folder itself; ``CHECKPOINT_DIR`` and
    ``CHECKPOINT_BASE_DIR``, in that order, name a parent folder.
    """
    env = os.environ if env is None else env
    own = env.get(f"{job.upper()}_CHECKPOINT_DIR")
    if own:
        return own
    parent = env.get("CHECKPOINT_DIR") or env.get("CHECKPOINT_BASE_DIR")
    if not parent:
        raise MissingSetting(
            f"set {job.upper()}_CHECKPOINT_DIR, CHECKPOINT_DIR or CHECKPOINT_BASE_DIR "
            "to a folder every executor can reach"
        )
    return os.path.join(parent, job)


@dataclass(frozen=True)
class BrokerSettings:
    bootstrap: str = "kafka:9092"
    raw_topic: str = TOPIC_RAW
    anomaly_topic: str = TOPIC_ANOMALY
    starting_offsets: str = "latest"
    #: Records per micro-batch; none by default, so that a job takes what its cluster can do.
    max_offsets_per_trigger: int | None = None
    #: Fail when the topic has lost records that were not read yet, rather than skip them.
    fail_on_data_loss: bool = True

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> BrokerSettings:
        env = os.environ if env is None else env
        return cls(
            bootstrap=env.get("KAFKA_BOOTSTRAP", cls.bootstrap),
            raw_topic=env.get("KAFKA_TOPIC_RAW") or env.get("KAFKA_TOPIC") or cls.raw_topic,
            anomaly_topic=env.get("KAFKA_TOPIC_ANOMALY", cls.anomaly_topic),
            starting_offsets=env.get("KAFKA_STARTING_OFFSETS", cls.starting_offsets),
            max_offsets_per_trigger=int(env.get("MAX_OFFSETS_PER_TRIGGER", "0")) or None,
            fail_on_data_loss=flag(env, "FAIL_ON_DATA_LOSS", True),
        )


@dataclass(frozen=True)
class LakeSettings:
    raw_path: str
    offline_path: str | None = None
    thresholds_path: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> LakeSettings:
        env = os.environ if env is None else env
        return cls(
            raw_path=require(env, "RAW_S3_PATH"),
            offline_path=env.get("OFFLINE_STATS_S3_PATH") or env.get("OUT_S3_PATH"),
            thresholds_path=env.get("THRESHOLDS_S3_PATH"),
        )


@dataclass(frozen=True)
class ScoringSettings:
    window: str = WINDOW
    watermark: str = WATERMARK
    z_threshold: float = Z_THRESHOLD
    min_std: float = MIN_STD
    #: State keys the readings of one window and series are spread over.
    salts: int = 16

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> ScoringSettings:
        env = os.environ if env is None else env
        return cls(
            window=env.get("WINDOW_DURATION", WINDOW),
            watermark=env.get("WATERMARK_DELAY", WATERMARK),
            z_threshold=float(env.get("Z_THRESHOLD", Z_THRESHOLD)),
            min_std=float(env.get("MIN_STD", MIN_STD)),
            salts=int(env.get("SCORING_SALTS", "16")),
        )


@dataclass(frozen=True)
class JdbcSettings:
    url: str
    user: str
    password: str = field(repr=False)
    table: str = "anomalies"
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcSettings:
        env = os.environ if env is None else env
        return cls(
            url=require(env, "PG_URL"),
            user=require(env, "PG_USER"),
            password=require(env, "PG_PASSWORD"),
            table=env.get("PG_TABLE", "anomalies"),
        )


@dataclass(frozen=True)
class TimeSeriesSettings:
    url: str
    org: str
    bucket: str
    token: str = field(repr=False)
    precision: str = "ns"
    metrics_measurement: str = MEASUREMENT_METRICS
    anomalies_measurement: str = MEASUREMENT_ANOMALIES

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> TimeSeriesSettings:
        env = os.environ if env is None else env
        return cls(
            url=require(env, "INFLUX_URL"),
            org=require(env, "INFLUX_ORG"),
            bucket=require(env, "INFLUX_BUCKET"),
            token=require(env, "INFLUX_TOKEN"),
            precision=env.get("INFLUX_PRECISION", "ns"),
            metrics_measurement=env.get("INFLUX_MEAS_METRICS", MEASUREMENT_METRICS),
            anomalies_measurement=env.get("INFLUX_MEAS_ANOMS", MEASUREMENT_ANOMALIES),
        )


@dataclass(frozen=True)
class AlertSettings:
    threshold: float = ALERT_THRESHOLD
    only_flagged: bool = True

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> AlertSettings:
        env = os.environ if env is None else env
        return cls(
            threshold=float(env.get("SCORE_THRESHOLD", ALERT_THRESHOLD)),
            only_flagged=flag(env, "ONLY_FLAGGED", True),
        )
