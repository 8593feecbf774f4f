"""Small row builders."""

from datetime import datetime, timedelta, timezone

from tidegauge import schemas

START = datetime(2026, 1, 13, tzinfo=timezone.utc)


def at(minutes=0.0):
    return START + timedelta(minutes=minutes)


def reading(minute, value, device="d", metric="temperature", location="l", model="m"):
    return (at(minute), device, location, model, metric, value)


def readings(spark, rows):
    return spark.createDataFrame(rows, schemas.METRIC_ROW)


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def column(df, name):
    return [row[name] for row in df.collect()]
