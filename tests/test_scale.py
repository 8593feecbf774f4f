"""What the physical plans must look like for large and skewed inputs."""

import re

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import anomaly, ewma, metrics, offline, registry
from tidegauge.plans import fixtures as fx


def skewed_rows(spark, n=300_000):
    """A third of all readings belongs to one device, metric and window."""
    third = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.timestamp_seconds(F.when(third, F.lit(30)).otherwise(F.col("id"))).alias("ts"),
        F.when(third, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 997)).alias("device_id"),
        F.when(third, F.lit("l")).otherwise(F.concat(F.lit("l"), F.col("id") % 13)).alias("location"),
        F.when(third, F.lit("m")).otherwise(F.concat(F.lit("m"), F.col("id") % 5)).alias("model"),
        F.when(third, F.lit("t")).otherwise(F.concat(F.lit("m"), F.col("id") % 7)).alias("metric"),
        F.sin(F.col("id")).alias("value"),
    )


def test_hot_group_is_split_over_tasks(spark, conf):
    # the thresholds shrink with the data; the mechanism is the same
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2.0")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    scored = anomaly.score_rows(skewed_rows(spark), "1 hour")
    # a filter on the device would leave nothing for the hot key to stand out from
    rows = scored.select("device_id", "mean", "value", F.spark_partition_id().alias("task"))
    hot = [r for r in rows.collect() if r["device_id"] == "hot"]
    assert len(hot) == 100_000 and len({r["mean"] for r in hot}) == 1
    assert len({r["task"] for r in hot}) > 1
    assert "skew=true" in final_plan(scored)


def test_statistics_are_hashed_when_small_and_sorted_when_not(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    scored = anomaly.score_rows(skewed_rows(spark, 30_000), "1 hour")
    assert "ShuffledHashJoin" in final_plan(scored)
    conf("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    scored = anomaly.score_rows(skewed_rows(spark, 30_000), "1 hour")
    assert "SortMergeJoin" in final_plan(scored)


def final_plan(df):
    """The plan after running it, with the decisions taken by measured sizes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_daily_statistics_shuffle_once_after_partial_aggregation(spark, sf_dir):
    lake = fx.sensor_messages(spark, sf_dir).withColumn("dt", F.to_date("ts"))
    stats = offline.daily_stats(lake)
    assert shuffles(stats) == 1
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan
    scanned = re.search(r"ReadSchema: struct<l_suppkey[^>]*>", plan).group(0)
    assert "l_orderkey" not in scanned and "l_returnflag" not in scanned


def test_thresholds_add_one_shuffle_of_daily_rows(spark, sf_dir):
    lake = fx.sensor_messages(spark, sf_dir).withColumn("dt", F.to_date("ts"))
    assert shuffles(offline.thresholds(offline.daily_stats(lake))) == 2


def written(df):
    """Bytes and rows of each shuffle of a run, from the last to the first."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    df.collect()
    parts = [plan.executedPlan()]
    while parts:
        node = parts.pop(0)
        if node.nodeName() == "Exchange":
            held = node.metrics()
            found.append((held.apply("shuffleBytesWritten").value(), held.apply("shuffleRecordsWritten").value()))
        below = [node.plan()] if node.nodeName().endswith("QueryStage") else []
        parts += below + [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize("name", ["thresholds", "trend_rollup", "offline_stats"])
def test_few_messages_a_device_and_day_are_shuffled_whole(spark, name, tmp_path):
    from tidegauge.plans.queries import QUERIES

    tables = {
        "nation": spark.sql("select 1L as n_nationkey, 'N' as n_name"),
        "supplier": spark.range(50).selectExpr("id as s_suppkey", "1L as s_nationkey"),
        "lineitem": spark.range(2000).selectExpr(
            "id % 50 as l_suppkey", "timestamp_ntz'2026-01-01' + make_interval(0, 0, 0, id % 31) as l_shipdate",
            "'A' as l_returnflag", "double(id) as l_quantity", "double(id) as l_extendedprice", "0.1d as l_discount",
            "0.2d as l_tax",
        ),
    }
    for table, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{table}.parquet")
    # a row per message, not one per reading with the states of all its aggregates
    assert written(QUERIES[name](spark, str(tmp_path)))[-1][1] == 2000


def test_days_of_a_month_are_merged_before_a_trend_shuffles_them(spark, conf):
    rows = spark.range(0, 6000, 1, 8).selectExpr(
        "date_add(date'2026-01-01', cast(id % 59 as int)) as dt",
        "concat('d', id div 59 % 10) as device_id",
        "map('t', cast(id as double), 'h', 1d) as metrics",
    )
    daily = offline.daily_stats(rows, gather="month")
    assert daily.count() == 59 * 10 * 2
    months, messages = written(offline.trend(daily, "month"))
    assert (months[1], messages[1]) == (2 * 10 * 2, 6000)


def test_day_filters_reach_the_lake_partitions(spark, tmp_path):
    path = str(tmp_path / "lake")
    rows = spark.sql(
        "select date_add(date'2026-01-01', cast(id % 5 as int)) as dt, 'd' as device_id,"
        " map('t', cast(id as double)) as metrics from range(20)"
    )
    rows.write.partitionBy("dt").parquet(path)
    stats = offline.daily_stats(spark.read.parquet(path), "2026-01-02", "2026-01-03")
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2026-01-02[^\]]*dt#\d+ <= 2026-01-03", plan)
    assert stats.count() == 2


def test_reports_count_before_they_join(spark, sf_dir, conf):
    # with a small registry Spark may filter by broadcast first instead
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = fx.fleet_rows(spark, sf_dir)
    known = fx.devices(spark, sf_dir)
    for df in (
        registry.anomalies_by(found, known, "model"),
        registry.orphan_report(found, known, "device_id"),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Join"):]
        assert "partial_count" in below


def test_first_per_key_reduces_before_the_shuffle(spark):
    rows = skewed_rows(spark, 1000).withColumn("position", F.monotonically_increasing_id())
    plan = registry.first_per_key(rows, "device_id", "position")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.index("partial_min") > text.index("Exchange")
    assert not re.search("SortAggregate|ObjectHashAggregate", text)


def test_features_are_aggregated_by_hashing(spark):
    text = metrics.window_features(skewed_rows(spark, 1000))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in text and not re.search("SortAggregate|ObjectHashAggregate|Sort ", text)


def test_copies_of_a_point_collapse_before_points_are_built(spark):
    rows = skewed_rows(spark, 3000)
    text = metrics.metric_points(rows)._jdf.queryExecution().executedPlan().toString()
    assert text.index("collect_list") < text.index("partial_max")
    assert metrics.metric_points(rows).filter("device_id = 'hot'").count() == 1


def test_no_operator_calls_python_or_cross_joins(spark, sf_dir):
    from tidegauge.plans.queries import QUERIES

    for name in ("zscore_anomalies", "before_after_maintenance", "normalize_mqtt",
                 "metric_lines", "alert_lines", "threshold_scored"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan), name


def test_moving_average_scans_once_and_carries_over_batches(spark, sf_dir, conf):
    rows = fx.sensor_rows(spark, sf_dir)
    scored = ewma.ewma_scores(metrics.window_features(rows, "6 hours"))
    # the blocks' maps and the scores both come from one aggregate, shuffled once
    plan = final_plan(scored).split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan and "partial_avg" in plan
    whole = sorted(scored.collect())
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    again = ewma.ewma_scores(metrics.window_features(rows, "6 hours"))
    assert [r[:3] for r in sorted(again.collect())] == [r[:3] for r in whole]
    assert [r["ewma"] for r in sorted(again.collect())] == pytest.approx([r["ewma"] for r in whole])
