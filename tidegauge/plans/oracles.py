"""The registered queries in SQL, for an independent engine on the same tables."""

from __future__ import annotations

from string import Template

from tidegauge.plans.fixtures import TIE_SHIFT

# Views shared by the statements; each is the SQL form of a function in fixtures.py.
VIEWS = {
    "sensor_rows": """
        select ts,
            concat('dev-', cast(user_id % 2 as varchar)) as device_id,
            concat('zone', cast(user_id % 2 + 1 as varchar)) as location,
            case when user_id % 4 = 3 then null
                else concat('model-', cast(user_id % 2 as varchar)) end as model,
            event_type as metric, value
        from events""",
    "numbered": """
        select event_id, ts,
            concat('dev-', cast(user_id % 2 as varchar)) as device_id,
            concat('zone', cast(user_id % 2 + 1 as varchar)) as location,
            case when user_id % 4 = 3 then null
                else concat('model-', cast(user_id % 2 as varchar)) end as model,
            event_type as metric, value
        from events""",
    "scored": """
        select r.*, r.bucket + interval '1 day' as window_end, s.mean, s.std,
            (r.value - s.mean) / greatest(s.std, 0.05) + 0.0 as zscore
        from (select *, date_trunc('day', ts) as bucket from sensor_rows) r
        left join (
            select date_trunc('day', ts) as bucket, device_id, metric, location, model,
                avg(value) as mean, stddev_pop(value) as std
            from sensor_rows group by all
        ) s on r.bucket = s.bucket and r.device_id = s.device_id and r.metric = s.metric
            and r.location = s.location and r.model = s.model""",
    "fleet_rows": """
        select ts,
            concat('sup-', cast(user_id % 120 as varchar)) as device_id,
            concat('zone', cast(user_id % 120 % 4 as varchar)) as location,
            concat('model-', cast(user_id % 120 % 3 as varchar)) as model,
            event_type as metric, value,
            time_bucket(interval '30 days', ts, timestamp '1970-01-01') as bucket
        from events""",
    "fleet_anomalies": """
        select ts, device_id, location, model, metric, value, zscore as score,
            'zscore' as method, $severity as severity
        from (
            select *, (value - avg(value) over k) / greatest(stddev_pop(value) over k, 0.05)
                as zscore
            from fleet_rows
            window k as (partition by bucket, device_id, metric, location, model)
        )
        where abs(zscore) >= 2.0""",
    "wide_rows": """
        select ts as event_ts, concat('dev-', cast(user_id % 2 as varchar)) as device_id,
            value as temperature,
            case when event_type <> 'error' then value / 2 end as humidity
        from events""",
    "wide_stats": """
        select time_bucket(interval '6 hours', event_ts, timestamp '1970-01-01') as window_start,
            time_bucket(interval '6 hours', event_ts, timestamp '1970-01-01')
                + interval '6 hours' as window_end,
            device_id,
            avg(temperature) as temp_mean, stddev_pop(temperature) as temp_std,
            avg(humidity) as hum_mean, stddev_pop(humidity) as hum_std
        from wide_rows where temperature is not null group by all""",
    "peaks": """
        select bucket + interval '1 day' as ts, device_id, max(temperature) as value,
            (max(temperature) - avg(temperature)) / stddev_samp(temperature) as score
        from (
            select *, time_bucket(interval '6 hours', event_ts, timestamp '1970-01-01')
                - to_hours(cast(6 * k as bigint)) as bucket
            from wide_rows, range(4) as steps(k)
        )
        group by bucket, device_id
        having stddev_samp(temperature) > 0
            and (max(temperature) - avg(temperature)) / stddev_samp(temperature) >= 4.0""",
    "messages": """
        select l_shipdate as ts, concat('sup-', cast(l_suppkey as varchar)) as device_id,
            n_name as location, l_returnflag as model,
            l_quantity as quantity, l_extendedprice as price, l_discount as discount, l_tax as tax
        from lineitem join supplier on l_suppkey = s_suppkey
            join nation on s_nationkey = n_nationkey""",
    "message_rows": """
        select ts, device_id, location, model, 'quantity' as metric, quantity as value
            from messages
        union all select ts, device_id, location, model, 'price', price from messages
        union all select ts, device_id, location, model, 'discount', discount from messages
        union all select ts, device_id, location, model, 'tax', tax from messages""",
    "devices": """
        select concat('sup-', cast(s_suppkey as varchar)) as device_id, s_suppkey,
            s_nationkey + 1 as zone_id,
            concat('model-', cast(s_suppkey % 3 as varchar)) as model
        from supplier""",
    # what a strict reader makes of each topic record
    "parsed": """
        select event_id as "offset",
            case event_id % 8 when 5 then null when 7 then 'bad'
                else strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') end as ts,
            case when event_id % 8 in (5, 6) then null
                else concat('dev-', cast(user_id % 2 as varchar)) end as device_id,
            case when event_id % 8 in (5, 6, 7) then null
                else concat('zone', cast(user_id % 2 + 1 as varchar)) end as location,
            case when event_id % 8 in (5, 6, 7) then null else 'model-0' end as model,
            case when event_id % 8 = 0 then 2 when event_id % 8 in (6, 7) then 1 end as n_metrics,
            case when event_id % 8 = 0 and event_type < 'level'
                    then concat(event_type, '=', $value, ',level=', cast(user_id % 10 as varchar), '.0000')
                when event_id % 8 = 0
                    then concat('level=', cast(user_id % 10 as varchar), '.0000,', event_type, '=', $value)
                when event_id % 8 in (6, 7) then concat(event_type, '=', $value) end as readings,
            ts as event_time, event_type, value, user_id
        from events""",
    "day_rows": """
        select cast(ts as date) as dt, device_id, metric, value from sensor_rows""",
    "limits": """
        select device_id, metric, avg(value) as mean, stddev_samp(value) as stddev,
            avg(value) - 2 * stddev_samp(value) as lower,
            avg(value) + 2 * stddev_samp(value) as upper
        from sensor_rows where ts < timestamp '2024-01-16' group by all""",
    "closing": "select max(ts) - interval '2 minutes' as mark from events",
    "features": """
        select bucket as window_start, bucket + interval '6 hours' as window_end,
            device_id, metric, count(*) as n, avg(value) as mean, stddev_pop(value) as std,
            min(value) as min, max(value) as max,
            arg_max(value, ts) - arg_min(value, ts) as delta,
            (arg_max(value, ts) - arg_min(value, ts))
                / nullif((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 0) as rate
        from (
            select *, time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as bucket
            from sensor_rows
        ) group by bucket, device_id, metric""",
}

# Order in which views build on one another.
BASE = {
    "scored": ("sensor_rows",),
    "fleet_anomalies": ("fleet_rows",),
    "wide_stats": ("wide_rows",),
    "peaks": ("wide_rows",),
    "message_rows": ("messages",),
    "day_rows": ("sensor_rows",),
    "limits": ("sensor_rows",),
    "features": ("sensor_rows",),
}

PARTS = {
    "value": "cast(cast(value as decimal(18, 4)) as varchar)",
    "clamped": "cast(cast(least(greatest(value - 100, 0), 100) as decimal(18, 4)) as varchar)",
    "halved": "cast(cast(least(greatest(value - 50, 0), 100) as decimal(18, 4)) as varchar)",
    "capped": "cast(cast(least(value, 100) as decimal(18, 4)) as varchar)",
    "severity": "case when abs(zscore) >= 8 then 'critical' when abs(zscore) >= 5 then 'high' "
    "when abs(zscore) >= 3 then 'medium' else 'low' end",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
    "open": "(select mark from closing)",
    "stats": "round(mean, 6) as mean, round(std, 6) as std",
}


def sql(body: str, *views: str) -> str:
    """A statement over the named views, with the shared snippets filled in.

    ``round`` in lower case also adds the shift ``fixtures.plain`` adds.
    """
    needed: list[str] = []
    for view in views:
        needed.extend(v for v in (*BASE.get(view, ()), view) if v not in needed)
    heads = ", ".join(f"{v} as ({VIEWS[v]})" for v in needed)
    text = f"with {heads} {body}" if needed else body
    return Template(text).substitute(PARTS).replace("round(", f"round({TIE_SHIFT} + ")


SCORED = """window_end, ts, device_id, location, model, metric, value,
    $stats, round(zscore, 6) as zscore, round(abs(zscore), 6) as abs_z"""
ANOMALY = """select ts, device_id, location, model, metric, value, round(zscore, 6) as score,
    'zscore' as method, $severity as severity from scored where abs(zscore) >= 2.0"""
PEAK = """select ts, device_id, 'temperature' as metric, value, round(score, 6) as score,
    'zscore_window_1m' as method, 'high' as severity from peaks"""
RULE = """select window_start, window_end, device_id, round(temp_mean, 6) as temp_mean,
    round(temp_std, 6) as temp_std, round(hum_mean, 6) as hum_mean,
    round(hum_std, 6) as hum_std, true as is_anomaly
    from wide_stats where (temp_mean >= 60 or temp_std >= 55)"""
WINDOW_STATS = """select date_trunc('day', ts) as window_start,
    date_trunc('day', ts) + interval '1 day' as window_end,
    device_id, metric, location, model,
    round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std
    from sensor_rows group by date_trunc('day', ts), device_id, metric, location, model"""
FEATURES = """select window_start, window_end, device_id, metric, n, round(mean, 6) as mean,
    round(std, 6) as std, min, max, round(delta, 6) as delta, round(rate + 0.0, 6) + 0.0 as rate
    from features"""
LIMIT_SCORED = """select r.device_id, r.metric, r.ts, r.location, r.model, r.value,
    round(mean, 6) as mean, round(stddev, 6) as stddev, round(lower, 6) as lower,
    round(upper, 6) as upper,
    round(case when mean is not null then (r.value - mean) / greatest(coalesce(stddev, 0.05), 0.05)
        end, 6) + 0.0 as zscore,
    round(case when mean is not null
        then abs(r.value - mean) / greatest(coalesce(stddev, 0.05), 0.05) end, 6) as abs_z,
    r.value < lower or r.value > upper as out_of_range
    from sensor_rows r left join limits l on r.device_id = l.device_id and r.metric = l.metric"""
EWMA = """, averaged as (
            select *, list_reduce(list(mean) over s, lambda e, x: 0.3 * x + 0.7 * e) as ewma
            from features
            window s as (partition by device_id, metric order by window_start
                rows between unbounded preceding and current row)
        ), stepped as (
            select *, lag(ewma) over s as before,
                0.7 * coalesce(pow(mean - lag(ewma) over s, 2), 0) as step
            from averaged window s as (partition by device_id, metric order by window_start)
        ), spread as (
            select *, list_reduce(list_prepend(0.0, list(step) over s),
                lambda v, x: 0.3 * x + 0.7 * v) as variance
            from stepped
            window s as (partition by device_id, metric order by window_start
                rows between unbounded preceding and current row)
        )
        select device_id, metric, window_start, round(mean, 6) as mean, round(ewma, 6) as ewma,
            round((mean - before) / greatest(0.05, sqrt(lag(variance) over (
                partition by device_id, metric order by window_start))), 6) as score
        from spread"""
PARSED = """ts, device_id, location, model, n_metrics, readings"""
ANOMALY_TEXT = """from (select *, cast(ROUND(zscore, 4) as varchar) as s, $severity as severity
    from scored where abs(zscore) >= 2.0)"""


MESSAGE = """concat('{"ts":"', rtrim(rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.'),
    '","device_id":"', device_id, '","location":"', location, '","model":"', model, '","metric":"', metric,
    '","value":', cast(value as varchar), ',"score":', s, ',"severity":"', severity,
    '","is_anomaly":1}') as value"""
MARK = """concat('sensor_anomalies,device_id=', device_id, ',location=', location,
    ',model=', model, ',metric=', metric, ',severity=', severity, ' value=', cast(value as varchar),
    ',score=', s, ' ', cast(epoch_us(ts) * 1000 as varchar)) as value"""
POINT_LINE = """concat('sensor_metrics,device_id=', device_id, ',location=', location, ',model=', model, ' ',
    fields, ' ', cast(epoch_us(ts) * 1000 as varchar)) as value"""
POINTS = """(select ts, device_id, location, model,
    string_agg(concat(metric, '=', cast(value as varchar)), ',' order by metric) as fields
    from (select ts, device_id, location, coalesce(model, 'unknown') as model, metric, max(value) as value
        from sensor_rows group by all) group by all)"""
ALERTS = """from (select event_id, user_id, event_type, value,
        case event_id % 11 when 2 then -value / 20 when 9 then 1.0 else value / 20 end as score,
        case event_id % 11 when 0 then 1 when 1 then 0 when 4 then 1 when 10 then 1 end as flag,
        case event_id % 11 when 4 then 'unknown-ts' else concat('t', cast(event_id as varchar)) end as t,
        case when event_id % 11 in (0, 4) then event_type else 'unknown-metric' end as m
    from events where event_id % 11 in (0, 1, 2, 4, 7, 8, 9, 10))"""
ALERT_TEXT = """concat('[ANOMALY ALERT] ts=', t, ' device_id=d', cast(user_id as varchar), ' metric=', m,
    ' score=', cast(score as varchar), ' flag=', coalesce(cast(flag as varchar), 'None')) as value"""


ORACLES: dict[str, str] = {
    "zscore_anomalies": sql(ANOMALY, "scored"),
    "window_stats": sql(WINDOW_STATS, "sensor_rows"),
    "scored_rows": sql(f"select {SCORED} from scored", "scored"),
    "severity_counts": sql(
        """select $severity as severity, count(*) as n, count(zscore) as n_scored from (
            select (value - avg(value) over k) / greatest(stddev_pop(value) over k, 0.05) as zscore
            from sensor_rows window k as (partition by device_id, metric,
                time_bucket(interval '30 days', ts, timestamp '1970-01-01'))
        ) group by 1""",
        "sensor_rows",
    ),
    "wide_window_stats": sql(
        """select window_start, window_end, device_id, round(temp_mean, 6) as temp_mean,
            round(temp_std, 6) as temp_std, round(hum_mean, 6) as hum_mean,
            round(hum_std, 6) as hum_std from wide_stats""",
        "wide_stats",
    ),
    "window_rule_anomalies": sql(RULE, "wide_stats"),
    "sliding_peak_anomalies": sql(PEAK, "peaks"),
    "parse_messages_strict": sql(f"""select "offset", {PARSED} from parsed""", "parsed"),
    "parse_messages_lenient": sql(
        """select "offset", ts, device_id, location, model,
            case when "offset" % 8 in (1, 2) then 1 else n_metrics end as n_metrics,
            case when "offset" % 8 in (1, 2) then concat(event_type, '=', $value) else readings end
                as readings
        from parsed""",
        "parsed",
    ),
    "valid_messages": sql(
        """select "offset", event_time as ts, device_id, location, model, n_metrics, readings
        from parsed
        where "offset" % 8 = 0""",
        "parsed",
    ),
    "archive_rows": sql(
        f"""select "offset", {PARSED},
            case when ts <> 'bad' then event_time end as event_ts,
            case when ts <> 'bad' then cast(event_time as date) end as dt
        from parsed where device_id is not null""",
        "parsed",
    ),
    "explode_metrics": sql(
        """select "offset", event_time as ts, device_id, location, model, event_type as metric,
            value from parsed where "offset" % 8 in (0, 1, 2)
        union all
        select "offset", event_time, device_id, location, model, 'level',
            cast(user_id % 10 as double) from parsed where "offset" % 8 = 0""",
        "parsed",
    ),
    "explode_order_metrics": sql("select * from message_rows", "message_rows"),
    "metric_columns": sql(
        """select ts, device_id, location, model, price, quantity,
            cast(null as double) as voltage from messages""",
        "messages",
    ),
    "normalize_timestamps": sql(
        """select event_id, t as ts, cast(t as date) as dt from (
            select event_id, case event_id % 6 when 2 then date_trunc('milliseconds', ts)
                when 3 then date_trunc('second', ts) when 4 then date_trunc('day', ts)
                when 5 then null else ts end as t
            from events)"""
    ),
    "latest_anomalies": sql(
        """select ts, device_id, metric, value, round(score, 6) as score, method, severity
        from fleet_anomalies order by ts desc, device_id, metric, value limit 50""",
        "fleet_anomalies",
    ),
    "anomaly_count_24h": sql(
        """select device_id, count(*) as n from fleet_anomalies
        where ts >= timestamp '2024-01-29' and ts < timestamp '2024-01-30' group by 1""",
        "fleet_anomalies",
    ),
    "top_devices_24h": sql(
        """select device_id, count(*) as n from fleet_anomalies
        where ts >= timestamp '2024-01-29' and ts < timestamp '2024-01-30' group by 1
        order by n desc, device_id limit 10""",
        "fleet_anomalies",
    ),
    "anomalies_by_zone_model": sql(
        """select concat('Zone ', n_name) as zone_name, d.model, count(*) as n
        from fleet_anomalies a left join devices d on a.device_id = d.device_id
        left join nation on d.zone_id = n_nationkey + 1 group by n_name, d.model""",
        "fleet_anomalies",
        "devices",
    ).replace("concat('Zone ', n_name)", "'Zone ' || n_name"),
    "before_after_maintenance": sql(
        """select cast(s_suppkey + 1 as integer) as schedule_id, device_id, last_maintained,
            cast(count(ts) filter (where cast(ts as date) < last_maintained) as bigint)
                as n_before,
            cast(count(ts) filter (where cast(ts as date) >= last_maintained) as bigint)
                as n_after
        from (select s_suppkey, device_id,
                date '2024-01-01' + cast(s_suppkey % 30 as integer) as last_maintained
            from devices) m
        left join (select ts, device_id as found_on from fleet_anomalies) a
            on found_on = device_id and cast(ts as date) >= last_maintained - 7
            and cast(ts as date) < last_maintained + 7
        group by all""",
        "fleet_anomalies",
        "devices",
    ),
    "orphan_devices": sql(
        """select device_id, count(*) as n from fleet_rows
        where device_id not in (select device_id from devices) group by 1""",
        "fleet_rows",
        "devices",
    ),
    "rows_of_known_devices": sql(
        """select ts, device_id, location, model, metric, value from fleet_rows
        where device_id in (select device_id from devices)""",
        "fleet_rows",
        "devices",
    ),
    "insert_if_absent": sql(
        """select device_id, zone_id, model from (
            select concat('sup-', cast(user_id % 120 as varchar)) as device_id,
                cast(user_id % 25 + 1 as integer) as zone_id, event_type as model,
                row_number() over (partition by user_id % 120 order by event_id) as rank
            from events
        ) where rank = 1 and device_id not in (select device_id from devices)""",
        "devices",
    ),
    "device_zone_lookup": sql(
        """select concat('sup-', cast(s_suppkey as varchar)) as device_id,
            case when s_suppkey % 10 = 0 then 'nowhere'
                else concat('NATION_', cast(s_nationkey as varchar)) end as zone_code,
            case when s_suppkey % 10 <> 0 then n_nationkey + 1 end as zone_id
        from supplier left join nation on n_name = concat('NATION_', cast(s_nationkey as varchar))"""
    ),
    "registry_roundtrip": sql(
        """select 'zones' as name, concat(cast(n_nationkey + 1 as varchar), '|', n_name, '|Zone ', n_name)
            as row from nation
        union all select 'devices', concat(device_id, '|', cast(zone_id as varchar), '|', model) from devices
        union all select 'maintain_schedules', concat(cast(s_suppkey + 1 as varchar), '|', device_id, '|',
            cast(date '2024-01-01' + cast(s_suppkey % 30 as integer) as varchar)) from devices
        union all select 'anomalies before clearing', concat(device_id, '|', metric, '|', severity)
            from fleet_anomalies""",
        "fleet_anomalies",
        "devices",
    ),
    "series_range_filter": sql(
        """select ts, device_id, location, model, metric, value from sensor_rows
        where ts >= timestamp '2024-01-29 18:00:00' and ts < timestamp '2024-01-30'
            and metric = 'click' and device_id = 'dev-1'""",
        "sensor_rows",
    ),
    "metric_regex_filter": sql(
        """select ts, device_id, location, model, metric, value from sensor_rows
        where regexp_matches(metric, 'click|view|sign')""",
        "sensor_rows",
    ),
    "declared_vs_observed_metrics": sql(
        """select coalesce(d.device_id, o.device_id) as device_id,
            coalesce(d.metric, o.metric) as metric, coalesce(n, 0) as n,
            case when d.metric is null then 'undeclared' when n is null then 'silent'
                else 'ok' end as status
        from (select device_id, unnest(case when s_suppkey % 3 = 0
                then ['quantity', 'price', 'voltage']
                else ['quantity', 'price', 'discount', 'tax'] end) as metric from devices) d
        full join (select device_id, metric, count(*) as n from message_rows group by all) o
            on d.device_id = o.device_id and d.metric = o.metric""",
        "devices",
        "message_rows",
    ),
    "offline_stats": sql(
        """select cast(ts as date) as dt, device_id, metric, count(*) as n,
            round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev
        from message_rows group by all""",
        "message_rows",
    ),
    "offline_stats_from_lake": sql(
        """select cast(event_time as date) as dt, device_id, metric, count(*) as n,
            round(avg(value), 6) as mean, round(stddev_samp(value), 6) as stddev
        from (
            select event_time, device_id, event_type as metric, value from parsed
            where "offset" % 8 in (0, 1, 2)
            union all
            select event_time, device_id, 'level', cast(user_id % 10 as double) from parsed
            where "offset" % 8 = 0
        ) where event_time >= timestamp '2024-01-05' and event_time < timestamp '2024-01-26'
        group by 1, 2, 3""",
        "parsed",
    ),
    "trend_rollup": sql(
        """select cast(date_trunc('month', ts) as date) as period, device_id, metric,
            count(*) as n, round(avg(value), 6) as mean from message_rows group by 1, 2, 3""",
        "message_rows",
    ),
    "trend_weekly": sql(
        """select cast(date_trunc('week', dt) as date) as period, device_id, metric,
            count(*) as n, round(avg(value), 6) as mean from day_rows group by 1, 2, 3""",
        "day_rows",
    ),
    "thresholds": sql(
        """select device_id, metric, count(*) as n, round(avg(value), 4) as mean,
            round(stddev_samp(value), 4) as stddev,
            round(avg(value) - 2 * stddev_samp(value), 4) as lower,
            round(avg(value) + 2 * stddev_samp(value), 4) as upper
        from message_rows group by 1, 2""",
        "message_rows",
    ),
    "threshold_scored": sql(LIMIT_SCORED, "sensor_rows", "limits"),
    "window_features": sql(FEATURES, "features"),
    "downsample": sql(
        """select date_trunc('hour', ts) as ts, device_id, location, model, metric,
            round(avg(value), 6) as value, count(value) as n
        from sensor_rows group by date_trunc('hour', ts), device_id, location, model, metric""",
        "sensor_rows",
    ),
    "ewma_scores": sql(EWMA, "features"),
    "anomaly_messages": sql(
        f"select cast(null as varchar) as key, {MESSAGE} {ANOMALY_TEXT}",
        "scored",
    ),
    "metric_lines": sql(
        """select concat('sensor_metrics,device_id=', device_id, ',location=', location,
            ',model=', model, ' discount=', cast(discount as varchar),
            ',price=', cast(price as varchar), ',quantity=', cast(quantity as varchar),
            ',tax=', cast(tax as varchar), ' ', cast(epoch_us(ts) * 1000 as varchar)) as value
        from messages""",
        "messages",
    ),
    "metric_lines_long": sql(f"select {POINT_LINE} from {POINTS}", "sensor_rows"),
    "metric_points": sql(
        """select ts, device_id, location, coalesce(model, 'unknown') as model,
            cast(count(*) as integer) as n_metrics,
            string_agg(concat(metric, '=', $value), ',' order by metric) as readings
        from (select ts, device_id, location, model, metric, max(value) as value
            from sensor_rows group by all)
        group by all""",
        "sensor_rows",
    ),
    "anomaly_lines": sql(
        f"select {MARK} {ANOMALY_TEXT}",
        "scored",
    ),
    "alert_lines": sql(
        f"""select {ALERT_TEXT} from (select * replace (ROUND(score, 4) as score) {ALERTS})
        where case when flag is not null then flag = 1 else abs(score) >= 3.0 end"""
    ),
    "stream_alerts": sql(
        f"""select {ALERT_TEXT} {ALERTS}
        where case when flag is not null then flag = 1 else abs(score) >= 3.0 end"""
    ),
    "alerts_by_threshold": sql(
        f"""select round(score, 4) as score, flag, t as ts,
            concat('d', cast(user_id as varchar)) as device_id, m as metric {ALERTS}
        where abs(score) >= 4.0"""
    ),
    "normalize_rest": sql(
        """select event_id,
            case event_id % 8 when 0 then concat($iso, 'Z') else concat($iso, '+00:00') end as ts,
            concat('d', cast(user_id as varchar)) as device_id,
            case event_id % 8 when 1 then 'lab' else 'farm-zone-1' end as location,
            case event_id % 8 when 1 then 'M1' else 'ESP32' end as model,
            'ingress-rest-api' as source,
            case when event_id % 8 in (0, 5) then 2 else 1 end as n_metrics,
            case event_id % 8 when 0 then concat('temperature=', $value, ',x=', $value)
                when 1 then concat('humidity=', $capped)
                when 5 then concat('soil_moisture=', $clamped, ',x=', $value)
                else concat('humidity=', $halved) end as readings
        from events where event_id % 8 in (0, 1, 5, 6)"""
    ),
    "rejected_payloads": sql(
        """select event_id,
            case event_id % 8 when 3 then null else concat('d', cast(user_id as varchar)) end
                as device_id,
            case event_id % 8 when 3 then 'missing device_id' when 4 then 'invalid number'
                else 'no metrics' end as reason
        from events where event_id % 8 in (2, 3, 4, 7)"""
    ),
    "normalize_mqtt": sql(
        """select event_id,
            case event_id % 7 when 0 then concat($iso, 'Z') else concat($iso, '+00:00') end as ts,
            case when event_id % 7 in (0, 5) then concat('d', cast(user_id as varchar))
                when user_id % 3 = 0 then 'mqtt-device'
                when user_id % 3 = 1 then concat('node-', cast(user_id as varchar))
                else 'gate' end as device_id,
            case event_id % 7 when 4 then 'lab' else 'farm-zone-1' end as location,
            'ESP32' as model, 'ingress-mqtt' as source,
            case user_id % 3 when 0 then 'iot'
                when 1 then concat('iot/node-', cast(user_id as varchar), '/telemetry')
                else 'iot/gate' end as topic,
            case when event_id % 7 in (0, 1) then 2 else 0 end as n_metrics,
            case event_id % 7 when 0 then concat('temperature=', $value, ',x=', $value)
                when 1 then concat('humidity=', $capped, ',soil_moisture=', $clamped)
                else '' end as readings,
            case event_id % 7 when 2 then concat('hello ', cast(event_id as varchar))
                when 3 then concat('[', cast(value as varchar), ']')
                when 4 then concat('code ', cast(event_id as varchar))
                when 6 then concat('{"device_id":"d', cast(user_id as varchar),
                    '","metrics":{"x":', cast(value as varchar), '}') end as raw
        from events"""
    ),
    "mqtt_wire_messages": sql(
        """select device_id as key, device_id, n_metrics, readings
        from (select
                case when event_id % 7 in (0, 5) then concat('d', cast(user_id as varchar))
                    when user_id % 3 = 0 then 'mqtt-device'
                    when user_id % 3 = 1 then concat('node-', cast(user_id as varchar))
                    else 'gate' end as device_id,
                case event_id % 7 when 0 then concat('temperature=', $value, ',x=', $value)
                    when 1 then concat('humidity=', $capped, ',soil_moisture=', $clamped)
                    when 5 then '' end as readings,
                case event_id % 7 when 0 then 2 when 1 then 2 when 5 then 0 end as n_metrics
            from events)"""
    ),
    "normalize_board": sql(
        """select event_id, 'iot_event' as type, value as temperature,
            round(user_id / 10, 6) as humidity, cast(event_id % 100 as integer) as soil_moisture,
            round(epoch_us(ts) / 1e6, 6) as "timestamp",
            'pump' as device1_name,
            case user_id % 2 when 1 then 'ON' else 'OFF' end as device1_state,
            'fan' as device2_name,
            case event_id % 2 when 1 then 'ON' else 'OFF' end as device2_state
        from events where event_id % 6 < 4"""
    ),
    "calibrate_soil": sql(
        """select event_id, cast(user_id * 37 % 4096 as integer) as raw,
            cast(least(greatest(trunc((user_id * 37 % 4096 - 3500) * 100 / -2000.0), 0), 100)
                as integer) as percent
        from events"""
    ),
    "drop_nan_readings": sql(
        """select event_id, value as temperature,
            case when user_id % 3 = 1 then null else value end as humidity
        from events where event_id % 3 <> 0 and user_id % 3 <> 0"""
    ),
    "inspect_messages": sql(
        """select cast(user_id % 3 as integer) as "partition", event_id as "offset",
            concat('dev-', cast(user_id % 2 as varchar)) as key,
            concat($iso, '+00:00') as kafka_ts,
            case event_id % 8
                when 1 then concat(head, '"metrics":{"', event_type, '":"', v, '"}}')
                when 2 then concat(head, '"metrics":{"', event_type, '":', v, ',"note":"x"}}')
                when 3 then concat(head, '"metrics":[1]}')
                when 4 then concat(head, '"extra":', v, '}')
                when 5 then concat('not json ', cast(event_id as varchar))
                when 6 then concat('{"ts":"', $iso, 'Z","metrics":{"', event_type, '":', v, '}}')
                when 7 then concat('{"ts":"bad","device_id":"dev-', cast(user_id % 2 as varchar),
                    '","metrics":{"', event_type, '":', v, '}}')
                else concat(head, '"metrics":{"', event_type, '":', v, ',"level":',
                    cast(user_id % 10 as varchar), '}}')
            end as value
        from (select *, cast(value as varchar) as v,
                concat('{"ts":"', $iso, 'Z","device_id":"dev-', cast(user_id % 2 as varchar),
                    '","location":"zone', cast(user_id % 2 + 1 as varchar),
                    '","model":"model-0",') as head
            from events)
        order by 1, 2 limit 20"""
    ),
    "stream_zscore": sql(
        f"select {SCORED} from scored where window_end <= $open", "scored", "closing"
    ),
    "stream_anomalies": sql(f"{ANOMALY} and window_end <= $open", "scored", "closing"),
    "stream_window_stats": sql(
        f"select * from ({WINDOW_STATS}) where window_end <= $open", "sensor_rows", "closing"
    ),
    "stream_window_rule": sql(f"{RULE} and window_end <= $open", "wide_stats", "closing"),
    "stream_sliding_peak": sql(f"{PEAK} where ts <= $open", "peaks", "closing"),
    "stream_window_features": sql(
        f"{FEATURES} where window_end <= $open", "features", "closing"
    ),
    "stream_ewma": sql(
        f"{EWMA} where window_start + interval '6 hours' <= $open", "features", "closing"
    ),
    "stream_archive": sql(
        f"""select {PARSED}, case when ts <> 'bad' then event_time end as event_ts,
            case when ts <> 'bad' then cast(event_time as date) end as dt
        from parsed where device_id is not null""",
        "parsed",
    ),
    "stream_threshold_scored": sql(LIMIT_SCORED, "sensor_rows", "limits"),
    "stream_two_queries": sql(
        """select 'archive' as branch, cast(event_ts as date) as dt, event_ts as ts, device_id,
            round(temperature, 6) as temperature, round(humidity, 6) as humidity,
            cast(null as double) as score from wide_rows
        union all
        select 'peaks', cast(ts as date), ts, device_id, round(value, 6), cast(null as double),
            round(score, 6) from peaks where ts <= $open""",
        "wide_rows",
        "peaks",
        "closing",
    ),
    "stream_fan_out": sql(
        f""", closed as (select * from scored where window_end <= $open)
        select 'registry' as sink, concat(device_id, '|', metric, '|', severity, '|',
            cast(value as varchar)) as value {ANOMALY_TEXT.replace("from scored", "from closed")}
        union all select 'records', {MESSAGE} {ANOMALY_TEXT.replace("from scored", "from closed")}
        union all select 'lines', {MARK} {ANOMALY_TEXT.replace("from scored", "from closed")}
        union all select 'metrics', {POINT_LINE} from {POINTS.replace("from sensor_rows", "from closed")}""",
        "scored",
        "closing",
    ),
}
# topic inspection without a limit
ORACLES["inspect_all_messages"] = (
    "select * from (" + ORACLES["inspect_messages"].replace("order by 1, 2 limit 20", "") + ")"
)
ORACLES["stream_normalize_rest"] = ORACLES["normalize_rest"]
ORACLES["stream_normalize_mqtt"] = ORACLES["normalize_mqtt"]
ORACLES["stream_rejected"] = ORACLES["rejected_payloads"]
ORACLES["stream_ingest"] = (
    "select device_id as key, ts, device_id, location, model, n_metrics, readings, cast(null as varchar) as reason"
    f" from ({ORACLES['normalize_rest']})"
    " union all by name"
    f" select device_id as key, reason from ({ORACLES['rejected_payloads']})"
)
ORACLES["inspect_newest_messages"] = (
    ORACLES["inspect_messages"].replace("order by 1, 2 limit 20", 'order by kafka_ts desc, "partition", "offset" desc limit 20')
)
ORACLES["stream_closed_windows"] = sql(
    """, parts as (
        select *, case when event_id % 50 = 0 then 2 when ts < timestamp '2024-01-16' then 0 else 1 end as part
        from numbered
    ), marks as (
        select max(ts) filter (part < 2) - interval '2 minutes' as before, max(ts) - interval '2 minutes' as after
        from parts
    ), judged as (
        select p.*, date_trunc('day', ts) + interval '1 day' as ends, before, after,
            case when model is null then 'no time or incomplete key'
                when part = 2 and date_trunc('day', ts) + interval '1 day' <= before then 'window has closed' end as reason
        from parts p, marks
    ), stats as (
        select ends, device_id, metric, location, model, avg(value) as mean, stddev_pop(value) as std
        from judged where reason is null group by all
    )
    select case when reason is null then j.ends end as window_end, ts, j.device_id, j.location, j.model, j.metric, value,
        $stats, round((value - mean) / greatest(std, 0.05) + 0.0, 6) as zscore,
        round(abs((value - mean) / greatest(std, 0.05)), 6) as abs_z, reason
    from judged j left join stats s on reason is null and j.ends = s.ends and j.device_id = s.device_id
        and j.metric = s.metric and j.location = s.location and j.model = s.model
    where reason is not null or j.ends <= after""",
    "numbered",
)
ORACLES["thresholds_as_of"] = ORACLES["stream_thresholds_as_of"] = sql(
    """, versions as (
        select v.valid_from, device_id, metric, avg(value) as mean, stddev_samp(value) as stddev,
            avg(value) - 2 * stddev_samp(value) as lower, avg(value) + 2 * stddev_samp(value) as upper
        from sensor_rows, (select unnest([timestamp '2024-01-08', timestamp '2024-01-15', timestamp '2024-01-22']) as valid_from) v
        where ts < v.valid_from group by all
    )
    select r.*, v.valid_from, round(v.mean, 6) as mean, round(v.stddev, 6) as stddev, round(v.lower, 6) as lower,
        round(v.upper, 6) as upper,
        round(case when mean is not null then (r.value - mean) / greatest(coalesce(stddev, 0.05), 0.05) end, 6) + 0.0 as zscore,
        round(case when mean is not null then abs(r.value - mean) / greatest(coalesce(stddev, 0.05), 0.05) end, 6) as abs_z,
        r.value < lower or r.value > upper as out_of_range
    from sensor_rows r asof left join versions v
        on r.device_id = v.device_id and r.metric = v.metric and r.ts >= v.valid_from""",
    "sensor_rows",
)
ORACLES["stream_delivery_ledger"] = sql(
    f"""select unnest(['appended', 'flaky', 'published']) as sink,
        concat(device_id, '|', metric, '|', severity, '|', cast(value as varchar)) as value
    {ANOMALY_TEXT.replace("from scored where", "from scored where window_end <= $open and")}""",
    "scored",
    "closing",
)
ORACLES["incremental_thresholds"] = sql(
    """select device_id, metric, count(*) as n, round(avg(value), 4) as mean,
        round(stddev_samp(value), 4) as stddev,
        round(avg(value) - 2 * stddev_samp(value), 4) as lower,
        round(avg(value) + 2 * stddev_samp(value), 4) as upper
    from sensor_rows group by 1, 2""",
    "sensor_rows",
)
ORACLES["stream_compacted_archive"] = ORACLES["stream_archive"]
ORACLES["series_range_from_lake"] = ORACLES["series_range_filter"]
ORACLES["stream_upserted_windows"] = ORACLES["window_stats"]
ORACLES["stream_spooled_lines"] = sql(
    """select concat('sensor_metrics,device_id=', device_id, ',location=', location, ',model=model-0 ',
        case when event_type < 'level' then concat(event_type, '=', cast(value as varchar), ',level=', level)
            else concat('level=', level, ',', event_type, '=', cast(value as varchar)) end,
        ' ', cast(epoch_us(event_time) * 1000 as varchar)) as value
    from (select *, cast(cast(user_id % 10 as double) as varchar) as level from parsed where "offset" % 8 = 0)""",
    "parsed",
)
