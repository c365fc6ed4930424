"""Statistics queries."""

from pyspark.sql import functions as F

from flowlark.operators import stats
from flowlark.queries.registry import query, rounded, table
from flowlark.session import materialize

FLOATS = ("sum", "min", "max", "mean", "stddev")


def _six_sql(value: str, digits: int = 8) -> str:
    return f"""count({value}) as "count", round(sum({value}), {digits}) as "sum",
        round(min({value}), {digits}) as "min", round(max({value}), {digits}) as "max",
        round(avg({value}), {digits}) as mean,
        round(coalesce(stddev_samp({value}), 0.0), {digits}) as stddev"""


@query(
    "attribute_moments",
    f"""select event_type as "key", {_six_sql("value")} from events group by 1""",
)
def attribute_moments(spark, sf):
    return rounded(stats.moments(table(spark, sf, "events"), "value", "event_type"), 8, *FLOATS)


@query(
    "bytes_transferred",
    f"""select lang as "key", {_six_sql("n")}, 'Bytes' as units
        from (select lang, octet_length(encode(text))::double as n from documents) group by 1""",
)
def bytes_transferred(spark, sf):
    return rounded(stats.bytes_stats(table(spark, sf, "documents"), "text", "lang"), 8, *FLOATS)


@query(
    "latency_statistics",
    f"""select event_type as "key", {_six_sql("age", 3)}, 'Seconds' as units from (
          select event_type,
            ((epoch_us(timestamp '2024-02-01 00:00:00') // 1000) - (epoch_us(ts) // 1000)) / 1000.0::double as age
          from events) group by 1""",
)
def latency_statistics(spark, sf):
    as_of = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    events = table(spark, sf, "events")
    return rounded(stats.latency_stats(events, "ts", as_of, "event_type"), 3, *FLOATS)


@query(
    "volume_statistics",
    """select l_returnflag as "key", count(*) as "count", count(*) as "sum"
       from lineitem group by 1""",
)
def volume_statistics(spark, sf):
    return stats.volume_stats(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "moments_missing_key",
    f"""select coalesce(case when event_type <> 'error' then event_type end, '') as "key",
        {_six_sql("value")} from events group by 1""",
)
def moments_missing_key(spark, sf):
    key = F.when(F.col("event_type") != "error", F.col("event_type"))
    return rounded(stats.moments(table(spark, sf, "events"), "value", key), 8, *FLOATS)


@query(
    "moments_rollup",
    f"""select epoch_us(date_trunc('day', ts)) as day_us, event_type, {_six_sql("value")}
        from events group by 1, 2""",
)
def moments_rollup(spark, sf):
    """Hourly states of event values, stored once and merged to days."""
    events = table(spark, sf, "events")
    hourly = stats.moment_state(
        events,
        "value",
        {"hour": F.date_trunc("hour", F.col("ts").cast("timestamp")), "event_type": F.col("event_type")},
    )
    daily = stats.merge_moments(
        materialize(hourly), {"day": F.date_trunc("day", "hour"), "event_type": F.col("event_type")}
    )
    done = stats.finish_moments(daily).withColumn("day_us", F.unix_micros("day")).drop("day")
    return rounded(done, 8, *FLOATS)


@query(
    "interval_moments",
    f"""select epoch_us(time_bucket(interval '1 hour', ts)) as start_us, event_type as "key",
        {_six_sql("value")} from events group by 1, 2""",
)
def interval_moments(spark, sf):
    report = stats.interval_moments(
        table(spark, sf, "events"), "value", "ts", "1 hour", "event_type"
    )
    out = report.withColumn("start_us", F.unix_micros("window_start"))
    return rounded(out.drop("window_start", "window_end"), 8, *FLOATS)


@query(
    "with_stats",
    """select event_id, event_type as "key", count(*) over w as "count",
         round(avg(value) over w, 8) as mean, round(max(value) over w, 8) as "max"
       from events window w as (partition by event_type)""",
)
def with_stats(spark, sf):
    out = stats.with_stats(table(spark, sf, "events"), "value", "event_type")
    return rounded(out.select("event_id", "key", "count", "mean", "max"), 8, "mean", "max")
