"""Time-series queries."""

from pyspark.sql import functions as F

from flowlark.functions.times import to_time
from flowlark.operators import points as p
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, rounded, table
from flowlark.session import scratch_path

_POINT_SQL = """select event_id, 'event' as measurement, event_type as t, user_id::varchar as u,
  value, (props->>'$.k')::double as k, (epoch_us(ts) // 1000) * 1000 as time_us, 'success' as _rel
from events"""


def _points(spark, sf, strict=True, keep=("event_id",), precision="MILLISECONDS"):
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    tags = F.concat(F.lit("type="), "event_type", F.lit(",user="), F.col("user_id").cast("string"))
    ts = F.unix_millis("ts") if precision == "MILLISECONDS" else F.unix_micros("ts") * 1000
    return p.to_points(
        events,
        F.lit("event"),
        tags,
        {"value": F.col("value"), "k": F.get_json_object("props", "$.k"), "x": F.col("event_type")},
        ts=ts,
        precision=precision,
        strict_tags=strict,
        keep=keep,
    )


def _flat(points):
    return points.select(
        "event_id",
        "measurement",
        F.col("tags")["type"].alias("t"),
        F.col("tags")["user"].alias("u"),
        F.col("fields")["value"].alias("value"),
        F.col("fields")["k"].alias("k"),
        F.unix_micros("time").alias("time_us"),
        REL,
    )


@query("influx_points", _POINT_SQL)
def influx_points(spark, sf):
    return _flat(_points(spark, sf))


@query("influx_points_v2", _POINT_SQL.replace("(epoch_us(ts) // 1000) * 1000", "epoch_us(ts)"))
def influx_points_v2(spark, sf):
    return _flat(_points(spark, sf, strict=False, precision="NANOSECONDS"))


@query(
    "influx_points_failed",
    """select event_id, case when event_type = 'error' then 'failure' else 'success' end as _rel
       from events""",
)
def influx_points_failed(spark, sf):
    """Error events have no numeric field and give no point."""
    value = F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise("n/a")
    out = p.to_points(
        table(spark, sf, "events"),
        F.lit("event"),
        F.lit(None).cast("string"),
        {"value": value},
        keep=["event_id"],
    )
    return out.select("event_id", REL)


@query(
    "time_precision",
    """select event_id, epoch_us(ts) as us, (epoch_us(ts) // 1000) * 1000 as ms,
         (epoch_us(ts) // 1000) // 1000 * 1000000 as s from events""",
)
def time_precision(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    div = lambda n: F.call_function("div", us, F.lit(n))
    return table(spark, sf, "events").select(
        "event_id",
        F.unix_micros(to_time(us * 1000, "NANOSECONDS")).alias("us"),
        F.unix_micros(to_time(div(1_000), "MILLISECONDS")).alias("ms"),
        F.unix_micros(to_time(div(1_000_000), "SECONDS")).alias("s"),
    )


INFLUX_LINES_SQL = """select event_id, 'event,type=' || event_type || ',user=' || user_id || ' k='
         || (props->>'$.k')::double::varchar || ',value=' || value::varchar || ' '
         || (epoch_us(ts) // 1000) || '000000' as line from events"""


@query("influx_lines", INFLUX_LINES_SQL)
def influx_lines(spark, sf):
    return _points(spark, sf).select("event_id", p.line_text().alias("line"))


@query(
    "influx_write",
    f"""select 'event' as measurement, md5(line) as hash, count(*) as n from ({INFLUX_LINES_SQL})
       group by 2""",
)
def influx_write(spark, sf):
    """Points written as line text and read back, by line."""
    out = scratch_path(spark, "points")
    p.write_points(_points(spark, sf), out)
    lines = spark.read.text(out)
    return lines.groupBy("measurement", F.md5("value").alias("hash")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "series_packets",
    """with s as (select event_type as t, epoch_us(time_bucket(interval '6 hours', ts)) as us,
           count(value) as n, row_number() over (
             partition by event_type order by time_bucket(interval '6 hours', ts)) - 1 as pos
         from events group by event_type, time_bucket(interval '6 hours', ts))
       select t as tag, (pos // 20)::bigint as packet, count(*)::int as size,
         string_agg(us || ':' || n, ',' order by us) as body
       from s group by 1, 2""",
)
def series_packets(spark, sf):
    """The nested form: packets of twenty windows of one series."""
    series = p.series_query(
        _points(spark, sf),
        "event",
        group_tags=["type"],
        every="6 hours",
        aggs={"n": F.count(p.field("value"))},
    )
    out = p.series_packets(series, "event", ["tag_type"], ["time", "n"], rows=20)
    pair = F.transform(
        "values",
        lambda v: F.concat_ws(":", F.unix_micros(v["time"]).cast("string"), v["n"].cast("string")),
    )
    return out.select(
        F.element_at("tags", F.lit("type")).alias("tag"),
        "packet",
        F.size("values").alias("size"),
        F.array_join(pair, ",").alias("body"),
    )


@query(
    "series_query",
    """select event_type as tag_type, epoch_us(time_bucket(interval '6 hours', ts)) as time_us,
         round(avg(value), 8) as mean, count(value) as n,
         row_number() over (partition by event_type
           order by time_bucket(interval '6 hours', ts)) as position
       from events group by event_type, time_bucket(interval '6 hours', ts)""",
)
def series_query(spark, sf):
    out = p.series_query(
        _points(spark, sf),
        "event",
        group_tags=["type"],
        every="6 hours",
        aggs={"mean": F.avg(p.field("value")), "n": F.count(p.field("value"))},
    )
    out = out.withColumn("time_us", F.unix_micros("time")).drop("time")
    return rounded(out, 8, "mean")


@query(
    "series_query_limit",
    """with s as (select user_id::varchar as u from events group by 1 order by 1 limit 20)
       select * from (
         select user_id::varchar as tag_user, epoch_us(date_trunc('day', ts)) as time_us,
           round(max(value), 4) as top, row_number() over (
             partition by user_id order by date_trunc('day', ts)) as position
         from events where value > 10 and user_id::varchar in (from s)
         group by user_id, date_trunc('day', ts)) where position <= 3""",
)
def series_query_limit(spark, sf):
    """First three days of the first twenty series."""
    out = p.series_query(
        _points(spark, sf),
        "event",
        where=p.field("value") > 10,
        group_tags=["user"],
        every="1 day",
        aggs={"top": F.max(p.field("value"))},
        limit=3,
        slimit=20,
    )
    out = out.withColumn("time_us", F.unix_micros("time")).drop("time")
    return rounded(out, 4, "top")
