"""Streaming queries: the given tables read as file streams."""

from pyspark.sql import functions as F

from flowlark.operators import stats, windows
from flowlark.operators.routing import REL
from flowlark.queries.keys import FRESH_SQL
from flowlark.queries.registry import query, rounded, table
from flowlark.queries.stats import FLOATS, _six_sql
from flowlark.queries.windows import ANCHORED_SQL
from flowlark.sources.files import read_stream_files
from flowlark.streaming import stateful
from flowlark.streaming.run import drain


def stream(spark, sf, name):
    schema = table(spark, sf, name).schema
    return read_stream_files(spark, sf, schema, pattern=f"{name}.parquet")


@query(
    "stream_tumbling",
    """select epoch_us(time_bucket(interval '6 hours', ts)) as start_us, event_type,
         round(sum(value), 4) as window_sum, count(value) as window_count
       from events where time_bucket(interval '6 hours', ts) + interval '6 hours'
         <= (select max(date_trunc('milliseconds', ts)) from events) - interval '1 hour'
       group by 1, 2""",
)
def stream_tumbling(spark, sf):
    """Windows that the watermark has closed."""
    sums = windows.tumbling(
        stream(spark, sf, "events"), "value", "ts", "6 hours", ["event_type"], watermark="1 hour"
    )
    out = drain(sums, "tumbling")
    out = out.withColumn("start_us", F.unix_micros("window_start")).drop("window_start")
    return rounded(out, 4, "window_sum")


@query(
    "stream_interval_moments",
    f"""select epoch_us(time_bucket(interval '1 hour', ts)) as start_us, event_type as "key",
          {_six_sql("value")} from events
        where time_bucket(interval '1 hour', ts) + interval '1 hour'
          <= (select max(date_trunc('milliseconds', ts)) from events) - interval '30 minutes'
        group by 1, 2""",
)
def stream_interval_moments(spark, sf):
    report = stats.interval_moments(
        stream(spark, sf, "events"), "value", "ts", "1 hour", "event_type", watermark="30 minutes"
    )
    out = drain(report, "moments").withColumn("start_us", F.unix_micros("window_start"))
    return rounded(out.drop("window_start", "window_end"), 8, *FLOATS)


@query("stream_anchored_tumbling", ANCHORED_SQL)
def stream_anchored_tumbling(spark, sf):
    events = stream(spark, sf, "events").drop("props", "event_type")
    out = drain(
        stateful.anchored_stream(events, "value", "ts", "24 hours", ["user_id"], ["event_id"]),
        "anchored",
    )
    closed = out.filter(F.col(REL) == "elapsed").select("event_id", "window_sum", "window_count")
    return rounded(closed, 4, "window_sum")


@query("stream_dedupe_ttl", FRESH_SQL)
def stream_dedupe_ttl(spark, sf):
    events = stream(spark, sf, "events").select("event_id", "ts", "user_id")
    out = stateful.dedupe_stream(events, "user_id", ["event_id"], "6 hours", "ts", "1 hour")
    return drain(out, "dedupe").select("event_id", REL)


@query(
    "stream_batch_wait",
    """with n as (select o_orderkey,
         row_number() over (partition by o_custkey order by o_orderkey) as rn from orders)
       select o_orderkey, 'original' as _rel from n
       union all select o_orderkey, 'batch-completed' from n where rn % 4 = 0""",
)
def stream_batch_wait(spark, sf):
    """Batches of four orders per customer."""
    orders = stream(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.lit("4").alias("want")
    )
    out = stateful.batch_wait_stream(orders, "o_custkey", "want", ["o_orderkey"])
    return drain(out, "batches").select("o_orderkey", REL)


@query(
    "stream_batch_wait_nameless",
    """with n as (select event_id, event_type = 'purchase' as ok,
           row_number() over (partition by event_type = 'purchase', user_id order by ts, event_id) as rn from events)
       select event_id, 'original' as _rel from n
       union all select event_id, 'batch-completed' from n where ok and rn % 3 = 0
       union all select event_id, 'failure' from n where not ok""",
)
def stream_batch_wait_nameless(spark, sf):
    """Most events have no batch id; they have no state."""
    events = stream(spark, sf, "events").select("event_id", "ts", "event_type", "user_id")
    name = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
    rows = events.withColumns({"batch": name, "size": F.lit("3")})
    out = stateful.batch_wait_stream(rows, "batch", "size", ["ts", "event_id"])
    return drain(out, "batches").select("event_id", REL)


@query(
    "stream_delay",
    """with e as (select *, case when event_type = 'error' then null else event_id % 86400000 * 7000 end as delay from events)
       select event_id, epoch_us(ts) as us, value, case when delay is null then 'failure' else 'success' end as _rel
       from e where delay is null or epoch_us(ts) // 1000 + delay
         <= (select max(epoch_us(ts) // 1000) from e) - 3600000""",
)
def stream_delay(spark, sf):
    """Events held by event time for a delay of their own; errors have none that is a number."""
    events = stream(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    wait = F.col("event_id") % 86_400_000 * 7000
    delay = F.when(F.col("event_type") == "error", "soon").otherwise(wait.cast("string"))
    out = stateful.delay_stream(events, "event_type", delay, ts="ts", watermark="1 hour", grain="1 hour")
    out = drain(out, "delay")
    return out.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value", REL)
