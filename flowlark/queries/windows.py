"""Window, batch and hold-back queries."""

from pyspark.sql import functions as F

from flowlark.operators import windows
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, rounded, table

# Windows per user that open at a record; one step per window.
ANCHORED_SQL = """
with recursive v as (
  select user_id, event_id, ts, value from events where value is not null
), anchors as (
  select user_id, 0 as n, min(ts) as start_ts from v group by user_id
  union all
  select a.user_id, a.n + 1, x.ts
  from anchors a, lateral (
    select min(v.ts) as ts from v
    where v.user_id = a.user_id and v.ts >= a.start_ts + interval '24 hours') x
  where x.ts is not null
), spans as (
  select user_id, start_ts,
    lead(start_ts) over (partition by user_id order by start_ts) as next_ts from anchors
), totals as (
  select s.user_id, s.next_ts, round(sum(v.value), 4) as window_sum, count(*) as window_count
  from spans s join v on v.user_id = s.user_id and v.ts >= s.start_ts and v.ts < s.next_ts
  where s.next_ts is not null group by all
)
select v.event_id, t.window_sum, t.window_count
from totals t join v on v.user_id = t.user_id and v.ts = t.next_ts
"""


@query(
    "tumbling_window",
    """select epoch_us(time_bucket(interval '6 hours', ts)) as start_us, event_type,
         round(sum(value), 4) as window_sum, count(value) as window_count
       from events where value is not null group by 1, 2""",
)
def tumbling_window(spark, sf):
    out = windows.tumbling(table(spark, sf, "events"), "value", "ts", "6 hours", ["event_type"])
    out = out.withColumn("start_us", F.unix_micros("window_start")).drop("window_start")
    return rounded(out, 4, "window_sum")


@query(
    "running_tumbling",
    """select event_id, round(sum(value) over w, 4) as window_sum, count(*) over w as window_count
       from events window w as (
         partition by user_id, time_bucket(interval '24 hours', ts)
         order by ts, event_id rows unbounded preceding)""",
)
def running_tumbling(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = windows.running_tumbling(events, "value", "ts", "24 hours", ["user_id"], ["event_id"])
    return rounded(out.select("event_id", "window_sum", "window_count"), 4, "window_sum")


@query("anchored_tumbling", ANCHORED_SQL)
def anchored_tumbling(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    out = windows.anchored_tumbling(events, "value", "ts", "24 hours", ["user_id"], ["event_id"])
    closed = out.filter(F.col(REL) == "elapsed").select("event_id", "window_sum", "window_count")
    return rounded(closed, 4, "window_sum")


@query(
    "tumbling_failures",
    """select event_id from events
       where not regexp_matches(case when event_type = 'error' then props else value::varchar end,
         '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')""",
)
def tumbling_failures(spark, sf):
    """Error events carry text where a number is due."""
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.col("value").cast("string")
    )
    out = windows.anchored_tumbling(
        table(spark, sf, "events"), text, "ts", "24 hours", ["user_id"], ["event_id"]
    )
    return out.filter(F.col(REL) == "failure").select("event_id")


@query(
    "batch_wait",
    """with n as (select conv_id, turn, count(*) over (partition by conv_id) as c,
         row_number() over (partition by conv_id order by turn) as rn from conversations)
       select conv_id, turn, 'original' as _rel from n
       union all select conv_id, turn, 'batch-completed' from n where rn % c = 0""",
)
def batch_wait(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    sizes = turns.groupBy(F.col("conv_id").alias("c")).agg(F.count(F.lit(1)).alias("turns"))
    rows = turns.join(sizes, F.col("conv_id") == F.col("c"))
    return windows.batch_wait(rows, "conv_id", "turns", ["turn"]).select("conv_id", "turn", REL)


@query(
    "batch_wait_varying",
    """with recursive r as (
         select o_custkey, o_orderkey, substr(o_orderpriority, 1, 1)::bigint as want,
           row_number() over (partition by o_custkey order by o_orderkey) as rn from orders
       ), f as (
         select o_custkey, o_orderkey, rn, case when want = 1 then 0 else 1 end as c from r where rn = 1
         union all
         select r.o_custkey, r.o_orderkey, r.rn, case when f.c + 1 = r.want then 0 else f.c + 1 end
         from f join r on r.o_custkey = f.o_custkey and r.rn = f.rn + 1
       )
       select o_orderkey, 'original' as _rel from orders
       union all select o_orderkey, 'batch-completed' from f where c = 0""",
)
def batch_wait_varying(spark, sf):
    """The expected count changes from record to record."""
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("want")
    )
    return windows.batch_wait(rows, "o_custkey", "want", ["o_orderkey"]).select("o_orderkey", REL)


@query(
    "batch_pending",
    """select l_orderkey, 3::bigint as expected, (count(*) % 3)::bigint as waiting
       from lineitem group by 1 having count(*) % 3 > 0""",
)
def batch_pending(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.lit(3).alias("want"))
    return windows.batch_pending(rows, "l_orderkey", "want")


@query(
    "delay_ready",
    """select _rel, count(*) as n, sum(l_orderkey)::bigint as key_sum from (
         select l_orderkey, case when l_linestatus = 'F' and l_quantity < 2 then 'failure' when (epoch_us(l_shipdate) // 1000) + l_quantity * 86400000
           <= (epoch_us(timestamp '1998-09-01') // 1000) then 'success' else 'held' end as _rel
         from lineitem) group by 1""",
)
def delay_ready(spark, sf):
    """Lines are held as many days after shipping as they have units.

    The delay of some is no number.
    """
    late = (F.col("l_linestatus") == "F") & (F.col("l_quantity") < 2)
    out = windows.release_ready(
        table(spark, sf, "lineitem"),
        "l_shipdate",
        F.when(~late, (F.col("l_quantity") * 86_400_000).cast("long").cast("string")).otherwise("soon"),
        F.to_timestamp(F.lit("1998-09-01")),
    )
    return out.groupBy(REL).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum")
    )


@query(
    "batch_wait_nameless",
    """with n as (select event_id, event_type = 'purchase' as ok,
           row_number() over (partition by event_type = 'purchase', user_id order by ts, event_id) as rn from events)
       select event_id, 'original' as _rel from n
       union all select event_id, 'batch-completed' from n where ok and rn % 3 = 0
       union all select event_id, 'failure' from n where not ok""",
)
def batch_wait_nameless(spark, sf):
    """Most events have no batch id; they never enter the ordering."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id")
    name = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("string"))
    rows = events.withColumns({"batch": name, "size": F.lit("3")})
    return windows.batch_wait(rows, "batch", "size", ["ts", "event_id"]).select("event_id", REL)
