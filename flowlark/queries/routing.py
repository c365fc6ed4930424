"""Routing queries."""

from pyspark.sql import functions as F

from flowlark.operators import routing
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, table

MASKS = {"one": 1, "two": 2, "four": 4}

_MASK_SQL = """
with m(name, mask) as (values ('one', 1), ('two', 2), ('four', 4)),
r as (select l_orderkey, l_partkey, l_linenumber::bigint as v from lineitem),
hit as (
  select r.*, m.name as _rel from r, m where (r.v & m.mask) = m.mask
  union all select r.*, 'unmatched' from r where (r.v & 7) = 0
)
"""


@query(
    "route_bitmask",
    _MASK_SQL + """select _rel, v as routed_value, count(*) as n,
         sum(l_orderkey)::bigint as key_sum from hit group by 1, 2""",
)
def route_bitmask(spark, sf):
    out = routing.route_bitmask(table(spark, sf, "lineitem"), "l_linenumber", MASKS)
    return _totals(out)


@query(
    "route_bitmask_flip",
    _MASK_SQL + """select _rel, xor(v, v & 7) as routed_value, count(*) as n,
         sum(l_orderkey)::bigint as key_sum from hit group by 1, 2""",
)
def route_bitmask_flip(spark, sf):
    out = routing.route_bitmask(table(spark, sf, "lineitem"), "l_linenumber", MASKS, flip=True)
    return _totals(out)


def _totals(out):
    return out.groupBy(REL, "routed_value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum")
    )


@query(
    "split_dataflow",
    """select o_orderkey, case when (row_number() over (order by o_orderkey) - 1) % 100 < 25
         then 'a' else 'b' end as _rel from orders""",
)
def split_dataflow(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return routing.split_percent(orders, 25, ["o_orderkey"])


@query(
    "retry_counter",
    """select o_orderkey, case when c < 3 then c + 1 else c end as retry_counter,
         case when c < 3 then 'retry' else 'conditional-violated' end as _rel,
         case when c >= 3 then o_orderstatus end as reason
       from (select *, substr(o_orderpriority, 1, 1)::bigint as c from orders)""",
)
def retry_counter(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "retry_counter", F.substring("o_orderpriority", 1, 1)
    )
    out = routing.retry_gate(
        orders,
        F.col("retry_counter") < 3,
        F.col("retry_counter") + 1,
        on_exceeded={"reason": F.col("o_orderstatus")},
        as_of=F.to_timestamp(F.lit("2024-01-01")),
    )
    return out.select("o_orderkey", "retry_counter", REL, "reason")


@query(
    "route_parse",
    """select event_id, case when event_type = 'error' then 'failure' else 'success' end as _rel,
         case when event_type <> 'error' then value end as parsed from events""",
)
def route_parse(spark, sf):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.col("value").cast("string")
    )
    out = routing.route_parse(table(spark, sf, "events"), text)
    return out.select("event_id", REL, "parsed")


@query(
    "select_named",
    """select p_partkey, p_name from part
       where p_name in ('red widget', '7', 'blue bolt') or p_partkey::varchar in ('red widget', '7', 'blue bolt')""",
)
def select_named(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return routing.select_named(part, " red widget, , 7,blue bolt , 7,  ", ["p_name", "p_partkey"])


@query(
    "route_empty",
    """select event_id, case when event_type = 'view' then 'reject' else 'success' end as _rel
       from events""",
)
def route_empty(spark, sf):
    """The type of view events is blanked first."""
    content = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    out = routing.route_empty(table(spark, sf, "events"), content)
    return out.select("event_id", REL)


@query(
    "route_outputs",
    """select o_orderkey, case when o_orderstatus = 'F' then 1 else 0 end as done from orders""",
)
def route_outputs(spark, sf):
    """Each output of a routed frame is consumed on its own and joined up again."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    routed = orders.withColumn(
        REL, F.when(F.col("o_orderstatus") == "F", "done").otherwise("open")
    )
    outputs = routing.split_routes(routed, ["done", "open"])
    done = outputs["done"].select("o_orderkey", F.lit(1).alias("done"))
    return done.unionByName(outputs["open"].select("o_orderkey", F.lit(0).alias("done")))
