"""De-duplication and key-set queries."""

from pyspark.sql import functions as F

from flowlark.operators import dedupe, seen
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, table
from flowlark.session import scratch_path

FRESH_SQL = """
with recursive a as (
  select user_id, min(ts) as t from events group by user_id
  union all
  select a.user_id, x.ts from a, lateral (
    select min(e.ts) as ts from events e
    where e.user_id = a.user_id and e.ts >= a.t + interval '6 hours') x
  where x.ts is not null
)
select e.event_id, case when a.t is null then 'duplicate' else 'non-duplicate' end as _rel
from events e left join a on a.user_id = e.user_id and a.t = e.ts
"""


@query(
    "identify_duplicate",
    """select doc_id, case when trim(text) = '' then 'failure'
         when row_number() over (partition by text order by doc_id) = 1 then 'non-duplicate'
         else 'duplicate' end as _rel from documents""",
)
def identify_duplicate(spark, sf):
    docs = table(spark, sf, "documents")
    return dedupe.identify_duplicates(docs, "text", ["doc_id"]).select("doc_id", REL)


@query(
    "identify_duplicate_users",
    """select event_id, case when row_number() over (partition by user_id order by ts, event_id) = 1
         then 'non-duplicate' else 'duplicate' end as _rel from events""",
)
def identify_duplicate_users(spark, sf):
    events = table(spark, sf, "events")
    return dedupe.identify_duplicates(events, "user_id", ["ts", "event_id"]).select("event_id", REL)


@query("dedupe_ttl", FRESH_SQL)
def dedupe_ttl(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    out = dedupe.identify_duplicates(events, "user_id", ["event_id"], ttl="6 hours", ts="ts")
    return out.select("event_id", REL)


@query(
    "add_if_absent",
    """select o_orderkey, (row_number() over (partition by o_custkey order by o_orderkey) = 1
         and o_custkey not in (select s_suppkey from supplier)) as added from orders""",
)
def add_if_absent(spark, sf):
    flagged = dedupe.add_if_absent(
        table(spark, sf, "orders"), table(spark, sf, "supplier"), "o_custkey", ["o_orderkey"], "s_suppkey"
    )
    return flagged.select("o_orderkey", "added")


@query(
    "cache_contains",
    """select l_orderkey, count(*) as n, bool_and(l_partkey in (select s_suppkey from supplier)) as all_in,
         bool_or(l_partkey in (select s_suppkey from supplier)) as any_in
       from lineitem group by 1""",
)
def cache_contains(spark, sf):
    out = dedupe.contains(
        table(spark, sf, "lineitem"), table(spark, sf, "supplier"), "l_partkey", "s_suppkey"
    )
    return out.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and("contained").alias("all_in"),
        F.bool_or("contained").alias("any_in"),
    )


@query(
    "cache_remove",
    """select c_custkey from customer where c_custkey not in (select user_id from events)""",
)
def cache_remove(spark, sf):
    return dedupe.remove_keys(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "events"),
        "c_custkey",
        "user_id",
    )


@query(
    "seen_keys",
    """select event_id, row_number() over (partition by user_id, event_type order by event_id) = 1 as added
       from events""",
)
def seen_keys(spark, sf):
    """Events in three micro-batches against a set that lasts; the second one is replayed."""
    events = table(spark, sf, "events")
    events = events.select("event_id", F.concat_ws(":", "user_id", "event_type").alias("name"))
    last = events.agg(F.max("event_id")).first()[0] or 0
    part = F.call_function("div", F.col("event_id") * 3, F.lit(last + 1))
    names = seen.SeenKeys(spark, scratch_path(spark, "seen"), buckets=64)
    flags = {}
    for batch in (0, 1, 2, 1):
        flags[batch] = names.add(events.filter(part == batch), "name", ["event_id"], batch)
    return flags[0].unionByName(flags[1]).unionByName(flags[2]).select("event_id", "added")
