"""Metrics-reporting queries."""

from pyspark.sql import functions as F

from flowlark.functions import numbers
from flowlark.operators import metrics as m
from flowlark.queries.registry import query, rounded, table


def _tree(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    supplier = table(spark, sf, "supplier")

    def name(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    zero = F.lit(0.0).alias("balance")
    nodes = (
        region.select(name("r", "r_regionkey").alias("id"), zero)
        .unionByName(nation.select(name("n", "n_nationkey").alias("id"), zero))
        .unionByName(
            supplier.select(name("s", "s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
        )
    )
    edges = nation.select(
        name("r", "n_regionkey").alias("parent"), name("n", "n_nationkey").alias("child")
    ).unionByName(
        supplier.select(name("n", "s_nationkey").alias("parent"), name("s", "s_suppkey").alias("child"))
    )
    roots = region.select(name("r", "r_regionkey").alias("id"))
    return m.flatten_tree(nodes, edges, roots)


@query(
    "hierarchy_flatten",
    """with recursive e as (
         select 'r' || n_regionkey as parent, 'n' || n_nationkey as child from nation
         union all select 'n' || s_nationkey, 's' || s_suppkey from supplier
       ), t as (
         select 'r' || r_regionkey as id, 0 as depth, 'r' || r_regionkey as path from region
         union all
         select e.child, t.depth + 1, t.path || '/' || e.child from t join e on e.parent = t.id
       ) select id, depth, path from t""",
)
def hierarchy_flatten(spark, sf):
    return _tree(spark, sf).select("id", "depth", F.array_join("path", "/").alias("path"))


@query(
    "hierarchy_rollup",
    """select id, round(sum(balance), 2) as balance from (
         select 's' || s_suppkey as id, s_acctbal as balance from supplier
         union all select 'n' || s_nationkey, s_acctbal from supplier
         union all select 'r' || n_regionkey, s_acctbal from supplier join nation on n_nationkey = s_nationkey
         union all select 'n' || n_nationkey, 0.0 from nation
         union all select 'r' || r_regionkey, 0.0 from region) group by 1""",
)
def hierarchy_rollup(spark, sf):
    return rounded(m.rollup_tree(_tree(spark, sf), ["balance"]), 2, "balance")


@query(
    "status_points",
    """select s_suppkey, 'processor' as measurement, field, value from (
         select s_suppkey, 'inputBytes' as field, s_acctbal as value from supplier
         union all select s_suppkey, 'inputCount', s_nationkey::double from supplier)""",
)
def status_points(spark, sf):
    """Suppliers as processors."""
    rows = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").cast("string").alias("groupId"),
        F.col("s_name").alias("processorName"),
        F.col("s_suppkey").cast("string").alias("id"),
        F.lit("supplier").alias("type"),
        F.col("s_acctbal").alias("inputBytes"),
        F.col("s_nationkey").cast("double").alias("inputCount"),
    )
    points = m.status_to_points(
        rows,
        "processor",
        field_columns=["inputBytes", "inputCount"],
        global_tags={"clusterNodeId": F.lit("node-1"), "ipAddress": F.lit("10.0.0.1")},
        keep=["s_suppkey"],
    )
    return m.long_fields(points, ["s_suppkey"])


def _register_entity(entity: str) -> None:
    """All tags and fields of one kind of status, from the orders."""
    tags, fields = m.ENTITY_TAGS[entity], m.ENTITY_FIELDS[entity]
    names = ", ".join(f"'{f}'" for f in fields)
    tag_text = " || ',' || ".join(f"'{t}=' || o_custkey || '{t}'" for t in sorted(tags)) or "''"
    sql = f"""select o_orderkey, '{entity}' as measurement, {tag_text} as tags, field,
         o_totalprice + position as value
       from orders, (select unnest([{names}]) as field, unnest(range({len(fields)})) as position)"""

    def status(spark, sf):
        rows = table(spark, sf, "orders").select(
            "o_orderkey",
            *[F.concat(F.col("o_custkey").cast("string"), F.lit(t)).alias(t) for t in tags],
            *[(F.col("o_totalprice") + i).alias(f) for i, f in enumerate(fields)],
        )
        points = m.status_to_points(rows, entity, keep=["o_orderkey"])
        text = F.array_join(
            F.transform(
                F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
            ),
            ",",
        )
        return points.select("o_orderkey", "measurement", text.alias("tags"), F.explode("fields").alias("field", "value"))

    query(f"status_{entity}", sql)(status)


for _entity in m.ENTITY_FIELDS:
    _register_entity(_entity)


@query(
    "status_tags",
    """select s_suppkey, 'node-1' as node, s_nationkey::varchar as "group", s_name as name,
         'supplier' as type, 5 as tags, 1 as fields from supplier""",
)
def status_tags(spark, sf):
    rows = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("groupId"),
        F.col("s_name").alias("processorName"),
        F.col("s_suppkey").alias("id"),
        F.lit("supplier").alias("type"),
        F.col("s_acctbal").alias("inputBytes"),
        F.lit(None).cast("double").alias("runStatus"),
    )
    points = m.status_to_points(
        rows,
        "processor",
        field_columns=["inputBytes", "runStatus"],
        global_tags={"clusterNodeId": F.lit("node-1")},
        keep=["s_suppkey"],
    )
    tag = lambda k: F.col("tags")[k]
    return points.select(
        "s_suppkey",
        tag("clusterNodeId").alias("node"),
        tag("groupId").alias("group"),
        tag("processorName").alias("name"),
        tag("type").alias("type"),
        F.size("tags").alias("tags"),
        F.size("fields").alias("fields"),
    )


@query(
    "used_percent",
    """select o_orderkey, round(case when o_totalprice <> 0
         then 100.0 * (1.0 - c_acctbal / o_totalprice) end, 6) as used
       from orders join customer on c_custkey = o_custkey""",
)
def used_percent(spark, sf):
    pairs = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    used = numbers.used_percent("c_acctbal", "o_totalprice")
    return pairs.select("o_orderkey", F.round(used, 6).alias("used"))


@query(
    "state_percent",
    """select 'jvm.thread_states.' || s as field, trunc(100 * n / (sum(n) over ()))::double as value
       from (select case event_type when 'click' then 'runnable' when 'view' then 'blocked'
               when 'purchase' then 'terminated' when 'signup' then 'timed_waiting' else 'new' end as s,
             count(*)::double as n from events group by 1)
       qualify s <> 'new'""",
)
def state_percent(spark, sf):
    """Share of each event type, as if it were a thread state."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "click", "RUNNABLE")
        .when(kind == "view", "BLOCKED")
        .when(kind == "purchase", "TERMINATED")
        .when(kind == "signup", "TIMED_WAITING")
        .otherwise("NEW")
    )
    names = ["RUNNABLE", "BLOCKED", "TERMINATED", "TIMED_WAITING", "NEW"]
    counts = table(spark, sf, "events").select(state.alias("state")).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("state") == n).alias(n) for n in names]
    )
    pairs = [
        F.struct(F.lit(n).alias("state"), F.try_divide(n, "total").alias("share")) for n in names
    ]
    shares = counts.select(F.inline(F.array(*pairs)))
    return m.normalize_states(shares, "state", "share")


@query(
    "gc_metrics",
    """select 'jvm.gc.runs.' || replace(s_name, ' ', '') as field, s_nationkey::double as value from supplier
       union all select 'jvm.gc.time.' || replace(s_name, ' ', ''), s_acctbal from supplier""",
)
def gc_metrics(spark, sf):
    return m.flatten_gc(table(spark, sf, "supplier"), "s_name", "s_nationkey", "s_acctbal")


@query(
    "status_ordinal",
    """select o_orderkey, case o_orderstatus when 'O' then 0.0 when 'F' then 1.0 else null end::double
         as status from orders""",
)
def status_ordinal(spark, sf):
    level = numbers.ordinal("o_orderstatus", ["O", "F"])
    return table(spark, sf, "orders").select("o_orderkey", level.alias("status"))


_DATUMS_SQL = """select p_partkey, 'p_retailprice' as name, p_retailprice as value, p_name as location,
  p_brand as brand, 2 as dimensions from part"""


def _datums(spark, sf):
    part = table(spark, sf, "part")
    return m.metric_datums(
        part,
        "p_name",
        ["p_retailprice", "p_size", "p_type", " "],
        {"brand": F.col("p_brand")},
        keep=["p_partkey"],
    )


@query("metric_datums", _DATUMS_SQL)
def metric_datums(spark, sf):
    """Only the price is a double; size, type and the blank name give nothing."""
    return _datums(spark, sf).select(
        "p_partkey",
        "name",
        "value",
        F.col("dimensions")[m.LOCATION].alias("location"),
        F.col("dimensions")["brand"].alias("brand"),
        F.size("dimensions").alias("dimensions"),
    )


@query(
    "metric_batches",
    """select p_partkey, ((row_number() over (order by p_partkey) - 1) // 20)::bigint as chunk from part""",
)
def metric_batches(spark, sf):
    out = m.chunk_rows(_datums(spark, sf), m.DATUMS_PER_REQUEST, ["p_partkey"])
    return out.select("p_partkey", "chunk")


@query(
    "metric_requests",
    """select chunk, count(*)::int as n, round(sum(p_retailprice), 2) as total from (
         select p_retailprice, ((row_number() over (order by p_partkey) - 1) // 20)::bigint as chunk
         from part) group by 1""",
)
def metric_requests(spark, sf):
    out = m.metric_requests(_datums(spark, sf), ["p_partkey"])
    total = F.aggregate("data", F.lit(0.0), lambda a, x: a + x["value"])
    return out.select("chunk", F.size("data").alias("n"), F.round(total, 2).alias("total"))


@query(
    "snapshot_json",
    """select n_name, part, '{"n_name":"' || n_name || '","members":['
         || string_agg('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}', ','
            order by c_custkey) || ']}' as snapshot
       from (select n_name, c_custkey, c_name, ((row_number() over (
               partition by n_name order by c_custkey) - 1) // 50)::bigint as part
             from customer join nation on n_nationkey = c_nationkey) group by 1, 2""",
)
def snapshot_json(spark, sf):
    """Nations with their customers, at most fifty to a part."""
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    members = ["c_custkey", "c_name"]
    return m.snapshot_json(rows, ["n_name"], members, ["c_custkey"], part_rows=50)
