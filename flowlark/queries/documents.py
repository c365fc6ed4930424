"""Document-table and bulk-action queries."""

from pyspark.sql import functions as F

from flowlark.operators import bulk, documents as d
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, table
from flowlark.session import scratch_path


@query(
    "doc_find",
    """with hits as (
         select c_custkey, o_orderkey, o_totalprice, row_number() over (
           partition by c_custkey order by o_totalprice desc, o_orderkey) as rn
         from customer join orders on o_custkey = c_custkey)
       select c_custkey, o_orderkey, o_totalprice, 'success' as _rel from hits where rn <= 3
       union all select c_custkey, null, null, 'noresult' from customer
       where c_custkey not in (select o_custkey from orders)""",
)
def doc_find(spark, sf):
    """The three dearest orders of each customer."""
    return d.find(
        table(spark, sf, "customer").select("c_custkey"),
        table(spark, sf, "orders"),
        {"c_custkey": "o_custkey"},
        project=["o_orderkey", "o_totalprice"],
        sort=[F.desc("o_totalprice"), F.col("o_orderkey")],
        limit=3,
        request_id=["c_custkey"],
    )


@query(
    "doc_find_array",
    """with w as (select p_partkey, unnest(list_distinct(string_split(p_name, ' '))) as word from part),
       r as (select distinct split_part(p_name, ' ', 2) as asked from part
             union select distinct lower(p_type) from part)
       select asked, p_partkey, case when p_partkey is null then 'noresult' else 'success' end as _rel
       from r left join w on word = asked""",
)
def doc_find_array(spark, sf):
    """Parts by any word of their name, asked with name words and part types."""
    part = table(spark, sf, "part")
    asked = part.select(F.substring_index("p_name", " ", -1).alias("asked")).unionByName(
        part.select(F.lower("p_type").alias("asked"))
    )
    docs = part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return d.find(asked.distinct(), docs, {"asked": "words"}, project=["p_partkey"])


_WORDS_SQL = """select lang, word, count(*) as n from (
   select lang, unnest(string_split(text, ' ')) as word from documents where source <> 'src0')
 where word <> '' group by 1, 2"""


def _word_stages():
    return [
        d.match(F.col("source") != "src0"),
        d.project("lang", F.split("text", " ").alias("word")),
        d.unwind("word"),
        d.match(F.col("word") != ""),
        d.group(["lang", "word"], n=F.count(F.lit(1))),
        d.sort(F.desc("n"), "lang", "word"),
    ]


@query("doc_aggregate", _WORDS_SQL)
def doc_aggregate(spark, sf):
    return d.aggregate(table(spark, sf, "documents"), _word_stages())


@query("doc_aggregate_out", _WORDS_SQL)
def doc_aggregate_out(spark, sf):
    """The same pipeline into a table, read back."""
    out = scratch_path(spark, "aggregate")
    d.aggregate(table(spark, sf, "documents"), _word_stages()[:-1], out=out)
    return spark.read.parquet(out)


@query(
    "doc_lookup",
    """select n_name, count(*) as orders, round(sum(o_totalprice), 2) as price
       from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
       where o_orderstatus = 'F' group by 1 order by 1 limit 10 offset 5""",
)
def doc_lookup(spark, sf):
    return d.aggregate(
        table(spark, sf, "orders"),
        [
            d.match(F.col("o_orderstatus") == "F"),
            d.lookup(table(spark, sf, "customer"), "o_custkey", "c_custkey", "inner"),
            d.lookup(table(spark, sf, "nation"), "c_nationkey", "n_nationkey", "inner"),
            d.group(
                ["n_name"], orders=F.count(F.lit(1)), price=F.round(F.sum("o_totalprice"), 2)
            ),
            d.sort("n_name"),
            d.skip(5),
            d.limit(10),
        ],
    )


def _insert_rows(spark, sf):
    docs = table(spark, sf, "documents")
    bad = F.col("lang") == "fr"
    return docs.select(
        "doc_id",
        F.md5("text").alias("hash"),
        F.when(bad, F.lit("bad payload")).otherwise(F.to_json(F.struct("doc_id"))).alias("payload"),
    )


@query(
    "doc_insert_unordered",
    """with r as (select doc_id, md5(text) as h, lang = 'fr' as bad from documents),
       f as (select h, min(doc_id) as first_id from r where not bad
             and h not in (select md5(text) from benchmark) group by h)
       select r.doc_id,
         case when not bad and f.first_id is distinct from r.doc_id then 11000 end as error_code,
         case when not bad and f.first_id = r.doc_id then 'success' else 'failure' end as _rel
       from r left join f on f.h = r.h""",
)
def doc_insert_unordered(spark, sf):
    """Documents under a unique content hash; French ones carry a bad body."""
    held = table(spark, sf, "benchmark").select(F.md5("text").alias("hash"))
    out = d.insert(held, _insert_rows(spark, sf), "hash", ["doc_id"], payload="payload")
    return out.select("doc_id", "error_code", REL)


@query(
    "doc_insert_ordered",
    """with recursive r as (
         select doc_id, md5(text) as h, lang = 'fr' as bad,
           row_number() over (order by doc_id) as pos from documents
       ), f as (
         select 0::bigint as pos, 0::bigint as doc_id, false as stopped,
           (select list(md5(text)) from benchmark) as seen, '' as rel, null::int as code
         union all
         select r.pos, r.doc_id, x.stopped or (not bad and x.dup),
           case when not bad and not x.stopped and not x.dup then list_append(f.seen, r.h) else f.seen end,
           case when not bad and not x.stopped and not x.dup then 'success' else 'failure' end,
           case when not bad and not x.stopped and x.dup then 11000 end
         from f join r on r.pos = f.pos + 1, lateral (
           select f.stopped and (r.pos - 1) % 50 <> 0 as stopped, list_contains(f.seen, r.h) as dup) x
       )
       select doc_id, code as error_code, rel as _rel from f where pos > 0""",
)
def doc_insert_ordered(spark, sf):
    held = table(spark, sf, "benchmark").select(F.md5("text").alias("hash"))
    out = d.insert(
        held, _insert_rows(spark, sf), "hash", ["doc_id"], ordered=True, payload="payload"
    )
    return out.select("doc_id", "error_code", REL)


@query(
    "doc_update_set",
    """select c_custkey, c_name, coalesce(u.price, c_acctbal) as c_acctbal,
         coalesce(u.prio, c_mktsegment) as c_mktsegment
       from customer left join (
         select o_custkey, arg_max(o_totalprice, o_orderkey) as price,
           arg_max(o_orderpriority, o_orderkey) as prio from orders group by 1) u
       on o_custkey = c_custkey""",
)
def doc_update_set(spark, sf):
    """Customers take balance and segment from their last order."""
    docs = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return d.update_many(
        docs,
        table(spark, sf, "orders"),
        {"c_custkey": "o_custkey"},
        {"c_acctbal": "o_totalprice", "c_mktsegment": "o_orderpriority"},
        ["o_orderkey"],
    )


@query(
    "doc_update_unset",
    """select c_custkey, case when c_custkey not in (select user_id from events) then c_acctbal end
         as c_acctbal from customer""",
)
def doc_update_unset(spark, sf):
    docs = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return d.update_many(
        docs,
        table(spark, sf, "events"),
        {"c_custkey": "user_id"},
        {"c_acctbal": "value"},
        ["event_id"],
        op=d.UNSET,
    )


@query(
    "doc_update_add_to_set",
    """select c_custkey, array_to_string(list_sort(list_distinct(
         list_append(coalesce(u.p, []), c_mktsegment))), '|') as tags
       from customer left join (
         select o_custkey, list(distinct o_orderpriority) as p from orders group by 1) u
       on o_custkey = c_custkey""",
)
def doc_update_add_to_set(spark, sf):
    docs = table(spark, sf, "customer").select("c_custkey", F.array("c_mktsegment").alias("tags"))
    out = d.update_many(
        docs,
        table(spark, sf, "orders"),
        {"c_custkey": "o_custkey"},
        {"tags": "o_orderpriority"},
        ["o_orderkey"],
        op=d.ADD_TO_SET,
    )
    return out.select("c_custkey", F.array_join(F.sort_array("tags"), "|").alias("tags"))


@query(
    "doc_update_push",
    """select c_custkey, case when u.p is null then c_mktsegment
         else c_mktsegment || '|' || u.p end as tags
       from customer left join (
         select o_custkey, string_agg(o_orderpriority, '|' order by o_orderkey) as p from orders group by 1) u
       on o_custkey = c_custkey""",
)
def doc_update_push(spark, sf):
    """Priorities of a customer's orders behind the segment, repeats included."""
    docs = table(spark, sf, "customer").select("c_custkey", F.array("c_mktsegment").alias("tags"))
    out = d.update_many(
        docs,
        table(spark, sf, "orders"),
        {"c_custkey": "o_custkey"},
        {"tags": "o_orderpriority"},
        ["o_orderkey"],
        op=d.PUSH,
    )
    return out.select("c_custkey", F.array_join("tags", "|").alias("tags"))


@query(
    "doc_upsert",
    """select coalesce(s_suppkey, o_custkey) as s_suppkey, s_name,
         coalesce(u.price, s_acctbal) as s_acctbal
       from supplier full join (
         select o_custkey, arg_max(o_totalprice, o_orderkey) as price from orders group by 1) u
       on o_custkey = s_suppkey""",
)
def doc_upsert(spark, sf):
    docs = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return d.update_many(
        docs,
        table(spark, sf, "orders"),
        {"s_suppkey": "o_custkey"},
        {"s_acctbal": "o_totalprice"},
        ["o_orderkey"],
        upsert=True,
    )


@query(
    "doc_delete",
    """select o_orderkey, o_custkey from orders
       where o_custkey not in (select c_custkey from customer where c_acctbal < 0)""",
)
def doc_delete(spark, sf):
    gone = table(spark, sf, "customer").filter("c_acctbal < 0")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return d.delete_many(orders, gone, {"o_custkey": "c_custkey"})


@query(
    "doc_expire",
    """select o_orderkey from orders
       where o_orderdate > timestamp '1998-08-01' - interval '365 days'""",
)
def doc_expire(spark, sf):
    as_of = F.to_timestamp(F.lit("1998-08-01"))
    return d.expire(table(spark, sf, "orders"), "o_orderdate", 365 * 86_400, as_of).select(
        "o_orderkey"
    )


@query(
    "doc_unique_violations",
    """select l_partkey, l_suppkey, count(*) as n from lineitem group by 1, 2 having count(*) > 1""",
)
def doc_unique_violations(spark, sf):
    return d.violations(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


# --- bulk actions ----------------------------------------------------------------------

_OPS_SQL = """case event_type when 'click' then 'INDEX' when 'view' then 'update'
  when 'purchase' then 'upsert' when 'signup' then 'delete' else 'merge' end"""


def _actions(spark, sf):
    op = (
        F.when(F.col("event_type") == "click", "INDEX")
        .when(F.col("event_type") == "view", "update")
        .when(F.col("event_type") == "purchase", "upsert")
        .when(F.col("event_type") == "signup", "delete")
        .otherwise("merge")
    )
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("value") < 200, "events").otherwise("").alias("index"),
        F.when(F.col("event_type") != "view", "event").alias("type"),
        op.alias("op"),
        F.when(F.col("value") >= 5, F.col("user_id").cast("string")).alias("doc_id"),
        F.when(F.col("value") <= 150, F.regexp_replace("props", " ", "\n")).alias("content"),
    )


_GOOD_SQL = """value < 200 and event_type <> 'error' and (event_type = 'click' or value >= 5)
  and (event_type = 'signup' or value <= 150)"""


@query(
    "bulk_validate",
    f"""select event_id, case when {_GOOD_SQL} then 'success' else 'failure' end as _rel
        from events""",
)
def bulk_validate(spark, sf):
    return bulk.validate_actions(_actions(spark, sf), content="content").select("event_id", REL)


@query(
    "bulk_lines",
    f"""with a as (select event_id, props, event_type, '"_index":"events"'
         || case when event_type <> 'view' then ',"_type":"event"' else '' end
         || case when value >= 5 then ',"_id":"' || user_id || '"' else '' end as meta
       from events where {_GOOD_SQL})
       select event_id, case event_type
         when 'click' then '{{"index":{{' || meta || '}}}}' || chr(10) || props
         when 'signup' then '{{"delete":{{' || meta || '}}}}'
         else '{{"update":{{' || meta || '}}}}' || chr(10) || '{{"doc":' || props
           || ',"doc_as_upsert":true}}' end as lines
       from a""",
)
def bulk_lines(spark, sf):
    checked = bulk.validate_actions(_actions(spark, sf), content="content")
    good = checked.filter(F.col(REL) == "success")
    out = bulk.bulk_lines(good, upsert_option=bulk.DOC_AS_UPSERT)
    return out.select("event_id", "lines")


@query(
    "bulk_apply",
    """with recursive a as (
         select o_custkey as id, case o_orderstatus when 'F' then 'update' when 'O' then 'upsert'
             else case when o_orderpriority < '3' then 'index'
               when o_orderpriority < '4' then 'merge' else 'delete' end end as op,
           case when o_orderpriority <> '5-LOW' then o_totalprice end as price,
           o_orderpriority as seg,
           row_number() over (partition by o_custkey order by o_orderkey) as rn from orders
         where not (o_orderstatus = 'P' and o_orderpriority < '2')
       ), ids as (select s_suppkey as id from supplier union select o_custkey from orders
       ), f as (
         select ids.id, 0::bigint as rn, s_suppkey is not null as here, s_acctbal as bal, s_name as nm
         from ids left join supplier on s_suppkey = ids.id
         union all
         select f.id, a.rn,
           case a.op when 'index' then true when 'delete' then false when 'upsert' then true else f.here end,
           case when a.op = 'merge' then f.bal when a.op = 'delete' then null when a.op = 'index' then a.price
             when a.op = 'upsert' or f.here then coalesce(a.price, f.bal) end,
           case when a.op = 'merge' then f.nm when a.op = 'delete' then null when a.op = 'index' then a.seg
             when a.op = 'upsert' or f.here then coalesce(a.seg, f.nm) end
         from f join a on a.id = f.id and a.rn = f.rn + 1
       )
       select id as s_suppkey, bal as s_acctbal, nm as s_name from f
       where here and rn = (select max(g.rn) from f g where g.id = f.id)
       union all select -o_orderkey, o_totalprice, o_orderpriority from orders
       where o_orderstatus = 'P' and o_orderpriority < '2'""",
)
def bulk_apply(spark, sf):
    """Orders as actions on the supplier table, by customer number.

    Some have an op that is none, some are new documents without an id.
    """
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    op = (
        F.when(status == "F", "update")
        .when(status == "O", "upsert")
        .when(priority < "3", "index")
        .when(priority < "4", "merge")
        .otherwise("delete")
    )
    unnamed = (status == "P") & (priority < "2")
    actions = table(spark, sf, "orders").select(
        F.when(~unnamed, F.col("o_custkey")).alias("s_suppkey"),
        op.alias("op"),
        F.when(priority != "5-LOW", F.col("o_totalprice")).alias("s_acctbal"),
        priority.alias("s_name"),
        "o_orderkey",
    )
    base = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_name")
    return bulk.apply_bulk(
        base, actions, "s_suppkey", ["s_acctbal", "s_name"], ["o_orderkey"],
        new_id=-F.col("o_orderkey"),
    )


@query(
    "bulk_response",
    """select o_orderkey, case when n_status >= 500 then 'retry' when n_status >= 300 then 'failure'
         when errors and o_orderstatus = 'F' then 'failure' else 'success' end as _rel,
         case when n_status < 300 and errors and o_orderstatus = 'F' then o_orderpriority end as error_reason
       from (select *, (o_orderkey // 100) % 5 as k,
               case k when 0 then 503 when 1 then 404 else 200 end as n_status,
               k in (0, 1, 2, 3) as errors from orders)""",
)
def bulk_response(spark, sf):
    """Orders in requests of a hundred keys; the answers follow from the orders."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.call_function("div", F.col("o_orderkey"), F.lit(100)).alias("batch"),
        F.pmod("o_orderkey", F.lit(100)).cast("int").alias("position"),
    )
    item = F.struct(
        "position",
        F.when(F.col("o_orderstatus") == "F", 400).otherwise(201).alias("status"),
        F.col("o_orderpriority").alias("reason"),
    )
    kind = F.pmod("batch", F.lit(5))
    # At most a hundred items per request, by the key arithmetic above.
    answers = orders.groupBy("batch").agg(F.sort_array(F.collect_list(item)).alias("items"))
    answers = answers.select(
        "batch",
        F.when(kind == 0, 503).when(kind == 1, 404).otherwise(200).alias("status"),
        (kind < 4).alias("errors"),
        "items",
    )
    out = bulk.route_bulk_response(orders, answers)
    return out.select("o_orderkey", REL, "error_reason")
