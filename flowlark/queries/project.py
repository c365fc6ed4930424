"""Projection queries."""

from pyspark.sql import functions as F

from flowlark.functions import json as fj
from flowlark.functions.tags import parse_tags
from flowlark.operators import project
from flowlark.operators.routing import REL
from flowlark.queries.registry import query, table


@query(
    "md5_attributes",
    """select c_custkey, case when c_acctbal >= 0 then md5(c_name) end as name_hash,
         case when c_acctbal >= 0 then md5(c_mktsegment || ':' || c_nationkey) end as place_hash,
         case when c_acctbal >= 0 then 'success' else 'failure' end as _rel from customer""",
)
def md5_attributes(spark, sf):
    """Customers in debt have no name here, so none of their hashes is made."""
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    place = F.concat_ws(":", "c_mktsegment", F.col("c_nationkey").cast("string"))
    out = project.md5_columns(
        table(spark, sf, "customer"), {"name_hash": name, "place_hash": place}
    )
    return out.select("c_custkey", "name_hash", "place_hash", REL)


@query(
    "attributes_to_json",
    """select c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name
         || '","c_nationkey":' || c_nationkey || '}' as content,
         'application/json' as mime_type, 'success' as _rel from customer""",
)
def attributes_to_json(spark, sf):
    out = project.to_json_content(
        table(spark, sf, "customer"), ["c_custkey", "c_name", "c_nationkey"]
    )
    return out.select("c_custkey", "content", "mime_type", REL)


@query(
    "attributes_to_json_text",
    """select event_id, case when event_type <> 'error' then
         '{"event_type":"' || event_type || '","props":' || props || ',"value":' || value::varchar
         || ',"user_id":' || user_id || '}' end as content,
         case when event_type = 'error' then 'failure' else 'success' end as _rel from events""",
)
def attributes_to_json_text(spark, sf):
    """All attributes are text; those of error events hold broken JSON."""
    events = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props"))
        .otherwise(F.col("props"))
        .alias("props"),
        F.col("value").cast("string").alias("value"),
        F.concat(F.lit(" "), F.col("user_id").cast("string")).alias("user_id"),
    )
    out = project.to_json_content(events, ["event_type", "props", "value", "user_id"])
    return out.select("event_id", "content", REL)


@query(
    "create_content",
    """select c_custkey, 'Dear ' || c_name || ' (' || c_mktsegment || '), nation '
         || c_nationkey || ', null.' as content from customer""",
)
def create_content(spark, sf):
    template = "Dear {{ c_name }} ({{c_mktsegment}}), nation {{ c_nationkey }}, {{ missing }}."
    out = project.render_template(table(spark, sf, "customer"), template)
    return out.select("c_custkey", "content")


@query(
    "create_json_content",
    """select o_orderkey, '{"order":{"key":' || o_orderkey || ',"price":' || o_totalprice::varchar
         || ',"status":"' || o_orderstatus || '"},"urgent":' || (o_orderpriority = '1-URGENT')::varchar
         || ',"note":null,"version":2,"tags":["{{ o_orderkey }}"]}' as content,
         'success' as _rel from orders""",
)
def create_json_content(spark, sf):
    template = """{"order": {"key": "{{ o_orderkey:int }}", "price": "{{o_totalprice:float}}",
      "status": "{{ o_orderstatus }}"}, "urgent": "{{ urgent:bool }}", "note": "{{ missing:json }}",
      "version": 2, "tags": ["{{ o_orderkey }}"]}"""
    orders = table(spark, sf, "orders").withColumn(
        "urgent", (F.col("o_orderpriority") == "1-URGENT").cast("string")
    )
    return project.render_json(orders, template).select("o_orderkey", "content", REL)


@query(
    "create_json_failures",
    """select o_orderkey, 'failure' as _rel, '$.priority' as json_error_key,
         o_orderpriority as json_error_value from orders""",
)
def create_json_failures(spark, sf):
    out = project.render_json(
        table(spark, sf, "orders"), '{"key": "{{o_orderkey:int}}", "priority": "{{o_orderpriority:int}}"}'
    )
    return out.select("o_orderkey", REL, "json_error_key", "json_error_value")


@query(
    "json_extract",
    """select event_id, json_extract_string(props, '$.k') as k, 'null' as gone from events""",
)
def json_extract(spark, sf):
    events = table(spark, sf, "events")
    out = project.with_json_value(events, "props", "k", "k")
    return project.with_json_value(out, "props", "a.b", "gone").select("event_id", "k", "gone")


@query(
    "json_update",
    """select event_id, '{"k":' || event_id || '}' as props, true as updated, false as again
       from events""",
)
def json_update(spark, sf):
    out = project.with_json_update(table(spark, sf, "events"), "props", "k", F.col("event_id"))
    _, again = fj.json_update("props", "missing.leaf", F.lit(1))
    return out.select("event_id", "props", "updated", again.alias("again"))


@query(
    "object_id",
    """select event_id, printf('%08x', (epoch_us(ts) // 1000) // 1000) as head, 24 as size from events""",
)
def object_id(spark, sf):
    events = table(spark, sf, "events")
    seed = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    out = project.with_object_id(events, "oid", seed)
    return out.select(
        "event_id", F.substring("oid", 1, 8).alias("head"), F.length("oid").alias("size")
    )


@query(
    "parse_tags_strict",
    """select event_id, case when event_type <> 'error' then event_type end as t,
         case when event_type <> 'error' then user_id::varchar end as u,
         event_type <> 'error' as valid from events""",
)
def parse_tags_strict(spark, sf):
    text = F.concat(
        F.lit("type= "),
        "event_type",
        F.lit(", user="),
        F.col("user_id").cast("string"),
        F.when(F.col("event_type") == "error", ",oops").otherwise(""),
    )
    tags = table(spark, sf, "events").select("event_id", parse_tags(text).alias("m"))
    return tags.select(
        "event_id",
        F.try_element_at("m", F.lit("type")).alias("t"),
        F.try_element_at("m", F.lit("user")).alias("u"),
        F.col("m").isNotNull().alias("valid"),
    )


@query(
    "parse_tags_quoted",
    """select c_custkey, c_name || ', ' || c_mktsegment as note, c_nationkey::varchar as nation,
         'a=b' as kept, 3 as n from customer""",
)
def parse_tags_quoted(spark, sf):
    text = F.concat(
        F.lit('"note='), "c_name", F.lit(", "), "c_mktsegment", F.lit('", nation='),
        F.col("c_nationkey").cast("string"), F.lit(",oops, =x, y= , kept=a=b"),
    )
    tags = table(spark, sf, "customer").select("c_custkey", parse_tags(text, False).alias("m"))
    return tags.select(
        "c_custkey",
        *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("note", "nation", "kept")],
        F.size("m").alias("n"),
    )


@query(
    "field_map",
    """select event_id, value, (props->>'$.k')::double as k, 2 as n from events""",
)
def field_map(spark, sf):
    events = table(spark, sf, "events")
    fields = project.field_map(
        events,
        {
            "value": F.col("value"),
            "k": F.get_json_object("props", "$.k"),
            "type": F.col("event_type"),
        },
    )
    out = events.select("event_id", fields.alias("f"))
    return out.select(
        "event_id", F.col("f")["value"].alias("value"), F.col("f")["k"].alias("k"), F.size("f").alias("n")
    )


@query(
    "extended_json",
    """select event_id, substr(md5(event_id::varchar), 1, 24) as oid,
         (epoch_us(ts) // 1000) * 1000 as at_us, event_type as plain from events""",
)
def extended_json(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.concat(
            F.lit('{"$oid":"'), F.substring(F.md5(F.col("event_id").cast("string")), 1, 24), F.lit('"}')
        ).alias("a"),
        F.concat(
            F.lit('{"$date":'), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit("}")
        ).alias("b"),
        F.concat(F.lit('"'), "event_type", F.lit('"')).alias("c"),
    )
    return events.select(
        "event_id",
        fj.extended_text("a").alias("oid"),
        F.unix_micros(fj.extended_date("b")).alias("at_us"),
        fj.extended_text("c").alias("plain"),
    )
