"""Search-index bulk actions as lines, and their effect on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.functions.json import json_string
from flowlark.operators.routing import REL
from flowlark.plans.ordered import order_key
from flowlark.plans.skew import join_hot

# Operations and upsert options of the bulk format.
OPS = ["index", "update", "upsert", "delete"]
DOC_AS_UPSERT = "doc_as_upsert"
SCRIPTED_UPSERT = "scripted_upsert"


def validate_actions(
    df: DataFrame,
    index: str = "index",
    op: str = "op",
    doc_id: str = "doc_id",
    content: str | None = None,
) -> DataFrame:
    """``failure`` for an empty index or op, an unknown op, or a missing id.

    Only ``index`` may go without an id. With ``content`` given, so is an action
    without content, unless it deletes.
    """
    name = F.lower(F.coalesce(F.col(op).cast("string"), F.lit("")))
    unnamed = F.coalesce(F.col(index).cast("string"), F.lit("")) == ""
    bad = unnamed | ~name.isin(OPS) | ((name != "index") & F.col(doc_id).isNull())
    if content is not None:
        bad = bad | ((name != "delete") & F.col(content).isNull())
    return df.withColumn(REL, F.when(bad, "failure").otherwise("success"))


def _one_line(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n|\n|\r", " ")


def bulk_lines(
    df: DataFrame,
    index: str = "index",
    doc_type: str = "type",
    op: str = "op",
    doc_id: str = "doc_id",
    content: str = "content",
    script: str | None = None,
    upsert_option: str | None = None,
) -> DataFrame:
    """Add ``lines``: the action line and, but for deletes, the source line.

    A null type is left out. ``lines`` is null for an unknown op and for an
    action that lacks its content.
    """
    name = F.lower(F.col(op))
    body = _one_line(F.col(content))
    meta = F.concat(
        F.lit('"_index":'),
        json_string(F.col(index)),
        F.when(
            F.col(doc_type).isNotNull(), F.concat(F.lit(',"_type":'), json_string(F.col(doc_type)))
        ).otherwise(""),
        F.when(
            F.coalesce(F.col(doc_id), F.lit("")) != "",
            F.concat(F.lit(',"_id":'), json_string(F.col(doc_id))),
        ).otherwise(""),
    )

    def action(verb: str) -> Column:
        return F.concat(F.lit(f'{{"{verb}":{{'), meta, F.lit("}}"))

    as_doc = F.concat(
        F.lit('{"doc":'),
        body,
        F.lit(f',"{DOC_AS_UPSERT}":{str(upsert_option == DOC_AS_UPSERT).lower()}}}'),
    )
    source = as_doc
    if script is not None and upsert_option != DOC_AS_UPSERT:
        text = _one_line(F.col(script))
        rest = (
            F.lit(f',"upsert":{{}},"{SCRIPTED_UPSERT}":true}}')
            if upsert_option == SCRIPTED_UPSERT
            else F.concat(F.lit(',"upsert":'), body, F.lit("}"))
        )
        scripted = F.concat(F.lit('{"script":'), text, rest)
        source = F.when(F.coalesce(text, F.lit("")) == "", as_doc).otherwise(scripted)
    lines = (
        F.when(name == "index", F.concat(action("index"), F.lit("\n"), body))
        .when(name.isin("update", "upsert"), F.concat(action("update"), F.lit("\n"), source))
        .when(name == "delete", action("delete"))
    )
    return df.withColumn("lines", lines)


def write_bulk(df: DataFrame, path: str, batch_size: int = 100) -> None:
    """One request body per file of at most ``batch_size`` records."""
    writer = df.select("lines").write.option("maxRecordsPerFile", batch_size)
    writer.mode("overwrite").text(path)


def apply_bulk(
    base: DataFrame,
    actions: DataFrame,
    doc_id: str,
    fields: Sequence[str],
    order: Sequence[str],
    op: str = "op",
    *,
    new_id: Column,
) -> DataFrame:
    """The index as a table after all actions, in order per id.

    ``index`` replaces a document, ``update`` merges into one that exists,
    ``upsert`` merges or inserts, ``delete`` removes; merging skips null
    fields. An ``index`` action with a null or empty id is a document of its own, under
    ``new_id``; other ops, and others without an id, have no effect. Everything
    per id is a maximum or minimum by order, so actions are combined before each
    shuffle and an id with very many actions stays cheap.
    """
    at = order_key(order)
    kind = base.schema[doc_id].dataType
    name = F.lower(F.col(op))
    given = F.coalesce(F.col(doc_id).cast("string"), F.lit("")) != ""
    unnamed = actions.filter((name == "index") & ~given)
    unnamed = unnamed.select(new_id.cast(kind).alias(doc_id), *fields)
    rows = actions.filter(name.isin(OPS) & given).select(
        F.col(doc_id).alias("_id"), name.alias("_op"), at.alias("_at"), *fields
    )
    full = F.col("_op").isin("index", "delete")
    resets = (
        rows.filter(full)
        .groupBy("_id")
        .agg(F.max("_at").alias("_reset"), F.max_by("_op", "_at").alias("_reset_op"))
    )
    joined = join_hot(rows, resets, {"_id": "_id"})
    later = F.col("_reset").isNull() | (F.col("_at") > F.col("_reset"))
    merging = ~full & later
    aggs = [
        F.first("_reset_op").alias("_reset_op"),
        F.min(F.when(merging & (F.col("_op") == "upsert"), F.col("_at"))).alias("_upsert"),
    ]
    for f in fields:
        when = F.when(merging & F.col(f).isNotNull(), F.col("_at"))
        aggs += [
            F.max_by(f, F.when(F.col("_at") == F.col("_reset"), F.col("_at"))).alias(f"_full_{f}"),
            F.max_by(f, when).alias(f"_new_{f}"),
            F.max(when).alias(f"_new_at_{f}"),
        ]
    net = joined.groupBy("_id").agg(*aggs)
    both = base.withColumn("_there", F.lit(True)).join(
        net, F.col(doc_id) == F.col("_id"), "full_outer"
    )
    stands = F.when(
        F.col("_reset_op").isNull(), F.coalesce(F.col("_there"), F.lit(False))
    ).otherwise(F.col("_reset_op") == "index")
    values = [F.coalesce(F.col(doc_id), F.col("_id")).alias(doc_id)]
    for f in fields:
        old = F.when(F.col("_reset_op").isNull(), F.col(f)).when(
            F.col("_reset_op") == "index", F.col(f"_full_{f}")
        )
        counts = stands | (F.col(f"_new_at_{f}") >= F.col("_upsert"))
        values.append(F.coalesce(F.when(counts, F.col(f"_new_{f}")), old).alias(f))
    kept = both.filter(stands | F.col("_upsert").isNotNull()).select(*values)
    return kept.unionByName(unnamed)


def route_bulk_response(
    requests: DataFrame, responses: DataFrame, batch: str = "batch", position: str = "position"
) -> DataFrame:
    """Route sent records by the answer to their request.

    ``responses`` has ``batch``, ``status``, ``errors`` and ``items``, an array
    of (status, reason) in request order. A 5xx answer means ``retry`` for all,
    any other but 2xx ``failure`` for all; with errors each item decides.
    """
    heads = responses.select(
        F.col(batch).alias("_b"), F.col("status").alias("_status"), F.col("errors").alias("_errors")
    )
    items = responses.filter("errors").select(
        F.col(batch).alias("_ib"), F.posexplode("items").alias("_ip", "_item")
    )
    joined = requests.join(heads, F.col(batch) == F.col("_b"), "left").join(
        items, (F.col(batch) == F.col("_ib")) & (F.col(position) == F.col("_ip")), "left"
    )
    kind = F.floor(F.col("_status") / 100)
    item_kind = F.floor(F.col("_item.status") / 100)
    rel = (
        F.when(kind == 5, "retry")
        .when(F.coalesce(kind != 2, F.lit(True)), "failure")
        .when(F.col("_errors") & F.coalesce(item_kind != 2, F.lit(False)), "failure")
        .otherwise("success")
    )
    reason = F.when(F.col("_errors") & (kind == 2) & (item_kind != 2), F.col("_item.reason"))
    return joined.withColumns({REL: rel, "error_reason": reason}).drop(
        "_b", "_status", "_errors", "_ib", "_ip", "_item"
    )
