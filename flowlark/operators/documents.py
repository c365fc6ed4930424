"""Operators over a document table: find, pipelines, insert, update, delete."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlark.operators.routing import REL
from flowlark.plans.ordered import first_rows, order_key, rank_rows
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

DUPLICATE_KEY = 11000  # fixed value: error code of a unique-key clash
DEFAULT_BATCH = 50  # fixed value: rows per bulk write

Stage = Callable[[DataFrame], DataFrame]


def doc_eq(df: DataFrame, column: str, value) -> Column:
    """Equality that also matches an element of an array field."""
    if df.schema[column].dataType.typeName() == "array":
        return F.array_contains(F.col(column), value)
    return F.col(column) == value


def find(
    requests: DataFrame,
    docs: DataFrame,
    on: dict[str, str],
    project: Sequence[str] | None = None,
    sort: Sequence[Column | str] = (),
    limit: int | None = None,
    request_id: Sequence[str] = (),
) -> DataFrame:
    """Hits of many requests in one equi-join, with the asking row's columns.

    ``on`` maps request columns to document fields; an array field matches by
    element (it is exploded, so the join stays an equi-join). Requests without
    hit go to ``noresult``. ``limit`` needs ``sort`` with a unique last column
    and ``request_id``; only the best rows per task are shuffled for it.
    """
    fields = list(project or [c for c in docs.columns if c not in requests.columns])
    extra = []
    if limit is not None:  # fields that only the sort may need
        extra = [c for c in docs.columns if c not in fields and c not in requests.columns]
    side, keys = docs, {}
    for i, (asked, field) in enumerate(on.items()):
        value = F.col(field)
        if docs.schema[field].dataType.typeName() == "array":
            value = F.explode(F.array_distinct(value))
        keys[f"_doc_{i}"] = asked
        side = side.withColumn(f"_doc_{i}", value)
    for field in on.values():  # a plain condition reaches the files
        side = side.filter(F.col(field).isNotNull())
    side = side.select(*fields, *extra, *keys)
    asking = requests.withColumns({f"_ask_{i}": F.col(a) for i, a in enumerate(on)})
    pairs = {k: f"_ask_{i}" for i, k in enumerate(keys)}
    hits = join_hot(side.dropna(subset=list(keys)), asking, pairs, "inner")
    if limit is not None:
        if not sort or not request_id:
            raise ValueError("limit needs sort and request_id")
        window = Window.partitionBy(*request_id).orderBy(*sort)
        hits = hits.withColumn("_at", F.row_number().over(window)).filter(F.col("_at") <= limit)
    found = hits.select(*requests.columns, *fields, F.lit("success").alias(REL))
    answered = side.select(*keys).distinct()
    missed = join_hot(requests, answered, {a: k for k, a in keys.items()}, "left_anti")
    nothing = [F.lit(None).cast(docs.schema[f].dataType).alias(f) for f in fields]
    return found.unionByName(
        missed.select(*requests.columns, *nothing, F.lit("noresult").alias(REL))
    )


# --- pipelines -------------------------------------------------------------------


def match(condition: Column) -> Stage:
    return lambda d: d.filter(condition)


def project(*columns: Column | str) -> Stage:
    return lambda d: d.select(*columns)


def add_fields(**columns: Column) -> Stage:
    return lambda d: d.withColumns(columns)


def group(by: Sequence[Column | str], **aggs: Column) -> Stage:
    return lambda d: d.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])


def sort(*columns: Column | str) -> Stage:
    return lambda d: d.orderBy(*columns)


def limit(n: int) -> Stage:
    return lambda d: d.limit(n)


def skip(n: int) -> Stage:
    return lambda d: d.offset(n)


def unwind(column: str) -> Stage:
    """One row per array element; rows with an empty or null array go away."""
    return lambda d: d.withColumn(column, F.explode(column))


def lookup(other: DataFrame, local: str, foreign: str, how: str = "left") -> Stage:
    """Join another table by field; Spark picks the strategy."""
    return lambda d: d.join(other, F.col(local) == other[foreign], how)


def count(name: str = "count") -> Stage:
    return lambda d: d.agg(F.count(F.lit(1)).alias(name))


def aggregate(docs: DataFrame, stages: Sequence[Stage], out: str | None = None) -> DataFrame | None:
    """Apply the stages in order; with ``out`` replace that table instead."""
    for stage in stages:
        docs = docs.transform(stage)
    if out is None:
        return docs
    docs.write.mode("overwrite").parquet(out)
    return None


# --- insert -----------------------------------------------------------------------


def insert(
    docs: DataFrame,
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    ordered: bool = False,
    batch_size: int = DEFAULT_BATCH,
    payload: str | None = None,
) -> DataFrame:
    """Route rows by whether an insert under a unique key would take them.

    Bad JSON in ``payload`` is ``failure`` and not part of the write. A key
    that exists, or was written by an earlier row, is ``failure`` with its
    error code. With ``ordered`` the first failed write of a batch also fails
    the rest of that batch, whose keys stay free.
    """
    good = F.lit(True)
    if payload is not None:
        good = F.coalesce(F.try_parse_json(F.col(payload)).isNotNull(), F.lit(False))
    marked = rows.withColumn("_good", good)
    taken = docs.select(F.col(key).alias("_taken")).distinct()
    if ordered:
        return _insert_ordered(marked, taken, key, order, batch_size)
    usable = marked.filter(F.col("_good") & F.col(key).isNotNull()).select(key, *order)
    firsts = first_rows(usable, [key], order)
    new = firsts.join(taken, firsts[key] == taken["_taken"], "left_anti").select(
        *[F.col(c).alias(f"_first_{c}") for c in order], F.lit(True).alias("_new")
    )
    same = [F.col(c) == F.col(f"_first_{c}") for c in order]
    joined = marked.join(new, same, "left")
    wins = F.coalesce(F.col("_new"), F.lit(False)) | F.col(key).isNull()
    code = F.when(F.col("_good") & ~wins, F.lit(DUPLICATE_KEY))
    out = joined.withColumns(
        {
            "error_code": code,
            REL: F.when(F.col("_good") & wins, "success").otherwise("failure"),
        }
    )
    return out.drop("_good", "_new", *[f"_first_{c}" for c in order])


def _insert_ordered(marked, taken, key, order, batch_size) -> DataFrame:
    """Find the first failed position of every batch.

    Whether a row fails depends on which earlier rows were written, which depends on
    where earlier batches stopped. Only rows whose key repeats or is taken are looked at.
    """
    marked = marked.drop("error_code", REL)
    narrow = marked.select(*dict.fromkeys([*order, key, "_good"]))
    ranked = rank_rows(narrow, [], order, "_pos", keep=[key, "_good"])
    batch = F.call_function("div", F.col("_pos") - 1, F.lit(batch_size)).cast("long")
    ranked = materialize(ranked.withColumn("_batch", batch))
    tries = ranked.filter(F.col("_good") & F.col(key).isNotNull()).select(
        F.col(key).alias("_k"), "_pos", "_batch"
    )
    repeated = tries.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    status = repeated.join(taken, F.col("_k") == F.col("_taken"), "left").select(
        "_k", F.col("_taken").isNotNull().alias("_exists"), "_n"
    )
    contested = materialize(
        join_hot(tries, status.filter("_n > 1 or _exists"), {"_k": "_k"}, "inner").drop("_n")
    )
    joined = ranked.join(_stops(contested), "_batch", "left")
    stop = F.coalesce("_stop", F.lit(NEVER))
    written = F.col("_good") & (F.col("_pos") < stop)
    code = F.when(F.col("_good") & (F.col("_pos") == stop), F.lit(DUPLICATE_KEY))
    routed = joined.select(
        *[F.col(c).alias(f"_at_{c}") for c in order],
        code.alias("error_code"),
        F.when(written, "success").otherwise("failure").alias(REL),
    )
    out = join_hot(marked, routed, {c: f"_at_{c}" for c in order}, "left", null_safe=True)
    return out.drop("_good")


NEVER = 2**62


def _stops(contested: DataFrame) -> DataFrame:
    """First failed position (null: none) of each batch with contested rows.

    A row whose key exists, or came before in its own batch, is a limit that its batch
    cannot pass. Of the rows before the limits, each key's first one is written if its
    batch comes that far; any other one, a candidate, fails if an earlier one is written.
    In each round

    * batches without candidates are settled; so is what comes before the first candidate
      of the others, and all of it limits later rows with its keys;
    * a first candidate with one earlier row is decided by the first candidate of that
      row's batch: one fails where the other does not. These links form chains, and
      pointers that double carry the answer along a chain of any length in as many joins
      as its logarithm.

    The earliest batch never has candidates, so every round settles some.
    """
    nth = Window.partitionBy("_k", "_batch").orderBy("_pos")  # rows of one batch
    rows = contested.withColumn("_nth", F.row_number().over(nth))
    limits = rows.groupBy("_batch").agg(F.min(F.when(F.col("_exists") | (F.col("_nth") == 2), F.col("_pos"))).alias("_stop"))
    heads = rows.filter("_nth = 1 and not _exists").select("_k", "_pos", "_batch")
    limits = materialize(limits)
    live, held, settled = materialize(heads), None, []
    while True:
        marked = materialize(_candidates(_before_limits(live, limits)))
        firsts = marked.groupBy("_batch").agg(
            # Candidates of one batch, no more than its rows.
            F.slice(F.array_sort(F.collect_list(F.when(F.col("_pos") > F.col("_pos1"), F.col("_pos")))), 1, 2).alias("_c")
        )
        batches = limits.join(firsts, "_batch", "left").select(
            "_batch", "_stop", F.get("_c", F.lit(0)).alias("_c1"), F.get("_c", F.lit(1)).alias("_c2")
        )
        batches = materialize(batches)
        settled.append(batches.filter("_c1 is null").select("_batch", "_stop"))
        open_ = batches.filter("_c1 is not null")
        if open_.isEmpty():
            return reduce(lambda x, y: x.unionByName(y), settled)
        fails = _decided(marked, batches)
        ended = fails.filter("_fails").select("_batch")
        again = open_.join(ended, "_batch", "left_anti").select("_batch", "_stop")
        settled.append(open_.join(ended, "_batch").select("_batch", F.col("_c1").alias("_stop")))
        # Rows that are surely written, by key: all before the first open candidate.
        passed = fails.filter("not _fails").select("_batch", F.lit(True).alias("_passed"))
        placed = marked.join(batches.select("_batch", "_c1", "_c2"), "_batch").join(passed, "_batch", "left")
        until = F.when(F.col("_passed"), F.coalesce("_c2", F.lit(NEVER))).otherwise(F.coalesce("_c1", F.lit(NEVER)))
        written = placed.filter(F.col("_pos") < until).select("_k", "_pos")
        held = written if held is None else held.unionByName(written)
        held = materialize(held.groupBy("_k").agg(F.min("_pos").alias("_pos")))
        waiting = placed.filter(F.col("_c1").isNotNull()).join(ended, "_batch", "left_anti")
        waiting = waiting.select("_k", "_pos", "_batch", (F.col("_pos") < until).alias("_sure"))
        since = held.select(F.col("_k").alias("_hk"), F.col("_pos").alias("_since"))
        waiting = join_hot(waiting, since, {"_k": "_hk"})
        clash = F.coalesce(F.col("_since") < F.col("_pos"), F.lit(False))
        hits = waiting.groupBy("_batch").agg(F.min(F.when(clash, F.col("_pos"))).alias("_hit"))
        limits = materialize(
            again.join(hits, "_batch", "left").select("_batch", F.least("_stop", "_hit").alias("_stop"))
        )
        if limits.isEmpty():
            return reduce(lambda x, y: x.unionByName(y), settled)
        live = waiting.filter("not _sure").select("_k", "_pos", "_batch")


def _before_limits(live: DataFrame, limits: DataFrame) -> DataFrame:
    near = live.join(limits, "_batch")
    return near.filter(F.col("_pos") < F.coalesce("_stop", F.lit(NEVER))).select("_k", "_pos", "_batch")


def _candidates(live: DataFrame) -> DataFrame:
    """Rows with the first row of their key, and whether it is the only one before them."""
    first = live.groupBy("_k").agg(F.min(F.struct("_pos", "_batch")).alias("_1"))
    first = first.select(F.col("_k").alias("_k1"), F.col("_1._pos").alias("_pos1"), F.col("_1._batch").alias("_batch1"))
    near = join_hot(live, first, {"_k": "_k1"})
    second = near.filter("_pos > _pos1").groupBy(F.col("_k").alias("_k2")).agg(F.min("_pos").alias("_pos2"))
    return join_hot(near, second, {"_k": "_k2"}).withColumn(
        "_only", F.coalesce(F.col("_pos") == F.col("_pos2"), F.lit(False))
    )


def _decided(marked: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches of which is known whether their first candidate fails, with ``_fails``."""
    first = marked.join(batches.select("_batch", "_c1"), "_batch").filter("_pos = _c1")
    over = batches.select(F.col("_batch").alias("_batch1"), F.col("_c1").alias("_d1"), F.col("_c2").alias("_d2"))
    sure = F.coalesce(F.col("_pos1") < F.col("_d1"), F.lit(True))
    alone = F.col("_only") & F.coalesce(F.col("_pos1") < F.col("_d2"), F.lit(True))
    links = first.join(over, "_batch1").filter(sure | alone).select(
        "_batch", F.when(~sure, F.col("_batch1")).alias("_to"),
        F.lit(True).alias("_turned"), F.when(sure, True).alias("_fails"),
    )
    links = materialize(links)
    while not links.filter("_to is not null").isEmpty():
        there = links.select(
            F.col("_batch").alias("_to"), F.col("_to").alias("_far"), F.col("_turned").alias("_more"),
            F.col("_fails").alias("_there"),
        )
        # Links to batches that neither are known nor point on are left open.
        near = links.filter("_to is not null").join(there, "_to")
        turned = F.col("_turned") != F.coalesce("_more", F.lit(False))
        moved = near.select(
            "_batch", F.col("_far").alias("_to"),
            F.when(F.col("_there").isNull(), turned).alias("_turned"),
            (F.col("_there") != F.col("_turned")).alias("_fails"),
        )
        links = materialize(links.filter("_to is null").unionByName(moved))
    return links.select("_batch", "_fails")


# --- update and delete ----------------------------------------------------------------

SET, UNSET, PUSH, ADD_TO_SET = "set", "unset", "push", "add_to_set"


def route_updates(updates: DataFrame, on: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """``failure`` for updates without query value or anything to set."""
    queried = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    usable = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in sets])
    return updates.withColumn(REL, F.when(queried & usable, "success").otherwise("failure"))


def update_many(
    docs: DataFrame,
    updates: DataFrame,
    on: dict[str, str],
    sets: dict[str, str],
    order: Sequence[str],
    op: str = SET,
    upsert: bool = False,
) -> DataFrame:
    """The document table after all updates.

    ``on`` maps document keys to update columns, ``sets`` document fields to
    update columns. Updates are reduced to one row per key before the join
    (the last value per field by ``order``; null values are skipped), so
    neither many updates nor many documents of one key meet in pairs.
    """
    at = order_key(order)
    if op == SET:
        reduced = {f: F.max_by(c, F.when(F.col(c).isNotNull(), at)) for f, c in sets.items()}
    elif op == UNSET:
        reduced = {f: F.lit(None) for f in sets}
    elif op == ADD_TO_SET:
        reduced = {f: F.sort_array(F.collect_set(c)) for f, c in sets.items()}
    elif op == PUSH:
        pair = {
            f: F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.col(c).alias("value")))
            for f, c in sets.items()
        }
        reduced = {
            f: F.transform(F.sort_array(F.collect_list(p)), lambda e: e["value"])
            for f, p in pair.items()
        }
    else:
        raise ValueError(f"unknown update operator: {op}")
    usable = route_updates(updates, list(on.values()), list(sets.values())).filter(
        F.col(REL) == "success"
    )
    keys = {k: f"_u_{k}" for k in on}
    last = usable.groupBy(*[F.col(c).alias(keys[k]) for k, c in on.items()]).agg(
        *[c.alias(f"_set_{f}") for f, c in reduced.items()], F.lit(True).alias("_touched")
    )
    joined = join_hot(docs, last, keys)
    if upsert:  # updates without document become new ones
        held = docs.select(*[F.col(k).alias(f"_h_{k}") for k in on]).distinct()
        new = join_hot(last, held, {keys[k]: f"_h_{k}" for k in on}, "left_anti")
        empty = [F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns if c not in on]
        rows = new.select(*[F.col(keys[k]).alias(k) for k in on], *empty, *new.columns)
        joined = joined.unionByName(rows.drop(*keys.values()))
    touched = F.coalesce(F.col("_touched"), F.lit(False))
    out = []
    for c in docs.columns:
        new = F.col(f"_set_{c}") if c in sets else None
        if new is None:
            value = F.col(c)
        elif op == SET:
            value = F.coalesce(new, F.col(c))
        elif op == UNSET:
            value = F.when(~touched, F.col(c))
        else:
            old = F.coalesce(F.col(c), F.array().cast(docs.schema[c].dataType))
            joined_list = F.array_union(old, new) if op == ADD_TO_SET else F.concat(old, new)
            value = F.when(touched, joined_list).otherwise(F.col(c))
        out.append(value.alias(c))
    return joined.select(*out)


def delete_many(docs: DataFrame, requests: DataFrame, on: dict[str, str]) -> DataFrame:
    """Documents that no request matches; a null key matches a null field."""
    gone = requests.select(*on.values()).distinct()
    return join_hot(docs, gone, on, "left_anti", null_safe=True)


def expire(docs: DataFrame, ts: str, seconds: int, as_of: Column) -> DataFrame:
    """Documents younger than ``seconds``; without a time they stay.

    The limit is moved to the constant side so the scan can filter on ``ts``.
    """
    kind = docs.schema[ts].dataType
    limit_at = (as_of.cast("timestamp") - F.expr(f"interval {seconds} seconds")).cast(kind)
    return docs.filter(F.col(ts).isNull() | (F.col(ts) > limit_at))


def violations(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number."""
    return docs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
