"""De-duplication and key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlark.functions.numbers import is_blank
from flowlark.functions.times import micros
from flowlark.operators.routing import REL
from flowlark.operators.windows import interval_micros
from flowlark.plans.folds import AgeOffFold
from flowlark.plans.ordered import first_rows, fold_rows
from flowlark.plans.skew import join_hot


def identify_duplicates(
    df: DataFrame,
    key: str | Column,
    order: Sequence[str],
    ttl: str | None = None,
    ts: str | None = None,
) -> DataFrame:
    """Route to ``non-duplicate``, ``duplicate`` or, without a key, ``failure``.

    ``order`` must identify a row. With ``ttl`` a key is forgotten that long
    after it was accepted; duplicates do not refresh it.
    """
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    if ttl is None:
        return _identify_forever(df, text, order)
    keyed = df.withColumns(
        {"_key": F.when(~is_blank(text) & F.col(ts).isNotNull(), text), "_t": micros(F.col(ts))}
    )
    good = F.col("_key").isNotNull()
    marked = fold_rows(
        keyed.filter(good),
        ["_key"],
        ["_t", *order],
        ["_t"],
        [T.StructField("_fresh", T.BooleanType())],
        AgeOffFold(interval_micros(ttl)),
        keep=[ts, *([key] if isinstance(key, str) else [])],
    )
    rel = F.when(F.col("_fresh"), "non-duplicate").otherwise("duplicate")
    failed = keyed.filter(~good).withColumn(REL, F.lit("failure"))
    out = marked.withColumn(REL, rel).drop("_fresh").unionByName(failed)
    return out.drop("_key", "_t")


def _identify_forever(df: DataFrame, text: Column, order: Sequence[str]) -> DataFrame:
    """First row per key by a pre-combined minimum, joined back on row identity.

    Keys are grouped by their SHA-256, so long texts are not shuffled. No task
    ever sees all rows of a key: the aggregate combines before its shuffle and
    the join runs on the unique order columns.
    """
    keys = df.select(F.unhex(F.sha2(text, 256)).alias("_key"), is_blank(text).alias("_blank"), *order)
    keys = keys.filter(~F.col("_blank")).drop("_blank")
    firsts = first_rows(keys, ["_key"], order).select(
        *[F.col(c).alias(f"_first_{c}") for c in order], F.lit(True).alias("_fresh")
    )
    same = [F.col(c) == F.col(f"_first_{c}") for c in order]
    rel = (
        F.when(F.col("_blank"), "failure")
        .when(F.col("_fresh"), "non-duplicate")
        .otherwise("duplicate")
    )
    rows = df.withColumn("_blank", is_blank(text))
    joined = rows.join(firsts, same, "left").withColumn(REL, rel)
    return joined.drop("_fresh", "_blank", *[f"_first_{c}" for c in order])


def add_if_absent(
    keys: DataFrame, seen: DataFrame, key: str, order: Sequence[str], seen_key: str | None = None
) -> DataFrame:
    """Each key row with ``added``: true when neither seen nor earlier in here.

    Distinct keys are formed first, so the join to the seen set has one row per
    key on both sides and no hot key.
    """
    known = seen.select(F.col(seen_key or key).alias("_seen")).distinct()
    usable = keys.select(key, *order).filter(~is_blank(key))
    firsts = first_rows(usable, [key], order)
    new = firsts.join(known, firsts[key] == known["_seen"], "left_anti").select(
        *[F.col(c).alias(f"_first_{c}") for c in order], F.lit(True).alias("_new")
    )
    same = [F.col(c) == F.col(f"_first_{c}") for c in order]
    flagged = keys.join(new, same, "left").withColumn(
        "added", F.coalesce(F.col("_new"), F.lit(False))
    )
    return flagged.drop("_new", *[f"_first_{c}" for c in order])


def updated_set(seen: DataFrame, flagged: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """The seen set after ``add_if_absent``."""
    name = seen_key or key
    new = flagged.filter("added").select(F.col(key).alias(name))
    return seen.select(name).unionByName(new)


def contains(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """Each row with ``contained``; the seen side is unique, so rows stay as they are."""
    known = seen.select(
        F.col(seen_key or key).alias("_seen"), F.lit(True).alias("_hit")
    ).distinct()
    joined = join_hot(df, known, {key: "_seen"})
    return joined.withColumn("contained", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def remove_all(seen: DataFrame) -> DataFrame:
    """The empty key set."""
    return seen.filter(F.lit(False))


def remove_keys(seen: DataFrame, keys: DataFrame, key: str, drop_key: str | None = None) -> DataFrame:
    """The seen set without the given keys."""
    gone = keys.select(F.col(drop_key or key).alias("_gone")).distinct()
    return join_hot(seen, gone, {key: "_gone"}, "left_anti")
