"""Routing: one ``_rel`` column names the output of each row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.functions.numbers import double_of, long_of
from flowlark.plans.ordered import rank_rows

REL = "_rel"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def route_copies(df: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """One copy of each row per output whose condition holds.

    The source is read once; the copies stay inside generated code.
    """
    names = F.array(*[F.when(hit, F.lit(name)) for name, hit in routes.items()])
    return df.withColumn(REL, F.explode(names)).filter(F.col(REL).isNotNull())


def route_bitmask(
    df: DataFrame, value: str | Column, masks: dict[str, int], flip: bool = False
) -> DataFrame:
    """One copy per mask whose bits are all set in the value.

    No mask set: ``unmatched``; value that is no whole number: ``failure``.
    ``routed_value`` is the value, with all matched bits flipped if asked.
    """
    number = long_of(df, value)
    hits = {name: number.bitwiseAND(F.lit(m).cast("long")) == m for name, m in masks.items()}
    matched_any = reduce(lambda a, b: a | b, hits.values(), F.lit(False))
    routes = {**hits, "unmatched": ~matched_any & number.isNotNull(), "failure": number.isNull()}
    result = number
    if flip:
        matched = reduce(
            lambda a, b: a.bitwiseOR(b),
            [
                F.when(hits[name], F.lit(m)).otherwise(F.lit(0)).cast("long")
                for name, m in masks.items()
            ],
        )
        result = number.bitwiseXOR(matched)
    return route_copies(df.withColumn("routed_value", result), routes)


def split_percent(
    df: DataFrame, percent: int, order: Sequence[str]
) -> DataFrame:
    """First ``percent`` of every hundred rows to ``a``, the rest to ``b``."""
    if percent <= 0 or percent >= 100:
        return df.withColumn(REL, F.lit("a" if percent >= 100 else "b"))
    ranked = rank_rows(df, [], order, "_rank")
    first = F.pmod(F.col("_rank") - 1, F.lit(100)) < percent
    return ranked.withColumn(REL, F.when(first, "a").otherwise("b")).drop("_rank")


def retry_gate(
    df: DataFrame,
    while_: Column,
    next_: Column,
    counter: str = "retry_counter",
    on_exceeded: dict[str, Column] | None = None,
    as_of: Column | None = None,
    penalty: str | None = "2 seconds",
) -> DataFrame:
    """Count a record's attempts while a condition on the counter holds.

    ``while_`` and ``next_`` see the counter with a missing one as 0. Retried
    rows get ``not_before`` when a penalty is set; others the extra columns.
    """
    rows = df.withColumn(counter, F.coalesce(long_of(df, counter), F.lit(0).cast("long")))
    rows = rows.withColumn("_again", F.coalesce(while_, F.lit(False)))
    again = F.col("_again")
    extra = {
        name: F.when(~again, value) for name, value in (on_exceeded or {}).items()
    }
    if penalty:
        now = as_of if as_of is not None else F.current_timestamp()
        extra["not_before"] = F.when(again, now.cast("timestamp") + F.expr(f"interval {penalty}"))
    out = rows.withColumns(
        {
            **extra,
            counter: F.when(again, next_.cast("long")).otherwise(F.col(counter)),
            REL: F.when(again, "retry").otherwise("conditional-violated"),
        }
    )
    return out.drop("_again")


def route_parse(df: DataFrame, value: str | Column, kind: str = "double") -> DataFrame:
    """``success`` with ``parsed`` where the text is a number, else ``failure``."""
    parsed = long_of(df, value) if kind in ("long", "bigint") else double_of(df, value)
    return df.withColumn("parsed", parsed).withColumn(
        REL, F.when(F.col("parsed").isNotNull(), "success").otherwise("failure")
    )


def csv_names(csv: str | None) -> list[str] | None:
    """Trimmed, non-empty, unique names; None when unset."""
    if csv is None:
        return None
    return list(dict.fromkeys(n for n in (part.strip() for part in csv.split(",")) if n))


def select_named(df: DataFrame, csv: str | None, columns: Sequence[str]) -> DataFrame:
    """Rows whose name or id is listed; unset keeps all, empty keeps none."""
    names = csv_names(csv)
    if names is None:
        return df
    listed = [F.col(c).cast("string").isin(names) for c in columns]
    return df.filter(reduce(lambda a, b: a | b, listed) if names else F.lit(False))


def route_empty(df: DataFrame, content: str | Column, reject: bool = True) -> DataFrame:
    """Rows with empty content go to ``reject``."""
    size = F.coalesce(F.octet_length(_col(content)), F.lit(0))
    empty = (size == 0) & F.lit(reject)
    return df.withColumn(REL, F.when(empty, "reject").otherwise("success"))


def split_routes(df: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per output; persist the routed frame if several are used."""
    return {name: df.filter(F.col(REL) == name).drop(REL) for name in names}
