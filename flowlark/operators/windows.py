"""Tumbling windows, batch completion and hold-back."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlark.functions.numbers import double_of, long_of
from flowlark.functions.times import as_timestamp, micros
from flowlark.operators.routing import REL, route_copies
from flowlark.plans.folds import AnchoredFold, CounterFold
from flowlark.plans.ordered import fold_rows, order_key, running
from flowlark.plans.skew import join_hot

# Interval units in microseconds.
UNIT_MICROS = {
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def interval_micros(text: str) -> int:
    """Microseconds of a text such as ``6 hours``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not match or match.group(2) not in UNIT_MICROS:
        raise ValueError(f"not an interval: {text!r}")
    return int(match.group(1)) * UNIT_MICROS[match.group(2)]


def tumbling(
    df: DataFrame,
    value: str | Column,
    ts: str | Column,
    width: str,
    by: Sequence[str] = (),
    watermark: str | None = None,
) -> DataFrame:
    """Sum and count per key and epoch-aligned window; on a stream, append."""
    rows = df.select(*by, as_timestamp(ts).alias("_ts"), double_of(df, value).alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull())
    if watermark:
        rows = rows.withWatermark("_ts", watermark)
    sums = rows.groupBy(F.window("_ts", width).alias("w"), *by).agg(
        F.sum("_v").alias("window_sum"), F.count("_v").alias("window_count")
    )
    return sums.select(F.col("w.start").alias("window_start"), *by, "window_sum", "window_count")


def running_tumbling(
    df: DataFrame,
    value: str | Column,
    ts: str,
    width: str,
    by: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Each record with the sum and count of its window so far.

    Records without a usable value or time go to ``failure`` and are not counted.
    """
    at = micros(F.col(ts))
    start = F.timestamp_micros(at - F.pmod(at, F.lit(interval_micros(width))))
    rows = df.withColumns({"_v": double_of(df, value), "window_start": start})
    good = F.col("_v").isNotNull() & F.col(ts).isNotNull()
    out = running(
        rows.withColumn("_one", good.cast("long")),
        [*by, "window_start"],
        [ts, *order],
        sums={"window_sum": F.coalesce(F.col("_v"), F.lit(0.0)), "window_count": "_one"},
        keep=["_v", "_one", *_named(value)],
    )
    return out.withColumns(
        {
            REL: F.when(good, "success").otherwise("failure"),
            "window_sum": F.when(good, F.col("window_sum")),
            "window_count": F.when(good, F.col("window_count")),
        }
    ).drop("_v", "_one")


def anchored_tumbling(
    df: DataFrame,
    value: str | Column,
    ts: str,
    width: str,
    by: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Windows per key that start at a record instead of at the clock.

    A record that finds the window over carries the closed totals, goes to
    ``success`` and ``elapsed``, and its value opens the next window. Records
    without a usable value or time go to ``failure`` and touch nothing.
    """
    timed = F.when(F.col(ts).isNotNull(), double_of(df, value))
    rows = df.withColumns({"_t": micros(F.col(ts)), "_v": timed})
    folded = fold_rows(
        rows.filter(F.col("_v").isNotNull()),
        by,
        ["_t", *order],
        ["_t", "_v"],
        [
            T.StructField("window_sum", T.DoubleType()),
            T.StructField("window_count", T.LongType()),
            T.StructField("_elapsed", T.BooleanType()),
        ],
        AnchoredFold(interval_micros(width)),
        keep=[ts, *_named(value)],
    )
    failed = rows.filter(F.col("_v").isNull()).withColumns(
        {
            "window_sum": F.lit(None).cast("double"),
            "window_count": F.lit(None).cast("long"),
            "_elapsed": F.lit(False),
        }
    )
    return route_windows(folded.unionByName(failed))


def _named(value: str | Column) -> list[str]:
    """The column that is read, where it is one."""
    return [value] if isinstance(value, str) else []


def route_windows(out: DataFrame) -> DataFrame:
    """Outputs of folded window rows."""
    good = F.col("_v").isNotNull()
    routed = route_copies(out, {"failure": ~good, "success": good, "elapsed": F.col("_elapsed")})
    return routed.drop("_t", "_v", "_elapsed")


# --- batches ---------------------------------------------------------------------


def fragments(df: DataFrame, frag_id: str, frag_count: str) -> DataFrame:
    counted = long_of(df, frag_count)
    return df.withColumns(
        {
            "_want": counted,
            "_ok": F.col(frag_id).isNotNull() & counted.isNotNull(),
        }
    )


def batch_wait(
    df: DataFrame,
    frag_id: str,
    frag_count: str,
    order: Sequence[str],
) -> DataFrame:
    """Route records by completion of their batch.

    Every record goes to ``original``; the one that completes its batch also to
    ``batch-completed`` and the count starts again; one without id or whole
    expected count also to ``failure``.
    """
    rows = fragments(df, frag_id, frag_count)
    good = rows.filter("_ok")
    marked = fold_rows(
        good,
        [frag_id],
        order,
        ["_want", "_ok"],
        [T.StructField("_done", T.BooleanType())],
        CounterFold(),
        keep=[frag_count],
    )
    # Rows without an id or count never enter the ordering.
    failed = rows.filter(~F.col("_ok")).withColumn("_done", F.lit(False))
    return route_batch(marked.unionByName(failed), F.col("_done"))


def route_batch(marked: DataFrame, done: Column) -> DataFrame:
    """Outputs of counted batch rows."""
    routes = {"original": F.lit(True), "batch-completed": done, "failure": ~F.col("_ok")}
    return route_copies(marked, routes).drop("_want", "_ok", "_done")


def batch_pending(
    df: DataFrame, frag_id: str, frag_count: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Ids whose last batch is not complete, with the records waiting.

    With one expected count per id this is a plain aggregate. ``order`` is
    needed only where the count changes within an id.
    """
    rows = fragments(df, frag_id, frag_count).filter("_ok")
    if order is None:
        counts = rows.groupBy(frag_id).agg(
            F.count(F.lit(1)).alias("n"), F.max("_want").alias("expected")
        )
        left = F.when(F.col("expected") > 0, F.pmod("n", "expected")).otherwise(F.col("n"))
        return counts.select(frag_id, "expected", left.alias("waiting")).filter("waiting > 0")
    done = batch_wait(df, frag_id, frag_count, order)
    # Rows after the last completed one, per id: all partial aggregates.
    key = order_key(order)
    last = (
        done.filter(F.col(REL) == "batch-completed")
        .groupBy(frag_id)
        .agg(F.max(key).alias("_last"))
    )
    open_rows = join_hot(rows, last, {frag_id: frag_id}).filter(
        F.col("_last").isNull() | (key > F.col("_last"))
    )
    return open_rows.groupBy(frag_id).agg(
        F.max_by("_want", key).alias("expected"), F.count(F.lit(1)).alias("waiting")
    )


def release_ready(
    df: DataFrame, seen_at: str | Column, delay_ms: str | Column, as_of: Column
) -> DataFrame:
    """``success`` once a record's own delay has passed, else ``held``.

    Without a readable time and delay a record goes to ``failure``.
    """
    seen = as_timestamp(seen_at)
    delay = (F.col(delay_ms) if isinstance(delay_ms, str) else delay_ms).try_cast("bigint")
    due = F.try_add(F.unix_micros(seen), F.try_multiply(delay, F.lit(1000).cast("bigint")))
    ready = due <= F.unix_micros(as_timestamp(as_of))
    return df.withColumn(
        REL, F.when(due.isNull(), "failure").when(ready, "success").otherwise("held")
    )
