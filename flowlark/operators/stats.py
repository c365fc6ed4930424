"""Statistics per correlation key.

All of them are partial aggregates: each task reduces its rows to one state
per key before anything is shuffled, so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.functions.numbers import double_of
from flowlark.functions.times import as_timestamp
from flowlark.plans.skew import join_hot

KEY = "key"
VALUE = "_value"
STATS = ("count", "sum", "min", "max", "mean", "stddev")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def correlation_key(by: str | Column | None) -> Column:
    """Group key as text; the empty key when unset or missing."""
    if by is None:
        return F.lit("")
    return F.coalesce(_col(by).cast("string"), F.lit(""))


def _six(value: str) -> list[Column]:
    return [
        F.count(value).alias("count"),
        F.sum(value).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.avg(value).alias("mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stddev"),
    ]


def moments(df: DataFrame, value: str | Column, by: str | Column | None = None) -> DataFrame:
    """Count, sum, min, max, mean and sample deviation per key.

    Values that are no numbers are skipped; a key without any gives no row.
    """
    rows = df.select(correlation_key(by).alias(KEY), double_of(df, value).alias(VALUE))
    return rows.filter(F.col(VALUE).isNotNull()).groupBy(KEY).agg(*_six(VALUE))


def bytes_stats(df: DataFrame, content: str | Column, by: str | Column | None = None) -> DataFrame:
    """Statistics over the size of the content."""
    sized = moments(df, F.octet_length(_col(content)), by)
    return sized.withColumn("units", F.lit("Bytes"))


def latency_stats(
    df: DataFrame, event_time: str | Column, as_of: Column, by: str | Column | None = None
) -> DataFrame:
    """Statistics over the age of each record in seconds, to the millisecond.

    The event time is a timestamp, or epoch milliseconds as number or text;
    records without a usable one are skipped.
    """
    column = _col(event_time)
    kind = df.select(column.alias("t")).schema["t"].dataType.typeName()
    if kind.startswith("timestamp"):
        event = F.unix_millis(as_timestamp(column))
    else:
        text = column.cast("string")
        event = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    age = F.try_subtract(F.unix_millis(as_timestamp(as_of)), event) / F.lit(1000.0)
    return moments(df, age, by).withColumn("units", F.lit("Seconds"))


def volume_stats(df: DataFrame, by: str | Column | None = None) -> DataFrame:
    """Number of records per key."""
    rows = df.select(correlation_key(by).alias(KEY))
    counted = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("sum", F.col("count"))


# --- states that can be stored and merged -----------------------------------------


def moment_state(df: DataFrame, value: str | Column, by: dict[str, Column]) -> DataFrame:
    """One mergeable state (n, mean, m2, sum, min, max) per key."""
    rows = df.select(*[c.alias(n) for n, c in by.items()], double_of(df, value).alias(VALUE))
    states = rows.filter(F.col(VALUE).isNotNull()).groupBy(*by)
    return states.agg(
        F.count(VALUE).alias("n"),
        F.avg(VALUE).alias("mean"),
        (F.var_pop(VALUE) * F.count(VALUE)).alias("m2"),
        F.sum(VALUE).alias("sum"),
        F.min(VALUE).alias("min"),
        F.max(VALUE).alias("max"),
    )


def merge_moments(states: DataFrame, by: dict[str, Column]) -> DataFrame:
    """Combine states into coarser keys without the rows behind them.

    The common mean comes first; then each part's squared deviations are moved
    to it, m2 + n * (mean - common)^2, which does not cancel for large means.
    """
    named = states.select(
        *[c.alias(k) for k, c in by.items()], "n", "mean", "m2", "sum", "min", "max"
    )
    totals = named.groupBy(*by).agg(
        F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean")
    )
    keys = list(by)
    joined = join_hot(named, totals, {k: k for k in keys}, "inner", null_safe=True)
    shift = F.col("mean") - F.col("_mean")
    return joined.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).alias("m2"),
        F.sum("sum").alias("sum"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
    )


def finish_moments(states: DataFrame) -> DataFrame:
    """The six statistics of stored states."""
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).otherwise(F.lit(0.0))
    return states.withColumn("stddev", spread).withColumnRenamed("n", "count").drop("m2")


# --- reports per interval -----------------------------------------------------------


def interval_moments(
    df: DataFrame,
    value: str | Column,
    ts: str | Column,
    interval: str,
    by: str | Column | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """The six statistics per key and interval of event time.

    On a stream give ``watermark``: an interval is reported once, when it is
    complete, and later rows for it are dropped by Spark.
    """
    rows = df.select(
        as_timestamp(ts).alias("_ts"),
        correlation_key(by).alias(KEY),
        double_of(df, value).alias(VALUE),
    ).filter(F.col(VALUE).isNotNull())
    if watermark:
        rows = rows.withWatermark("_ts", watermark)
    report = rows.groupBy(F.window("_ts", interval).alias("w"), KEY).agg(*_six(VALUE))
    return report.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), KEY, *STATS
    )


def with_stats(
    df: DataFrame, value: str | Column, by: str | Column | None = None, prefix: str = ""
) -> DataFrame:
    """Every input row with the key and statistics it belongs to.

    The statistics are aggregated first (combining before the shuffle) and then
    joined back, so rows of a hot key are not gathered. ``prefix`` keeps the
    added columns apart from those of the input.
    """
    names = {c: f"{prefix}{c}" for c in (KEY, *STATS)}
    taken = sorted(set(names.values()) & set(df.columns))
    if taken:
        raise ValueError(f"give a prefix, the input has {taken}")
    keyed = df.withColumn(names[KEY], correlation_key(by))
    stats = moments(df, value, by).withColumnsRenamed(names)
    if by is None:
        return keyed.join(F.broadcast(stats), names[KEY], "left")  # one row without keys
    return join_hot(keyed, stats, {names[KEY]: names[KEY]})
