"""Time-series points: building, line text and series queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlark.functions.tags import parse_tags
from flowlark.functions.times import as_timestamp, to_time
from flowlark.operators.project import field_map
from flowlark.operators.routing import REL
from flowlark.plans.ordered import rank_rows


def to_points(
    df: DataFrame,
    measurement: Column,
    tags: Column,
    fields: dict[str, Column],
    ts: Column | None = None,
    precision: str = "MILLISECONDS",
    strict_tags: bool = True,
    now: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One point per record: measurement, tags, fields, time and ``_rel``.

    A record without any finite field, with a bad time, with bad tag text in the
    strict form, without a measurement, or with a line break in a name or tag gives
    ``failure``. Without ``ts`` the time is one fixed ``now``.
    """
    if ts is not None:
        at = to_time(ts, precision)
    else:
        at = now.cast("timestamp") if now is not None else F.current_timestamp()
    points = df.select(
        *keep,
        measurement.alias("measurement"),
        parse_tags(tags, strict_tags).alias("tags"),
        field_map(df, fields).alias("fields"),
        at.alias("time"),
    )
    names = F.concat(F.map_keys("tags"), F.map_values("tags"), F.map_keys("fields"))
    broken = F.exists(F.array_append(names, F.col("measurement")), lambda x: x.rlike(r"[\r\n]"))
    usable = (F.size("fields") > 0) & F.col("tags").isNotNull() & F.col("time").isNotNull()
    named = F.coalesce(F.col("measurement"), F.lit("")) != ""
    usable = usable & named & ~F.coalesce(broken, F.lit(False))
    return points.withColumn(REL, F.when(usable, "success").otherwise("failure"))


def _escape(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, r"\\$1")


def line_text(nanos: bool = True) -> Column:
    """Line-protocol text of a point; tags and fields in name order."""

    def pairs(column: str, render) -> Column:
        entries = F.sort_array(F.map_entries(column))
        return F.array_join(F.transform(entries, render), ",")

    tags = pairs(
        "tags",
        lambda e: F.concat(_escape(e["key"], r"([,= ])"), F.lit("="), _escape(e["value"], r"([,= ])")),
    )
    fields = pairs(
        "fields",
        lambda e: F.concat(_escape(e["key"], r"([,= ])"), F.lit("="), e["value"].cast("string")),
    )
    time = F.unix_micros(F.col("time")).cast("string")
    return F.concat(
        _escape(F.col("measurement"), r"([, ])"),
        F.when(F.size("tags") > 0, F.concat(F.lit(","), tags)).otherwise(""),
        F.lit(" "),
        fields,
        F.lit(" "),
        F.concat(time, F.lit("000")) if nanos else time,
    )


def write_points(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write good points as line text, one folder per measurement.

    The file commit makes the write all-or-nothing.
    """
    good = df.filter(F.col(REL) == "success") if REL in df.columns else df
    lines = good.select("measurement", line_text().alias("value"))
    lines.write.partitionBy("measurement").mode(mode).text(path)


def series_query(
    points: DataFrame,
    measurement: str,
    where: Column | None = None,
    group_tags: Sequence[str] = (),
    every: str | None = None,
    aggs: dict[str, Column] | None = None,
    limit: int | None = None,
    slimit: int | None = None,
) -> DataFrame:
    """Rows of the series of a measurement, in long form.

    One row per series and time with ``series`` (the tag set) and ``position``
    in it. ``aggs`` are aggregates over ``field(name)`` columns, per series and,
    with ``every``, per window. As a guard against whole-table reads one of
    ``where``, ``limit``, ``slimit`` or ``group_tags``/``every`` must be given.
    """
    if where is None and limit is None and slimit is None and not group_tags and not every:
        raise ValueError("give where, limit, slimit, group_tags or every")
    rows = points.filter(F.col("measurement") == measurement)
    if where is not None:
        rows = rows.filter(where)
    names = [f"tag_{t}" for t in group_tags]
    rows = rows.withColumns({n: F.try_element_at("tags", F.lit(t)) for n, t in zip(names, group_tags)})
    if slimit is not None:
        rows = _first_series(rows, names, slimit)
    if aggs:
        keys = list(names)
        if every:
            rows = rows.withColumn("time", F.window(as_timestamp("time"), every)["start"])
            keys.append("time")
        rows = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
        order = ["time"] if every else []
    else:
        fields = F.to_json(F.col("fields"))
        rows = rows.select(*names, "time", fields.alias("values"))
        order = ["time", "values"]
    if not order:
        return rows.withColumn("position", F.lit(1).cast("long"))
    if limit is not None:  # top-k: Spark keeps only k rows per series and task
        window = Window.partitionBy(*names).orderBy(*order)
        return rows.withColumn("position", F.row_number().over(window).cast("long")).filter(
            F.col("position") <= limit
        )
    return rank_rows(rows, names, order, "position")


def _first_series(rows: DataFrame, names: Sequence[str], slimit: int) -> DataFrame:
    """Rows of the first ``slimit`` tag sets in name order."""
    sets = rows.select(*[F.col(n).alias(f"_s_{n}") for n in names]).distinct()
    chosen = sets.orderBy(*sets.columns).limit(slimit)
    same = [F.col(n).eqNullSafe(F.col(f"_s_{n}")) for n in names]
    return rows.join(chosen, same, "left_semi")


def field(name: str) -> Column:
    """Field of a point by name."""
    return F.try_element_at("fields", F.lit(name))


def series_packets(
    series: DataFrame,
    measurement: str,
    names: Sequence[str],
    columns: Sequence[str],
    precision: str = "MILLISECONDS",
    rows: int = 1000,
) -> DataFrame:
    """Nested form: measurement, tags, column names, values and precision.

    A packet holds at most ``rows`` values of one series, in order, so a long
    series is several rows instead of one that grows with the data.
    """
    packet = F.call_function("div", F.col("position") - 1, F.lit(rows))
    values = F.sort_array(F.collect_list(F.struct("position", *columns)))
    packed = series.groupBy(*names, packet.alias("packet")).agg(values.alias("_values"))
    tags = [x for n in names for x in (F.lit(n.removeprefix("tag_")), F.col(n))]
    return packed.select(
        F.lit(measurement).alias("measurement"),
        F.create_map(*tags).cast("map<string,string>").alias("tags"),
        "packet",
        F.array(*[F.lit(c) for c in columns]).alias("columns"),
        F.transform("_values", lambda e: F.struct(*[e[c].alias(c) for c in columns])).alias("values"),
        F.lit(precision).alias("precision"),
    )
