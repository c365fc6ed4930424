"""Order-dependent operators on streams, on typed keyed state.

The folds are those of the batch operators. Rows of one micro-batch are sorted per key
first, so a run over split input gives the batch result as long as records arrive in order
across micro-batches. Micro-batches bound what a task sees of a hot key; set
``maxFilesPerTrigger`` on the source accordingly. Records that fail have no state.

State lives in RocksDB: run these streams through ``streaming.run.drain``, or with
``spark.sql.streaming.stateStore.providerClass`` set to ``streaming.run.ROCKS``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowlark.functions.numbers import double_of, is_blank
from flowlark.functions.times import as_timestamp, micros
from flowlark.operators.routing import REL
from flowlark.operators.windows import (
    fragments,
    interval_micros,
    route_batch,
    route_windows,
)
from flowlark.plans.folds import AgeOffFold, AnchoredFold, CounterFold
from flowlark.plans.ordered import Fold

#: Buckets that the keys of a folded stream are dealt to, and the columns that name them.
BUCKETS = 1024
KEY, BUCKET = "key", "bucket"


class Folding(StatefulProcessor):
    """Folds the rows of a bucket of keys; a key's state is the three numbers of the fold.

    A call of Python, a frame and an output batch are shared by all keys of a bucket; states
    are kept by key, so only those of keys with new rows are read and written. With
    ``forget_after_ms`` a key is dropped once the watermark is that long after the time in
    the first place of its state: one timer of the bucket stands for its next keys, at steps
    of an eighth of that span, and drops all that are due.
    """

    def __init__(self, fold: Fold, order: list[str], inputs: dict, outputs: dict, forget_after_ms: int | None):
        self.fold, self.order, self.inputs, self.outputs = fold, order, inputs, outputs
        self.forget_after_ms = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = handle.getMapState("states", "key string", "a long, s double, n long")
        if self.forget_after_ms is not None:
            self.next = handle.getValueState("next", "due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        pdf = parts[0] if len(parts) == 1 else pd.concat(parts)
        codes, names = pd.factorize(pdf[KEY])
        by = np.lexsort([*[pdf[c].to_numpy() for c in reversed(self.order)], codes])
        pdf, codes = pdf.iloc[by], codes[by]
        arrays = {}
        for name, c in self.inputs.items():
            missing = pdf[f"n{c}"].to_numpy(bool) if f"n{c}" in pdf else pdf[c].isna().to_numpy()
            values = pdf[c].fillna(0).to_numpy() if missing.any() else pdf[c].to_numpy()
            arrays[name] = np.ma.MaskedArray(values, missing)
        known, found, due = self.states.exists(), {name: [] for name in self.outputs.values()}, []
        cuts = [*np.flatnonzero(np.diff(codes, prepend=-1)).tolist(), len(codes)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = (names[codes[a]],)
            held = self.states.getValue(own) if known else None
            outs, after = self.fold.run(
                {n: x[a:b] for n, x in arrays.items()}, None if held is None else tuple(held)
            )
            if after is not None:
                self.states.updateValue(own, after)
                due.append(after[0])
            for name, values in found.items():
                values.append(outs[name])
        self._wait_for([x for x in due if x is not None])
        added = {}
        for c, name in self.outputs.items():
            values = np.ma.concatenate(found[name])
            if np.ma.getmaskarray(values).any():
                values = np.where(np.ma.getmaskarray(values), None, values.astype(object))
            added[c] = np.asarray(values)
        yield pdf.drop(columns=[KEY, BUCKET]).assign(**added)

    def _wait_for(self, times: list[int]) -> None:
        if self.forget_after_ms is None or not times:
            return
        step = max(self.forget_after_ms // 8, 1)
        due = -(-(min(times) // 1000 + self.forget_after_ms) // step) * step
        known = self.next.get()
        if known is not None:
            if known[0] <= due:
                return
            self.handle.deleteTimer(known[0])
        self.handle.registerTimer(due)
        self.next.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, stay = timerValues.getCurrentWatermarkInMs(), []
        for own, state in list(self.states.iterator()):
            if state[0] is not None and state[0] // 1000 + self.forget_after_ms <= now:
                self.states.removeKey(tuple(own))
            elif state[0] is not None:
                stay.append(state[0])
        self.next.clear()
        self._wait_for(stay)
        return iter([])

    def close(self) -> None:
        pass


def _key_text(sdf: DataFrame, by: Sequence[str]) -> Column:
    """One text for each key, exact for every type, nulls apart."""

    def text(c: str) -> Column:
        kind = sdf.schema[c].dataType
        if isinstance(kind, T.BinaryType):
            return F.hex(c)
        if isinstance(kind, (T.StructType, T.ArrayType)):
            return F.to_json(c, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        return _plain(F.col(c), kind).cast("string")

    return F.to_json(F.array(*[text(c) for c in by]))


def fold_stream(
    sdf: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    inputs: Sequence[str],
    outputs: Sequence[T.StructField],
    fold: Fold,
    forget_after_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming twin of the batch fold; ``forget_after_ms`` needs a watermark.

    Keys are dealt to ``buckets`` by hash; a running stream must keep their number.
    """
    # Rows come as named tuples, which only keep names that are Python's.
    names = {c: f"c{i}" for i, c in enumerate(sdf.columns)}
    plain = sdf.toDF(*names.values())
    # Whole numbers with nulls would come as doubles: the nulls travel apart.
    holed = [f.name for f in plain.schema.fields if isinstance(f.dataType, T.IntegralType)]
    blank = {c: f"n{c}" for c in holed}
    key = _key_text(plain, [names[c] for c in by])
    packed = plain.withColumns(
        {**{n: F.col(c).isNull() for c, n in blank.items()}, KEY: key, BUCKET: F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")}
    ).withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(plain.schema[c].dataType)) for c in holed})
    added = [f"o{i}" for i in range(len(outputs))]
    fields = [T.StructField(n, f.dataType) for n, f in zip(added, outputs)]
    ordered = [x for c in order for x in ([blank[names[c]]] if names[c] in blank else []) + [names[c]]]
    folding = Folding(
        fold, ordered, {c: names[c] for c in inputs},
        dict(zip(added, [f.name for f in outputs])), forget_after_ms,
    )
    time = "None" if forget_after_ms is None else "EventTime"
    schema = T.StructType([*[f for f in packed.schema.fields if f.name not in (KEY, BUCKET)], *fields])
    out = packed.groupBy(BUCKET).transformWithStateInPandas(folding, schema, "Append", time)
    back = [F.when(~F.col(blank[c]), F.col(c)).alias(c) if c in blank else F.col(c) for c in plain.columns]
    return out.select(*back, *added).toDF(*names, *[f.name for f in outputs])


def anchored_stream(
    sdf: DataFrame, value: str | Column, ts: str, width: str, by: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """``anchored_tumbling`` on a stream."""
    timed = F.when(F.col(ts).isNotNull(), double_of(sdf, value))
    rows = sdf.withColumns({"_t": micros(F.col(ts)), "_v": timed})
    out = fold_stream(
        rows,
        by,
        ["_t", *order],
        ["_t", "_v"],
        [
            T.StructField("window_sum", T.DoubleType()),
            T.StructField("window_count", T.LongType()),
            T.StructField("_elapsed", T.BooleanType()),
        ],
        AnchoredFold(interval_micros(width)),
    )
    return route_windows(out)


def dedupe_stream(
    sdf: DataFrame, key: str, order: Sequence[str], ttl: str, ts: str, watermark: str | None = None
) -> DataFrame:
    """``identify_duplicates`` with age-off on a stream.

    With a watermark a key's state is dropped once it is aged off. As in the batch
    form, records without key or time fail; they have no state.
    """
    text = F.col(key).cast("string")
    rows = sdf.withColumn(ts, as_timestamp(ts))
    if watermark:
        rows = rows.withWatermark(ts, watermark)
    rows = rows.withColumns({"_key": text, "_t": micros(F.col(ts))})
    good = ~is_blank(text) & F.col(ts).isNotNull()
    age = interval_micros(ttl)
    out = fold_stream(
        rows.filter(good),
        ["_key"],
        ["_t", *order],
        ["_t"],
        [T.StructField("_fresh", T.BooleanType())],
        AgeOffFold(age),
        forget_after_ms=age // 1000 if watermark else None,
    )
    rel = F.when(F.col("_fresh"), "non-duplicate").otherwise("duplicate")
    failed = rows.filter(~good).withColumn(REL, F.lit("failure"))
    both = out.withColumn(REL, rel).drop("_fresh").unionByName(failed)
    return both.drop("_key", "_t")


def distinct_stream(sdf: DataFrame, key: str, ts: str | None = None, watermark: str | None = None) -> DataFrame:
    """First record of each key; with a watermark, within that span only."""
    rows = sdf.filter(~is_blank(F.col(key)))
    if watermark is None:
        return rows.dropDuplicates([key])
    timed = rows.withColumn(ts, as_timestamp(ts)).withWatermark(ts, watermark)
    return timed.dropDuplicatesWithinWatermark([key])


def batch_wait_stream(
    sdf: DataFrame, frag_id: str, frag_count: str, order: Sequence[str]
) -> DataFrame:
    """``batch_wait`` on a stream; records without id or count have no state."""
    rows = fragments(sdf, frag_id, frag_count)
    out = fold_stream(
        rows.filter("_ok"),
        [frag_id],
        order,
        ["_want", "_ok"],
        [T.StructField("_done", T.BooleanType())],
        CounterFold(),
    )
    failed = rows.filter(~F.col("_ok")).withColumn("_done", F.lit(False))
    return route_batch(out.unionByName(failed), F.col("_done"))


def _bare(value):
    """Nested rows as plain tuples, which state can be written with."""
    if isinstance(value, tuple):
        return tuple(_bare(v) for v in value)
    if isinstance(value, list):
        return [_bare(v) for v in value]
    return {k: _bare(v) for k, v in value.items()} if isinstance(value, dict) else value


class Holding(StatefulProcessor):
    """Holds typed rows in a list until each one's own time has come.

    One timer stands for the next row due. When it fires, all rows that are due leave in
    one pass over the list.
    """

    def __init__(self, schema: T.StructType, event_time: bool):
        self.schema, self.event_time = schema, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)
        self.next = handle.getValueState("next", "due long")

    def _now(self, times) -> int:
        return times.getCurrentWatermarkInMs() if self.event_time else times.getCurrentProcessingTimeInMs()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, kept = self._now(timerValues), []
        for row in rows:
            values = tuple(_bare(row[c]) for c in self.schema.names)
            if values[0] <= now:
                yield Row(**dict(zip(self.schema.names[1:], values[1:])))
            else:
                kept.append(values)
        if kept:
            self.held.appendList(kept)
            self._wait_for(min(x[0] for x in kept))

    def _wait_for(self, due: int) -> None:
        known = self.next.get()
        if known is not None:
            if known[0] <= due:
                return
            self.handle.deleteTimer(known[0])
        self.handle.registerTimer(due)
        self.next.update((due,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, rest = self._now(timerValues), []
        for values in map(_bare, self.held.get()):
            if values[0] <= now:
                yield Row(**dict(zip(self.schema.names[1:], values[1:])))
            else:
                rest.append(values)
        self.next.clear()
        if rest:
            self.held.put(rest)
            self._wait_for(min(x[0] for x in rest))
        else:
            self.held.clear()

    def close(self) -> None:
        pass


def _plain(c: Column, kind: T.DataType) -> Column:
    """Times, dates and decimals as numbers and texts that Python keeps exactly."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    return c.cast("string") if isinstance(kind, T.DecimalType) else c


def _restored(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", c, F.lit("1970-01-01").cast("timestamp_ntz"))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(c)
    return c.cast(kind) if isinstance(kind, T.DecimalType) else c


def delay_stream(
    sdf: DataFrame,
    key: str,
    delay_ms: str | Column,
    ts: str | None = None,
    watermark: str | None = None,
    grain: str = "1 minute",
) -> DataFrame:
    """Hold each record for its own delay: from its arrival, or from its time ``ts``.

    With ``ts`` and ``watermark`` a record leaves when the watermark reaches its time and
    delay, otherwise when the clock does. Records are held by ``key`` and by the ``grain``
    in which they are due, so a key with very many records is many lists, and a list is
    read when it is due. Released records are ``success``; a record without a readable
    delay, or time, is ``failure`` at once.
    """
    given = F.col(delay_ms) if isinstance(delay_ms, str) else delay_ms
    rows = sdf.withColumn("_delay", given.try_cast("bigint"))
    if ts is not None:
        rows = rows.withColumn("_at", as_timestamp(ts)).withWatermark("_at", watermark)
        start = F.unix_millis("_at")
    else:
        start = F.unix_millis(F.current_timestamp())
    rows = rows.withColumn("_due", F.try_add(start, F.col("_delay")))
    fields = sdf.schema.fields
    bucket = F.call_function("div", F.col("_due"), F.lit(interval_micros(grain) // 1000))
    # Without the time itself, late records are not dropped: they are due, and leave.
    packed = rows.filter(F.col("_due").isNotNull()).select(
        F.col(key).cast("string").alias("_key"), bucket.alias("_bucket"), "_due",
        *[_plain(F.col(f.name), f.dataType).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    kinds = [packed.schema[c] for c in ["_due", *[f"c{i}" for i in range(len(fields))]]]
    held = packed.groupBy("_key", "_bucket").transformWithState(
        Holding(T.StructType([T.StructField(f.name, f.dataType) for f in kinds]), ts is not None),
        T.StructType([T.StructField(f.name, f.dataType) for f in kinds[1:]]),
        "Append",
        "ProcessingTime" if ts is None else "EventTime",
    )
    back = held.select(*[_restored(F.col(f"c{i}"), f.dataType).alias(f.name) for i, f in enumerate(fields)])
    failed = rows.filter(F.col("_due").isNull()).select(*sdf.columns)
    return back.withColumn(REL, F.lit("success")).unionByName(
        failed.withColumn(REL, F.lit("failure"))
    )
