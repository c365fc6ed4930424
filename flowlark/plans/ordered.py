"""Order-dependent work per key, in one way for groups of any size.

Rows are range-partitioned on (key, order), so a hot key is spread over many
chunks and a chunk holds many short keys. What a chunk needs to know about the
chunks before it, its carry, is one row per chunk; which chunks share a key is
decided by Spark's own comparison, so nulls and NaN are keys like any other.

Only the columns that an operator reads are dealt, sorted and written. All others are
joined back by row identity, the key and order columns, so they are shuffled once and
never written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlark.plans.skew import join_hot
from flowlark.session import materialize

CHUNK = "_chunk"


def range_chunks(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows sorted by (key, order) in stable range chunks numbered ``_chunk``.

    The chunk borders come from sampling, so they are pinned by writing the
    result once: both passes over it must see the same borders.
    """
    keys = [*by, *order]
    return materialize(_dealt(df, keys).sortWithinPartitions(*keys).withColumn(CHUNK, F.spark_partition_id()))


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *keys)


def _rejoined(df: DataFrame, result: DataFrame, by: Sequence[str], order: Sequence[str], added: Sequence[str]) -> DataFrame:
    """``df`` with the ``added`` columns of its rows, of which ``result`` has a part."""
    if set(df.columns) <= set(result.columns):
        return result.select(*df.columns, *added)
    identity = list(dict.fromkeys([*by, *order]))
    side = result.select(*identity, *added)
    return join_hot(df, side, {c: c for c in identity}, "left", null_safe=True)


def order_key(order: Sequence[str]) -> Column:
    """One orderable column; a single one stays plain, which keeps hash aggregates."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _key(by: Sequence[str]) -> Column:
    return F.struct(*by) if by else F.struct(F.lit(0).alias("all"))


def _borders(chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per chunk: first and last key, and how its neighbours continue.

    ``_continues``: the first key began before; ``_inside``: it also is the last
    one; ``_goes_on``: the last key continues; ``_run``: chunks with one last key.
    """
    key = _key(by)
    edges = chunks.groupBy(CHUNK).agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    return materialize(_between(edges))


def _between(edges: DataFrame) -> DataFrame:
    before = Window.orderBy(CHUNK)  # as many rows as chunks
    joined = edges.withColumns(
        {
            "_continues": (F.row_number().over(before) > 1)
            & F.col("_lo").eqNullSafe(F.lag("_hi").over(before)),
            "_one": F.col("_lo").eqNullSafe(F.col("_hi")),
        }
    )
    joined = joined.withColumn("_inside", F.col("_continues") & F.col("_one"))
    return joined.withColumns(
        {
            "_goes_on": F.coalesce(F.lead("_continues").over(before), F.lit(False)),
            "_run": F.sum((~F.col("_inside")).cast("int")).over(before),
        }
    ).drop("_one")


def running(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str | Column] | None = None,
    count: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Add running sums and a running row count per key, in ``order``.

    ``order`` must end in a column that is unique within a key. ``sums`` maps new column
    names to numeric inputs; ``count`` names the running count (1 for the first row).
    ``keep`` names narrow columns that are written with the rows instead of being joined
    back. Sums within a chunk are written too; a chunk's last row then is its total.
    """
    parts = {name: F.col(c) if isinstance(c, str) else c for name, c in (sums or {}).items()}
    if count:
        parts[count] = F.lit(1).cast("long")
    own = list(dict.fromkeys([*by, *order, *keep]))
    inputs = {n: f"_in_{n}" for n in parts}
    narrow = df.select(*own, *[value.alias(inputs[n]) for n, value in parts.items()])
    dealt = _dealt(narrow, [*by, *order]).withColumn(CHUNK, F.spark_partition_id())
    within = Window.partitionBy(CHUNK, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    chunks = dealt.withColumns({n: F.sum(c).over(within) for n, c in inputs.items()}).drop(*inputs.values())
    chunks = materialize(chunks)
    tails = [F.col(n).alias(f"_tail_{n}") for n in parts]
    edges = chunks.groupBy(CHUNK).agg(
        F.min(_key(by)).alias("_lo"), F.max(F.struct(_key(by).alias("_hi"), *order, *tails)).alias("_last")
    )
    borders = _between(edges.select(CHUNK, "_lo", "_last._hi", *[f"_last._tail_{n}" for n in parts]))
    upto = Window.partitionBy("_run").orderBy(CHUNK)
    before = Window.orderBy(CHUNK)  # as many rows as chunks
    totals = borders.withColumns({f"_upto_{n}": F.sum(f"_tail_{n}").over(upto) for n in parts})
    carries = totals.select(
        CHUNK, "_lo",
        *[F.when(F.col("_continues"), F.lag(f"_upto_{n}").over(before)).alias(f"_carry_{n}") for n in parts],
    )
    first_key = _key(by).eqNullSafe(F.col("_lo"))

    def total(name: str) -> Column:
        own, carry = F.col(name), F.when(first_key, F.col(f"_carry_{name}"))
        return F.coalesce(own + carry, own, carry)

    joined = chunks.join(F.broadcast(carries), CHUNK)  # one row per chunk
    out = joined.select(*own, *[total(n).alias(n) for n in parts])
    return _rejoined(df, out, by, order, list(parts))


def rank_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "_rank", keep: Sequence[str] = ()
) -> DataFrame:
    """Exact 1-based position of each row within its key."""
    return running(df, by, order, count=name, keep=keep)


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Key and order columns of the first row per key.

    A minimum per key combines before the shuffle, so a hot key costs one row
    per task.
    """
    least = df.groupBy(*by).agg(F.min(order_key(order)).alias("_least"))
    if len(order) == 1:
        return least.select(*by, F.col("_least").alias(order[0]))
    return least.select(*by, *[F.col("_least")[c].alias(c) for c in order])


class Fold:
    """What a key's rows do, in order, to a small state.

    A state is three numbers (a, s, n) or None at the start of a key. ``run`` gets
    the input columns of consecutive rows as numpy arrays, ``changes`` marking the
    rows before another key, and the state left by the rows before them; it
    returns the output arrays and the new state.

    A chunk inside one key is described without its entry state: ``exits`` gives
    a builder whose table has entry marks with the exit states behind them. Which
    mark a state finds in the chunks to come says ``following``; a chunk in which
    it finds none only adds its totals, as ``passed`` says.
    """

    def run(self, arrays: dict, state, changes: np.ndarray | None = None) -> tuple[dict, tuple]:
        raise NotImplementedError

    def exits(self):
        raise NotImplementedError

    def following(self, nodes: DataFrame, spans: list[Span]) -> DataFrame:
        """Next node (tq, tm) of each node (q, m) with a state, where there is one."""
        raise NotImplementedError

    def passed(self, state, sums: float, rows: int):
        raise NotImplementedError


class Span(NamedTuple):
    """A chunk inside one key: its marks and totals, in order."""

    chunk: int
    run: int
    first: int | None
    last: int | None
    rows: int


STATE = ["a", "s", "n"]
EXITS = f"{CHUNK} int, kind string, entry long, a long, s double, n long"
HEAD = -(1 << 62)  # mark of the state that a run of chunks begins with


def fold_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    inputs: Sequence[str],
    outputs: Sequence[T.StructField],
    fold: Fold,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fold each key's rows in ``order`` and add the ``outputs`` columns.

    Rows stream through in Arrow batches; no group is held in memory. As in ``running``,
    (key, order) is unique and ``keep`` names narrow columns to be written with the rows.
    """
    names = [f.name for f in outputs]
    chunks = range_chunks(df.select(*dict.fromkeys([*by, *order, *inputs, *keep])), by, order)
    carries = _settle(chunks, by, inputs, fold)
    wide = T.StructType([*chunks.schema.fields, *outputs])
    folded = chunks.mapInArrow(_folder(by, inputs, names, fold, wide, carries), wide)
    return _rejoined(df, folded, by, order, names)


def _settle(chunks: DataFrame, by: Sequence[str], inputs: Sequence[str], fold: Fold) -> dict:
    """State with which each chunk starts, for keys that span chunks.

    One pass gives, per chunk whose last key goes on, the state after it or, for a
    chunk inside one key, a table from entry marks to exit states. Tables stay
    distributed; a row points to the row of a later chunk where its state opens
    next. The rows on the way of the true state are found by doubling pointers, so
    jobs grow with the logarithm of the chunks. One row per chunk reaches the
    driver.
    """
    borders = _borders(chunks, by)
    rows = borders.select(CHUNK, "_continues", "_inside", "_goes_on", "_run").orderBy(CHUNK).collect()
    if not any(r["_continues"] for r in rows):
        return {}
    inside = {r[CHUNK] for r in rows if r["_inside"]}
    going = borders.filter("_goes_on").select(CHUNK, "_hi", "_run")
    narrow = (
        chunks.select(CHUNK, *dict.fromkeys([*by, *inputs]))
        .join(F.broadcast(going), CHUNK)  # one row per chunk
        .filter(_key(by).eqNullSafe(F.col("_hi")))
        .drop("_hi", "_run")
    )
    exits = materialize(narrow.mapInArrow(_exits(by, inputs, fold, inside), EXITS))
    state, totals = {}, {}
    for r in exits.filter("kind <> 'exit'").collect():  # one row per chunk
        (totals if r["kind"] == "total" else state)[r[CHUNK]] = (r["a"], r["s"], r["n"])
    opened = {}
    if totals:
        marks = exits.filter("kind = 'exit'").groupBy(CHUNK).agg(
            F.min("entry").alias("first"), F.max("entry").alias("last")
        )
        marks = {r[CHUNK]: r for r in marks.collect()}  # one row per chunk
        none = {"first": None, "last": None}
        spans = [
            Span(r[CHUNK], r["_run"], marks.get(r[CHUNK], none)["first"],
                 marks.get(r[CHUNK], none)["last"], totals[r[CHUNK]][2])
            for r in rows if r[CHUNK] in totals
        ]
        runs = F.broadcast(going.select(CHUNK, "_run"))
        nodes = exits.filter("kind <> 'total'").join(runs, CHUNK).select(
            F.col(CHUNK).alias("q"), F.coalesce("entry", F.lit(HEAD)).alias("m"), "_run", *STATE
        )
        for r in _visited(materialize(nodes), spans, fold).collect():  # at most one per chunk
            opened[r["q"]] = (r["a"], r["s"], r["n"])
    carries, before = {}, None
    for r in rows:
        c = r[CHUNK]
        if r["_continues"] and before is not None and before[0] is not None:
            carries[c] = before
        if c in opened:
            before = opened[c]
        elif c in totals:
            before = fold.passed(before, totals[c][1], totals[c][2])
        else:
            before = state.get(c)
    return carries


def _visited(nodes: DataFrame, spans: list[Span], fold: Fold) -> DataFrame:
    """Nodes inside chunks that the states of the runs come through."""
    jump = materialize(fold.following(nodes, spans).filter("tq is not null"))
    seen = nodes.filter(F.col("m") == HEAD).select("q", "m")
    while True:
        new = materialize(seen.join(jump, ["q", "m"]).select(F.col("tq").alias("q"), F.col("tm").alias("m")))
        if new.isEmpty():
            return seen.filter(F.col("m") != HEAD).join(nodes, ["q", "m"])
        seen = materialize(seen.unionAll(new))
        far = jump.select(F.col("q").alias("tq"), F.col("m").alias("tm"), F.col("tq").alias("fq"), F.col("tm").alias("fm"))
        jump = materialize(jump.join(far, ["tq", "tm"]).select("q", "m", F.col("fq").alias("tq"), F.col("fm").alias("tm")))


def next_at_or_after(nodes: DataFrame, spans: list[Span], mark: Column) -> DataFrame:
    """For each node the first node of a later chunk whose mark is ``mark`` or more.

    The chunk is found in the list of spans; inside it one sorted pass serves all
    who look for a mark there. Marks grow from chunk to chunk of a run.
    """
    listed = [x for x in spans if x.last is not None]
    order = {run: [x for x in listed if x.run == run] for run in {x.run for x in listed}}
    lasts = {run: np.array([x.last for x in xs]) for run, xs in order.items()}

    def aim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, m, run, at = (batch.column(i).to_pylist() for i in range(4))
            goals = []
            for r, x in zip(run, at):
                place = int(np.searchsorted(lasts[r], x)) if r in lasts else 0
                goals.append(order[r][place] if r in lasts and place < len(lasts[r]) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([g and g.chunk for g in goals], pa.int32()),
                    pa.array([None if g is None else max(x, g.first) for g, x in zip(goals, at)], pa.int64()),
                ],
                names=["q", "m", "tq", "at"],
            )

    aimed = nodes.select("q", "m", "_run", mark.alias("at")).mapInArrow(aim, "q int, m long, tq int, at long")
    seekers = aimed.filter("tq is not null").select(
        "tq", "at", F.lit(1).alias("turn"), "q", "m", F.lit(None).cast("long").alias("tm")
    )
    marks = nodes.filter(F.col("m") != HEAD).select(
        F.col("q").alias("tq"), F.col("m").alias("at"), F.lit(0).alias("turn"), "q", "m", F.col("m").alias("tm")
    )
    back = Window.partitionBy("tq").orderBy(F.desc("at"), "turn")
    near = seekers.unionAll(marks).withColumn("tm", F.last("tm", ignorenulls=True).over(back))
    return near.filter("turn = 1").select("q", "m", "tq", "tm")


def _exits(by, inputs, fold, inside):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, builder = _Scan(by, inputs, fold, {}), None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if scan.chunk is None and batch.column(CHUNK)[0].as_py() in inside:
                builder = fold.exits()
            scan.feed(batch, fold=builder is None)
            if builder is not None:
                builder.feed(scan.arrays)
        if scan.chunk is None:
            return
        entries, states, total = [], [scan.state or (None, None, None)], "state"
        if builder is not None:
            entries, exits, totals = builder.table()
            states, total = [*exits, totals], "total"
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([scan.chunk] * len(states), pa.int32()),
                pa.array(["exit"] * len(entries) + [total]),
                pa.array([*entries, None], pa.int64()),
                pa.array([x[0] for x in states], pa.int64()),
                pa.array([x[1] for x in states], pa.float64()),
                pa.array([x[2] for x in states], pa.int64()),
            ],
            names=[CHUNK, "kind", "entry", *STATE],
        )

    return run


def _folder(by, inputs, names, fold, schema, carries):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = {f.name: to_arrow_type(f.dataType) for f in schema.fields if f.name in names}
        scan = _Scan(by, inputs, fold, carries)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            outs = scan.feed(batch)
            arrays = [*batch.columns, *[_to_arrow(outs[n], types[n]) for n in names]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *names])

    return run


def _to_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, np.ma.MaskedArray):
        return pa.array(values.data, mask=np.ma.getmaskarray(values)).cast(kind)
    return pa.array(values).cast(kind)


class _Scan:
    """Carries the fold state from batch to batch of one sorted partition."""

    def __init__(self, by, inputs, fold, carries):
        self.by, self.inputs, self.fold, self.carries = by, inputs, fold, carries
        self.last: list | None = None
        self.state = None
        self.chunk: int | None = None
        self.arrays: dict = {}

    def feed(self, batch: pa.RecordBatch, fold: bool = True) -> dict:
        rows = batch.num_rows
        keys = [batch.column(batch.schema.get_field_index(c)) for c in self.by]
        first = [k[0] for k in keys]
        if self.last is None:
            self.chunk = batch.column(CHUNK)[0].as_py()
            self.state = self.carries.get(self.chunk)
        elif not all(_same(a, b) for a, b in zip(self.last, first)):
            self.state = None
        self.last = [k[rows - 1] for k in keys]
        arrays = {c: _to_numpy(batch.column(batch.schema.get_field_index(c))) for c in self.inputs}
        self.arrays = arrays
        if not fold:
            return {}
        outs, self.state = self.fold.run(arrays, self.state, _changes(keys, rows))
        return outs


def _same(a: pa.Scalar, b: pa.Scalar) -> bool:
    x, y = a.as_py(), b.as_py()
    return x == y or (x != x and y != y)


def _changes(keys: list[pa.Array], rows: int) -> np.ndarray:
    """True where row i+1 has another key than row i."""
    pairs = []
    for key in keys:
        a, b = key.slice(0, rows - 1), key.slice(1)
        differs = pc.fill_null(pc.not_equal(a, b), False)
        differs = pc.or_(differs, pc.xor(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(key.type):
            both_nan = pc.and_(
                pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False)
            )
            differs = pc.and_(differs, pc.invert(both_nan))
        pairs.append(differs.to_numpy(zero_copy_only=False))
    return reduce(np.logical_or, pairs, np.zeros(max(rows - 1, 0), dtype=bool))


def _to_numpy(column: pa.Array) -> np.ma.MaskedArray | np.ndarray:
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.int64())
    if column.null_count == 0:
        return column.to_numpy(zero_copy_only=False)
    mask = column.is_null().to_numpy(zero_copy_only=False)
    return np.ma.MaskedArray(pc.fill_null(column, 0).to_numpy(zero_copy_only=False), mask)
