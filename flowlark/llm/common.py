"""Shared helpers: words, ordered totals, bounded sieves and link components."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlark.session import materialize

#: White space of the word definition, as Java and SQL patterns.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bits of a sieve: 4 MB, whatever the size of the tables.
SIEVE_BITS = 1 << 25
#: Bytes of text that a Python task handles at once; a longer document goes alone.
SLICE_BYTES = 4 << 20
#: Rows that may be broadcast after they have been counted.
BROADCAST_ROWS = 100_000
#: Links, counted first, whose components are found in one partition: 8 MB of keys.
FEW_LINKS = 250_000
#: Documents for which a task after a shuffle is worth its cost to the driver.
TASK_DOCS = 4096


def words_in(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def join_small(rows: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a side that is usually small: broadcast once counted, shuffled if not.

    ``side`` must be materialised. Keys are null-safe; the side's key columns go.
    """
    names = {c: f"_side_{c}" for c in on}
    side = side.withColumnsRenamed(names)
    if side.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
        match = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    else:  # structs: both sides are shuffled, so that hot keys can be split
        match = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)]).eqNullSafe(
            F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(names.values())])
        )
    return rows.join(side, match, how).drop(*names.values())


def ordered_totals(
    df: DataFrame, order: Sequence[str], sums: dict[str, Column], parts: int | None = None
) -> DataFrame:
    """Add ``_row`` (0-based rank) and running sums in a global order.

    Rows are dealt by range and pinned; only one row per part meets in one task.
    ``order`` must decide between all rows that differ.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt)
    sums = {"_row": F.lit(1).cast("long"), **sums}
    totals = dealt.groupBy(F.col("_part").alias("_at")).agg(
        *[F.sum(v).alias(f"_sum_{n}") for n, v in sums.items()]
    )
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "_at",
        *[
            F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}")
            for n in sums
        ],
    )
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(carried), F.col("_part") == F.col("_at"))  # one row per part
    out = out.withColumns(
        {n: F.sum(v).over(within) + F.col(f"_before_{n}") for n, v in sums.items()}
    )
    out = out.withColumn("_row", F.col("_row") - 1)
    return out.drop("_part", "_at", *[f"_before_{n}" for n in sums])


def most_frequent(counts: DataFrame, column: str, limit: int, weight: Column | None = None) -> DataFrame:
    """The most frequent rows, at most ``limit``, by a threshold on their count.

    With ``weight``, the sum of weights is at most ``limit``.

    A histogram of counts in steps of a sixteenth of a doubling, about a thousand
    rows, gives the threshold; no task gathers candidates of others. Where a step
    would exceed the limit, the whole step stays out.
    """
    step = F.floor(F.log2(F.col(column)) * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.sum(F.lit(1) if weight is None else weight).alias("n")).collect()
    lowest, total = 1 << 20, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["n"]
        if total > limit:
            break
        lowest = row["step"]
    return counts.filter(step >= lowest)


# --- texts in Arrow batches -------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that its texts stay near SLICE_BYTES."""
    starts = text_bytes(batch.column(column))[1]
    at, rows = 0, batch.num_rows
    while at < rows:
        end = int(np.searchsorted(starts, starts[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield batch.slice(at, end - at)
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and their offsets, nulls empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    starts = starts.astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def encoded(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8, nulls empty."""
    data, starts = text_bytes(column)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _table(make: Callable[[int], bool]) -> np.ndarray:
    return np.array([make(b) for b in range(256)])


#: Whether a byte belongs to a word, by the two definitions in use.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = _table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_STEP = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        with np.errstate(over="ignore"):
            up = np.full(n, _STEP, np.uint64)
            up[0] = 1
            down = np.full(n, pow(_STEP, -1, 1 << 64), np.uint64)
            down[0] = 1
            _powers["up"], _powers["down"] = np.cumprod(up), np.cumprod(down)
    return _powers["up"], _powers["down"]


def hashed_words(
    data: np.ndarray, starts: np.ndarray, inside: np.ndarray, chunk: int = 1 << 19, tails=None
) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, A-Z lower-cased, and the first word of each text.

    The second array has one more entry, the number of words. Texts are read in
    chunks that end between words, so memory follows the number of words. The last
    two bytes of each word are appended to ``tails``, in arrays.
    """
    hashes, firsts = [], []
    begins = starts[:-1]
    at, size = 0, len(data)
    while at < size:
        end = min(at + chunk, size)
        while end < size:  # a cut needs a gap on its left
            gaps = np.flatnonzero(~inside[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + chunk, size)
        part = _LOWER[data[at:end]]
        word = inside[part]
        fresh = np.zeros(len(part) + 1, bool)
        own = begins[np.searchsorted(begins, at) : np.searchsorted(begins, end)]
        fresh[own - at] = True
        fresh[0] = fresh[-1] = True
        left = np.empty(len(part), bool)
        left[0], left[1:] = True, ~word[:-1]
        right = np.empty(len(part), bool)
        right[-1], right[:-1] = True, ~word[1:]
        a = np.flatnonzero(word & (left | fresh[:-1]))
        b = np.flatnonzero(word & (right | fresh[1:])) + 1
        up, down = _power_table(len(part) + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * up[: len(part)], out=total[1:])
            raw = (total[b] - total[a]) * down[a]
            hashes.append(mix(raw + (b - a).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)))
        firsts.append(a + at)
        if tails is not None:
            last = part[b - 1].astype(np.uint16)
            tails.append(last | (np.where(b - a > 1, part[b - 2], 0).astype(np.uint16) << 8))
        at = end
    none = np.zeros(0, np.int64)
    where = np.concatenate(firsts) if firsts else none
    found = np.concatenate(hashes) if hashes else none.astype(np.uint64)
    return found, np.searchsorted(where, starts)


def grams(words: np.ndarray, firsts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows of each text, and the first window of each.

    A text with fewer words, but at least one, has its whole sequence as the one
    window.
    """
    counts = np.diff(firsts)
    each = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(each)])
    out = np.zeros(bounds[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(words) >= k:
            seeds = mix(np.arange(11, 11 + k, dtype=np.uint64)) | np.uint64(1)
            full = np.zeros(len(words) - k + 1, np.uint64)
            for i in range(k):
                full = mix(full + words[i : len(words) - k + 1 + i] * seeds[i])
            whole = np.flatnonzero(counts >= k)
            keep = np.zeros(len(words) + 1, np.int64)
            np.add.at(keep, firsts[:-1][whole], 1)
            np.add.at(keep, firsts[:-1][whole] + each[whole], -1)
            taken = full[np.cumsum(keep)[: len(full)] > 0]
            long_rows = np.repeat(counts >= k, each)
            out[long_rows] = taken
        for row in np.flatnonzero((counts > 0) & (counts < k)):
            text = words[firsts[row] : firsts[row + 1]].tobytes()
            out[bounds[row]] = xxhash.xxh3_64_intdigest(text, seed=len(text))
    return out, bounds


# --- sieves -----------------------------------------------------------------------------


def row_hashes(ids: pa.Array, texts: Sequence[bytes]) -> np.ndarray:
    """64-bit hash of id and text of each row."""
    out = np.empty(len(texts), np.uint64)
    for i, (key, text) in enumerate(zip(ids.to_pylist(), texts)):
        seed = xxhash.xxh3_64_intdigest(str(key).encode())
        out[i] = xxhash.xxh3_64_intdigest(text, seed=seed)
    return out


def sieve_of(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of all hashes of a column: a lossy set of a fixed size.

    It may let strangers pass but stops none of its members, so it only thins out
    rows before an exact join. It holds SIEVE_BITS bits for any table.
    """
    at = F.pmod(F.col(column), F.lit(SIEVE_BITS)) + 1
    parts = (
        hashes.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in parts.collect():  # SIEVE_BITS bits at most
        start = (row["bucket"] - 1) * 4096
        sieve[start : start + 4096] = np.frombuffer(row["bits"], np.uint8)
    return sieve


def passes(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(SIEVE_BITS - 1)
    bits = sieve[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)
    return (bits & 1).astype(bool)


def positional(docs: DataFrame) -> DataFrame:
    """Columns renamed by position: names of the caller cannot clash."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def sift(docs: DataFrame, sieve, key: str, text: str, inside: bool) -> DataFrame:
    """Rows of ``docs`` whose row hash passes the sieve (or does not), with ``_h``.

    ``sieve`` is a broadcast of bits. Other columns are named by position.
    """
    key_at, text_at = docs.columns.index(key), docs.columns.index(text)
    rows = positional(docs)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_at):
                found = row_hashes(part.column(key_at), encoded(part.column(text_at)))
                keep = passes(sieve.value, found) == inside
                out = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(found[keep].view(np.int64))],
                    names=[*out.schema.names, "_h"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, _h long")


def without_rows(docs: DataFrame, losers: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` without the rows whose hash is in ``losers`` (column ``_h``).

    Rows that the sieve clears pass straight on; only the others are shuffled for
    the exact comparison.
    """
    spark = docs.sparkSession
    sieve = spark.sparkContext.broadcast(sieve_of(losers, "_h"))
    clear = sift(docs, sieve, key, text, False).drop("_h")
    doubtful = sift(docs, sieve, key, text, True)
    names = losers.select(F.col("_h").alias("_lost")).distinct()
    rest = doubtful.join(names, F.col("_h") == F.col("_lost"), "left_anti").drop("_h")
    return clear.unionAll(rest).toDF(*docs.columns)


# --- components -------------------------------------------------------------------------


def shuffled(side: DataFrame) -> DataFrame:
    """A side that grows with the corpus: never built into a table on the driver."""
    return side.hint("merge")


def side_of(side: DataFrame, rows: int) -> DataFrame:
    """A side of ``rows`` counted rows: broadcast while small, shuffled beyond."""
    return F.broadcast(side) if rows <= BROADCAST_ROWS else shuffled(side)


def in_few_tasks(rows: DataFrame, docs: int) -> DataFrame:
    """Rows made of ``docs`` counted documents, in a task for TASK_DOCS of them at least.

    The driver keeps several kB of every task. A shuffle has as many tasks as partitions are
    set; where these are more than so many documents need, a task reads several of them.
    Larger tables stay as they are.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    tasks = max(1, -(-docs // TASK_DOCS))
    return rows.coalesce(tasks) if tasks < parts else rows


def _without_guess(rows: DataFrame, parts: int) -> DataFrame:
    """Checkpointed rows without the size that Spark guesses for them.

    A join is taken to be as large as the product of its sides, and a checkpoint keeps the
    guess. In a loop the digits of this number double every round, until the driver spends its
    memory and time on it.
    """
    spark = rows.sparkSession
    fresh = DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.toJavaRDD(), rows._jdf.schema()), spark)
    return fresh.coalesce(1) if parts == 1 else fresh  # known to be one partition


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest key reachable from each linked key: rows (k, c).

    ``links`` has long columns a and b, each pair once. Every round each key takes
    the smallest label among its neighbours; from the third round on also its label's
    own label, so that long paths halve while stars are done before. Minima are
    combined before the shuffle; no key's neighbours meet in one group. Up to FEW_LINKS
    links lie in one partition, where a round needs no shuffle. ``links`` must be
    materialised. Raises if ``rounds`` do not suffice.
    """
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    parts = 1 if links.count() <= FEW_LINKS else parts
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.coalesce(parts)  # a union has the parts of all its sides
    edges = _without_guess(materialize(both), parts)
    first = edges.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("c"))
    labels = _without_guess(materialize(first.select("k", F.least("k", "c").alias("c"))), parts)
    size = labels.count()
    for turn in range(rounds):
        there = labels.select(F.col("k").alias("b"), F.col("c").alias("near"))
        told = edges.join(side_of(there, size), "b").select(
            F.col("a").alias("k"), F.col("near").alias("c"), F.lit(None).cast("long").alias("was")
        )
        told = told.unionAll(labels.select("k", "c", F.col("c").alias("was")))
        told = told.coalesce(1) if parts == 1 else told
        better = told.groupBy("k").agg(F.min("c").alias("c"), F.max("was").alias("was"))
        if turn >= 2:
            jump = labels.select(F.col("k").alias("c"), F.col("c").alias("far"))
            better = better.join(side_of(jump, size), "c").select("k", "was", F.least("c", "far").alias("c"))
        stepped = _without_guess(materialize(better), parts)
        done = stepped.filter("was <> c").isEmpty()
        labels = stepped.select("k", "c")
        if done:
            return labels
    raise RuntimeError(f"links do not settle within {rounds} rounds")


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x, np.uint64).view(np.int64))

