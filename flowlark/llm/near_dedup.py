"""Near-duplicates by fast similarity sketches, banding and exact verification.

A document's set holds the distinct k-word windows of its whole text, A-Z
lower-cased; a shorter text is one window. Documents are linked when
100 * |A and B| >= 80 * |A or B|, and a component is what links reach.

*Sketch.* Round r places every element in a bin by a fresh hash and a bin keeps its
smallest (round, hash) value. Rounds stop for a document when all bins are full:
one round for long texts, about bins * ln(bins) placements for short ones. Rounds
beyond the number of bins fill one given bin each, so every coordinate fills.
Two sketches agree in a bin with probability equal to the similarity, with the
concentration of fully independent samples.

*Candidates.* Equal sets are one class from here on. Bands of six coordinates
deal classes to buckets: a pair at similarity 0.8 shares none of 42 bands with
probability 3e-6. In a bucket each class is first paired with the smallest one;
links found merge into components. Where a bucket still holds several components,
elements are counted over all open classes: a class whose elements are too rare to
reach the threshold with any member leaves the bucket, and the others are paired with
the most typical member. Where several components are left after that, members get a
longer sketch of one bit per coordinate and are compared in blocks, matrix against matrix:
every pair of a bucket is looked at there and then, and only those go on that belong to
different components, whose bits agree as often as they must (4.7 standard deviations are
allowed, which a linked pair misses with probability 1e-6), and that share no earlier
bucket. So what leaves a bucket is each near pair once, and there is no cap.

*Verification.* Full sets of candidates are compared; the sets are computed for
rows that pass a sieve of fixed size.

Defined results: null, empty and blank texts have size 0 and are linked with
nothing; repeated rows are copies; null ids are never the smallest of a component
that has another id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import (
    SPACED,
    as_long,
    components,
    encoded,
    grams,
    hashed_words,
    in_few_tasks,
    mix,
    passes,
    row_hashes,
    shuffled,
    side_of,
    sieve_of,
    slices,
    text_bytes,
    without_rows,
)
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

BANDS, WIDTH = 42, 6
BINS = 256
VALUE_BITS = np.uint64(40)
#: Bits of the longer sketch, deviations allowed, and members of a block.
CHECK_BITS, DEVIATIONS, BLOCK = 2048, 4.7, 4096


def sketches(elements: np.ndarray, owner: np.ndarray, sets: int, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches: a row of ``bins`` values per set.

    ``owner`` is the set of each element. Sets without elements stay all ones.
    """
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(sets * bins, top, np.uint64)
    low = (np.uint64(1) << VALUE_BITS) - np.uint64(1)
    seeds = mix(np.arange(1001, 1001 + 2 * bins, dtype=np.uint64))
    base = owner.astype(np.int64) * bins
    with np.errstate(over="ignore"):
        for r in range(2 * bins):
            if not len(elements):
                break
            h = mix(elements * np.uint64(0x9FB21C651E98DF25) ^ seeds[r])
            if r < bins:
                at = base + (((h >> VALUE_BITS) * np.uint64(bins)) >> np.uint64(24)).astype(np.int64)
            else:
                at = base + (r - bins)
            np.minimum.at(out, at, (np.uint64(r) << VALUE_BITS) | (h & low))
            empty = (out.reshape(sets, bins) == top).any(axis=1)
            left = empty[owner]
            if not left.all():
                elements, owner, base = elements[left], owner[left], base[left]
    return out.reshape(sets, bins)


def band_hashes(sketch: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sketch), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WIDTH):
            out = mix(out + sketch[:, i : i + BANDS * WIDTH : WIDTH])
        return mix(out + np.arange(1, BANDS + 1, dtype=np.uint64))


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    data, starts = text_bytes(column)
    words, firsts = hashed_words(data, starts, SPACED)
    found, bounds = grams(words, firsts, k)
    return [np.unique(found[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _sketch_rows(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                sets = _sets(part.column(1), k)
                sizes = np.array([len(s) for s in sets], np.int64)
                owner = np.repeat(np.arange(len(sets)), sizes)
                sketch = sketches(np.concatenate(sets), owner, len(sets))
                bands = as_long(band_hashes(sketch).ravel())
                cuts = pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32())
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes),
                        pa.array(keys, pa.binary()),
                        as_long(row_hashes(part.column(0), encoded(part.column(1)))),
                        pa.ListArray.from_arrays(cuts, bands),
                    ],
                    names=["id", "n", "key", "_h", "bands"],
                )

    return run


def _set_rows(k: int, sieve):
    """Packed sets of rows that pass the sieve."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                hashes = row_hashes(part.column(0), encoded(part.column(1)))
                keep = np.flatnonzero(passes(sieve.value, hashes))
                sets = _sets(part.column(1).take(pa.array(keep)), k) if len(keep) else []
                yield pa.RecordBatch.from_arrays(
                    [as_long(hashes[keep]), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["_h", "items"],
                )

    return run


def _linked(percent: int):
    def run(batches):
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = []
            for a, b in rows:
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, docs: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough; b may be a hot key."""
    one = sets.select(F.col("k").alias("ka"), F.col("items").alias("x"))
    two = sets.select(F.col("k").alias("kb"), F.col("items").alias("y"))
    rows = in_few_tasks(join_hot(pairs, shuffled(one), {"a": "ka"}, "inner"), docs)
    rows = join_hot(rows, shuffled(two), {"b": "kb"}, "inner").select("a", "b", "x", "y")
    return in_few_tasks(rows, docs).mapInArrow(_linked(percent), "a long, b long")


def _items(batches):
    """One row per element of each set."""
    for batch in batches:
        sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
        for at in range(0, len(sets), 256):
            part = sets[at : at + 256]
            keys = np.repeat(batch.column(0).to_numpy()[at : at + 256], [len(x) for x in part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), as_long(np.concatenate(part))], names=["k", "item"]
            )


def _split_buckets(rows: DataFrame, docs: int) -> DataFrame:
    """Rows (b, k, c, ...) of buckets with more than one component."""
    split = rows.groupBy(F.col("b").alias("s")).agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    split = materialize(in_few_tasks(split.filter("c0 <> c1").select("s"), docs))
    return in_few_tasks(join_hot(rows, side_of(split, split.count()), {"b": "s"}, "inner"), docs)


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the component that they belong to so far."""
    there = side_of(labels.select(F.col("k").alias("m"), "c"), labels.count())
    named = rows.join(there, F.col("k") == F.col("m"), "left").drop("m")
    return named.withColumn("c", F.coalesce("c", "k"))


def _live(rows: DataFrame, sets: DataFrame, percent: int, docs: int) -> DataFrame:
    """Members that may have a partner in their bucket, with n, common and shared.

    ``common`` counts the elements that any other open class has too. A partner of
    size m shares at most these, so x can only be linked in a bucket whose smallest
    member leaves 100 * common >= percent * (n + m - common). ``shared`` is the mean
    number of classes per element.
    """
    keys = rows.select(F.col("k").alias("o")).distinct()
    items = sets.join(shuffled(keys), F.col("k") == F.col("o"), "left_semi").select("k", "items")
    items = in_few_tasks(items, docs)
    items = materialize(items.mapInArrow(_items, "k long, item long"))
    counts = in_few_tasks(items.groupBy(F.col("item").alias("i")).agg(F.count("*").alias("classes")), docs)
    shares = in_few_tasks(join_hot(items, shuffled(counts), {"item": "i"}, "inner"), docs)
    seen = shares.groupBy(F.col("k").alias("o")).agg(
        F.count("*").alias("n"), F.sum((F.col("classes") > 1).cast("long")).alias("common"),
        (F.sum("classes") / F.count("*")).alias("shared"),
    )
    least = in_few_tasks(rows.join(shuffled(seen), F.col("k") == F.col("o")).drop("o"), docs)
    small = in_few_tasks(least.groupBy(F.col("b").alias("s")).agg(F.min("n").alias("least")), docs)
    both = in_few_tasks(join_hot(least, shuffled(small), {"b": "s"}, "inner"), docs)
    open_ = 100 * F.col("common") >= percent * (F.col("n") + F.col("least") - F.col("common"))
    return both.filter(open_).drop("least")


# --- blocks of a bucket -----------------------------------------------------------------


def _bit_rows(batches):
    """(k, bits) of packed sets."""
    for batch in batches:
        sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
        for at in range(0, len(sets), 256):
            part = sets[at : at + 256]
            owner = np.repeat(np.arange(len(part)), [len(x) for x in part])
            sketch = sketches(np.concatenate(part), owner, len(part), CHECK_BITS)
            bits = np.packbits((mix(sketch) & np.uint64(1)).astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(part)), pa.array([x.tobytes() for x in bits], pa.binary())],
                names=["k", "bits"],
            )


def _disagreements(percent: int) -> int:
    """Bits in which two sketches of linked sets may differ."""
    p = (1 - percent / 100) / 2
    return int(CHECK_BITS * p + DEVIATIONS * (CHECK_BITS * p * (1 - p)) ** 0.5)


def _near_in_blocks(percent: int):
    """Pairs (a, b) of the rows of each (b, lo, hi), which come together."""
    most = _disagreements(percent)

    def pairs(bucket, lo, hi, block, k, c, n, bits, bands):
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        found = []
        for at in range(0, len(left), 32):
            own = left[at : at + 32]
            differ = np.bitwise_count(bits[own][:, None, :] ^ bits[right][None]).sum(axis=2, dtype=np.int32)
            near = (differ <= most) & (c[own][:, None] != c[right][None])
            near &= 100 * np.minimum(n[own][:, None], n[right]) >= percent * np.maximum(n[own][:, None], n[right])
            if lo == hi:
                near &= k[own][:, None] > k[right][None]
            x, y = np.nonzero(near)
            x, y = own[x], right[y]
            same = bands[x] == bands[y]
            first = bands[x, same.argmax(axis=1)] == bucket
            found.append(np.stack([k[x][first], k[y][first]]))
        both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both.max(axis=0)), pa.array(both.min(axis=0))], names=["a", "b"])

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if a == b:
                    continue
                if held and tuple(keys[a]) != key:
                    yield pairs(*key, *_group(held))
                    held = []
                key = tuple(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield pairs(*key, *_group(held))

    return run


def _group(parts: list[pa.RecordBatch]):
    """Columns of a group: block, k, c, n, bits as words, bands."""
    table = pa.Table.from_batches(parts)
    plain = [table.column(i).to_numpy() for i in range(3, 7)]
    bits = np.frombuffer(b"".join(table.column(7).to_pylist()), np.uint64).reshape(len(table), -1)
    bands = np.concatenate([p.column(8).flatten().to_numpy() for p in parts]).reshape(len(table), -1)
    return *plain, bits, bands


def _open_pairs(live: DataFrame, sets: DataFrame, bands: DataFrame, percent: int, docs: int) -> DataFrame:
    """Pairs (a, b) of open buckets that may be linked and are not joined yet."""
    keys = materialize(in_few_tasks(live.select(F.col("k").alias("o")).distinct(), docs))
    bits = sets.join(shuffled(keys), F.col("k") == F.col("o"), "left_semi").select("k", "items")
    bits = in_few_tasks(bits, docs).mapInArrow(_bit_rows, "k long, bits binary")
    traits = bits.join(shuffled(bands), F.col("k") == F.col("rid")).select(F.col("k").alias("o"), "bits", "bands")
    traits = in_few_tasks(traits, docs)
    blocks = live.groupBy(F.col("b").alias("s")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = in_few_tasks(join_hot(live.select("b", "k", "c", "n"), blocks, {"b": "s"}, "inner"), docs)
    rows = in_few_tasks(rows.join(shuffled(traits), F.col("k") == F.col("o")), docs)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parts = int(live.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = rows.select(
        "b", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "k", "c", "n", "bits", "bands",
    )
    dealt = rows.repartition(parts, "b", "lo", "hi").sortWithinPartitions("b", "lo", "hi")
    return dealt.mapInArrow(_near_in_blocks(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """Rows (id, n, component, _h): each row's set size and its component's smallest id."""
    spark = docs.sparkSession
    given = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    sketched = materialize(
        given.mapInArrow(
            _sketch_rows(k), f"id {kind}, n long, key binary, _h long, bands array<long>"
        )
    ).withColumn("rid", F.monotonically_increasing_id())
    count = sketched.count()
    classes = sketched.filter("n > 0").groupBy("key").agg(F.min("rid").alias("k"), F.min("id").alias("id"))
    classes = materialize(in_few_tasks(classes, count))
    chosen = classes.select("k")
    heads = in_few_tasks(sketched.join(chosen, F.col("rid") == F.col("k"), "left_semi"), count)
    members = heads.select(F.explode("bands").alias("b"), F.col("rid").alias("k"))
    shared = members.groupBy("b").agg(F.min("k").alias("head"), F.count("*").alias("size"))
    shared = in_few_tasks(shared.filter("size > 1").withColumnRenamed("b", "bucket"), count)
    found = materialize(in_few_tasks(join_hot(members, shuffled(shared), {"b": "bucket"}, "inner"), count))

    wanted = heads.join(found.select(F.col("k").alias("in")).distinct(), F.col("rid") == F.col("in"), "left_semi")
    wanted = materialize(in_few_tasks(wanted.select("_h", F.col("rid").alias("k")), count))
    sieve = spark.sparkContext.broadcast(sieve_of(wanted, "_h"))
    packed = given.mapInArrow(_set_rows(k, sieve), "_h long, items binary")
    packed = packed.join(wanted.withColumnRenamed("_h", "_w"), F.col("_h") == F.col("_w"))
    packed = in_few_tasks(packed.select("k", "items"), count)
    sets = materialize(in_few_tasks(packed.dropDuplicates(["k"]), count))

    pairs = found.filter("k <> head").select(F.col("k").alias("a"), F.col("head").alias("b"))
    checked = materialize(in_few_tasks(pairs.distinct(), count))
    links = materialize(_verified(checked, sets, percent, count))
    labels = components(links)
    named = _named(found.filter("size > 2").select("b", "k", "size"), labels)
    live = materialize(_live(materialize(_split_buckets(named, count)), sets, percent, count))
    live = materialize(_split_buckets(live, count))  # which reads its rows twice
    best = F.max(F.struct("shared", (-F.col("k")).alias("k")))
    typical = live.groupBy(F.col("b").alias("pb")).agg((-best["k"]).alias("p"))
    partners = live.join(shuffled(typical), (F.col("b") == F.col("pb")) & (F.col("k") == F.col("p")))
    partners = in_few_tasks(partners.select(F.col("pb").alias("sb"), "p", F.col("c").alias("pc")), count)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if not live.isEmpty():
        fresh = join_hot(live, shuffled(partners), {"b": "sb"}, "inner").filter("c <> pc and k <> p")
        fresh = in_few_tasks(fresh.select(F.greatest("k", "p").alias("a"), F.least("k", "p").alias("b")), count)
        fresh = in_few_tasks(fresh.distinct(), count)
        fresh = materialize(in_few_tasks(fresh.join(shuffled(checked), ["a", "b"], "left_anti"), count))
        links = materialize(links.unionAll(_verified(fresh, sets, percent, count)).coalesce(parts))
        labels = components(links)
        checked = in_few_tasks(checked.unionAll(fresh).coalesce(parts), count)
        live = materialize(_split_buckets(_named(live.drop("c"), labels), count))
    if not live.isEmpty():
        fresh = _open_pairs(live, sets, heads.select("rid", "bands"), percent, count)
        fresh = materialize(in_few_tasks(fresh.join(shuffled(checked), ["a", "b"], "left_anti"), count))
        more = materialize(_verified(fresh, sets, percent, count))
        if not more.isEmpty():
            labels = components(links.unionAll(more).coalesce(parts))

    reach = classes.join(shuffled(labels.withColumnRenamed("k", "m")), F.col("k") == F.col("m"), "left")
    reach = in_few_tasks(reach.select("key", "id", F.coalesce("c", "k").alias("c")), count)
    smallest = in_few_tasks(reach.groupBy(F.col("c").alias("g")).agg(F.min("id").alias("component")), count)
    of_class = in_few_tasks(join_hot(reach, shuffled(smallest), {"c": "g"}, "inner"), count)
    of_class = of_class.select(F.col("key").alias("class_key"), "component")
    rows = sketched.select("id", "n", "key", "_h")
    out = in_few_tasks(join_hot(rows, shuffled(of_class), {"key": "class_key"}, "left"), count)
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select("id", "n", component.alias("component"), "_h")


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """Whole rows of documents whose id is the smallest of their component."""
    near = materialize(near_duplicates(docs, key, text, k, percent))
    losers = near.filter(~F.col("id").eqNullSafe(F.col("component")))
    return without_rows(docs, losers, key, text)
