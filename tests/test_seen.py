"""The key set that lasts, over micro-batches, replays and compaction."""

import random

import pytest

from flowlark.operators.seen import SeenKeys
from flowlark.session import scratch_path


@pytest.fixture
def names(spark):
    return SeenKeys(spark, scratch_path(spark, "seen"), buckets=8)


def batches(n=4, size=300, keys=400, seed=1):
    rnd = random.Random(seed)
    return [[(b * size + i, rnd.choice([None, " ", f"k{rnd.randint(0, keys)}"])) for i in range(size)] for b in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string")


def flags(df):
    return {r["id"]: r["added"] for r in df.collect()}


def expected(parts):
    seen, out = set(), {}
    for rows in parts:
        for key, name in rows:
            out[key] = bool(name and name.strip()) and name not in seen
            seen.add(name)
    return out


def test_batches_and_replays(spark, names):
    parts = batches()
    want = expected(parts)
    for b, rows in enumerate(parts):
        got = flags(names.add(frame(spark, rows), "name", ["id"], b))
        assert got == {k: want[k] for k, _ in rows}
        for again in (b, max(b - 1, 0)):  # the same batch, and one that others came after
            rerun = flags(names.add(frame(spark, parts[again]).repartition(5), "name", ["id"], again))
            assert rerun == {k: want[k] for k, _ in parts[again]}
    assert names.keys().count() == sum(want.values()) == names.keys().distinct().count()


def test_compaction_keeps_the_set(spark, names):
    parts = batches()
    want = expected(parts)
    for b, rows in enumerate(parts[:2]):
        names.add(frame(spark, rows), "name", ["id"], b)
    names.compact(1)
    names.compact(1)
    assert {r["batch"] for r in names._read("keys").select("batch").distinct().collect()} == {-1}
    for b in (2, 3):
        got = flags(names.add(frame(spark, parts[b]), "name", ["id"], b))
        assert got == {k: want[k] for k, _ in parts[b]}
        names.compact(b)
    assert names.keys().count() == sum(want.values())


def test_full_filters_lose_and_add_nothing(spark):
    """One bucket, all of whose bits are set: every key is looked up."""
    names = SeenKeys(spark, scratch_path(spark, "seen"), buckets=1)
    many = spark.range(300_000).selectExpr("id", "cast(id as string) as name")
    assert names.add(many, "name", ["id"], 0).filter("added").count() == 300_000
    more = spark.range(299_000, 301_000).selectExpr("id", "cast(id as string) as name")
    got = names.add(more, "name", ["id"], 1)
    assert got.filter("added").count() == 1000 and got.filter("added and id < 300000").count() == 0


def test_empty_batches(spark, names):
    assert flags(names.add(frame(spark, []), "name", ["id"], 0)) == {}
    assert flags(names.add(frame(spark, [(1, None), (2, "a"), (3, "a")]), "name", ["id"], 1)) == {1: False, 2: True, 3: False}
    with pytest.raises(ValueError):
        names.add(frame(spark, []), "name", ["id"], -1)


def test_stream(spark, tmp_path, names):
    """As the sink of a stream, one file a micro-batch."""
    parts = batches(3)
    for rows in parts:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = {}
    sdf = spark.readStream.schema("id long, name string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        sdf.writeStream.foreachBatch(lambda df, b: got.update(flags(names.add(df, "name", ["id"], b))))
        .option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    want = expected(parts)
    assert got.keys() == want.keys() and sum(got.values()) == sum(want.values())
