"""Streaming twins over several micro-batches equal the batch results."""

import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlark.operators import dedupe, points, project, routing, stats, windows
from flowlark.operators.routing import REL
from flowlark.plans.folds import CounterFold
from flowlark.sources.files import read_stream_files
from flowlark.streaming import stateful
from flowlark.streaming.run import PROVIDER, ROCKS, drain, route_batches

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    """Events in five files in time order; one file is one micro-batch."""
    folder = tmp_path_factory.mktemp("events")
    events = spark.read.parquet(EVENTS).withColumn("ts", F.col("ts").cast("timestamp")).drop("props")
    bounds = events.approxQuantile("event_id", [0.2, 0.4, 0.6, 0.8], 0)
    edges = [-1, *bounds, 10**9]
    for lo, hi in zip(edges, edges[1:]):
        part = events.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi))
        part.coalesce(1).write.mode("append").parquet(str(folder / "in"))
        time.sleep(0.05)
    return str(folder / "in"), spark.read.parquet(str(folder / "in"))


def source(spark, split_events):
    path, batch = split_events
    return read_stream_files(spark, path, batch.schema, max_files=1)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_events_are_in_time_order(split_events):
    batch = split_events[1]
    assert batch.orderBy("ts", "event_id").select("event_id").collect() == batch.orderBy(
        "event_id"
    ).select("event_id").collect()


def test_anchored(spark, split_events):
    args = ("value", "ts", "24 hours", ["user_id"], ["event_id"])
    mine = drain(stateful.anchored_stream(source(spark, split_events), *args))
    want = windows.anchored_tumbling(split_events[1], *args)
    columns = ("event_id", REL, F.round("window_sum", 6), "window_count")
    assert rows(mine, *columns) == rows(want, *columns)


@pytest.mark.parametrize("watermark", [None, "1 hour"])
def test_dedupe(spark, split_events, watermark):
    mine = drain(
        stateful.dedupe_stream(source(spark, split_events), "user_id", ["event_id"], "6 hours", "ts", watermark)
    )
    want = dedupe.identify_duplicates(split_events[1], "user_id", ["event_id"], ttl="6 hours", ts="ts")
    assert rows(mine, "event_id", REL) == rows(want, "event_id", REL)


def test_distinct(spark, split_events):
    mine = drain(stateful.distinct_stream(source(spark, split_events), "user_id"))
    assert mine.count() == split_events[1].select("user_id").distinct().count()
    once = stateful.distinct_stream(source(spark, split_events), "event_id", "ts", "1 hour")
    assert drain(once).count() == split_events[1].count()


def test_batch_wait(spark, split_events):
    want_column = F.when(F.col("event_id") % 2 == 0, "3").otherwise("2")
    sdf = source(spark, split_events).withColumn("want", want_column)
    mine = drain(stateful.batch_wait_stream(sdf, "user_id", "want", ["event_id"]))
    batch = split_events[1].withColumn("want", want_column)
    want = windows.batch_wait(batch, "user_id", "want", ["event_id"])
    assert rows(mine, "event_id", REL) == rows(want, "event_id", REL)


class _Handle:
    """States in a dict, for a bucket without a stream."""

    def __init__(self):
        self.held = {}

    def getMapState(self, *_):
        return self

    def exists(self):
        return bool(self.held)

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value


def test_keys_of_a_bucket_share_a_frame():
    folding = stateful.Folding(CounterFold(), ["c0"], {"_want": "c1", "_ok": "c2"}, {"o0": "_done"}, None)
    handle = _Handle()
    folding.init(handle)

    def batch(rows_):
        pdf = pd.DataFrame(rows_, columns=["c0", "key"]).assign(c1=2, c2=True, bucket=7)
        (out,) = folding.handleInputRows((7,), iter([pdf[:2], pdf[2:]]), None)
        assert list(out.columns) == ["c0", "c1", "c2", "o0"]
        return dict(zip(out["c0"].tolist(), out["o0"].tolist()))

    assert batch([(3, "a"), (1, "b"), (2, "a"), (4, "c")]) == {1: False, 2: False, 3: True, 4: False}
    assert batch([(6, "b"), (5, "a"), (7, "d")]) == {5: False, 6: True, 7: False}
    assert {k[0]: v[0] for k, v in handle.held.items()} == {"a": 1, "b": 0, "c": 1, "d": 1}


def test_batch_wait_keeps_long_numbers_beside_nulls(spark, tmp_path):
    odd = spark.range(60).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 2 + 9_007_199_254_740_993).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") + 9_007_199_254_740_993).alias("big"), F.lit("2").alias("want"),
    )
    for i in range(2):
        odd.filter(F.floor(F.col("id") / 31) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    sdf = read_stream_files(spark, str(tmp_path / "in"), odd.schema, max_files=1)
    mine = drain(stateful.batch_wait_stream(sdf, "k", "want", ["id"]))
    want = windows.batch_wait(odd, "k", "want", ["id"])
    columns = ("id", REL, F.coalesce(F.col("k").cast("string"), F.lit("")), F.coalesce(F.col("big").cast("string"), F.lit("")))
    assert rows(mine, *columns) == rows(want, *columns)


def test_null_keys_take_no_rows_of_other_keys(spark, tmp_path):
    """One partition holds null and other keys; each keeps its windows."""
    odd = spark.range(200).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 10 > 0, F.col("id") % 10).alias("user_id"),
        F.timestamp_micros(F.col("id") * 3_600_000_000).alias("ts"), F.col("id").cast("double").alias("value"),
    )
    odd.coalesce(1).write.parquet(str(tmp_path / "in"))
    args = ("value", "ts", "24 hours", ["user_id"], ["event_id"])
    mine = drain(stateful.anchored_stream(read_stream_files(spark, str(tmp_path / "in"), odd.schema), *args))
    want = windows.anchored_tumbling(odd, *args)
    columns = ("event_id", REL, F.coalesce("window_sum", F.lit(-1.0)), F.coalesce("window_count", F.lit(-1)))
    assert rows(mine, *columns) == rows(want, *columns)


def test_watermarked_windows(spark, split_events):
    mine = drain(
        windows.tumbling(source(spark, split_events), "value", "ts", "6 hours", watermark="2 hours")
    )
    want = windows.tumbling(split_events[1], "value", "ts", "6 hours")
    last = split_events[1].agg(F.max("ts")).first()[0]
    end = F.col("window_start") + F.expr("interval 8 hours")
    columns = ("window_start", "window_count")
    assert rows(mine, *columns) == rows(want.filter(end <= F.lit(last)), *columns)
    report = drain(
        stats.interval_moments(source(spark, split_events), "value", "ts", "1 day", watermark="1 day")
    )
    assert report.count() > 0


def test_record_operators_run_on_streams(spark, split_events):
    def work(df):
        routed = routing.route_bitmask(df, "user_id", {"one": 1, "two": 2}, flip=True)
        named = routed.withColumnRenamed(REL, "route")
        hashed = project.md5_columns(named, {"h": F.col("event_type")}).drop(REL)
        text = project.render_template(hashed, "{{ event_type }}/{{ user_id }}")
        made = project.render_json(text, '{"id": "{{ event_id:int }}"}', into="json")
        return made.select("event_id", "route", "routed_value", "h", "content", "json", REL)

    batch = work(split_events[1])
    assert rows(drain(work(source(spark, split_events))), *batch.columns) == rows(batch, *batch.columns)

    def points_of(df):
        tags = F.concat(F.lit("type="), "event_type")
        made = points.to_points(
            df, F.lit("event"), tags, {"v": F.col("value")}, ts=F.unix_millis("ts"), keep=["event_id"]
        )
        return made.select("event_id", points.line_text().alias("line"), REL)

    batch = points_of(split_events[1])
    assert rows(drain(points_of(source(spark, split_events))), *batch.columns) == rows(batch, *batch.columns)


def test_delay(spark, split_events):
    path, batch = split_events
    sdf = read_stream_files(spark, path, batch.schema).withColumn(
        "wait", F.when(F.col("event_id") % 2 == 0, 0).otherwise(300)
    )
    held = stateful.delay_stream(sdf, "event_type", "wait", grain="1 second")
    spark.conf.set(PROVIDER, ROCKS)
    query = held.writeStream.format("memory").queryName("held").outputMode("append").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            if spark.table("held").count() >= batch.count():
                break
            time.sleep(0.5)
        got = spark.table("held")
        assert rows(got, "event_id", "ts", "value") == rows(batch, "event_id", "ts", "value")
    finally:
        query.stop()
        spark.conf.unset(PROVIDER)


ODD = """select id, case when id % 5 = 0 then null else id * 1000000000000001 end as big, id % 3 = 0 as flag,
  cast(id as decimal(30, 7)) / 3 as price, date '0001-01-02' + cast(id as int) as day,
  timestamp_ntz '1883-11-18 12:03:58.000001' as ntz, array(named_struct('a', id, 'b', 'x')) as list,
  timestamp_micros(1700000000000000 + id * 1000000) as ts, cast(id % 7 * 1000 as string) as wait from range(400)"""


def test_delay_by_event_time_keeps_typed_rows(spark, tmp_path):
    """Rows of one key leave when the watermark passes their own time, whole."""
    odd = spark.sql(ODD)
    for i in range(4):
        odd.filter(F.floor(F.col("id") / 100) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    sdf = read_stream_files(spark, str(tmp_path / "in"), odd.schema, max_files=1)
    bad = F.when(F.col("id") == 399, "soon").otherwise(F.col("wait"))
    out = drain(stateful.delay_stream(sdf, "flag", bad, ts="ts", watermark="10 seconds", grain="30 seconds"))
    last = 1_700_000_000_000 + 399_000 - 10_000
    due = F.unix_millis("ts") + F.col("wait").cast("long")
    want = odd.withColumn(REL, F.when(F.col("id") == 399, "failure").when(due <= last, "success"))
    want = want.filter(F.col(REL).isNotNull())
    assert want.count() > 380
    assert sorted(map(str, out.collect())) == sorted(map(str, want.select(out.columns).collect()))


def test_delay_of_many_rows_under_one_key(spark, tmp_path):
    rows_ = spark.range(30_000).select("id", F.timestamp_millis(F.col("id") * 10).alias("ts"), F.lit("k").alias("k"))
    rows_.coalesce(1).write.parquet(str(tmp_path / "in"))
    sdf = read_stream_files(spark, str(tmp_path / "in"), rows_.schema)
    out = drain(stateful.delay_stream(sdf, "k", F.lit(60_000), ts="ts", watermark="1 second", grain="10 seconds"))
    released = (299_990 - 1000 - 60_000) // 10 + 1
    assert out.agg(F.count("*"), F.max("id")).first() == (released, released - 1)


def test_failed_records_have_no_state(spark, split_events):
    """Records without batch id or key never reach the stateful operator."""
    sdf = source(spark, split_events).withColumn("name", F.when(F.col("event_id") < 0, "x"))
    for out in (
        stateful.batch_wait_stream(sdf.withColumn("n", F.lit("2")), "name", "n", ["event_id"]),
        stateful.dedupe_stream(sdf, "name", ["event_id"], "6 hours", "ts", "1 hour"),
    ):
        query = out.writeStream.format("memory").queryName("stateless").trigger(availableNow=True)
        spark.conf.set(PROVIDER, ROCKS)
        running = query.start()
        spark.conf.unset(PROVIDER)
        running.awaitTermination()
        states = [o["numRowsTotal"] for p in running.recentProgress for o in p["stateOperators"]]
        assert states and set(states) == {0}


def test_keys_are_forgotten(spark, split_events):
    out = stateful.dedupe_stream(source(spark, split_events), "user_id", ["event_id"], "1 hour", "ts", "1 hour")
    spark.conf.set(PROVIDER, ROCKS)
    running = out.writeStream.format("memory").queryName("forgotten").trigger(availableNow=True).start()
    spark.conf.unset(PROVIDER)
    running.awaitTermination()
    left = running.recentProgress[-1]["stateOperators"][0]["customMetrics"]["numDeletedTimers"]
    assert left > 0


def test_outputs_to_own_sinks(spark, split_events, tmp_path):
    sdf = source(spark, split_events).withColumn(
        REL, F.when(F.col("event_type") == "error", "bad").otherwise("good")
    )

    def to(name):
        return lambda df, epoch: df.write.mode("append").parquet(str(tmp_path / name))

    query = (
        sdf.writeStream.foreachBatch(route_batches({"bad": to("bad"), "good": to("good")}))
        .option("checkpointLocation", str(tmp_path / "log"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    batch = split_events[1]
    bad = spark.read.parquet(str(tmp_path / "bad")).count()
    good = spark.read.parquet(str(tmp_path / "good")).count()
    assert bad == batch.filter("event_type = 'error'").count() and bad + good == batch.count()


def test_read_files_are_archived(spark, tmp_path):
    src = tmp_path / "src"
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").json(str(src))
        time.sleep(0.05)
    sdf = read_stream_files(
        spark, str(src), "id long", "json", "archive", str(tmp_path / "done"), max_files=1
    )
    assert rows(drain(sdf), "id") == [(0,), (1,), (2,)]
    deadline = time.time() + 20
    while not list((tmp_path / "done").rglob("*.json")) and time.time() < deadline:
        time.sleep(0.2)
    assert list((tmp_path / "done").rglob("*.json"))
    with pytest.raises(ValueError):
        read_stream_files(spark, str(src), "id long", completion="burn")
    with pytest.raises(ValueError):
        read_stream_files(spark, str(src), "id long", completion="archive")
