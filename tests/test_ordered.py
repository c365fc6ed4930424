"""Order-dependent primitives against plain Python, with hot keys."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlark.operators import dedupe, documents, windows
from flowlark.operators.routing import REL
from flowlark.plans import folds, ordered

HOUR = 3_600_000_000


def hot_rows(n, seed=1, step=1800):
    """Half of the rows in one key, the rest in many; times may repeat."""
    rnd = random.Random(seed)
    rows, t = [], 0
    for i in range(n):
        t += rnd.choice([0, 1, step, 3 * step])
        key = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None, f"k{i % 40}"])
        value = None if rnd.random() < 0.1 else float(rnd.randint(-50, 50))
        rows.append((i, key, t * 1_000_000, value, rnd.randint(1, 4)))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def events(spark):
    rows = hot_rows(3000)
    df = spark.createDataFrame(rows, "id long, key string, us long, value double, want int")
    return rows, df.withColumn("ts", F.timestamp_micros("us")).repartition(5)


@pytest.fixture
def many(spark, parts):
    """Ordered rows fall into this many chunks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_running(events, many, parts):
    rows, df = events
    out = ordered.running(df, ["key"], ["ts", "id"], {"total": "value"}, "n")
    got = {r["id"]: (r["n"], r["total"]) for r in out.select("id", "n", "total").collect()}
    for group in by_key(rows).values():
        total = None
        for n, row in enumerate(group, 1):
            if row[3] is not None:
                total = row[3] + (total or 0.0)
            assert got[row[0]] == (n, total)
    assert len(got) == len(rows)


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_global_rank(events, many, parts):
    rows, df = events
    out = ordered.rank_rows(df, [], ["ts", "id"], "n")
    got = [r["id"] for r in out.orderBy("n").select("id").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))]


def expect_anchored(rows, width):
    elapsed = {}
    for group in by_key(rows).values():
        start = None
        for row in group:
            if row[3] is None:
                continue
            if start is None:
                start, total, n = row[2], row[3], 1
            elif row[2] - start >= width:
                elapsed[row[0]] = (total, n)
                start, total, n = row[2], row[3], 1
            else:
                total, n = total + row[3], n + 1
    return elapsed


@pytest.mark.parametrize("parts", [1, 8, 40])
@pytest.mark.parametrize("hours", [1, 7, 500])
def test_anchored_tumbling(events, many, parts, hours):
    rows, df = events
    out = windows.anchored_tumbling(df, "value", "ts", f"{hours} hours", ["key"], ["id"])
    counts = {r[REL]: r["n"] for r in out.groupBy(REL).agg(F.count("*").alias("n")).collect()}
    elapsed = out.filter(F.col(REL) == "elapsed").collect()
    got = {r["id"]: (r["window_sum"], r["window_count"]) for r in elapsed}
    assert got == expect_anchored(rows, hours * HOUR)
    bad = sum(r[3] is None for r in rows)
    assert counts["failure"] == bad and counts["success"] == len(rows) - bad


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_dedupe_age_off(events, many, parts):
    rows, df = events
    out = dedupe.identify_duplicates(df, "key", ["id"], ttl="5 hours", ts="ts")
    got = {r["id"]: r[REL] for r in out.select("id", REL).collect()}
    for key, group in by_key(rows).items():
        last = None
        for row in group:
            if key is None:
                want = "failure"
            elif last is None or row[2] - last >= 5 * HOUR:
                want, last = "non-duplicate", row[2]
            else:
                want = "duplicate"
            assert got[row[0]] == want


@pytest.mark.parametrize("parts", [1, 8, 40])
@pytest.mark.parametrize("varying", [False, True])
def test_batch_wait(events, many, parts, varying):
    rows, df = events
    want = F.col("want") if varying else F.lit(7)
    out = windows.batch_wait(
        df.withColumn("w", want.cast("string")), "key", "w", ["ts", "id"]
    )
    done = {r["id"] for r in out.filter(F.col(REL) == "batch-completed").collect()}
    expected = set()
    for key, group in by_key(rows).items():
        count = 0
        for row in group if key is not None else []:
            count += 1
            if count == (row[4] if varying else 7):
                expected.add(row[0])
                count = 0
    assert done == expected
    assert out.filter(F.col(REL) == "original").count() == len(rows)
    nameless = sum(r[1] is None for r in rows)
    assert out.filter(F.col(REL) == "failure").count() == nameless


def test_pending_with_changing_counts(events):
    rows, df = events
    out = windows.batch_pending(df, "key", "want", ["ts", "id"])
    got = {r["key"]: r["waiting"] for r in out.collect()}
    expected = {}
    for key, group in by_key(rows).items():
        count = 0
        for row in group if key is not None else []:
            count = 0 if count + 1 == row[4] else count + 1
        if count:
            expected[key] = count
    assert got == expected


def pieces(rnd, n):
    cuts = sorted(rnd.sample(range(n + 1), min(n + 1, 4)))
    return list(zip([0, *cuts], [*cuts, n]))


@pytest.mark.parametrize("seed", range(60))
def test_exit_tables(seed):
    """Reading a chunk through its table equals folding it from the entry state."""
    rnd = random.Random(seed)
    n, width = rnd.randint(0, 80), rnd.choice([1, 5, 20, 300])
    t = np.sort(np.array([rnd.randint(100, 100 + 4 * n) for _ in range(n)], dtype=np.int64))
    v = np.ma.MaskedArray(
        np.array([float(rnd.randint(-9, 9)) for _ in range(n)]),
        np.array([rnd.random() < 0.2 for _ in range(n)], dtype=bool),
    )
    want = np.array([rnd.randint(0, 6) for _ in range(n)], dtype=np.int64)
    ok = np.array([rnd.random() < 0.8 for _ in range(n)], dtype=bool)
    cases = [
        (folds.AnchoredFold(width), {"_t": t, "_v": v}, [(rnd.randint(0, 100), 3.0, 2) for _ in range(20)]),
        (folds.AgeOffFold(width), {"_t": t}, [(rnd.randint(0, 100), 0.0, 0) for _ in range(20)]),
        (folds.CounterFold(), {"_want": want, "_ok": ok}, [(c, 0.0, 0) for c in range(10)]),
    ]
    for fold, arrays, entries in cases:
        builder = fold.exits()
        for lo, hi in pieces(rnd, n):
            builder.feed({c: a[lo:hi] for c, a in arrays.items()})
        table = builder.table()
        for entry in entries:
            assert after(fold, table, entry) == fold.run(arrays, entry)[1]


def after(fold, table, state):
    """Exit state by the table, as the plan looks it up."""
    marks, exits, (_, total, rows) = table
    a, s, n = state
    if isinstance(fold, folds.CounterFold):
        return dict(zip(marks, exits)).get(a, (a + rows, 0.0, 0))
    width = fold.width if isinstance(fold, folds.AnchoredFold) else fold.ttl
    found = [x for m, x in sorted(zip(marks, exits)) if m >= a + width]
    if isinstance(fold, folds.AgeOffFold):
        return (found[0][0], 0.0, 0) if found else state
    return tuple(found[0]) if found else (a, s + total, n + rows)


@pytest.mark.parametrize("parts", [1, 13])
def test_odd_keys(spark, many, parts):
    """NaN, null and long texts are keys like any other, in any number of chunks."""
    keys = {0: "nan", 1: None, 2: "1.5"}
    rows = [(i, keys[i % 3], "x" * 3000 if i % 2 else None, 1_000 * i) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, k string, long string, us long")
    df = df.withColumns({"d": F.col("k").cast("double"), "ts": F.timestamp_micros("us")})
    out = ordered.running(df, ["d", "long"], ["id"], {"total": F.lit(1.0)}, "n").collect()
    last = {}
    for r in sorted(out, key=lambda r: r["id"]):
        key = (repr(r["d"]), r["long"])
        last[key] = last.get(key, 0) + 1
        assert r["n"] == last[key] and r["total"] == last[key]
    assert set(last.values()) == {150}
    one = windows.anchored_tumbling(df.withColumn("v", F.lit(1.0)), "v", "ts", "3 days", ["d"], ["id"])
    most = one.groupBy("d").agg(F.max("window_count").alias("n")).collect()
    assert {repr(r["d"]): r["n"] for r in most} == {"nan": 300, "None": 300, "1.5": 300}


@pytest.mark.parametrize("parts", [32])
def test_dense_key_takes_few_jobs(spark, many, parts):
    """One key, dense within one width: rounds grow with the logarithm of the chunks."""
    df = spark.range(20_000).select(
        "id", F.lit("one").alias("k"), F.timestamp_micros(F.col("id") * 10).alias("ts"), F.lit(1.0).alias("v")
    )
    sc = spark.sparkContext
    sc.setJobGroup("dense", "dense")
    out = windows.anchored_tumbling(df, "v", "ts", "70 milliseconds", ["k"], ["id"])
    elapsed = out.filter(F.col(REL) == "elapsed").select("id", "window_count").collect()
    jobs = len(sc.statusTracker().getJobIdsForGroup("dense"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, elapsed)) == [(7000, 7000), (14000, 7000)]
    assert jobs < 80


def expect_insert(rows, held, batch):
    seen, out, stopped = set(held), {}, False
    for pos, (row_id, key, payload) in enumerate(rows):
        if pos % batch == 0:
            stopped = False
        if payload == "bad":
            out[row_id] = "failure"
        elif stopped:
            out[row_id] = "failure"
        elif key in seen:
            out[row_id], stopped = "failure", True
        else:
            out[row_id] = "success"
            seen.add(key)
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("batch", [1, 5, 20])
def test_ordered_insert(spark, seed, batch):
    rnd = random.Random(seed)
    rows = [
        (i, f"k{rnd.randint(0, 60)}", "bad" if rnd.random() < 0.1 else "{}") for i in range(150)
    ]
    held = ["k1", "k2"]
    docs = spark.createDataFrame([(k,) for k in held], "key string")
    df = spark.createDataFrame(rows, "id long, key string, payload string")
    out = documents.insert(
        docs, df, "key", ["id"], ordered=True, batch_size=batch, payload="payload"
    )
    assert {r["id"]: r[REL] for r in out.collect()} == expect_insert(rows, held, batch)


@pytest.mark.parametrize("seed", range(12))
def test_ordered_insert_of_entangled_batches(spark, seed):
    """Keys that come three times and more, many of them in chains over batches."""
    rnd = random.Random(seed)
    n, batch = 240, rnd.choice([2, 3, 8])
    rows = []
    for i in range(n):
        near = rnd.choice([f"k{i // batch}", f"k{i // batch - 1}", f"k{rnd.randint(0, n // batch)}", f"u{i}"])
        rows.append((i, near, "bad" if rnd.random() < 0.03 else "{}"))
    held = ["k0", "k7"]
    docs = spark.createDataFrame([(k,) for k in held], "key string")
    df = spark.createDataFrame(rows, "id long, key string, payload string")
    out = documents.insert(docs, df, "key", ["id"], ordered=True, batch_size=batch, payload="payload")
    assert {r["id"]: r[REL] for r in out.collect()} == expect_insert(rows, held, batch)


@pytest.mark.parametrize("batches", [16, 128])
def test_chains_take_logarithmic_rounds(spark, monkeypatch, batches):
    rows = []
    for i in range(batches):
        rows += [(3 * i, f"a{i}", "{}"), (3 * i + 1, f"c{i - 1}", "{}"), (3 * i + 2, f"c{i}", "{}")]
    df = spark.createDataFrame(rows, "id long, key string, payload string")
    docs = spark.createDataFrame([("c-1",)], "key string")
    written = []
    keep = documents.materialize
    monkeypatch.setattr(documents, "materialize", lambda df: written.append(df.columns) or keep(df))
    out = documents.insert(docs, df, "key", ["id"], ordered=True, batch_size=3, payload="payload")
    assert {r["id"]: r[REL] for r in out.collect()} == expect_insert(rows, ["c-1"], 3)
    rounds = sum(c == ["_batch", "_to", "_turned", "_fails"] for c in written)
    assert rounds <= 2 * math.log2(batches)


def test_ordered_insert_of_a_long_chain(spark):
    """Each batch's stop depends on the batch before it."""
    rows = []
    for i in range(6):
        # The second row fails only if the batch before wrote its third key.
        rows += [(3 * i, f"a{i}", "{}"), (3 * i + 1, f"c{i - 1}", "{}"), (3 * i + 2, f"c{i}", "{}")]
    df = spark.createDataFrame(rows, "id long, key string, payload string")
    docs = spark.createDataFrame([("c-1",)], "key string")
    out = documents.insert(docs, df, "key", ["id"], ordered=True, batch_size=3, payload="payload")
    want = expect_insert(rows, ["c-1"], 3)
    assert set(want.values()) == {"success", "failure"}
    assert {r["id"]: r[REL] for r in out.collect()} == want


# --- folds on whole arrays ------------------------------------------------------------


def plain_anchored(rows, width, state):
    """Rows (t, v or None, new key) one by one."""
    out = []
    for t, v, new in rows:
        if new:
            state = None
        if v is None:
            out.append((None, None, False))
        elif state is None:
            state = (t, v, 1)
            out.append((v, 1, False))
        elif t - state[0] >= width:
            out.append((state[1], state[2], True))
            state = (t, v, 1)
        else:
            state = (state[0], state[1] + v, state[2] + 1)
            out.append((state[1], state[2], False))
    return out, state


def plain_counter(rows, count):
    done = []
    for want, ok, new in rows:
        count = (0 if new else count) + ok
        done.append(ok and count == want)
        count = 0 if done[-1] else count
    return done, count


@pytest.mark.parametrize("seed", range(200))
def test_folds_equal_rows_one_by_one(seed):
    rnd = random.Random(seed)
    n, width = rnd.randint(1, 90), rnd.choice([1, 3, 10, 50, 1000, 1 << 61])
    share = rnd.choice([0, 0.1, 0.6])
    changes = np.array([rnd.random() < share for _ in range(n - 1)], dtype=bool)
    new = [False, *changes.tolist()]
    t, now = [], rnd.randint(0, 50)
    for i in range(n):
        now = rnd.randint(0, 60) if new[i] else now + rnd.choice([0, 0, 1, 2, 7, 30])
        t.append(now)
    v = [None if rnd.random() < 0.2 else rnd.choice([rnd.uniform(-9, 9), 1e18, float("inf")]) for _ in range(n)]
    arrays = {
        "_t": np.array(t), "_v": np.ma.MaskedArray([x or 0.0 for x in v], [x is None for x in v]),
        "_want": np.array([rnd.randint(-1, 6) for _ in range(n)]), "_ok": np.array([rnd.random() < 0.8 for _ in range(n)]),
    }
    state = rnd.choice([None, (rnd.randint(-100, 0), 1.5, 2)])
    got, after_rows = folds.AnchoredFold(width).run(arrays, state, changes)
    want, end = plain_anchored(list(zip(t, v, new)), width, state)
    assert repr(after_rows) == repr(end)
    shown = zip(got["window_sum"].tolist(), got["window_count"].tolist(), got["_elapsed"].tolist())
    assert [repr(x) for x in shown] == [repr(x) for x in want]

    got, after_rows = folds.AgeOffFold(width).run(arrays, state, changes)
    want, end = plain_anchored([(a, 1.0, b) for a, b in zip(t, new)], width, state)
    opens = [e or (c == 1 and not e and (b or i == 0 and state is None)) for i, ((_, c, e), b) in enumerate(zip(want, new))]
    assert got["_fresh"].tolist() == opens and after_rows[0] == end[0]

    count = rnd.randint(0, 8)
    got, after_rows = folds.CounterFold().run(arrays, (count, 0.0, 0), changes)
    want, end = plain_counter(list(zip(arrays["_want"].tolist(), arrays["_ok"].tolist(), new)), count)
    assert got["_done"].tolist() == want and after_rows[0] == end


def test_exits_touch_only_windows_that_end():
    """A dense chunk costs as much as its rows; openings that share an exit are one row."""
    class Counted(folds.JumpExits):
        touched = 0

        def _due(self, t):
            paths, rows = super()._due(t)
            self.touched += len(paths)
            return paths, rows

    for step, width, left in [(1, 10**9, 60_000), (1, 700, 701), (10, 5, 1), (3, 299, 101)]:
        exits = Counted(width)
        t = np.arange(60_000) * step
        for lo in range(0, len(t), 500):
            exits.feed({"_t": t[lo : lo + 500], "_v": np.ma.MaskedArray(np.ones(500))})
        entries, states, _ = exits.table()
        assert len(entries) == len(states) <= left
        assert exits.touched <= 2 * len(t)


def test_only_read_columns_are_written(spark, monkeypatch):
    """Payload columns are joined back; no checkpoint has them."""
    written = []
    keep = ordered.materialize
    monkeypatch.setattr(ordered, "materialize", lambda df: written.append(df.columns) or keep(df))
    rows = [(i, i % 3, 1_000_000 * i, float(i), "x" * 500) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k long, us long, v double, payload string")
    df = df.withColumn("ts", F.timestamp_micros("us")).drop("us")
    made = [
        windows.running_tumbling(df, "v", "ts", "1 hour", ["k"], ["id"]),
        windows.anchored_tumbling(df, "v", "ts", "1 minute", ["k"], ["id"]),
        dedupe.identify_duplicates(df, "k", ["id"], ttl="1 minute", ts="ts"),
        windows.batch_wait(df.withColumn("n", F.lit("3")), "k", "n", ["id"]),
        ordered.rank_rows(df, [], ["id"]),
    ]
    for out in made:
        assert out.filter(F.length("payload") == 500).select("id").distinct().count() == 300
    assert written and not any("payload" in columns for columns in written)
