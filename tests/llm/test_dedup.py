"""Exact and near de-duplication against brute force."""

import hashlib
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from plain_versions import brute_components, shingles
from pyspark.sql import functions as F

from flowlark.llm import common, exact_dedup, near_dedup
from flowlark.session import materialize
from awkward import EDGES, PROSE, documents


def _norm(text):
    return (text or "").encode().lower()


def _exact(df):
    return [
        (r["row"]["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["sha"]).hex())
        for r in exact_dedup.exact_duplicates(df).collect()
    ]


def test_exact_edges(edges):
    got = _exact(edges)
    assert len(got) == len(EDGES)
    groups = {}
    for i, text, *_ in EDGES:
        groups.setdefault(_norm(text), []).append(i)
    by_sum = {hashlib.sha256(k).hexdigest(): v for k, v in groups.items()}
    for i, keep, size, _, sha in got:
        ids = [x for x in by_sum[sha] if x is not None]
        assert i in by_sum[sha] and size == len(by_sum[sha])
        assert keep == max(ids, default=None)
    for sha in by_sum:
        stays = [g for g in got if g[4] == sha and g[3]]
        assert len(stays) == 1 and stays[0][0] == stays[0][1]


def test_exact_lower_cases_ascii_only(spark):
    got = _exact(documents(spark, [(1, "É A", "", ""), (2, "é a", "", ""), (3, "É a", "", "")]))
    assert sorted((i, keep) for i, keep, *_ in got) == [(1, 3), (2, 2), (3, 3)]


def test_exact_hot_group_and_carry(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}", "en", "s") for i in range(3000)]
    df = documents(spark, rows).repartition(7)
    left = exact_dedup.drop_exact_duplicates(df)
    assert left.columns == df.columns
    kept = sorted(r.doc_id for r in left.select("doc_id").collect())
    assert kept == sorted([2997] + [i for i in range(3000) if i % 3])


def test_exact_empty(nothing):
    assert _exact(nothing) == []
    assert exact_dedup.drop_exact_duplicates(nothing).count() == 0


@pytest.mark.parametrize("n", [1, 2, 50, 3000])
@pytest.mark.parametrize("bits", [3, 20, 48])
def test_golomb_round_trip(n, bits):
    draw = np.random.default_rng(n)
    values = np.unique(draw.integers(0, 1 << bits, n, dtype=np.uint64))
    code = exact_dedup.golomb(values)
    assert (exact_dedup.ungolomb(code) == values).all()
    assert len(code) < 20 + len(values) * (bits - np.log2(max(len(values), 1)) + 4) / 8


def _near(df, k=4):
    rows = near_dedup.near_duplicates(df, k=k).collect()
    return sorted(((r["id"], r["n"], r["component"]) for r in rows), key=repr)


def test_near_edges(edges):
    got = _near(edges)
    assert len(got) == len(EDGES)
    want = brute_components([(r[0], r[1]) for r in EDGES], 4)
    assert got == sorted(want, key=repr)


def test_near_families(spark):
    """Families of edits, some of them chains whose ends are not linked."""
    draw = random.Random(4)
    rows = []
    for family in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([6, 40, 200]))]
        for _ in range(draw.choice([1, 3, 25])):
            words = list(words)
            for _ in range(draw.choice([0, 1, 1, 2])):
                words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(words), "en", "s"))
    draw.shuffle(rows)
    want = brute_components([r[:2] for r in rows], 4)
    assert len({w[2] for w in want}) < len(rows)
    assert _near(documents(spark, rows)) == sorted(want, key=repr)


def test_near_stage_keeps_one_of_each_group(spark):
    near = PROSE.replace("evening", "night")
    rows = [(5, PROSE * 3, "en", "a"), (2, PROSE * 2 + near, "en", "a"), (9, "something else entirely", "en", "b"), (1, None, "", "")]
    df = documents(spark, rows)
    left = near_dedup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.select("doc_id").collect()) == [1, 2, 9]


def test_near_empty(nothing):
    assert _near(nothing) == []
    assert near_dedup.drop_near_duplicates(nothing).count() == 0


def test_sketch_fills_every_bin_and_estimates_similarity():
    draw = np.random.default_rng(1)
    for n in (1, 2, 30, 4000):
        items = draw.integers(0, 1 << 62, n, dtype=np.uint64)
        sketch = near_dedup.sketches(items, np.zeros(n, np.int64), 1)
        assert (sketch != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    base = draw.integers(0, 1 << 62, 1200, dtype=np.uint64)
    a, b = base[:1000], base[200:]
    both = near_dedup.sketches(np.concatenate([a, b]), np.repeat([0, 1], 1000), 2)
    same = (both[0] == both[1]).mean()
    assert abs(same - 800 / 1200) < 0.12


def test_words_and_grams_match_plain_python():
    import pyarrow as pa

    texts = [t for _, t, *_ in EDGES if t is None or len(t) < 9999] + ["\x1c a\x85b c"]
    data, starts = common.text_bytes(pa.array(texts))
    for chunk in (3, 64, 1 << 19):
        words, firsts = common.hashed_words(data, starts, common.SPACED, chunk=chunk)
        plain = [_norm(t).split() for t in texts]
        assert np.diff(firsts).tolist() == [len(p) for p in plain]
        names = {}
        for w, h in zip([w for p in plain for w in p], words.tolist()):
            assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)
    found, bounds = common.grams(words, firsts, 4)
    names = {}
    for i, t in enumerate(texts):
        own = found[bounds[i] : bounds[i + 1]].tolist()
        for gram, h in zip(shingles(t, 4, as_list=True), own, strict=True):
            assert names.setdefault(gram, h) == h
    assert len(set(names.values())) == len(names)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.k: r.c for r in common.components(links).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


@pytest.mark.parametrize("few", [0, 1000])
def test_few_links_stay_in_one_partition(spark, monkeypatch, few):
    monkeypatch.setattr(common, "FEW_LINKS", few)
    rows = [(i, i + 1) for i in range(40)] + [(50, 60), (50, 70)]
    links = spark.createDataFrame(rows, "a long, b long").repartition(5)
    got = common.components(links)
    assert {r.k: r.c for r in got.collect()} == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 70: 50}
    if few:
        assert got.rdd.getNumPartitions() == 1


def test_shuffle_files_go_with_a_checkpoint(spark):
    """The rows stay, the shuffle behind them does not wait for a garbage collection."""
    local = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = set(local.rglob("shuffle_*.data"))
    kept = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    deadline = time.time() + 20
    while set(local.rglob("shuffle_*.data")) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not set(local.rglob("shuffle_*.data")) - before
    assert kept.count() == 7


def _family(count, seed, low, high):
    """Texts of one origin, changed so that many pairs lie near the threshold."""
    draw = random.Random(seed)
    origin = [f"w{i}" for i in range(120)]
    rows = []
    for key in range(count):
        words = list(origin)
        for _ in range(draw.randint(low, high)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        rows.append((key, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 16])
def test_family_at_the_threshold(spark, monkeypatch, block):
    """Every link of a family that is one large bucket, most pairs of which just miss."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = _family(140, 3, 2, 4) + [(500 + i, t, "en", "s") for i, t, _, _ in _family(60, 4, 4, 7)]
    out = near_dedup.near_duplicates(documents(spark, rows), k=4, percent=80)
    got = sorted((r["id"], r["n"], r["component"]) for r in out.collect())
    want = sorted(brute_components([(i, t) for i, t, _, _ in rows], 4))
    assert 20 < len({c for _, _, c in want}) < 180
    assert got == want


def test_bits_of_linked_sets_rarely_differ_more(spark):
    """Recall of the longer sketch at the threshold, and what it lets through below it."""
    draw = np.random.default_rng(2)
    most, near, far = near_dedup._disagreements(80), 0, 0
    for _ in range(300):
        base = draw.integers(1, 1 << 62, 400, dtype=np.uint64)
        for share, what in ((0.8, "near"), (0.6, "far")):
            both = int(round(180 * 2 * share / (1 + share)))
            one, two = base[:180], np.concatenate([base[:both], base[200 : 200 + 180 - both]])
            owner = np.repeat([0, 1], [len(one), len(two)])
            sketch = near_dedup.sketches(np.concatenate([one, two]), owner, 2, near_dedup.CHECK_BITS)
            bits = (near_dedup.mix(sketch) & np.uint64(1)).astype(bool)
            hit = int((bits[0] ^ bits[1]).sum()) <= most
            near, far = near + (hit and what == "near"), far + (hit and what == "far")
    assert near == 300 and far == 0


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 40
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)


def test_few_documents_take_few_tasks(spark, many_partitions):
    """The driver keeps something of every task, so partitions that are set do not make them all."""
    rows = _family(60, 3, 2, 4) + [(100, None, "en", "s"), (101, "", "en", "s"), (102, "one two", "en", "s")]
    docs = documents(spark, rows).coalesce(2)
    sc = spark.sparkContext
    sc.setJobGroup("few-documents", "near duplicates")
    try:
        got = sorted((r.id, r.n, r.component) for r in near_dedup.near_duplicates(docs, k=4).collect())
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == sorted(brute_components([r[:2] for r in rows], 4))
    told = sc.statusTracker()
    stages = {s for j in told.getJobIdsForGroup("few-documents") for s in told.getJobInfo(j).stageIds}
    tasks = sum(i.numTasks for i in map(told.getStageInfo, stages) if i and i.numCompletedTasks)
    assert tasks < 25 * many_partitions, tasks


def test_rows_of_many_documents_keep_their_partitions(spark, many_partitions):
    rows = spark.range(100).repartition(40, "id")
    assert common.in_few_tasks(rows, 5000).rdd.getNumPartitions() == 2
    assert common.in_few_tasks(rows, 0).rdd.getNumPartitions() == 1
    assert common.in_few_tasks(rows, 40 * common.TASK_DOCS).rdd.getNumPartitions() == 40


def _digits(rows):
    """Of the size in bytes that Spark expects, which it writes as 1.23E+45 B from 2 ZiB on."""
    power = re.search(r"E\+(\d+)", rows._jdf.queryExecution().optimizedPlan().stats().toString())
    return int(power[1]) if power else 0


@pytest.mark.parametrize("few", [0, 1000])
def test_guessed_sizes_do_not_grow_with_the_rounds(spark, monkeypatch, few):
    """The driver's memory held numbers whose digits doubled with every round."""
    monkeypatch.setattr(common, "FEW_LINKS", few)
    links = materialize(spark.range(120).select("id", (F.col("id") + 1).alias("b")).toDF("a", "b"))
    got = common.components(links)
    assert _digits(got) < 60
    assert {r.c for r in got.collect()} == {0}
