"""Mixing, line rules, sharding and packing against plain versions and invariants."""

import collections
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from awkward import EDGES, PROSE, documents
from pyspark.sql import functions as F

from flowlark.llm import line_rules, mixing, packing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def count(text):
    return len(WORD.findall(text or ""))


def _plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return {**target, **{s: level * w[s] for s in free}}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def _sizes(rows):
    out = collections.Counter()
    for _, text, _, source in rows:
        out[source] += count(text)
    return out


def _check_mix(spark, rows, near):
    got = mixing.mix_sizes(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_size = _sizes(rows)
    want = _plain_targets(by_size)
    taken = collections.Counter()
    targets = {}
    source_of = {r[0]: r[3] for r in rows}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert r["source_size"] == by_size[source_of[r["id"]]]
        taken[source_of[r["id"]]] += r["taken"]
        targets[source_of[r["id"]]] = r["target"]
    for s in by_size:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= near(s)
    return got


def test_mix_edges(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(EDGES)]
    longest = collections.defaultdict(int)
    for r in rows:
        longest[r[3]] = max(longest[r[3]], count(r[1]))
    _check_mix(spark, rows, lambda s: longest[s])


def test_mix_is_near_and_repeats(spark):
    draw = random.Random(1)
    rows = []
    for i in range(4000):
        source = "hot" if i % 3 == 0 else draw.choice(["a", "é", "z", None])
        rows.append((i, "w " * int(draw.paretovariate(0.9) * 5 % 3000), "en", source))
    sizes = _sizes(rows)
    first = _check_mix(spark, rows, lambda s: 0.002 * sizes[s] + 2)
    draw.shuffle(rows)
    again = mixing.mix_sizes(documents(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_mix_chances_follow_length(spark):
    rows = [(i, "w " * (4 if i % 2 else 400), "en", "abc"[i % 3]) for i in range(6000)]
    got = mixing.mix_sizes(documents(spark, rows)).filter("source_size * 2 > target").collect()
    mean = {n: np.mean([r["copies"] for r in got if r["size"] == n]) for n in (4, 400)}
    assert mean[400] > mean[4] > 0


def test_mix_stage_repeats_rows(spark):
    rows = [(i, f"{PROSE} {i}", "en", "ab"[i % 2]) for i in range(50)]
    df = documents(spark, rows)
    copies = {r["id"]: r["copies"] for r in mixing.mix_sizes(df).collect()}
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    got = collections.Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert got == collections.Counter({i: n for i, n in copies.items() if n})


def test_mix_empty(nothing):
    assert mixing.mix_sizes(nothing).count() == 0
    assert mixing.mix_documents(nothing).count() == 0


def _plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    places = collections.defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), n < 20 or 100 * len(covered) > 30 * n,
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_measures(spark, edges):
    draw = random.Random(2)
    texts = [" ".join(draw.choice("ab") for _ in range(draw.randrange(60))) for _ in range(60)]
    texts += [draw.choice("\n ").join(draw.choice(["a b", "c", "", "| x |"]) for _ in range(30)) for _ in range(30)]
    df = edges.unionAll(documents(spark, [(100 + i, t, "", "") for i, t in enumerate(texts)]))
    rows = line_rules.judge(df).select("row.doc_id", "row.text", *BASE).collect()
    assert len(rows) == len(EDGES) + len(texts)
    for r in rows:
        assert tuple(r[2:]) == _plain_base(r["text"]), r["text"]


def test_line_verdicts(spark):
    nav = "Home | News | About | Contact"
    junk = "qua*** vert### lom$$$ tri%%%"
    texts = {
        1: PROSE, 2: PROSE + "\n" + nav, 3: "\n".join([nav, junk] * 20), 4: PROSE + "\n\nA second paragraph, with its own words, follows here.",
        5: PROSE + "\nRead more\nAll rights reserved.", 6: " ".join(f"{junk} {i}" for i in range(9)),
        7: PROSE.replace(",", "").replace(".", ""),
    }
    df = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    got = {r["i"]: r for r in line_rules.judge(df).select(F.col("row.doc_id").alias("i"), "kept", "clean_text").collect()}
    assert {i for i, r in got.items() if r["kept"]} == {1, 2, 4, 5, 7}
    assert got[2]["clean_text"] == PROSE and got[5]["clean_text"] == PROSE
    assert got[4]["clean_text"] == texts[4]
    clean = line_rules.clean_documents(df)
    assert clean.columns == df.columns
    by_id = {r.doc_id: r for r in clean.select("doc_id", "text", "n_chars").collect()}
    assert set(by_id) == {1, 2, 4, 5, 7}
    assert by_id[2].text == PROSE and by_id[2].n_chars == len(PROSE)


def wrapped(text, width):
    lines = (text or "").split("\n")
    return "\n".join("\n".join(textwrap.wrap(x, width, break_long_words=False)) if x.strip() else x for x in lines)


@pytest.mark.parametrize("width", [40, 60])
def test_hard_line_breaks_change_few_verdicts(spark, width):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.filter("text is not null").limit(400).collect()]

    def judged(texts):
        df = spark.createDataFrame([(i, t) for (i, _), t in zip(rows, texts)], "doc_id long, text string")
        out = line_rules.judge(df).select("row.doc_id", "base_failed", "kept", "kept_chars", "line_chars").collect()
        return {r[0]: r for r in out if not r.base_failed}

    plain = judged([t for _, t in rows])
    broken = judged([wrapped(t, width) for _, t in rows])
    both = plain.keys() & broken.keys()
    assert len(both) > 300
    assert sum(plain[i].kept != broken[i].kept for i in both) <= 0.05 * len(both)
    shares = [sum(d[i].kept_chars for i in both) / sum(d[i].line_chars for i in both) for d in (plain, broken)]
    assert abs(shares[0] - shares[1]) < 0.05


def test_lines_and_their_neighbours(spark):
    story = wrapped(PROSE + " They walked on, and nobody said that they read more of the privacy policy than of the sea.", 40)
    menu = "Home\nNews\nAbout us\nContact"
    texts = {
        1: story, 2: menu + "\n\n" + story, 3: story + "\n\n" + menu + "\nAll rights reserved.",
        4: PROSE + " We say in our privacy policy, which is short, what is kept and why, and nothing more than that is kept.",
        5: "\n".join(["Home page", "News of the day", "About us all", "Contact form here"] * 8),
    }
    df = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    got = {r["i"]: r for r in line_rules.judge(df).select(F.col("row.doc_id").alias("i"), "kept", "clean_text").collect()}
    assert {i for i, r in got.items() if r["kept"]} == {1, 2, 3, 4}
    assert got[1]["clean_text"] == story and got[4]["clean_text"] == texts[4]
    assert got[2]["clean_text"].strip() == story and got[3]["clean_text"].strip() == story


def test_rules_empty(nothing):
    assert line_rules.judge(nothing).count() == 0
    assert line_rules.clean_documents(nothing).count() == 0


def _check_shards(rows, shards):
    counts = collections.Counter(r["shard"] for r in rows)
    even = [len(rows) // shards, -(-len(rows) // shards)]
    assert all(counts.get(s, 0) in even for s in range(shards))
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_edges(edges):
    rows = sharding.shard_rows(edges, shards=4).collect()
    assert len(rows) == len(EDGES)
    _check_shards(rows, 4)
    got = sorted(((r["id"], r["size"], r["text_crc32"]) for r in rows), key=repr)
    want = [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in EDGES]
    assert got == sorted(want, key=repr)


def test_shards_hold_groups_together(spark):
    texts = ["hot"] * 500 + [f"group {i // 4}" for i in range(400)] + [f"alone {i}" for i in range(700)]
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)])
    rows = sharding.shard_rows(df, shards=8).collect()
    _check_shards(rows, 8)
    where = collections.defaultdict(set)
    for r in rows:
        where[texts[r["id"]]].add(r["shard"])
    groups = [s for t, s in where.items() if t.startswith("group")]
    assert sum(len(s) == 1 for s in groups) >= 90
    assert len(where["hot"]) <= 8


def _cut(rows, texts):
    own = collections.Counter((texts[r["id"]], r["shard"]) for r in rows)
    pairs = lambda counts: sum(n * (n - 1) // 2 for n in counts)
    edges = pairs(collections.Counter(texts).values())
    return edges, edges - pairs(own.values())


@pytest.mark.parametrize("others", ["alone", "linked"])
def test_shards_hold_medium_and_large_groups(spark, others):
    """A group that fits is in one shard, a larger one in as few as hold it."""
    names = [f"other {i if others == 'alone' else i // 2}" for i in range(2000)]
    texts = ["one"] * 60 + ["two"] * 40 + ["hot"] * 700 + names
    random.Random(3).shuffle(texts)
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)])
    report = {}
    rows = sharding.shard_rows(df, shards=10, report=report).collect()
    _check_shards(rows, 10)
    where = collections.defaultdict(set)
    for r in rows:
        where[texts[r["id"]]].add(r["shard"])
    assert len(where["one"]) == len(where["two"]) == 1
    assert len(where["hot"]) == 3  # 280 rows in a shard
    assert sum(len(s) > 1 for t, s in where.items() if t.startswith("other")) <= 10
    assert (report["edges"], report["cut_edges"]) == _cut(rows, texts)


def test_shards_of_linked_rows_only(spark):
    """Whole groups give way to others, as nothing else can."""
    texts = [f"group {i // 25}" for i in range(500)] + [f"pair {i // 2}" for i in range(1500)]
    random.Random(5).shuffle(texts)
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)])
    rows = sharding.shard_rows(df, shards=10).collect()
    _check_shards(rows, 10)
    where = collections.defaultdict(set)
    for r in rows:
        where[texts[r["id"]]].add(r["shard"])
    assert all(len(s) == 1 for t, s in where.items() if t.startswith("group"))
    assert sum(len(s) > 1 for s in where.values()) <= 10


def test_shards_empty(nothing):
    assert sharding.shard_rows(nothing).count() == 0


def test_quotas_swap_and_fill():
    wishes = np.array([[0, 10, 0], [4, 0, 0], [0, 6, 0]])
    part = sharding.quotas(wishes, np.array([20, 20, 20]), 23)
    assert part[1, 0] == 1 and 0.4 < part[0, 1] < 1
    moved = (part * wishes).round(6)
    assert moved.sum(axis=0)[1] - moved.sum(axis=1)[1] <= 3


def _check_packing(rows, docs, lengths, overhead):
    want = collections.Counter()
    for i, text, *_ in docs:
        want[i] += count(text) + 1
    got = collections.Counter()
    bins = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        bins[r["bin_id"]].append(r)
    assert got == want
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        ends = np.cumsum([r["n_tokens"] for r in own])
        assert [r["bin_offset"] for r in own] == [0, *ends[:-1].tolist()]
        assert {r["bin_length"] for r in own} == {min(c for c in lengths if c >= ends[-1])}
    return bins


def test_packing_edges(edges):
    rows = packing.pack_documents(edges).collect()
    _check_packing(rows, EDGES, packing.LENGTHS, packing.OVERHEAD)


def test_packing_is_tight(spark):
    draw = random.Random(3)
    docs = [(i, "w " * int(draw.paretovariate(1.1) * 60 % 2500), "", "") for i in range(2500)]
    rows = packing.pack_documents(documents(spark, docs), group=1000).collect()
    bins = _check_packing(rows, docs, packing.LENGTHS, packing.OVERHEAD)
    used = sum(r["n_tokens"] for r in rows)
    assert used / sum(own[0]["bin_length"] for own in bins.values()) > 0.95


def test_pack_takes_the_best_fit():
    bins, offsets, final, _ = packing.pack(np.array([6, 5, 4, 3, 2]), (4, 10), 1, 1e9)
    assert len(set(bins.tolist())) == 2
    assert bins[0] == bins[2] and bins[1] == bins[3] == bins[4]
    assert set(final.tolist()) == {10}
    assert packing.pack(np.array([2]), (4, 10), 1, 1e9)[2].tolist() == [4]


def bins_of(found):
    """(opened, final) of every bin."""
    bins, _, final, opened = found
    return [(opened[i], final[i]) for i in np.unique(bins, return_index=True)[1]]


def cost_of(found, overhead, attention):
    return sum(packing.cost_of(int(c), overhead, attention) for _, c in bins_of(found))


def least_cost(sizes, lengths, overhead, attention):
    """Optimum over all ways to part the pieces."""
    best = float("inf")

    def place(i, fills):
        nonlocal best
        if i == len(sizes):
            best = min(best, sum(packing.cost_of(min(c for c in lengths if c >= f), overhead, attention) for f in fills))
            return
        for b in range(len(fills)):
            if fills[b] + sizes[i] <= max(lengths):
                place(i + 1, [*fills[:b], fills[b] + sizes[i], *fills[b + 1 :]])
        place(i + 1, [*fills, sizes[i]])

    place(0, [])
    return best


def test_packing_is_near_the_optimum():
    draw = random.Random(11)
    ratios = []
    for _ in range(60):
        lengths, overhead = draw.choice([(4, 10), (6, 9, 14), (5, 8, 13, 20)]), draw.choice([1, 3])
        attention = draw.choice([12, 40, 1e9])
        sizes = [draw.randint(1, max(lengths)) for _ in range(draw.randint(1, 7))]
        found = packing.pack(np.array(sizes), lengths, overhead, attention)
        mine, best = cost_of(found, overhead, attention), least_cost(sizes, lengths, overhead, attention)
        single = cost_of(one_length(sizes, lengths, overhead, attention), overhead, attention)
        assert best <= mine + 1e-9 and mine <= single + 1e-9
        ratios.append(mine / best)
    assert np.mean(ratios) < 1.03 and max(ratios) < 1.35


def one_length(sizes, lengths, overhead, attention):
    """Best fit with the longest length alone, then downsized."""
    bins, offsets, _, opened = packing.pack(np.array(sizes), lengths[-1:], overhead, attention)
    ends = np.zeros(bins.max() + 1, int)
    np.maximum.at(ends, bins, offsets + np.array(sizes))
    final = np.array([min(c for c in lengths if c >= e) for e in ends])
    return bins, offsets, final[bins], opened


@pytest.mark.parametrize("kind", ["uniform", "short", "long tail", "two kinds"])
def test_lengths_are_chosen_jointly(kind):
    """Other bins than those of one length, where that costs less, and never more."""
    draw = np.random.default_rng(5)
    sizes = {
        "uniform": draw.integers(1, 2049, 5000),
        "short": np.minimum(draw.geometric(1 / 150, 5000), 2048),
        "long tail": np.clip(draw.lognormal(6, 1, 5000).astype(int) + 1, 1, 2048),
        "two kinds": np.concatenate([draw.integers(1100, 1300, 2000), draw.integers(300, 380, 3000)]),
    }[kind]
    found = packing.pack(sizes)
    single = one_length(sizes, packing.LENGTHS, packing.OVERHEAD, packing.ATTENTION)
    mine, other = (cost_of(x, packing.OVERHEAD, packing.ATTENTION) for x in (found, single))
    assert mine <= other
    if kind in ("short", "long tail"):  # few pieces that force the longest
        assert mine < other * 0.98
        assert len({c for c, _ in bins_of(found)}) > 2
        assert sum(c for _, c in bins_of(found)) < 1.02 * sizes.sum()


def test_bins_by_length(spark, edges):
    packed = packing.pack_documents(edges)
    told = packing.bins_by_length(packed).collect()
    assert sum(r["bins"] for r in told) == packed.select("bin_id").distinct().count()
    assert sum(r["n_tokens"] for r in told) == packed.groupBy().sum("n_tokens").first()[0]
    assert all(r["bin_length"] <= r["opened_length"] and r["padding"] >= 0 for r in told)


def test_packing_empty(nothing):
    assert packing.pack_documents(nothing).count() == 0
