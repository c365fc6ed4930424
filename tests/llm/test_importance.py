"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from awkward import EDGES, PROSE, documents

from flowlark.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest=3):
    words = WORD.findall((text or "").encode().lower())
    out = [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), out


def plain_resample(docs, target, percent=5, least=20, buckets=10_000, seed=42):
    def counts(texts):
        found = collections.Counter()
        for text in texts:
            found.update(zlib.crc32(f) % buckets for f in plain_features(text)[1])
        return found

    corpus, aimed = counts(t for _, t in docs), counts(target)
    s, t = sum(corpus.values()), sum(aimed.values())
    rows = []
    for key, text in docs:
        n, found = plain_features(text)
        weight = sum(
            math.floor(1000 * math.log((aimed[b] + 1.0) * (s + buckets) / ((corpus[b] + 1.0) * (t + buckets))))
            for b in (zlib.crc32(f) % buckets for f in found)
        )
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, n, len(found), weight, score, None])
    able = [r for r in rows if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is not None, r[0], r[2], r[3]))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("piece", [importance.PIECE_BYTES, 64])
def test_features_across_pieces(monkeypatch, piece):
    monkeypatch.setattr(importance, "PIECE_BYTES", piece)
    texts = ["", "a\0b c", PROSE, "x" * 5000, "one", "two three", "", "été ÉTÉ, a-b 1.5 " * 30, "z" * 70 + " end"]
    words, found = np.zeros(len(texts), int), [collections.Counter() for _ in texts]
    for n, owner, at in importance.features([t.encode() for t in texts], 1 << 31, 3):
        words += n
        for i, b in zip(owner.tolist(), at.tolist()):
            found[i][b] += 1
    for i, text in enumerate(texts):
        n, want = plain_features(text)
        assert words[i] == n
        assert found[i] == collections.Counter(zlib.crc32(f) % (1 << 31) for f in want)


def test_edges(spark, edges, nothing):
    target = ["the harvest and the weather", None, "", "word word word"]
    aimed = spark.createDataFrame([(t,) for t in target], "`my.text` string")
    got = importance.resample(edges, aimed, target_text="my.text", percent=60)
    assert collected(got) == plain_resample([(r[0], r[1]) for r in EDGES], target, percent=60)
    assert importance.resample(nothing, aimed, target_text="my.text").collect() == []
    none = aimed.filter("false")
    assert collected(importance.resample(edges, none, target_text="my.text")) == plain_resample(
        [(r[0], r[1]) for r in EDGES], []
    )


def test_ties_and_repeated_rows(spark):
    rows = [(i % 7, PROSE + f" more {i % 3}", None, None) for i in range(60)]
    got = collected(importance.resample(documents(spark, rows), documents(spark, rows[:2]), percent=33))
    assert got == plain_resample([(a, b) for a, b, _, _ in rows], [rows[0][1], rows[1][1]], percent=33)
    assert sorted(r[5] for r in got if r[5]) == list(range(1, 20))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    target = spark.read.parquet(f"{folder}/benchmark.parquet")
    want = plain_resample([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert collected(importance.resample(docs, target)) == want
