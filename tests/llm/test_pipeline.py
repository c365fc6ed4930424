"""The pipeline's stages against plain versions, on a whole small table."""

import collections

import corpus_pipeline
import pytest
from awkward import PROSE
from plain_versions import brute_components

from flowlark.llm import line_rules, mixing

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    run = dict(corpus_pipeline.STAGES)
    assert list(run) == ["quality_rules", "exact_dedup", "near_dedup", "mixing", "packing"]

    clean = run["quality_rules"](spark, docs, FOLDER).cache()
    kept = {r[0] for r in line_rules.judge(docs).filter("kept").select("row.doc_id").collect()}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == kept

    exact = run["exact_dedup"](spark, clean, FOLDER).cache()
    last = {}
    for r in clean.collect():
        key = (r.text or "").encode().lower()
        last[key] = max(last.get(key, -1), r.doc_id)
    assert exact.columns == columns and sorted(r.doc_id for r in exact.collect()) == sorted(last.values())

    near = run["near_dedup"](spark, exact, FOLDER).cache()
    least = brute_components([(r.doc_id, r.text) for r in exact.collect()], 5)
    assert near.columns == columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, _, c in least if i == c)

    mixed = run["mixing"](spark, near, FOLDER).cache()
    copies = {r["id"]: r["copies"] for r in mixing.mix_sizes(near).collect()}
    got = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == columns and got == collections.Counter({i: n for i, n in copies.items() if n})

    packed = run["packing"](spark, mixed, FOLDER).collect()
    want = collections.Counter()
    for r in mixed.collect():
        want[r.doc_id] += len((r.text or "").encode().split()) + 1
    tokens = collections.Counter()
    for r in packed:
        tokens[r.doc_id] += r.n_tokens
    assert tokens == want


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_awkward_rows(spark, edges, nothing, name):
    """Nulls, empty and long texts, ties, repeated rows, clashing names and names with dots."""
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = edges.withColumnsRenamed({"row": "a.b", "_row": "c`d"})
    out = stage(spark, rows, FOLDER)
    found = out.collect()
    none = stage(spark, nothing.withColumnsRenamed({"row": "a.b"}), FOLDER)
    assert none.collect() == []
    if name == "packing":
        assert {r["doc_id"] for r in found} == {r["doc_id"] for r in rows.collect()}
        return
    assert out.columns == rows.columns and out.schema == rows.schema
    given = collections.Counter(map(str, rows.collect()))
    if name != "quality_rules":  # whole rows stay, or go
        assert set(map(str, found)) <= set(given)
    if name in ("exact_dedup", "near_dedup"):
        prose = [r for r in found if r["text"] and r["text"].lower() == PROSE.lower()]
        assert len(prose) == 1


def test_whole_pipeline_twice(spark):
    """Reruns agree."""
    one, two = (sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) for _ in range(2))
    assert one == two and one
