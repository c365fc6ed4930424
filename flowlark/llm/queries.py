"""Named queries of the operators, by their contracts."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from flowlark.llm import (
    exact_dedup,
    html_blocks,
    importance,
    language,
    licenses,
    line_rules,
    mixing,
    near_dedup,
    oracles,
    packing,
    scoring,
    sharding,
    trie,
    warc,
)
from flowlark.queries.registry import table
from flowlark.session import scratch_path, ship_package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under a name."""

    def add(fn):
        @wraps(fn)
        def run(spark, folder):
            ship_package(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _bucket(n: int):
    """Remainder that deals documents to folds."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(key), F.lit(n))


@query(
    "op10_exact_dedup",
    """select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
         row_number() over (partition by norm order by doc_id desc) = 1 as kept,
         sha256(norm) as text_sha256
       from (select doc_id,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz') as norm from documents)
       window g as (partition by norm)""",
)
def op10(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs).select(
        "row.doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


@query("op4_near_dedup")
def op4(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    near = near_dedup.near_duplicates(docs, k=4, percent=80)
    return near.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


@query("op1_mixing", oracles.MIXING)
def op1(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix_sizes(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies"
    )


@query("op6_line_rules", oracles.LINE_RULES)
def op6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_rules.judge(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines_removed", "line_chars", "kept_chars",
    )


@query("op9_packing")
def op9(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@query("op2_lm_scoring")
def op2(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = _bucket(7) == 2
    return scoring.score_documents(
        docs, ~held_out, carry=[F.col("doc_id"), held_out.alias("held_out")]
    )


@query("op5_language_id")
def op5(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = _bucket(5) == 0
    model = language.learn(docs.filter(~held_out), "text", "lang")
    return language.predict(docs, model, "text", [F.col("doc_id"), held_out.alias("held_out")])


@query("op7_sharding")
def op7(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_license_scan")
def op8(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs)
    base = F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    more = F.transform("spans", lambda x: x["label"])
    starts = F.transform("places", lambda x: x["first_word"])
    best = F.array_max(F.transform("spans", lambda x: x["cover"]))
    return found.select(
        F.col("id").alias("doc_id"), "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


@query("op3_html_extraction")
def op3(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html_blocks.extract_text(pages)


@query("op11_importance_resampling", oracles.RESAMPLING)
def op11(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    target = table(spark, sf, "benchmark").select("text")
    return importance.resample(docs, target).select(
        F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank"
    )


@query("op12_warc", oracles.WARC)
def op12(spark, sf):
    path = scratch_path(spark, "archives")
    archive = warc.write_archives(table(spark, sf, "pages"), path)
    read = warc.joined_revisits(warc.read_archives(spark, path, archive).drop("payload"))
    return read.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query("op13_conversation_trie")
def op13(spark, sf):
    turns = trie.turn_digests(table(spark, sf, "conversations"))
    return trie.prefix_trie(*trie.rebuild(turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
