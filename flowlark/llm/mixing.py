"""Mix sources to target weights by Pareto order sampling, in DataFrame functions.

Each source gets a target in words; within a source a document expects
``e = min(cap, t * merit)`` copies, with merit rising with the document's length
class and t solved so that the expected words equal the target. The whole part of e
is allotted for certain. The fraction f is an inclusion probability: documents are
ranked by the odds of a random number over the odds of f, and the sample is the
prefix of this ranking whose words fit the rest of the target. One closing document
per source, the one that brings the words nearest, may join it.

The ranking is never sorted as a whole: ranks are counted in 4096 classes, and only
the class in which a source's target falls is ordered. Decisions are a threshold
per source, so they apply to whole rows without moving texts.

Defined results: null and empty texts have size 0 and are never taken; null sources
are one source, ordered last; a document's random number depends on its id and the
seed alone, so reruns agree and rows that repeat an id are taken alike; a share
beyond what the caps allow ends at the caps; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlark.llm.common import join_small, ordered_totals, words_in
from flowlark.session import materialize

#: Classes of ranks; about 1 / RANKS of a source is ordered exactly.
RANKS = 4096
#: Gain of merit per doubling of a document's length.
TILT = 0.125


@dataclass
class Plan:
    """What decides the copies of a row: tables by source, all materialised."""

    sources: DataFrame  # s, source_size, target
    classes: DataFrame  # s, size_class, e
    cuts: DataFrame  # s, cut, closing


def _drawn(key: str, seed: int) -> Column:
    """A number in (0, 1) from the id."""
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def _traits(docs: DataFrame, key: str, text: str, source: str, seed: int) -> list[Column]:
    size = words_in(F.col(text))
    return [
        F.col(key).alias("_id"),
        F.col(source).alias("_s"),
        size.alias("_size"),
        F.length(F.bin(size)).alias("_class"),
        _drawn(key, seed).alias("_u"),
    ]


def _merit() -> Column:
    return 1 + F.col("_class") * TILT


def _targets(rows: DataFrame, weights, share: float, cap: float) -> DataFrame:
    """Targets by source: shares by weight, the excess over caps dealt again."""
    sizes = rows.groupBy("_s").agg(F.sum("_size").alias("_size"))
    sizes = sizes.withColumn("_last", F.col("_s").isNull())
    ranked = ordered_totals(sizes, ["_last", "_s"], {}).withColumn(
        "_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                           (F.col("_row") % len(weights) + 1).cast("int"))
    )
    ranked = ranked.withColumnRenamed("_row", "_rank").withColumn("_ratio", F.col("_size") / F.col("_w"))
    filled = materialize(
        ordered_totals(ranked, ["_ratio", "_rank"], {"_sum": F.col("_size"), "_sum_w": F.col("_w")})
    )
    whole = filled.agg(F.sum("_size").alias("all"), F.sum("_w").alias("w")).first()
    if whole["all"] is None:
        return filled.select("_s", F.col("_size").alias("source_size"), F.lit(0.0).alias("target"))
    wanted = share * whole["all"]
    room = wanted - cap * (F.col("_sum") - F.col("_size"))
    left = whole["w"] - (F.col("_sum_w") - F.col("_w"))
    capped = room * F.col("_w") > cap * F.col("_size") * left
    level = filled.filter(~capped).orderBy("_row").select((room / left).alias("level")).first()
    level = 0.0 if level is None else level["level"]
    target = F.when(capped, cap * F.col("_size")).otherwise(level * F.col("_w"))
    return filled.select("_s", F.col("_size").alias("source_size"), target.alias("target"))


def _expected(rows: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """Expected copies by source and length class, and the words sure to be taken."""
    sums = rows.filter("_size > 0").groupBy("_s", "_class").agg(F.sum("_size").alias("_words"))
    sums = join_small(sums, targets.select("_s", "target"), ["_s"])
    before = Window.partitionBy("_s").orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_s")
    gain = _merit() * F.col("_words")
    room = F.col("target") - cap * F.coalesce(F.sum("_words").over(before), F.lit(0))
    left = F.sum(gain).over(whole) - F.coalesce(F.sum(gain).over(before), F.lit(0.0))
    levels = sums.withColumns({"_room": room, "_left": left})
    free = F.col("_room") * _merit() <= cap * F.col("_left")
    level = F.max_by(
        F.when(free, F.col("_room") / F.col("_left")), F.when(free, F.col("_class"))
    ).over(whole)
    e = F.least(F.lit(cap), F.coalesce(level * _merit(), F.lit(cap)))
    return levels.select("_s", "_class", "_words", "target", e.alias("e"))


def _ranked(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with expected copies and the rank value ``_p`` in [0, 1), null without a draw."""
    rows = join_small(rows, classes.select("_s", "_class", "e"), ["_s", "_class"])
    sure = F.floor("e")
    part = F.col("e") - sure
    odds = F.col("_u") * (1 - part)
    p = F.when((part > 0) & (F.col("_size") > 0), odds / (odds + (1 - F.col("_u")) * part))
    return rows.withColumns({"_sure": sure, "_p": p})


def _cuts(ranked: DataFrame, classes: DataFrame) -> DataFrame:
    """By source: the largest rank value taken, and that of the closing document."""
    rest = classes.groupBy("_s").agg(
        (F.max("target") - F.sum(F.floor("e") * F.col("_words"))).alias("rest")
    )
    drawn = ranked.filter("_p is not null").withColumn("_rank", F.floor(F.col("_p") * RANKS))
    counted = drawn.groupBy("_s", "_rank").agg(F.sum("_size").alias("_words"))
    upto = Window.partitionBy("_s").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("_upto", F.sum("_words").over(upto))
    counted = join_small(counted, materialize(rest), ["_s"])
    over = counted.filter("_upto > rest").groupBy("_s").agg(
        F.min("_rank").alias("edge"), F.min(F.col("_upto") - F.col("_words")).alias("before"),
        F.first("rest").alias("rest"),
    )
    over = materialize(over)
    edge = join_small(drawn, over, ["_s"], "inner").filter("_rank = edge")
    running = Window.partitionBy("_s").orderBy("_p")  # equal ranks together
    edge = edge.withColumn("_upto", F.col("before") + F.sum("_size").over(running))
    fits = F.col("_upto") <= F.col("rest")
    cut = edge.groupBy("_s").agg(
        F.coalesce(F.max(F.when(fits, F.col("_p"))), (F.max("edge") - 0.5) / RANKS).alias("cut"),
        F.max("edge").alias("edge"),
        (F.max("rest") - F.coalesce(F.max(F.when(fits, F.col("_upto"))), F.max("before"))).alias("gap"),
    )
    cut = materialize(cut)
    outside = join_small(drawn, cut, ["_s"], "inner").filter(
        (F.col("_rank") > F.col("edge")) | (F.col("_rank") == F.col("edge")) & (F.col("_p") > F.col("cut"))
    )
    miss = F.abs(F.col("gap") - F.col("_size"))
    closing = outside.filter(miss < F.col("gap")).groupBy("_s").agg(
        F.min(F.struct(miss.alias("miss"), "_p"))["_p"].alias("closing")
    )
    return materialize(join_small(cut.select("_s", "cut", "edge"), materialize(closing), ["_s"]))


def _copies() -> Column:
    """Copies of a row with its rank value and its source's cuts."""
    rank = F.floor(F.col("_p") * RANKS)
    inside = F.col("edge").isNull() | (rank < F.col("edge")) | (rank == F.col("edge")) & (F.col("_p") <= F.col("cut"))
    taken = F.col("_p").isNotNull() & (inside | F.coalesce(F.col("_p") == F.col("closing"), F.lit(False)))
    return F.when(F.col("_size") > 0, F.col("_sure") + taken.cast("long")).otherwise(0)


def _plan(docs, key, text, source, weights, share, cap, seed) -> tuple[DataFrame, Plan]:
    rows = materialize(docs.select(*_traits(docs, key, text, source, seed)))
    targets = materialize(_targets(rows, weights, share, cap))
    classes = materialize(_expected(rows, targets, cap))
    ranked = _ranked(rows, classes)
    return ranked, Plan(targets, classes, _cuts(ranked, classes))


def mix_sizes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17,
) -> DataFrame:
    """Per document: id, size, source_size, target, copies and taken words."""
    ranked, plan = _plan(docs, key, text, source, weights, share, cap, seed)
    rows = join_small(join_small(ranked, plan.cuts, ["_s"]), plan.sources, ["_s"])
    copies = _copies()
    return rows.select(
        F.col("_id").alias("id"), F.col("_size").alias("size"), "source_size", "target",
        copies.alias("copies"), (copies * F.col("_size")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 17,
) -> DataFrame:
    """The mix itself: whole rows, a row twice where two copies are taken."""
    _, plan = _plan(docs, key, text, source, weights, share, cap, seed)
    traits = _traits(docs, key, text, source, seed)
    named = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    rows = docs.select(F.struct(*named).alias("_row"), *traits)
    rows = join_small(_ranked(rows, plan.classes), plan.cuts, ["_s"])
    rows = rows.withColumn("_copies", _copies()).filter("_copies > 0")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
