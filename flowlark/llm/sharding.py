"""Shards by balanced label propagation, in DataFrame functions.

Documents with equal texts are linked. Every document starts in the shard of its
hash. Groups larger than a part of a shard, at most a few per shard, are placed first,
each in as few shards as hold it. Members of the other groups then ask in rounds for
the shard with room that holds most of them, and a quota says how many may move:
exchanges between two shards are free, beyond that a shard takes what it has room for.
Members of one group that leave a shard for the same target go together. Rounds end
when no document asks or the links inside shards stop rising; whatever is still apart
is then gathered where most of it lies, and shards that have too many rows by that
hand whole groups, the smallest ones, on to shards with room.

Unlinked rows belong anywhere, so they yield their place to linked ones. At last surplus
rows, unlinked ones first and then those of the smallest groups, move so that shards
differ by one row at most (law ``rows``). Only tables of shards and of the large groups
reach the driver.

Defined results: a null text has 16 bytes, checksum 0 and no links; repeated rows
are separate rows of one group; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import ordered_totals
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

#: Groups above this part of a shard are placed first.
UNIT_PART = 0.25
#: Room above an even share while labels move.
SLACK = 0.05


def quotas(wishes: np.ndarray, held: np.ndarray, room: float) -> np.ndarray:
    """Part of the rows wishing to go from i to j that may: exchanges, then free room."""
    allowed = np.minimum(wishes, wishes.T).astype(float)
    rest = wishes - allowed
    free = np.maximum(room - held, 0)
    asked = rest.sum(axis=0)
    allowed += rest * np.minimum(1.0, free / np.maximum(asked, 1))
    return allowed / np.maximum(wishes, 1)


def _pick(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at + 1)


def _propagate(linked: DataFrame, fixed: np.ndarray, shards: int, room: float) -> DataFrame:
    """Rows (rid, unit, n, shard) after the rounds; ``fixed`` are rows that stay, by shard."""
    inside, r = -1, 0
    now = fixed + _by_shard(linked, shards)
    while True:
        votes = materialize(linked.groupBy("unit", "shard").agg(F.count("*").alias("n")))
        links = votes.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0
        if links <= inside:
            return linked
        inside = links
        tie = -F.pmod(F.col("shard") + F.col("unit"), F.lit(shards))
        fits = _pick((now < room).tolist(), F.col("shard"))
        best = votes.groupBy(F.col("unit").alias("u")).agg(
            F.max(F.struct(fits.alias("fits"), "n", tie.alias("tie"), "shard"))["shard"].alias("goal")
        )
        asked = materialize(join_hot(linked, best, {"unit": "u"}, "inner"))
        wishes = np.zeros((shards, shards), np.int64)
        now = fixed.copy()
        for row in asked.groupBy("shard", "goal").count().collect():  # shards x shards at most
            now[row["shard"]] += row["count"]
            if row["shard"] != row["goal"]:
                wishes[row["shard"], row["goal"]] = row["count"]
        if not wishes.any():
            return linked
        part = quotas(wishes, now, room)
        luck = F.pmod(F.xxhash64("unit", "shard", F.lit(r)), F.lit(1 << 30)) / (1 << 30)
        moves = luck < _pick(part.ravel().tolist(), F.col("shard") * shards + F.col("goal"))
        to = F.when(moves, F.col("goal")).otherwise(F.col("shard"))
        linked = materialize(asked.select("rid", "unit", "n", to.alias("shard")))
        now = fixed + _by_shard(linked, shards)
        r += 1


def _gather(linked: DataFrame, room: np.ndarray, shards: int) -> DataFrame:
    """Rows (rid, unit, n, shard) with every unit in one shard.

    Shards keep their largest units, up to ``room`` rows; the others are dealt to the
    room that is left. A shard gets less than one of them too much.
    """
    votes = linked.groupBy("unit", "shard").agg(F.count("*").alias("n"))
    tie = -F.pmod(F.col("shard") + F.col("unit"), F.lit(shards))
    units = votes.groupBy("unit").agg(
        F.max(F.struct("n", tie.alias("tie"), "shard"))["shard"].alias("home"), F.sum("n").alias("rows")
    )
    units = materialize(units)
    held = _sums(units, "home", shards)
    home = F.col("home")
    if (held > room).any():
        order = units.withColumn("small", -F.col("rows"))
        order = ordered_totals(order, ["home", "small", "unit"], {"upto": F.col("rows")})
        end = F.col("upto") - _pick((np.cumsum(held) - held).tolist(), home)
        order = materialize(order.withColumns({"end": end, "stays": end <= _pick(room.tolist(), home)}))
        stay = _sums(order.filter("stays"), "home", shards)
        leave = held - stay
        lack = np.maximum(room - stay, 0)
        turn = F.col("end") - F.col("rows") - _pick((stay - (np.cumsum(leave) - leave)).tolist(), home)
        ends = F.array(*[F.lit(int(x)) for x in np.cumsum(lack)[:-1]])
        dealt = F.size(F.filter(ends, lambda x: x <= turn))
        units = order.withColumn("home", F.when(F.col("stays"), home).otherwise(dealt).cast("int"))
    homes = units.select(F.col("unit").alias("u"), "home")
    return join_hot(linked, homes, {"unit": "u"}, "inner").select("rid", "unit", "n", F.col("home").alias("shard"))


def spread(sizes: list[int], room: np.ndarray) -> list[list[tuple[int, int]]]:
    """Shards and rows of each group, largest groups first, in as few shards as hold it."""
    free = room.astype(np.int64).copy()
    out: list[list[tuple[int, int]]] = [[] for _ in sizes]
    for g in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        left = sizes[g]
        while left:
            fitting = np.flatnonzero(free >= left)
            s = int(fitting[free[fitting].argmin()] if len(fitting) else free.argmax())
            taken = int(min(left, free[s]))
            out[g].append((s, taken))
            free[s] -= taken
            left -= taken
    return out


def _place_large(large: DataFrame, room: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """Rows (rid, unit, n, shard) of the large groups, and how many each shard has."""
    groups = large.groupBy("unit").count().orderBy("unit").collect()  # a few per shard
    held = np.zeros(len(room), np.int64)
    if not groups:
        return large.select("rid", "unit", "n", "shard"), held
    parts = [x for own in spread([g["count"] for g in groups], room) for x in own]
    for s, n in parts:
        held[s] += n
    ordered = ordered_totals(large.select("rid", "unit", "n", "h"), ["unit", "h", "rid"], {})
    ends = F.array(*[F.lit(int(x)) for x in np.cumsum([n for _, n in parts])])
    at = F.size(F.filter(ends, lambda x: x <= F.col("_row")))
    return ordered.select("rid", "unit", "n", _pick([s for s, _ in parts], at).alias("shard")), held


def _sums(units: DataFrame, by: str, shards: int) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for row in units.groupBy(by).agg(F.sum("rows").alias("rows")).collect():  # one row per shard
        out[row[by]] = row["rows"]
    return out


def _by_shard(rows: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for row in rows.groupBy("shard").count().collect():  # one row per shard
        out[row["shard"]] = row["count"]
    return out


def shard_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 40, report: dict | None = None
) -> DataFrame:
    """Per document: id, size, text_crc32, shard and slot.

    ``report`` gets the number of ``edges``, pairs of equal texts, and of ``cut_edges``.
    """
    raw = F.col(text)
    rows = materialize(
        docs.select(
            F.col(key).alias("id"),
            (F.coalesce(F.octet_length(raw), F.lit(0)) + 16).cast("long").alias("size"),
            F.crc32(F.coalesce(raw, F.lit(""))).alias("text_crc32"),
            F.unhex(F.sha2(raw, 256)).alias("text_key"),
        )
    ).withColumn("rid", F.monotonically_increasing_id())
    rows = rows.withColumn("h", F.xxhash64("id", "text_crc32", "rid"))
    total = rows.count()
    start = F.pmod("h", F.lit(shards)).cast("int")
    groups = rows.filter("text_key is not null").groupBy(F.col("text_key").alias("g")).agg(
        F.count("*").alias("n")
    )
    even = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    limit = max(1, int(total / shards * UNIT_PART))
    members = materialize(
        join_hot(rows.filter("text_key is not null"), groups.filter("n > 1"), {"text_key": "g"}, "inner").select(
            "rid", F.xxhash64("text_key").alias("unit"), "n", "h", start.alias("shard")
        )
    )
    large, fixed = _place_large(members.filter(F.col("n") > limit), even)
    rest = _propagate(
        members.filter(F.col("n") <= limit).select("rid", "unit", "n", "shard"),
        fixed, shards, total / shards * (1 + SLACK) + 1,
    )
    placed = materialize(_gather(rest, even - fixed, shards).unionAll(large)).select(
        F.col("rid").alias("r"), "unit", "n", F.col("shard").alias("to")
    )
    all_rows = rows.select("rid", "id", "size", "text_crc32", start.alias("at"), "h").join(
        placed, F.col("rid") == F.col("r"), "left"
    )
    ordered = ordered_totals(
        all_rows.select(
            "rid", "id", "size", "text_crc32", F.coalesce("to", "at").alias("label"),
            F.col("r").isNotNull().alias("linked"), F.coalesce("unit", "h").alias("unit"), F.coalesce("n", F.lit(1)).alias("n"),
        ),
        ["label", "linked", "n", "unit", "rid"],
        {},
    )
    held = _by_shard(all_rows.select(F.coalesce("to", "at").alias("shard")), shards)
    surplus, lack = np.maximum(held - even, 0), np.maximum(even - held, 0)
    first = (np.cumsum(held) - held).tolist()
    leaving = (np.cumsum(surplus) - surplus).tolist()
    filled = np.cumsum(lack)

    at = F.col("_row") - _pick(first, F.col("label"))
    extra = _pick(surplus.tolist(), F.col("label"))
    turn = _pick(leaving, F.col("label")) + at
    ends = F.array(*[F.lit(int(x)) for x in filled])
    goal = F.size(F.filter(ends, lambda x: x <= turn))
    moved = at < extra
    shard = F.when(moved, goal).otherwise(F.col("label"))
    taken = _pick((filled - lack).tolist(), goal)
    slot = F.when(moved, _pick(held.tolist(), goal) + turn - taken).otherwise(at - extra)
    if report is not None:
        pairs = lambda n: (n * (n - 1) / 2)
        own = ordered.filter("linked").groupBy("unit", shard.alias("s")).agg(F.count("*").cast("double").alias("n"))
        own = own.groupBy("unit").agg(F.sum("n").alias("n"), F.sum(pairs(F.col("n"))).alias("inside"))
        sums = own.agg(F.sum(pairs(F.col("n"))).alias("edges"), F.sum("inside").alias("inside")).first()
        report["edges"] = int(sums["edges"] or 0)
        report["cut_edges"] = report["edges"] - int(sums["inside"] or 0)
    return ordered.select(
        "id", "size", "text_crc32", shard.cast("int").alias("shard"), slot.cast("long").alias("slot")
    )
