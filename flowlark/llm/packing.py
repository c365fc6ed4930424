"""Best-fit packing of documents into sequences of several permitted lengths.

A document is its words and one end mark; it is cut into pieces of at most the
largest permitted length. Pieces are dealt to groups of a fixed number by a global
order of hashes, so that each group is a fair sample of all lengths, and every group
is packed on its own. A sequence costs its length, an overhead and, as attention looks from
every word at every other, length squared over ATTENTION. So long sequences save overhead
and short ones attention, and what fills them decides.

* Pieces in falling length go to the open bin with the least room that takes them.
* If none does, a bin opens. For each length of the mix in use, the pieces still to come
  are laid into it, the largest that fits first; the bin opens at the length with the
  least cost per word that this fills.
* Which mix of lengths to open is searched over the group: from the longest alone, lengths
  are added or taken away one by one as long as the whole cost, after downsizing, falls. So
  no packing costs more than that of the longest length alone.
* At the end each bin shrinks to the shortest permitted length that holds it.

Nothing is dropped: every word and end mark lies in exactly one bin. Defined
results: a null or empty text is one piece, its end mark; repeated rows are packed
as often as they come; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import ordered_totals, words_in

LENGTHS = (256, 512, 768, 1024, 1536, 2048)
#: Cost of a sequence besides its length.
OVERHEAD = 32
#: Length at which attention costs as much as all else that grows with the length.
ATTENTION = 16_384
#: Pieces of a group: bounds the memory of a task.
GROUP = 20_000


def cost_of(length: int, overhead: int = OVERHEAD, attention: float = ATTENTION) -> float:
    return overhead + length + length * length / attention


def _opened(rising: list[int], left: int, mix: dict[int, float]) -> int:
    """Length at which a bin opens for the piece at ``left``, of pieces in rising length.

    The pieces before it are still to come; those that fit are tried from the largest on.
    """
    size = rising[left]
    best, least = 0, 0.0
    for length, price in mix.items():
        if length < size:
            continue
        room, at = length - size, left
        while room and (at := bisect.bisect_right(rising, room, 0, at)):
            at -= 1
            room -= rising[at]
        cost = price / (length - room)
        if not best or cost <= least:
            best, least = length, cost
    return best


def _fill(sizes: list[int], order: list[int], mix: dict[int, float]):
    """Bin and offset of each piece, content and opened length of each bin."""
    rising = [sizes[i] for i in reversed(order)]
    rooms: dict[int, list[int]] = {}  # room -> open bins
    known: list[int] = []  # rooms in use, ascending
    fill, opened = [], []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for turn, at in enumerate(order):
        size = sizes[at]
        place = bisect.bisect_left(known, size)
        if place < len(known):
            room = known[place]
            chosen = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                known.pop(place)
        else:
            room = _opened(rising, len(order) - 1 - turn, mix)
            chosen = len(fill)
            fill.append(0)
            opened.append(room)
        bins[at], offsets[at] = chosen, fill[chosen]
        fill[chosen] += size
        room -= size
        if room:
            if room not in rooms:
                bisect.insort(known, room)
                rooms[room] = []
            rooms[room].append(chosen)
    return bins, offsets, fill, opened


def pack(sizes: np.ndarray, lengths=LENGTHS, overhead: int = OVERHEAD, attention: float = ATTENTION):
    """Bin, offset in it, its final length and the length it was opened at, per piece."""
    lengths = sorted(lengths)
    given = np.asarray(sizes, np.int64)
    none = np.zeros(0, np.int64)
    if not len(given):
        return none, none, none, none
    order = np.argsort(-given, kind="stable").tolist()
    pieces, permitted = given.tolist(), np.array(lengths, np.int64)

    price = {c: cost_of(c, overhead, attention) for c in lengths}

    def tried(mix: frozenset):
        found = _fill(pieces, order, {c: price[c] for c in sorted(mix)})
        final = permitted[np.searchsorted(permitted, np.array(found[2], np.int64))]
        return sum(price[c] * n for c, n in zip(*np.unique(final, return_counts=True))), found, final

    mix = frozenset([lengths[-1]])
    cost, found, final = tried(mix)
    seen, better = {mix}, True
    while better:
        better = False
        for length in reversed(lengths[:-1]):
            other = mix ^ {length}
            if other not in seen:
                seen.add(other)
                cost2, found2, final2 = tried(other)
                if cost2 < cost:
                    mix, cost, found, final, better = other, cost2, found2, final2, True
    bins, offsets, _, opened = (np.array(x, np.int64) for x in found)
    return bins, offsets, final[bins], opened[bins]


def bins_by_length(packed: DataFrame) -> DataFrame:
    """Bins, words and padding by the lengths at which bins were opened and closed."""
    bins = packed.groupBy("bin_id", "opened_length", "bin_length").agg(F.sum("n_tokens").alias("n"))
    return bins.groupBy("opened_length", "bin_length").agg(
        F.count("*").alias("bins"), F.sum("n").alias("n_tokens"),
        F.sum(F.col("bin_length") - F.col("n")).alias("padding"),
    )


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lengths=LENGTHS,
    overhead: int = OVERHEAD, group: int = GROUP, attention: float = ATTENTION,
) -> DataFrame:
    """One row per piece: its words, its bin and the bin's final length.

    ``first_word`` counts from 0; a piece that ends a document counts the end mark
    in ``n_tokens``.
    """
    longest = max(lengths)
    kind = docs.schema[key].dataType.simpleString()
    sized = docs.select(F.col(key).alias("id"), (words_in(F.col(text)) + 1).alias("all"))
    pieces = sized.select(
        "id", "all", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("all") - 1), F.lit(longest).cast("long"))).alias("first_word")
    ).select(
        "id", "first_word", F.least(F.lit(longest), F.col("all") - F.col("first_word")).cast("long").alias("n_tokens"),
        F.xxhash64("id", "first_word").alias("_h"),
    )
    dealt = ordered_totals(pieces, ["_h", "id", "first_word", "n_tokens"], {})
    dealt = dealt.withColumn("_group", F.floor(F.col("_row") / group)).drop("_h")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row")
        bins, offsets, final, opened = pack(rows["n_tokens"].to_numpy(), lengths, overhead, attention)
        return pd.DataFrame(
            {
                "doc_id": rows["id"],
                "first_word": rows["first_word"],
                "n_tokens": rows["n_tokens"],
                "bin_id": rows["_group"] * group + bins,
                "bin_length": final,
                "bin_offset": offsets,
                "opened_length": opened,
            }
        )

    return dealt.groupBy("_group").applyInPandas(
        run,
        f"doc_id {kind}, first_word long, n_tokens long, bin_id long, bin_length long, bin_offset long, "
        "opened_length long",
    )
