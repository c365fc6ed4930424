"""Importance resampling towards the word n-grams of a target corpus.

Two passes over the texts, each by batch concatenation: the texts of a batch are joined
with a sentinel, one pattern pass finds all words and sentinels, the places of the
sentinels are the offsets of the documents, and ``searchsorted`` on them masks the runs of
words that would cross from one document into the next. What is left is hashed and counted
with ``bincount``.

1. Both corpora give one count per hash bucket, a table of a fixed number of rows, and from
   it a gain for each bucket: how much more the target has of it.
2. Each document sums the gains of its features. With Gumbel noise that its id decides, the
   highest scores are a sample without replacement by importance. They are ranked over
   range partitions of ids and scores alone; no text is shuffled.

The hash of a run follows from the hashes of its words: a CRC of a concatenation is the
first CRC moved on by the bytes of the second, which tables do for whole arrays.

Defined results: a null text has no words; a null id counts as empty text in the noise and
comes first among ties; equal ids with equal scores are ranked by features and weight, rows
equal in all of them in any order; an empty target or an empty corpus gives gains from zero
counts; an empty table gives an empty result. A text of any length is read in pieces of
PIECE_BYTES that end between words, so memory does not follow the longest text. Only the
id and text columns are read, by position, so other names do not matter.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import encoded, ordered_totals, slices
from flowlark.session import materialize

BUCKETS = 10_000
LONGEST = 3  # words of the longest feature
SEED = 42
#: Fixed value: bytes of a word after lower-casing, in UTF-8.
WORD = rb"[0-9a-z\x80-\xff]+"

#: Bytes of joined texts that one pattern pass reads.
PIECE_BYTES = 2 << 20
_MATCH = re.compile(WORD + rb"|\0")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Lower-cases A-Z; a zero byte of a text becomes a space, so that it is no sentinel.
_TABLE = bytes([32, *(b + 32 if 65 <= b <= 90 else b for b in range(1, 256))])


# --- CRCs of concatenations ---------------------------------------------------------------


def _one_byte() -> np.ndarray:
    """Moves a CRC on by one zero byte: a table per byte of the CRC."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    low = np.arange(256, dtype=np.uint32)
    return np.stack([table, low, low << np.uint32(8), low << np.uint32(16)])


def _moved(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Apply a move: it is linear, so the bytes of a CRC go one by one."""
    out = tables[0][crc & 0xFF]
    for i in range(1, 4):
        out = out ^ tables[i][(crc >> np.uint32(8 * i)) & 0xFF]
    return out


class _Moves:
    """Moves by any number of bytes: by up to 63 at once, then by powers of two."""

    def __init__(self):
        nothing = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
        one, moves = _one_byte(), [nothing]
        for _ in range(64):
            moves.append(_moved(one, moves[-1]))
        self.short, self.double = np.stack(moves[:64]), [moves[64]]

    def __call__(self, crc: np.ndarray, by: np.ndarray) -> np.ndarray:
        low = by & 63
        out = self.short[low, 0, crc & 0xFF]
        for i in range(1, 4):
            out = out ^ self.short[low, i, (crc >> np.uint32(8 * i)) & 0xFF]
        rest, k = by >> 6, 0
        while rest.any():
            if k == len(self.double):
                self.double.append(_moved(self.double[-1], self.double[-1]))
            odd = np.flatnonzero(rest & 1)
            out[odd] = _moved(self.double[k], out[odd])
            rest, k = rest >> 1, k + 1
        return out


_moves = _Moves()


# --- words of a batch ---------------------------------------------------------------------


def _pieces(joined: bytes):
    """Cut where no word is cut."""
    at = 0
    while at < len(joined):
        cut = _GAP.search(joined, min(at + PIECE_BYTES, len(joined)))
        end = cut.end() if cut else len(joined)
        yield joined[at:end]
        at = end


def features(texts: list[bytes], buckets: int, longest: int):
    """Per piece of the joined texts: words per text, and (text, bucket) of each feature.

    The last words of a piece go before the next one, so that runs across the cut count.
    """
    joined = b"".join(t.translate(_TABLE) + b"\0" for t in texts)
    document = 0
    none = np.zeros(0, np.int64)
    held = (none.astype(np.uint32), none, none)  # CRC, bytes and text of the last words
    for piece in _pieces(joined):
        found = _MATCH.findall(piece)
        size = np.fromiter(map(len, found), np.int64, len(found))
        crc = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        ends = np.flatnonzero((size == 1) & (crc == zlib.crc32(b"\0")))
        del found
        word = np.ones(len(size), bool)
        word[ends] = False
        owner = document + np.searchsorted(ends, np.flatnonzero(word))
        document += len(ends)
        fresh = len(owner)
        crc = np.concatenate([held[0], crc[word]])
        size = np.concatenate([held[1], size[word]])
        owner = np.concatenate([held[2], owner])
        old = len(owner) - fresh
        starts = np.searchsorted(owner, owner)  # first word here of each word's text
        place = np.arange(len(owner))
        words = np.bincount(owner[old:], minlength=len(texts))
        yield words, *_runs(crc, size, owner, place - starts, old, buckets, longest)
        held = tuple(x[len(x) - min(longest - 1, len(x)) :] for x in (crc, size, owner))


def _runs(crc, size, owner, before, old, buckets, longest):
    """Text and bucket of the runs that end in a word from ``old`` on."""
    spaced = _moves(np.full(len(crc), zlib.crc32(b" "), np.uint32), size) ^ crc
    texts, at, run = [], [], crc
    for n in range(longest):
        if n:  # the run that ends in the word before, a space and this word
            run = np.concatenate([run[:1], _moves(run[:-1], size[1:] + 1) ^ spaced[1:]])
        inside = np.flatnonzero(before[old:] >= n) + old
        texts.append(owner[inside])
        at.append((run[inside] % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(at)


# --- the two passes -----------------------------------------------------------------------


def bucket_counts(texts: DataFrame, column: str, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for _, _, at in features(encoded(part.column(0)), buckets, longest):
                    total += np.bincount(at, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = texts.select(F.col(_quoted(column)).alias("c0")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths of a natural logarithm."""
    size = float(len(corpus))
    s, t = corpus.astype(float), target.astype(float)
    whole, aimed = float(corpus.sum()) + size, float(target.sum()) + size
    ratios = (t + 1) * whole / ((s + 1) * aimed)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def score_documents(
    docs: DataFrame, key: str, text: str, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED
) -> DataFrame:
    """Rows (id, n_words, n_features, weight, score) of all documents."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket
    rows = docs.select(F.col(_quoted(key)).alias("id"), F.col(_quoted(text)).alias("c1"))

    def run(batches):
        gain = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                n = part.num_rows
                words, counts, weight = (np.zeros(n, np.int64) for _ in range(3))
                for found, texts, at in features(encoded(part.column(1)), len(gain), longest):
                    words += found
                    counts += np.bincount(texts, minlength=n)
                    # Whole numbers far below 2^53: their sums as doubles are exact.
                    weight += np.bincount(texts, gain[at], n).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, (words, counts, weight))],
                    names=["id", "n_words", "n_features", "weight"],
                )

    weighed = rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    least_words: int = 20,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    seed: int = SEED,
) -> DataFrame:
    """Rows (id, n_words, n_features, weight, score, rank); rank is null where not drawn.

    Of the documents with ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    gain = gains(bucket_counts(docs, text, buckets, longest), bucket_counts(target, target_text, buckets, longest))
    scored = materialize(score_documents(docs, key, text, gain, longest, seed))
    able = F.col("n_words") >= least_words
    drawn = scored.filter(able).count() * percent // 100
    ranked = scored.filter(able).withColumn("_down", -F.col("score"))
    ranked = ordered_totals(ranked, ["_down", "id", "n_features", "weight"], {})
    rank = F.when(F.col("_row") < drawn, F.col("_row") + 1)
    ranked = ranked.select(*scored.columns, rank.alias("rank"))
    rest = scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionAll(rest)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
