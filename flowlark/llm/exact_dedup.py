"""Exact de-duplication by an exchange of Golomb-coded fingerprints.

Texts are equal when they are identical after lower-casing A-Z. Three steps:

1. Every partition sorts the 48-bit fingerprints of its texts, codes the gaps and
   sends one compressed message to each owner of a fingerprint range: about four
   bytes per distinct text instead of the text.
2. Owners merge their messages and answer with bitmaps of the ranges in which a
   fingerprint came twice. All bitmaps together have a fixed size, so senders get
   them as one broadcast.
3. Only suspects, rows whose bit is set, are shuffled: their full texts are the
   grouping key, with copies merged in each task before the shuffle. A fingerprint
   shared by different texts therefore never joins them.

Defined results: a null text counts as empty; of equal texts the row with the
largest id stays, null ids being smallest; of rows that repeat this id too, one
stays; an empty table gives an empty result. Columns of the input are taken by
position, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import encoded, positional, slices
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

FINGERPRINT_BITS = 48
#: Ranges of fingerprints; one owner holds about rows / OWNERS fingerprints.
OWNERS = 1024
#: Bits of all answers together (4 MB).
ANSWER_BITS = 1 << 25
#: Fingerprints that a sender gathers before it sends.
SENT_AT_ONCE = 500_000


def golomb(values: np.ndarray) -> bytes:
    """Code sorted distinct integers as gaps: unary quotients, then k-bit remainders."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    mean = int(values[-1]) // len(values) if len(values) else 0
    k = max(mean.bit_length() - 1, 0)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    digits = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> digits) & np.uint64(1)).astype(np.uint8)
    head = np.array([len(gaps), k, len(unary)], np.uint32).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def ungolomb(code: bytes) -> np.ndarray:
    n, k, marks = (int(x) for x in np.frombuffer(code, np.uint32, 3))
    at = 12 + (marks + 7) // 8
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(code[12:at], np.uint8), count=marks))
    quotient = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    rest = np.unpackbits(np.frombuffer(code[at:], np.uint8), count=n * k).reshape(n, k)
    weights = np.uint64(1) << np.arange(k - 1, -1, -1, dtype=np.uint64)
    low = (rest * weights).sum(axis=1, dtype=np.uint64) if k else np.zeros(n, np.uint64)
    return np.cumsum((quotient << np.uint64(k)) + low, dtype=np.uint64)


def _fingerprints(texts: list[bytes]) -> np.ndarray:
    drop = 64 - FINGERPRINT_BITS
    return np.array([xxhash.xxh3_64_intdigest(t) >> drop for t in texts], np.uint64)


def _messages(found: list[np.ndarray]) -> pa.RecordBatch:
    """One message per owner: distinct fingerprints, and which came twice here."""
    values, counts = np.unique(np.concatenate(found), return_counts=True)
    width = FINGERPRINT_BITS - (OWNERS - 1).bit_length()
    owner = (values >> np.uint64(width)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(owner, prepend=-1))
    owners, codes, twice = [], [], []
    for a, b in zip(cuts, [*cuts[1:], len(values)]):
        owners.append(int(owner[a]))
        codes.append(golomb(values[a:b] & np.uint64((1 << width) - 1)))
        twice.append(np.packbits(counts[a:b] > 1).tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(owners, pa.int32()), pa.array(codes, pa.binary()), pa.array(twice, pa.binary())],
        names=["owner", "code", "twice"],
    )


def _send(batches):
    found, held = [], 0
    for batch in batches:
        for part in slices(batch, 0):
            found.append(_fingerprints([t.lower() for t in encoded(part.column(0))]))
            held += part.num_rows
        if held >= SENT_AT_ONCE:
            yield _messages(found)
            found, held = [], 0
    if held:
        yield _messages(found)


def _answer(table: pa.Table) -> pa.Table:
    """Merge an owner's messages into the bitmap of its range."""
    values, doubled = [], []
    for code, twice in zip(table["code"].to_pylist(), table["twice"].to_pylist()):
        got = ungolomb(code)
        values.append(got)
        marks = np.unpackbits(np.frombuffer(twice, np.uint8), count=len(got))
        doubled.append(got[marks.astype(bool)])
    distinct, counts = np.unique(np.concatenate(values), return_counts=True)
    suspects = np.union1d(distinct[counts > 1], np.concatenate(doubled))
    width = FINGERPRINT_BITS - (OWNERS - 1).bit_length()
    size = ANSWER_BITS // OWNERS
    bits = np.zeros(size, np.uint8)
    bits[(suspects * np.uint64(size)) >> np.uint64(width)] = 1
    out = zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1) if len(suspects) else None
    owner = table["owner"][0].as_py()
    return pa.table({"owner": pa.array([owner], pa.int32()), "bits": pa.array([out], pa.binary())})


def duplicate_bits(docs: DataFrame, text: str) -> np.ndarray:
    """Bits over the fingerprint space: set where a fingerprint came twice."""
    sent = docs.select(F.col(text)).mapInArrow(_send, "owner int, code binary, twice binary")
    answers = sent.groupBy("owner").applyInArrow(_answer, "owner int, bits binary")
    bits = np.zeros(ANSWER_BITS // 8, np.uint8)
    size = ANSWER_BITS // OWNERS // 8
    for row in answers.filter("bits is not null").collect():  # ANSWER_BITS bits at most
        at = row["owner"] * size
        bits[at : at + size] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return bits


def _sorted_out(docs: DataFrame, bits, text: str, suspects: bool) -> DataFrame:
    """Suspect rows, or the others, with the SHA-256 and the normalised text."""
    at = docs.columns.index(text)
    rows = positional(docs)
    shift = np.uint64(FINGERPRINT_BITS - (ANSWER_BITS - 1).bit_length())

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                texts = [t.lower() for t in encoded(part.column(at))]
                spot = _fingerprints(texts) >> shift
                hit = (bits.value[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1
                chosen = np.flatnonzero(hit.astype(bool) == suspects)
                out = part.take(pa.array(chosen))
                picked = [texts[i] for i in chosen]
                sums = pa.array([hashlib.sha256(t).digest() for t in picked], pa.binary())
                extra = [sums] if not suspects else [sums, pa.array(picked, pa.binary())]
                names = ["_sha", "_norm"][: len(extra)]
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, *extra], names=[*out.schema.names, *names]
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    norm = ", _norm binary" if suspects else ""
    return rows.mapInArrow(run, f"{kinds}, _sha binary{norm}")


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's columns in a struct ``row``, with keep_id, group_size, kept, sha."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(duplicate_bits(docs, text))
    names = [f"c{i}" for i in range(len(docs.columns))]
    packed = F.struct(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)]).alias("row")
    id_col = f"c{docs.columns.index(key)}"

    clear = _sorted_out(docs, bits, text, False).select(
        packed, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("_sha").alias("sha"),
    )
    suspects = materialize(_sorted_out(docs, bits, text, True))
    suspects = suspects.withColumn("_rid", F.monotonically_increasing_id())
    groups = suspects.groupBy("_norm", "_sha").agg(
        F.max(id_col).alias("keep_id"), F.count("*").alias("group_size")
    )
    first = suspects.groupBy(F.col("_sha").alias("_s"), F.col(id_col).alias("_k")).agg(
        F.min("_rid").alias("_stays")
    )
    won = groups.join(
        first, (F.col("_sha") == F.col("_s")) & F.col("keep_id").eqNullSafe(F.col("_k"))
    ).select("_sha", "keep_id", "group_size", "_stays")
    rows = suspects.select(packed, F.col("_sha").alias("sha"), "_rid")
    decided = join_hot(rows, won, {"sha": "_sha"}, "inner").select(
        "row", "keep_id", "group_size", (F.col("_rid") == F.col("_stays")).alias("kept"), "sha"
    )
    return clear.unionAll(decided)


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One whole row of each group of equal texts."""
    return exact_duplicates(docs, key, text).filter("kept").select("row.*")
