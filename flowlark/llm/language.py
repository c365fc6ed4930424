"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes. Its statistics are
counts of all four-byte windows of all training texts (A-Z lower-cased, three line
feeds in front), gathered by Spark and frozen. A byte seen d-distinct-ways in a
context of t occurrences costs -log2(n / (t + d)) bits; an unseen one pays the escape
-log2(d / (t + d)) and tries the next shorter context, down to 8 bits for any byte;
contexts that a language never saw escape free of charge. The language with the
shortest exact code of the whole text wins.

All counts are used, whatever their number. Up to ``max_windows`` of them are
broadcast. If there are more, windows of three and four bytes are broadcast for the
most frequent contexts, each context with all its windows; code lengths of the other
windows that the texts hold are computed in Spark from all counts and joined.

Defined results: null texts and texts without a letter are ``und`` with score 0;
rows without a text or language are not learned from; without anything to learn from
all texts are ``und``; ties go to the first language in order; repeated rows are
predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import most_frequent, slices, text_bytes
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

#: Counts of windows that are broadcast.
MAX_WINDOWS = 2_000_000
DEPTH = 4
PAD = 3
UNKNOWN = "und"
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def windows(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The four bytes that end at each byte of each text, as one integer."""
    counts = np.diff(starts)
    padded = np.full(len(data) + PAD * len(counts), 10, np.uint8)
    text_of = np.repeat(np.arange(1, len(counts) + 1, dtype=np.int64) * PAD, counts)
    at = np.arange(len(data)) + text_of
    padded[at] = _LOWER[data]
    wide = padded.astype(np.uint32)
    code = wide.copy()
    for back in (1, 2, 3):
        code[back:] |= wide[:-back] << np.uint32(8 * back)
    return code[at]


def _count(batches):
    """Counts of windows by language within a partition."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def rows():
        for lang, (codes, counts) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.astype(np.int64)), pa.array(counts)],
                names=["lang", "code", "n"],
            )

    for batch in batches:
        for part in slices(batch, 1):
            for lang in pc.unique(part.column(0)).to_pylist():
                texts = part.column(1).filter(pc.equal(part.column(0), lang))
                codes, counts = np.unique(windows(*text_bytes(texts)), return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], codes])
                    codes, place = np.unique(both, return_inverse=True)
                    counts = np.bincount(place, np.concatenate([held[lang][1], counts])).astype(np.int64)
                held[lang] = (codes, counts)
        if sum(len(c) for c, _ in held.values()) > MAX_WINDOWS:
            yield from rows()
            held.clear()
    yield from rows()


@dataclass
class Level:
    """Code lengths of windows of one length, and escapes of their contexts."""

    keys: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray
    whole: bool = True  # if not, absent contexts may have been seen
    slots: np.ndarray | None = None
    probes: int = 0


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in sorted keys, -1 where absent."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return np.where(keys[at] == wanted, at, -1) if len(keys) else np.full(len(wanted), -1)


def _hash(codes: np.ndarray, size: int) -> np.ndarray:
    shift = np.uint32(32 - (size - 1).bit_length())
    return (codes * np.uint32(0x9E3779B1)) >> shift


def _slots(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """An open-addressing table of places, and the longest probe."""
    size = 1 << max(4, (4 * max(len(keys), 1) - 1).bit_length())
    table = np.full(size, -1, np.int32)
    left, at, probes = np.arange(len(keys)), _hash(keys, size).astype(np.int64), 0
    while len(left):
        probes += 1
        free = table[at] < 0
        table[at[free]] = left[free]
        lost = table[at] != left
        left, at = left[lost], (at[lost] + 1) & (size - 1)
    return table, probes


class Model:
    """Frozen context trees of all languages.

    ``tables`` has (language, window, count) for windows of one to ``DEPTH`` bytes, and
    ``whole`` says for each whether it has all contexts; a context that it has is there
    with all its windows.
    """

    def __init__(self, langs: list[str], tables, whole=(True,) * DEPTH, counts: DataFrame | None = None):
        self.langs = langs
        self.counts = counts  # all counts, where the tables are not whole
        self.levels: list[Level] = []
        for depth, (lang, code, n) in enumerate(tables, 1):
            keys, place = np.unique(code, return_inverse=True)
            seen = np.zeros((len(keys), len(langs)))
            np.add.at(seen, (place, lang), n.astype(np.float64))
            contexts, of = np.unique(self._context(keys, depth), return_inverse=True)
            total = np.zeros((len(contexts), len(langs)))
            kinds = np.zeros_like(total)
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                all_ = total + kinds
                escapes = np.where(total > 0, -np.log2(kinds / all_), 0.0)
                bits = -np.log2(seen / all_[of])
            below = self._lengths(keys, depth - 1)
            bits = np.where(seen > 0, bits, escapes[of] + below)
            level = Level(keys, bits.astype(np.float32), contexts, escapes.astype(np.float32), whole[depth - 1])
            level.slots, level.probes = _slots(keys)
            self.levels.append(level)

    def __getstate__(self):
        return {**self.__dict__, "counts": None}  # tasks have no DataFrames

    @property
    def whole(self) -> bool:
        return all(level.whole for level in self.levels)

    @staticmethod
    def _context(codes: np.ndarray, depth: int) -> np.ndarray:
        """The bytes before the last, of a window of ``depth`` bytes."""
        return (codes & np.uint32((1 << (8 * depth)) - 1)) >> np.uint32(8)

    def _lengths(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """Bits of the last byte of windows by language; NaN where the tables do not tell."""
        if depth == 0:
            return np.full((len(codes), len(self.langs)), 8.0, np.float32)
        level = self.levels[depth - 1]
        codes = codes & np.uint32((1 << (8 * depth)) - 1)
        if not len(level.keys):
            return self._lengths(codes, depth - 1) if level.whole else np.full((len(codes), len(self.langs)), np.nan, np.float32)
        at = _hash(codes, len(level.slots)).astype(np.int64)
        place = level.slots[at]
        good = (place >= 0) & (level.keys[place] == codes)
        open_ = np.flatnonzero(~good & (place >= 0))
        for _ in range(level.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(level.slots) - 1)
            place[open_] = level.slots[at[open_]]
            hit = (place[open_] >= 0) & (level.keys[place[open_]] == codes[open_])
            good[open_[hit]] = True
            open_ = open_[~hit & (place[open_] >= 0)]
        out = level.bits[place]
        rest = np.flatnonzero(~good)
        if len(rest):
            context = _find(level.contexts, self._context(codes[rest], depth))
            paid = np.where(context[:, None] >= 0, level.escapes[context], 0 if level.whole else np.nan)
            out[rest] = paid + self._lengths(codes[rest], depth - 1)
        return out

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        return self.parted_lengths(data, starts)[0]

    def parted_lengths(self, data: np.ndarray, starts: np.ndarray):
        """Bits of each text in each language without its other windows; these, by text.

        Other windows are those of which the tables do not tell all code lengths: the
        bounds of each text in them, the distinct windows, and how often each comes.
        """
        out = np.zeros((len(starts) - 1, len(self.langs)))
        cuts = np.zeros(len(starts), np.int64)
        others, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(data):
            codes = windows(data, starts)
            bits = self._lengths(codes, DEPTH)
            if not self.whole:
                other = np.flatnonzero(np.isnan(bits).any(axis=1))
                bits[other] = 0
                text_of = np.searchsorted(starts, other, side="right") - 1
                pairs, times = np.unique(text_of << 32 | codes[other].astype(np.int64), return_counts=True)
                cuts = np.searchsorted(pairs >> 32, np.arange(len(starts)))
                others = pairs & 0xFFFFFFFF
            rows = np.flatnonzero(np.diff(starts))
            out[rows] = np.add.reduceat(bits, starts[rows], axis=0, dtype=np.float64)
        return out, cuts, others, times


def _level(counts: DataFrame, depth: int) -> DataFrame:
    """Counts (lang, code, n) of windows of ``depth`` bytes."""
    if depth == DEPTH:
        return counts
    short = F.col("code").bitwiseAND(F.lit((1 << 8 * depth) - 1))
    return counts.groupBy("lang", short.alias("code")).agg(F.sum("n").alias("n"))


def _context_of(code: str) -> Column:
    return F.shiftright(code, 8)


def _head(level: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    """All windows of the most frequent contexts, at most ``limit`` rows; whether that is all."""
    level = materialize(level)
    rows = level.count()
    if rows <= limit:
        return level, True
    contexts = level.groupBy(_context_of("code").alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    top = most_frequent(materialize(contexts), "n", limit, F.col("rows")).select("c")
    return level.withColumn("_c", _context_of("code")).join(top, F.col("_c") == F.col("c"), "left_semi").drop("_c"), False


def _arrays(rows: DataFrame, langs: list[str]):
    top = rows.select("lang", "code", "n").toArrow()
    names = top["lang"].combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    index = np.array([langs.index(x) for x in names.dictionary.to_pylist()], np.int64)
    place = index[np.asarray(names.indices)] if len(index) else np.zeros(0, np.int64)
    return place, np.asarray(top["code"]).astype(np.uint32), np.asarray(top["n"])


def learn(docs: DataFrame, text: str, lang: str, max_windows: int = MAX_WINDOWS) -> Model:
    """Context trees from all rows with a text and a language."""
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = rows.select(F.col(lang).cast("string"), text).mapInArrow(_count, "lang string, code long, n long")
    counts = materialize(counts.groupBy("lang", "code").agg(F.sum("n").alias("n")))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row per language
    if counts.count() <= max_windows:
        place, code, n = _arrays(counts, langs)  # at most max_windows rows
        return Model(langs, [(place, code & np.uint32((1 << 8 * d) - 1), n) for d in range(1, DEPTH + 1)])
    tables, whole = [], []
    for depth in range(1, DEPTH + 1):
        level = _level(counts, depth)
        full = True
        if depth > 2:  # one and two bytes have at most 65,792 windows
            level, full = _head(level, max_windows // 2)
        tables.append(_arrays(level, langs))  # at most max_windows // 2 rows
        whole.append(full)
    return Model(langs, tables, whole, counts)


def _by_language(rows: DataFrame, key: Column, model: Model, **values: Column) -> DataFrame:
    """Rows (key, by_lang): a map from places of languages to aggregates."""
    place = F.array_position(F.array(*[F.lit(x) for x in model.langs]), F.col("lang")).cast("int") - 1
    each = rows.groupBy(key.alias("key"), place.alias("place")).agg(*[v.alias(k) for k, v in values.items()])
    pair = F.struct("place", F.struct(*values))
    return each.groupBy("key").agg(F.map_from_entries(F.collect_list(pair)).alias("by_lang"))  # one entry per language


def _exact(model: Model, shared, codes: DataFrame, depth: int) -> DataFrame:
    """Rows (code, bits) for distinct windows of ``depth`` bytes, from all counts."""

    def run(batches):
        for batch in batches:
            bits = shared.value._lengths(np.asarray(batch.column(0)).astype(np.uint32), depth - 1)
            known = ~np.isnan(bits).any(axis=1)
            below = pa.array([b if k else None for b, k in zip(bits, known)], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), below], names=["low", "below"])

    low = F.col("code").bitwiseAND(F.lit((1 << 8 * (depth - 1)) - 1))
    lower = codes.select(low.alias("low")).distinct().mapInArrow(run, "low long, below array<float>")
    if depth > 3:
        lower = materialize(lower)
        more = _exact(model, shared, lower.filter("below is null").select(F.col("low").alias("code")), depth - 1)
        lower = lower.filter("below is not null").unionAll(more.toDF("low", "below"))
    level = materialize(_level(model.counts, depth))
    seen = _by_language(level, F.col("code"), model, n=F.sum("n")).toDF("seen_key", "seen")
    context = _by_language(level, _context_of("code"), model, n=F.sum("n"), kinds=F.count("*")).toDF("context_key", "context")
    joined = (
        codes.withColumn("_low", low)
        .join(lower, F.col("_low") == F.col("low"))
        .join(seen, F.col("code") == F.col("seen_key"), "left")
        .join(context, _context_of("code") == F.col("context_key"), "left")
    )

    def length(below, place):
        at, own = F.try_element_at("context", place), F.try_element_at("seen", place)["n"]
        whole = at["n"] + at["kinds"]
        escape = F.when(at.isNull(), 0.0).otherwise(-F.log2(at["kinds"] / whole))
        return F.when(own.isNotNull(), -F.log2(own / whole)).otherwise(escape + below).cast("float")

    return joined.select("code", F.transform("below", length).alias("bits"))


def predict(docs: DataFrame, model: Model, text: str, carry: list[Column]) -> DataFrame:
    """The carried columns with lang_pred and score."""
    rows = docs.select(F.col(text).alias("_text"), *carry)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_WINDOWS windows
    fields = rows.schema.fields[1:]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if not model.whole:
        return _predict_joined(rows, model, shared, kinds)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices(batch, 0):
                texts = part.column(0)
                known = _lettered(texts) & bool(model.langs)
                names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                if known.any():
                    bits = model.code_lengths(*text_bytes(texts))
                    best = bits.argmin(axis=1)
                    gap = np.minimum(bits - bits.min(axis=1)[:, None], 1000.0)
                    scores = np.where(known, 1 / np.exp2(-gap).sum(axis=1), 0.0)
                    names = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(names, pa.string()), pa.array(scores)],
                    names=[*part.schema.names[1:], "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def _lettered(texts: pa.Array) -> np.ndarray:
    return np.array([next(filter(str.isalpha, t or ""), None) is not None for t in texts.to_pylist()], bool)


def _predict_joined(rows: DataFrame, model: Model, shared, kinds: str) -> DataFrame:
    """As predict, with the windows that the broadcast does not tell joined."""
    names = rows.columns[1:]

    def run(batches):
        for batch in batches:
            for part in slices(batch, 0):
                texts = part.column(0)
                bits, cuts, others, times = shared.value.parted_lengths(*text_bytes(texts))
                cuts = pa.array(cuts, pa.int32())
                ends = pa.array(np.arange(len(bits) + 1) * bits.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:], pa.array(_lettered(texts)),
                        pa.ListArray.from_arrays(ends, pa.array(bits.ravel())),
                        pa.ListArray.from_arrays(cuts, pa.array(others)),
                        pa.ListArray.from_arrays(cuts, pa.array(times)),
                    ],
                    names=[*names, "_lettered", "_bits", "_codes", "_times"],
                )

    made = f"{kinds}, _lettered boolean, _bits array<double>, _codes array<long>, _times array<long>"
    parted = materialize(rows.mapInArrow(run, made)).withColumn("_rid", F.monotonically_increasing_id())
    pairs = parted.filter("_lettered").select("_rid", F.explode(F.arrays_zip("_codes", "_times")).alias("x"))
    pairs = pairs.select(F.col("_rid").alias("_r"), F.col("x._codes").alias("_code"), F.col("x._times").alias("_n"))
    exact = _exact(model, shared, pairs.select(F.col("_code").alias("code")).distinct(), DEPTH)
    found = join_hot(pairs, exact, {"_code": "code"}, "inner")
    sums = [F.sum(F.col("bits")[i] * F.col("_n")).alias(f"b{i}") for i in range(len(model.langs))]
    more = found.groupBy("_r").agg(*sums)
    more = more.select("_r", F.array(*[f"b{i}" for i in range(len(model.langs))]).alias("_more"))
    out = parted.join(more, F.col("_rid") == F.col("_r"), "left")
    bits = F.when(F.col("_more").isNull(), F.col("_bits")).otherwise(F.zip_with("_bits", "_more", lambda a, b: a + b))
    out = out.withColumn("_all", bits).withColumn("_least", F.array_min("_all"))
    best = F.array_position("_all", F.col("_least")).cast("int")
    near = F.transform("_all", lambda b: F.pow(F.lit(2.0), -F.least(b - F.col("_least"), F.lit(1000.0))))
    score = 1 / F.aggregate(near, F.lit(0.0), lambda a, b: a + b)
    return out.select(
        *[F.col(f"`{n}`") for n in names],
        F.when(F.col("_lettered"), F.element_at(F.array(*[F.lit(x) for x in model.langs]), best)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_lettered"), score).otherwise(0.0).alias("score"),
    )
