"""Language-model scores by a log-bilinear model with noise-contrastive training.

The vocabulary is that of all training texts. The most frequent words are classes of
their own; every other word belongs to a class of words with the same ending, so
that the model predicts a class and shares of the class come from counts. The
context of two tokens gives a predicted vector, the sum of their vectors weighted
per position, whose product with the class vectors plus a bias is the class's score.

*Counts* of all words are one Spark aggregation. *Training* is noise-contrastive:
every task passes over all its training tokens with unigram noise, from one common
start, and the parameters are averaged by the tokens behind them; ``ROUNDS`` rounds
start from the mean of the round before, with the mean of its step sizes. Only
parameters, a fixed number, reach the driver. *Scoring* normalises exactly: a matrix product of
predicted vectors with all class vectors gives the normaliser of each context.
Counts of the most frequent words (``KNOWN``) are broadcast; those of all others
are joined.

The probability of a word unseen in training is the class's share of one more word,
so the probabilities of all words and one unseen word per class sum to one.

Defined results: a null or empty text is its end token; without training texts all
classes are equally likely; repeated rows are scored alike; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import (
    SPACED,
    as_long,
    hashed_words,
    most_frequent,
    slices,
    text_bytes,
)
from flowlark.session import materialize

WORDS, ENDINGS = 767, 256
#: Words whose counts are broadcast (2 MB).
KNOWN = 1 << 17
SIZE, NOISE, BATCH, RATE = 16, 32, 4096, 0.1
#: Rounds of training, each over all training tokens.
ROUNDS = 3
#: Distinct words that a counting task holds before it hands them on.
HELD = 2_000_000
END = 0


def _ending(tails: list[np.ndarray]) -> np.ndarray:
    tail = np.concatenate(tails) if tails else np.zeros(0, np.uint16)
    return ((tail.astype(np.uint32) * np.uint32(40503)) >> np.uint32(5)) % np.uint32(ENDINGS)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tails: list[np.ndarray] = []
    words, firsts = hashed_words(*text_bytes(column), SPACED, tails=tails)
    return words, firsts, _ending(tails)


def _count(batches):
    """Distinct words with their ending and number; the end is the null word."""
    words, endings, counts = [], [], []
    ends = 0

    def merged():
        distinct, at, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        return distinct, np.concatenate(endings)[at], total

    for batch in batches:
        for part in slices(batch, 0):
            found, firsts, ending = _words(part.column(0))
            ends += part.num_rows
            distinct, at, n = np.unique(found, return_index=True, return_counts=True)
            words.append(distinct), endings.append(ending[at]), counts.append(n)
        if sum(map(len, words)) > 2 * HELD:
            distinct, ending, n = merged()
            words, endings, counts = [distinct], [ending], [n]
            if len(distinct) > HELD:
                yield _counted(distinct, ending, n)
                words, endings, counts = [], [], []
    if words:
        yield _counted(*merged())
    if ends:
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([0], pa.int32()), pa.array([ends])],
            names=["w", "ending", "n"],
        )


def _counted(distinct, ending, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [as_long(distinct), pa.array(ending.astype(np.int32)), pa.array(n.astype(np.int64))],
        names=["w", "ending", "n"],
    )


@dataclass
class Model:
    """Vocabulary, counts of frequent words and parameters; all of bounded size."""

    tokens: int
    distinct: int
    ends: int
    words: np.ndarray  # sorted hashes of words that are classes
    classes: np.ndarray  # their class
    known: np.ndarray  # sorted hashes of frequent words
    counts: np.ndarray
    share: np.ndarray  # by ending: tokens and distinct words, for shares
    unigram: np.ndarray
    params: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.unigram)

    def start(self) -> dict[str, np.ndarray]:
        draw = np.random.default_rng(5)
        return {
            "E": draw.normal(0, 0.1, (self.size + 1, SIZE)).astype(np.float32),
            "Q": draw.normal(0, 0.1, (self.size, SIZE)).astype(np.float32),
            "b": np.log(self.unigram).astype(np.float32),
            "c": np.ones((2, SIZE), np.float32),
        }

    def sequence(self, column: pa.Array):
        """Class, two classes before, text and word number of each token; ends included."""
        words, firsts, ending = _words(column)
        cls = (1 + WORDS + ending).astype(np.int32)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            own = self.words[at] == words
            cls[own] = self.classes[at[own]]
        lengths = np.diff(firsts) + 1
        starts = np.concatenate([[0], np.cumsum(lengths)])
        target = np.zeros(starts[-1], np.int32)
        inner = np.ones(starts[-1], bool)
        inner[starts[1:] - 1] = False
        target[inner] = cls
        before = np.full(starts[-1] + 2, self.size, np.int32)
        before[2:] = target
        one, two = before[1:-1].copy(), before[:-2].copy()
        one[starts[:-1]] = two[starts[:-1]] = self.size
        second = starts[:-1][lengths > 1] + 1
        two[second] = self.size
        return target, one, two, starts, words, inner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    flat = (rows[:, None] * SIZE + np.arange(SIZE)).ravel()
    return np.bincount(flat, values.ravel(), size * SIZE).reshape(size, SIZE)


def train_tokens(model: Model, sequences, state: dict[str, np.ndarray], turn: int = 0):
    """One pass of noise-contrastive AdaGrad over (target, one, two) arrays.

    ``state`` has the parameters to start from and, as ``past_`` them, their sums of
    squared gradients; the new state and the number of tokens are returned.
    """
    p = {k: state[k].copy() for k in model.start()}
    past = {k: state[f"past_{k}"].copy() for k in p}
    draw = np.random.default_rng(11 + turn)
    cumulative = np.cumsum(model.unigram)
    offset = np.log(NOISE * model.unigram).astype(np.float32)
    seen = 0
    for target, one, two in sequences:
        for at in range(0, len(target), BATCH):
            t, h, g = (x[at : at + BATCH] for x in (target, one, two))
            seen += len(t)
            noise = np.minimum(np.searchsorted(cumulative, draw.random(NOISE)), model.size - 1)
            eh, eg, qt, qn = p["E"][h], p["E"][g], p["Q"][t], p["Q"][noise]
            ctx = eh * p["c"][0] + eg * p["c"][1]
            good = 1 - _sigmoid((ctx * qt).sum(1) + p["b"][t] - offset[t])
            bad = -_sigmoid(ctx @ qn.T + p["b"][noise] - offset[noise])
            back = good[:, None] * qt + bad @ qn
            grad = {"Q": _scatter(t, good[:, None] * ctx, model.size)}
            np.add.at(grad["Q"], noise, bad.T @ ctx)
            grad["b"] = np.bincount(t, good, model.size)
            np.add.at(grad["b"], noise, bad.sum(0))
            grad["E"] = _scatter(
                np.concatenate([h, g]), np.concatenate([back * p["c"][0], back * p["c"][1]]), model.size + 1
            )
            grad["c"] = np.stack([(back * eh).mean(0), (back * eg).mean(0)]) * 0.1
            for k, v in grad.items():
                v = v.astype(np.float32)
                past[k] += v * v
                p[k] += RATE * v / np.sqrt(past[k])
    return {**p, **{f"past_{k}": v for k, v in past.items()}}, seen


def _flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)])


def _unflat(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def vocabulary(docs: DataFrame, text: str) -> tuple[Model, DataFrame]:
    """The untrained model and all counts (w, ending, n)."""
    counts = docs.select(text).mapInArrow(_count, "w long, ending int, n long")
    counts = materialize(counts.groupBy("w").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")))
    whole = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"),
        F.coalesce(F.sum(F.when(F.col("w").isNull(), F.col("n"))), F.lit(0)).alias("ends"),
    ).first()
    listed = counts.filter("w is not null")
    top = most_frequent(listed, "n", KNOWN).toArrow()  # at most KNOWN rows
    order = np.lexsort((np.asarray(top["w"]), -np.asarray(top["n"])))
    w = np.asarray(top["w"]).view(np.uint64)[order]
    n, ending = np.asarray(top["n"])[order], np.asarray(top["ending"])[order]
    share = np.zeros((ENDINGS, 2))
    for row in listed.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        share[row["ending"]] = row["n"], row["v"]  # ENDINGS rows
    own = min(WORDS, len(w))
    np.add.at(share, ending[:own], -np.stack([n[:own], np.ones(own)], axis=1))
    mass = np.ones(1 + WORDS + ENDINGS)
    mass[END] += whole["ends"]
    mass[1 : 1 + own] += n[:own]
    mass[1 + WORDS :] += share[:, 0]
    by_hash, by_known = np.argsort(w[:own]), np.argsort(w)
    model = Model(
        int(whole["n"]), int(whole["v"]), int(whole["ends"]),
        w[:own][by_hash], (1 + by_hash).astype(np.int32), w[by_known], n[by_known],
        share, mass / mass.sum(),
    )
    return model, listed


def train(docs: DataFrame, text: str, model: Model, rounds: int | None = None) -> Model:
    """Parameters after rounds of averaging what tasks reach on their training tokens."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)
    start = model.start()
    state = {**start, **{f"past_{k}": np.full(v.shape, 1e-2, np.float32) for k, v in start.items()}}
    for turn in range(ROUNDS if rounds is None else rounds):
        mean = _round(docs, text, shared, sc.broadcast(state), turn)  # a fixed number of parameters
        if not len(mean):
            break
        state = _unflat(mean, state)
    model.params = {k: state[k] for k in start}
    return model


def _round(docs: DataFrame, text: str, shared, state, turn: int) -> np.ndarray:
    def run(batches):
        model = shared.value
        parts = (part for batch in batches for part in slices(batch, 0))
        sequences = (model.sequence(p.column(0))[:3] for p in parts)
        params, seen = train_tokens(model, sequences, state.value, turn)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen]), pa.array([_flat(params)], pa.list_(pa.float32()))], names=["seen", "p"]
            )

    learned = docs.select(text).mapInArrow(run, "seen long, p array<float>")
    parts = learned.select("seen", F.posexplode("p").alias("at", "v"))
    mean = parts.groupBy("at").agg((F.sum(F.col("v") * F.col("seen")) / F.sum("seen")).alias("v"))
    return np.asarray(mean.orderBy("at").toArrow()["v"])  # as many rows as parameters


class Scorer:
    """Normalised scores; normalisers of contexts are kept once computed."""

    def __init__(self, model: Model):
        self.model = model
        self.norms = np.full((model.size + 1, model.size + 1), np.nan, np.float32)

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        p = self.model.params
        return p["E"][one] * p["c"][0] + p["E"][two] * p["c"][1]

    def normalise(self, one: np.ndarray, two: np.ndarray, block: int = 8192) -> np.ndarray:
        p = self.model.params
        missing = np.isnan(self.norms[one, two])
        codes = np.unique(one[missing].astype(np.int64) * (self.model.size + 1) + two[missing])
        for at in range(0, len(codes), block):
            a, b = np.divmod(codes[at : at + block], self.model.size + 1)
            scores = self.context(a, b) @ p["Q"].T + p["b"]
            top = scores.max(axis=1, keepdims=True)
            self.norms[a, b] = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        return self.norms[one, two]

    def class_scores(self, target, one, two) -> np.ndarray:
        """Natural log-probability of each class in its context."""
        p = self.model.params
        out = np.empty(len(target))
        for at in range(0, len(target), 1 << 17):
            t, h, g = (x[at : at + (1 << 17)] for x in (target, one, two))
            raw = np.einsum("ij,ij->i", self.context(h, g), p["Q"][t]) + p["b"][t]
            out[at : at + (1 << 17)] = raw - self.normalise(h, g)
        return out

    def score(self, column: pa.Array):
        """Per text: tokens, known tokens, base and model sums, rare words by text."""
        m = self.model
        target, one, two, starts, words, inner = m.sequence(column)
        logs = self.class_scores(target, one, two) / np.log(10)
        count = np.full(len(target), -1, np.int64)
        found = np.full(len(words), -1, np.int64)
        if len(m.known):
            at = np.minimum(np.searchsorted(m.known, words), len(m.known) - 1)
            hit = m.known[at] == words
            found[hit] = m.counts[at[hit]]
        count[inner] = found
        count[~inner] = m.ends
        number = np.log10(np.maximum(count, 0) + 1)
        ending = target - (1 + WORDS)
        shared = ending >= 0
        model_part = logs.copy()
        model_part[shared] += number[shared] - np.log10(m.share.sum(axis=1) + 1)[ending[shared]]
        lengths = np.diff(starts)
        base = np.add.reduceat(number, starts[:-1]) - lengths * np.log10(m.tokens + m.distinct + 1)
        rare = np.flatnonzero(found < 0)
        firsts = starts[:-1] - np.arange(len(lengths))
        text_of = np.searchsorted(firsts, rare, side="right") - 1
        order = np.lexsort((words[rare], text_of))
        rare, text_of = words[rare][order], text_of[order]
        fresh = np.ones(len(rare), bool)
        fresh[1:] = (rare[1:] != rare[:-1]) | (text_of[1:] != text_of[:-1])
        heads = np.flatnonzero(fresh)
        times = np.diff(np.append(heads, len(rare)))
        cuts = np.searchsorted(text_of[heads], np.arange(len(lengths) + 1))
        known = np.add.reduceat((count > 0).astype(np.int64), starts[:-1])
        return lengths, known, base, np.add.reduceat(model_part, starts[:-1]), cuts, rare[heads], times


def score_documents(
    docs: DataFrame, training: Column, text: str = "text", carry: list[Column] = ()
) -> DataFrame:
    """The carried columns with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` says which rows the model learns from.
    """
    rows = docs.select(F.col(text).alias("_text"), *carry)
    lessons = docs.filter(training).select(F.col(text).alias("_text"))
    model, counts = vocabulary(lessons, "_text")
    model = train(lessons, "_text", model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch, 0):
                tokens, known, base, score, cuts, rare, times = scorer.score(part.column(0))
                cuts = pa.array(cuts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[1:], pa.array(tokens), pa.array(known), pa.array(base), pa.array(score),
                        pa.ListArray.from_arrays(cuts, as_long(rare)),
                        pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int32))),
                    ],
                    names=[*part.schema.names[1:], "_tokens", "_known", "_base", "_score", "_rare", "_times"],
                )

    fields = rows.schema.fields[1:]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    scored = rows.mapInArrow(
        run,
        f"{kinds}, _tokens long, _known long, _base double, _score double, "
        "_rare array<long>, _times array<int>",
    )
    scored = materialize(scored).withColumn("_rid", F.monotonically_increasing_id())
    rare = scored.select(F.col("_rid").alias("_r"), F.explode(F.arrays_zip("_rare", "_times")).alias("x"))
    rare = rare.select("_r", F.col("x._rare").alias("rare"), F.col("x._times").alias("times"))
    rare = rare.join(counts.select("w", "n"), F.col("rare") == F.col("w"))
    more = rare.groupBy("_r").agg(
        F.sum("times").alias("_k"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_logs")
    )
    out = scored.join(more, F.col("_rid") == F.col("_r"), "left")
    logs = F.coalesce("_logs", F.lit(0.0))
    return out.select(
        *[F.col(f"`{f.name}`") for f in fields],
        F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_k", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + logs).alias("base_score"),
        (F.col("_score") + logs).alias("score"),
    )
