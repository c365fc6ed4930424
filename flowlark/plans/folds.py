"""Folds of the order-dependent operators, on whole arrays.

Rows of a key are in order. Which rows open a window, are accepted or complete a cycle
follows from pointers to the next such row, found for all rows at once; a walk then visits
the openings alone. Sums are added row by row, so they do not depend on other windows.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlark.plans.ordered import HEAD, Fold, next_at_or_after

#: Rows of a window up to which windows are summed side by side.
SHORT = 48


# --- rows of a batch ----------------------------------------------------------------------


def _valid(arrays: dict) -> tuple[np.ndarray, np.ndarray]:
    """Times and values of the rows that count."""
    times, values = arrays["_t"], arrays.get("_v")
    if values is None:
        return np.asarray(times), np.zeros(len(times))
    at = ~np.ma.getmaskarray(values)
    return np.asarray(times)[at], np.asarray(values)[at]


def _fresh(rows: int, changes: np.ndarray | None) -> np.ndarray:
    """Which rows begin a key."""
    out = np.zeros(rows, bool)
    if changes is not None and rows:
        out[1:] = changes
    return out


def _positive(width: int) -> int:
    if width <= 0:
        raise ValueError("the width must be positive")
    return width


def _walk(following: np.ndarray, start: int) -> np.ndarray:
    """The rows that pointers visit from ``start`` on, up to the end."""
    step, out, at = following.tolist(), [], start
    while at < len(step):
        out.append(at)
        at = step[at]
    return np.array(out, np.int64)


def openings(t: np.ndarray, fresh: np.ndarray, width: int, last: int | None) -> np.ndarray:
    """Rows that begin a key or come ``width`` or more after the opening before them.

    ``last`` is the opening that the first rows continue, None where they begin a key.
    On a clock that lets ``width`` pass between keys, and no more than that between two
    rows, times grow over all rows, and the first row of a key is always over the width.
    """
    most = max((1 << 62) // width, 1)  # rows for which the clock cannot overflow
    out = [np.zeros(0, np.int64)]
    for a in range(0, len(t), most):
        part, begins = t[a : a + most], fresh[a : a + most]
        passed = np.minimum(np.diff(part), width)
        passed[begins[1:]] = width
        clock = np.concatenate([[0], np.cumsum(passed)])
        start = 0
        if last is not None and not begins[0]:
            end = int(np.argmax(begins)) if begins.any() else len(part)
            start = int(np.searchsorted(part[:end], last + width))
        found = _walk(np.searchsorted(clock, clock + width), start)
        if len(found):
            last = int(part[found[-1]])
        out.append(found + a)
    return np.concatenate(out)


def window_sums(v: np.ndarray, starts: np.ndarray, first: float) -> np.ndarray:
    """Running sums that begin anew at ``starts``; rows before them go on from ``first``.

    Added in the order of the rows: short windows side by side, long ones each.
    """
    out = v.astype(float)
    ends = np.append(starts[1:], len(v))
    head = int(starts[0]) if len(starts) else len(v)
    if head:
        out[:head] = np.cumsum(np.concatenate([[first], v[:head]]))[1:]
    size = ends - starts
    for a, b in zip(starts[size > SHORT].tolist(), ends[size > SHORT].tolist()):
        out[a:b] = np.cumsum(v[a:b])
    at, left = starts[size <= SHORT], size[size <= SHORT]
    for step in range(1, SHORT):
        at, left = at[left > step], left[left > step]
        if not len(at):
            break
        out[at + step] = out[at + step - 1] + v[at + step]
    return out


# --- windows ------------------------------------------------------------------------------


class JumpExits:
    """Exit states of a chunk for windows of one width that open at a row.

    Whatever the entry state, the first row to open a window lies within one width of the
    chunk's start. Each such row begins a path of openings, and paths that come to one row
    stay together: a forest, in which a path points to the one it joined. Only the paths
    whose open window ends in a batch are touched; they are the oldest ones, at the front
    of a queue. Sums are differences of the chunk's running sums, kept in long doubles.
    """

    def __init__(self, width: int):
        self.width, self.total, self.rows = width, np.longdouble(0), 0
        self.head: int | None = None  # entry rows lie before this time
        self.open = True
        self.last: int | None = None  # time of the last entry row
        self.entries: list[np.ndarray] = []  # time of each possible entry row
        self.joined: list[np.ndarray] = []  # (path, path it joined)
        self.paths = 0
        # Open windows, oldest first: opening time, path, and sum and rows before it.
        self.queue: deque[tuple[np.ndarray, ...]] = deque()

    def feed(self, arrays: dict) -> None:
        t, v = _valid(arrays)
        if len(t) == 0:
            return
        if self.head is None:
            self.head = int(t[0]) + self.width
        before = self.total + np.concatenate([[0], np.cumsum(v, dtype=np.longdouble)])
        following = np.searchsorted(t, t + self.width)
        there = np.append(np.where(following == len(t), np.arange(len(t)), following), len(t))
        while True:  # to the last opening of each row's path in this batch
            further = there[there]
            if np.array_equal(further, there):
                break
            there = further
        paths, rows = self._due(t)
        if self.open:
            new = self._entry_rows(t)
            self.entries.append(t[new])
            rows = np.concatenate([rows, new])
            paths = np.concatenate([paths, self.paths + np.arange(len(new))])
            self.paths += len(new)
        rows, one, which = np.unique(there[rows], return_index=True, return_inverse=True)
        kept = paths[one]
        pairs = np.stack([paths, kept[which]])
        self.joined.append(pairs[:, pairs[0] != pairs[1]])
        if len(rows):
            self.queue.append((t[rows], kept, before[rows], self.rows + rows))
        self.total, self.rows = before[-1], self.rows + len(t)

    def _due(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths whose window ends in this batch, and the rows that open their next one."""
        paths, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while self.queue:
            starts = self.queue[0][0]
            due = int(np.searchsorted(starts, int(t[-1]) - self.width, side="right"))
            if due:
                paths.append(self.queue[0][1][:due])
                rows.append(np.searchsorted(t, starts[:due] + self.width))
            if due < len(starts):
                self.queue[0] = tuple(x[due:] for x in self.queue[0])
                break
            self.queue.popleft()
        return np.concatenate(paths), np.concatenate(rows)

    def _entry_rows(self, t: np.ndarray) -> np.ndarray:
        """First rows of each new time up to the first one past the head."""
        end = int(np.searchsorted(t, self.head))
        self.open = end == len(t)
        near = t[: end + 1]
        first = np.flatnonzero(np.diff(near, prepend=near[0] - 1) != 0)
        if self.last is not None:
            first = first[near[first] != self.last]
        self.last = int(near[-1])
        return first

    def table(self) -> tuple[list, list, tuple]:
        """The last entry row of each path that stays apart, and the state it leaves."""
        total = (None, float(self.total), self.rows)
        if not self.paths:
            return [], [], total
        root = np.arange(self.paths)
        for pairs in reversed(self.joined):
            root[pairs[0]] = root[pairs[1]]
        starts, paths, sums, rows = (np.concatenate(x) for x in zip(*self.queue))
        place = np.empty(self.paths, np.int64)
        place[paths] = np.arange(len(paths))
        last = np.flatnonzero(np.diff(root, append=-1))
        p = place[root[last]]
        exits = zip(starts[p].tolist(), (self.total - sums[p]).astype(float).tolist(), (self.rows - rows[p]).tolist())
        return np.concatenate(self.entries)[last].tolist(), list(exits), total


class AnchoredFold(Fold):
    """Windows that open at the row which found the last one over.

    State: opening time, sum and count of the open window.
    """

    def __init__(self, width: int):
        self.width = _positive(width)

    def run(self, arrays: dict, state, changes: np.ndarray | None = None) -> tuple[dict, tuple]:
        bad = np.ma.getmaskarray(arrays["_v"])
        size = len(bad)
        key = np.cumsum(_fresh(size, changes))  # keys of the rows; 0 goes on
        t, v = _valid(arrays)
        at = np.flatnonzero(~bad)
        key_at = key[at]
        start, total, n = state if state is not None else (None, 0.0, 0)
        fresh = np.diff(key_at, prepend=0 if start is not None else -1) != 0
        opened = openings(t, fresh, self.width, start)
        sums, place = window_sums(v, opened, total), np.arange(len(t))
        window = np.searchsorted(opened, place, side="right") - 1
        counts = place + 1 + n if not len(opened) else place - opened[window] + 1
        if len(opened):
            counts = np.where(window < 0, place + 1 + n, counts)
        shown_sums, shown_counts = sums.copy(), counts.copy()
        over = opened[~fresh[opened]]
        shown_sums[over] = np.where(over > 0, sums[over - 1], total)
        shown_counts[over] = np.where(over > 0, counts[over - 1], n)
        outs = {"window_sum": np.zeros(size), "window_count": np.zeros(size, np.int64), "_elapsed": np.zeros(size, bool)}
        outs["window_sum"][at], outs["window_count"][at] = shown_sums, shown_counts
        outs["_elapsed"][at[over]] = True
        for c in ("window_sum", "window_count"):
            outs[c] = np.ma.MaskedArray(outs[c], bad)
        if size and (not len(at) or key_at[-1] != key[-1]):  # the last key has no row that counts
            return outs, state if key[-1] == 0 else None
        if not len(t):
            return outs, state
        after = int(t[opened[-1]]) if len(opened) else start
        return outs, (after, float(sums[-1]), int(counts[-1]))

    def exits(self) -> JumpExits:
        return JumpExits(self.width)

    def following(self, nodes, spans):
        return next_at_or_after(nodes, spans, F.coalesce(F.col("a") + self.width, F.lit(HEAD)))

    def passed(self, state, sums, rows):
        return None if state is None or state[0] is None else (state[0], state[1] + sums, state[2] + rows)


class AgeOffFold(Fold):
    """Accepts a row when its key was last accepted at least ``ttl`` ago.

    State: time of the last accepted row.
    """

    def __init__(self, ttl: int):
        self.ttl = _positive(ttl)

    def run(self, arrays: dict, state, changes: np.ndarray | None = None) -> tuple[dict, tuple]:
        t = np.asarray(arrays["_t"])
        last = None if state is None else state[0]
        begins = _fresh(len(t), changes)
        if len(t) and last is None:
            begins[0] = True
        taken = openings(t, begins, self.ttl, last)
        fresh = np.zeros(len(t), bool)
        fresh[taken] = True
        return {"_fresh": fresh}, (int(t[taken[-1]]) if len(taken) else last, 0.0, 0)

    def exits(self) -> JumpExits:
        return JumpExits(self.ttl)

    def following(self, nodes, spans):
        return next_at_or_after(nodes, spans, F.coalesce(F.col("a") + self.ttl, F.lit(HEAD)))

    def passed(self, state, sums, rows):
        return state


# --- cycles -------------------------------------------------------------------------------


class CounterExits:
    """Exit counts of a chunk for every count it may be entered with.

    Counts only grow by one per row, so a running cycle is known by the row
    where it began. The one cycle that a row completes begins anew there.
    """

    def __init__(self):
        self.row = 0
        self.began: dict[int, int] = {}  # first row of a cycle -> entry count it comes from
        self.used: set[int] = set()

    def feed(self, arrays: dict) -> None:
        ok = np.asarray(arrays["_ok"]).astype(bool)
        for want in np.asarray(arrays["_want"])[ok].tolist():
            self.row += 1
            cycle = self.row - want
            entry = self.began.pop(cycle, None)
            if entry is None and cycle <= 0 and -cycle not in self.used:
                entry = -cycle
                self.used.add(entry)
            if entry is not None:
                self.began[self.row] = entry

    def table(self) -> tuple[list, list, tuple]:
        entries = list(self.began.values())
        exits = [(self.row - cycle, 0.0, 0) for cycle in self.began]
        return entries, exits, (None, 0.0, self.row)


def completions(want: np.ndarray, fresh: np.ndarray, count: int) -> np.ndarray:
    """Rows that complete a cycle, of rows that count; ``count`` rows came before.

    A row completes the one cycle that began ``want`` rows before its end. So each place
    has at most one first row to complete a cycle from there, and cycles follow by pointers.
    """
    n = len(want)
    rows = np.arange(n)
    starts = np.flatnonzero(fresh)
    key = np.cumsum(fresh)
    begin = np.concatenate([[0], starts])[key]
    place = rows + 1 - want
    fits = np.flatnonzero((place >= begin) & (want > 0))[::-1]
    first = np.full(n + 1, n, np.int64)  # the row that completes a cycle from each place
    first[place[fits]] = fits  # the earliest row is written last
    goes_on = np.flatnonzero((key == 0) & (want > 0) & (place == -count))
    first, done = first.tolist(), []
    row = int(goes_on[0]) if len(goes_on) else n
    for end in np.append(starts, n).tolist():
        while row < end:
            done.append(row)
            row = first[row + 1]
        row = first[end]
    return np.array(done, np.int64)


class CounterFold(Fold):
    """Counts rows; a row whose own expected count is reached ends the cycle.

    State: rows counted in the open cycle.
    """

    exact = True

    def run(self, arrays: dict, state, changes: np.ndarray | None = None) -> tuple[dict, tuple]:
        count = int(state[0] or 0) if state else 0
        ok = np.asarray(arrays["_ok"]).astype(bool)
        key = np.cumsum(_fresh(len(ok), changes))
        good = np.flatnonzero(ok)
        done = np.zeros(len(ok), bool)
        fresh = np.diff(key[good], prepend=0) != 0
        ends = completions(np.ma.getdata(arrays["_want"])[good].astype(np.int64), fresh, count)
        done[good[ends]] = True
        if len(ok) and key[-1] and (not len(good) or key[good[-1]] != key[-1]):
            return {"_done": done}, (0, 0.0, 0)
        began = max(int(ends[-1]) + 1 if len(ends) else -count, int(np.flatnonzero(fresh)[-1]) if fresh.any() else -count)
        return {"_done": done}, (len(good) - began, 0.0, 0)

    def exits(self) -> CounterExits:
        return CounterExits()

    def following(self, nodes, spans):
        """Counts minus the rows before them stay the same until a cycle ends."""
        before, upto, run = {}, {}, None
        for x in spans:
            total = upto[run[1]] if run is not None and run[0] == x.run else 0
            before[x.chunk], upto[x.chunk] = total, total + x.rows
            run = (x.run, x.chunk)
        spark = nodes.sparkSession
        table = spark.createDataFrame(
            [(c, before[c], upto[c]) for c in before], "sq int, before long, upto long"
        )
        placed = nodes.join(F.broadcast(table), F.col("q") == F.col("sq"), "left")  # one row per chunk
        upto_ = F.coalesce("upto", F.lit(0).cast("long"))
        seekers = placed.select(
            "_run", (F.coalesce("a", F.lit(0)) - upto_).alias("at"), F.col("q").alias("place"),
            F.lit(0).alias("turn"), "q", "m", F.lit(None).cast("struct<tq:int,tm:bigint>").alias("to"),
        )
        marks = placed.filter(F.col("m") != HEAD).select(
            "_run", (F.col("m") - F.col("before")).alias("at"), F.col("q").alias("place"),
            F.lit(1).alias("turn"), "q", "m", F.struct(F.col("q").alias("tq"), F.col("m").alias("tm")).alias("to"),
        )
        back = Window.partitionBy("_run", "at").orderBy(F.desc("place"), "turn")
        near = seekers.unionAll(marks).withColumn("to", F.last("to", ignorenulls=True).over(back))
        return near.filter("turn = 0").select("q", "m", "to.tq", "to.tm")

    def passed(self, state, sums, rows):
        return ((state[0] or 0) + rows if state else rows, 0.0, 0)
