"""Prefix trie of conversations, with subtree totals by time-forward processing.

*Nodes.* A turn is known by the SHA-256 of its role and text, so no text is shuffled. The
node of a prefix is the sum of four 32-bit hashes of (turn, place) over its turns: a running
sum, which range chunks compute for a conversation of any length. One aggregate gives each
node its members, one join its parent.

*Totals.* A node with one member has a chain below it, so its totals are known. The other
nodes are cut into shards: a node is heavy if the prefixes of its members below it exceed
SHARD_ROWS, and a shard is a whole subtree under a heavy node. In each task the nodes of
many shards are sorted in reverse level order by Spark's external sort and stream by; each
sends its totals forward to its parent through a priority queue, whose entries are due when
the parent comes. The queue keeps a bounded number of entries and spills the later ones
in sorted runs. The totals of the shards' roots, added up by parent, then go through the
heavy nodes in the same way, in one task: there are at most (all prefixes / SHARD_ROWS) of
them in a level, and they stream too.

*Ends.* The ids of the members that end in a node are hashed in order. Range partitions of
(node, id) write them as pieces of text side by side, and one task per node streams the
pieces of its node into the hash; so also the ids of very many equal conversations.

Defined results: null roles and texts are empty, null turn numbers come first, equal ones
in the order of their digests; repeated rows are turns of their own; rows without
conversation id belong to no conversation; a conversation whose rebuilding leaves no turn is
a member of the root alone; an empty table has no nodes. Columns are taken by name and
renamed, so other names do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.llm.common import join_small
from flowlark.plans.ordered import rank_rows, running
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

#: Prefixes below a node from which on it is heavy; bounds the nodes of a shard.
SHARD_ROWS = 200_000
#: Entries of a priority queue in memory, runs it keeps open, ids in one piece of text.
QUEUE_ROWS, QUEUE_RUNS, PIECE_IDS = 200_000, 64, 4096
LANES = 4
#: Fixed value: hash of no ids.
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- rebuilt conversations ----------------------------------------------------------------


def turn_digests(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows (conv, turn, sha, bytes) of all turns that have a conversation."""
    who, said = (F.coalesce(F.col(_quoted(c)), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    return conversations.select(
        F.col(_quoted(key)).cast("long").alias("conv"), F.col(_quoted(turn)).alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("sha"), F.octet_length(said).cast("long").alias("bytes"),
    ).filter("conv is not null")


def rebuild(turns: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first one of their family.

    The first h original turns of conversation c - c % family, then c's own ones after
    its first h; h is the CRC of c modulo ``most``. Gives rows (conv, last), last being the
    number of rebuilt turns, and (conv, pos, sha, bytes, last).
    """
    ranked = materialize(rank_rows(turns, ["conv"], ["turn", "sha", "bytes"], "r").drop("turn"))
    lengths = ranked.groupBy("conv").agg(F.max("r").alias("own"))
    convs = lengths.withColumns(
        {"h": F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most)), "base": F.expr(f"conv - conv % {family}")}
    )
    first = lengths.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    convs = convs.join(first, "base", "left").withColumn("got", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.withColumn("last", F.col("got") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv", "base", "h", "got", "last"))
    heads = ranked.filter(F.col("r") < most).withColumnRenamed("conv", "base")
    taken = convs.join(heads, "base").filter("r <= got").select("conv", F.col("r").alias("pos"), "sha", "bytes", "last")
    side = convs.select(F.col("conv").alias("c"), "h", "got", "last")
    own = join_hot(ranked, side, {"conv": "c"}, "inner").filter("r > h")
    own = own.select("conv", (F.col("r") - F.col("h") + F.col("got")).alias("pos"), "sha", "bytes", "last")
    return convs.select("conv", "last"), taken.unionAll(own)


# --- nodes --------------------------------------------------------------------------------


def _node(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[x.cast("string") for x in lanes])))


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """Rows (conv, d, node, parent, bytes, last): every prefix of every conversation."""
    low = F.lit(0xFFFFFFFF)
    own = [F.xxhash64(F.lit(i), "sha", "pos").bitwiseAND(low) for i in range(LANES)]
    lanes = turns.withColumns({f"own{i}": x for i, x in enumerate(own)}).drop("sha")
    sums = {f"sum{i}": f"own{i}" for i in range(LANES)}
    chained = running(lanes, ["conv"], ["pos"], sums=sums, keep=[*sums.values(), "bytes", "last"])
    total = [F.col(f"sum{i}") for i in range(LANES)]
    before = [F.col(f"sum{i}") - F.col(f"own{i}") for i in range(LANES)]
    zero = F.lit(0).cast("long")
    root = convs.select(
        "conv", zero.alias("d"), _node(zero, [zero] * LANES).alias("node"),
        F.lit(None).cast("binary").alias("parent"), zero.alias("bytes"), "last",
    )
    deeper = chained.select(
        "conv", F.col("pos").alias("d"), _node(F.col("pos"), total).alias("node"),
        _node(F.col("pos") - 1, before).alias("parent"), "bytes", "last",
    )
    return root.unionAll(deeper)


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per node, with ``shared``: whether its totals need those of its children.

    Adds ``parent_conv_id`` and ``in_tree``, whether the parent is shared.
    """
    nodes = rows.groupBy("node", "parent", F.col("d").alias("depth"), "bytes").agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("last") - F.col("d") + 1).alias("below"),
        F.max("last").alias("last"),
    )
    nodes = materialize(nodes.withColumn("shared", (F.col("n_convs") > 1) | (F.col("depth") == 0)))
    over = nodes.select(
        F.col("node").alias("over"), F.col("conv_id").alias("parent_conv_id"), F.col("shared").alias("in_tree")
    )
    return materialize(join_hot(nodes, over, {"parent": "over"}, "left"))


# --- totals -------------------------------------------------------------------------------


class SpillingQueue:
    """Priority queue with a bounded number of entries in memory.

    When it is full, the later half goes to a run in the task's scratch space, sorted; the
    runs are read back entry by entry as they become due. A run lives as long as its task.
    """

    def __init__(self, held: int = QUEUE_ROWS, runs: int = QUEUE_RUNS):
        self.held, self.runs, self.turn = held, runs, 0
        self.heap: list = []
        self.heads: list = []  # (next entry of a run, its number, the rest of it)

    def push(self, entry) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.held:
            self.heap.sort()
            keep = max(self.held // 2, 1)
            self._write(iter(self.heap[keep:]))
            del self.heap[keep:]

    def _write(self, entries) -> None:
        scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        run = tempfile.TemporaryFile(dir=scratch)
        for entry in entries:
            pickle.dump(entry, run)
        run.seek(0)
        self._open(self._read(run))
        if len(self.heads) > self.runs:
            parts, self.heads = self.heads, []
            self._write(heapq.merge(*[self._whole(*x) for x in parts]))

    def _open(self, rest) -> None:
        first = next(rest, None)
        if first is not None:
            self.turn += 1
            heapq.heappush(self.heads, (first, self.turn, rest))

    @staticmethod
    def _whole(first, _, rest):
        yield first
        yield from rest

    @staticmethod
    def _read(run):
        with run:
            while True:
                try:
                    yield pickle.load(run)
                except EOFError:
                    return

    def peek(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self):
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, _, rest = heapq.heappop(self.heads)
            self._open(rest)
            return entry
        return heapq.heappop(self.heap)


#: Columns that stream past the queue: what is known of a node before its children report.
SENT = ["node", "parent", "depth", "shard", "own", "children", "leaves", "saved"]
TOTALS = ["n_children", "n_leaves", "saved_tokens"]


def send_up(nodes: DataFrame) -> DataFrame:
    """Add the totals of nodes whose parents, up to the shard's root, are in their task.

    Sorted by reverse level and node; ``children``, ``leaves`` and ``saved`` are the sums
    over children of other shards.
    """
    names = [c for c in nodes.columns if c not in SENT[3:]]
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    out = ", ".join([f"`{c}` {kinds[c]}" for c in names] + [f"{c} long" for c in TOTALS])
    ordered = nodes.sortWithinPartitions(F.desc("depth"), "node")

    def run(batches):
        queue = SpillingQueue()
        for batch in batches:
            found = []
            for node, parent, depth, shard, own, children, leaves, saved in zip(
                *[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in SENT]
            ):
                saved += own
                while (due := queue.peek()) is not None and due[:2] == (-depth, node):
                    _, _, more, gained = queue.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + gained
                leaves = leaves if children else 1
                found.append((children, leaves, saved))
                if parent is not None and node != shard:
                    queue.push((1 - depth, parent, leaves, saved))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            sums = [pa.array([x[i] for x in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*kept, *sums], names=[*names, *TOTALS])

    return ordered.mapInArrow(run, out)


def _arrived(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Add the messages' sums to ``children``, ``leaves`` and ``saved`` of their parents."""
    sums = messages.groupBy("to").agg(
        F.sum("c").alias("_c"), F.sum("l").alias("_l"), F.sum("s").alias("_s")
    )
    joined = nodes.join(sums, F.col("node") == F.col("to"), "left")
    added = {a: F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("children", "_c"), ("leaves", "_l"), ("saved", "_s"))}
    return joined.withColumns(added).drop("to", "_c", "_l", "_s")


def subtree_totals(rows: DataFrame, nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """All nodes with ``n_children``, ``n_leaves`` and ``saved_tokens``."""
    spark = rows.sparkSession
    shown = ["node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs"]
    single = nodes.filter(~F.col("shared"))
    chains = single.select(
        *shown, (F.col("last") > F.col("depth")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
    )
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    tree = nodes.filter("shared").select(
        *shown, "below", own, zero.alias("children"), zero.alias("leaves"), zero.alias("saved")
    )
    below = single.filter("in_tree").select(F.col("parent").alias("to"), one.alias("c"), one.alias("l"), zero.alias("s"))
    tree = materialize(_arrived(tree, below))
    is_heavy = (F.col("below") > shard_rows) | (F.col("depth") == 0)
    heavy = materialize(tree.filter(is_heavy).select("node"))
    # The root of the shard that a conversation's path enters: one row at most for each.
    entered = join_small(rows.select("conv", "node", "parent"), heavy.select(F.col("node").alias("parent")), ["parent"], "left_semi")
    entered = join_small(entered, heavy, ["node"], "left_anti").select("conv", F.col("node").alias("shard"))
    light = join_hot(tree.filter(~is_heavy), entered, {"conv_id": "conv"}, "inner").drop("below")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    within = materialize(send_up(light.repartition(parts, "shard").withColumn("root", F.col("node") == F.col("shard"))))
    roots = within.filter("root").select(
        F.col("parent").alias("to"), one.alias("c"), F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s")
    )
    top = _arrived(tree.filter(is_heavy).drop("below"), roots).withColumn("shard", F.lit(None).cast("binary"))
    across = send_up(top.repartition(1))
    return chains.unionByName(within.drop("root")).unionByName(across)


# --- ends ---------------------------------------------------------------------------------


def _pieces(batches):
    """Ids of each node, in order, as texts of at most PIECE_IDS ids."""
    for batch in batches:
        nodes, ids = (c.to_pylist() for c in batch.columns)
        found, at = [], 0
        for i in range(1, len(nodes) + 1):
            if i == len(nodes) or nodes[i] != nodes[at] or i - at == PIECE_IDS:
                found.append((nodes[at], ids[at], ",".join(map(str, ids[at:i]))))
                at = i
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))],
            names=["node", "first", "piece"],
        )


def _hashes(batches):
    """One hash per node over its pieces, which come in order."""
    node, state = None, None
    for batch in batches:
        done = []
        for n, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if n != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield _ended(done)
    if state is not None:
        yield _ended([(node, state.hexdigest())])


def _ended(done):
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())],
        names=["at", "ends_sha256"],
    )


def end_hashes(rows: DataFrame) -> DataFrame:
    """Rows (at, ends_sha256) of the nodes in which conversations end."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ends = rows.filter("d = last").select("node", "conv")
    ranged = ends.repartitionByRange(parts, "node", "conv").sortWithinPartitions("node", "conv")
    pieces = ranged.mapInArrow(_pieces, "node binary, first long, piece string")
    gathered = pieces.repartition(parts, "node").sortWithinPartitions("node", "first")
    return gathered.mapInArrow(_hashes, "at binary, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the conversations that ``rebuild`` gives."""
    rows = materialize(prefixes(convs, turns))
    totals = subtree_totals(rows, nodes_of(rows), shard_rows)
    joined = totals.join(end_hashes(rows), F.col("node") == F.col("at"), "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).drop("at")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
