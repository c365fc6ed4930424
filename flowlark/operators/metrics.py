"""Status tables to metrics: trees, points, datum lists and snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlark.functions.numbers import state_percent
from flowlark.plans.ordered import rank_rows
from flowlark.plans.skew import join_hot
from flowlark.session import materialize

# Measurement, tag and field names of status points.
ENTITY_TAGS = {
    "connection": ["groupId", "connectionName", "id"],
    "input_port": ["groupId", "portName", "id"],
    "output_port": ["groupId", "portName", "id"],
    "process_group": ["processGroupName", "id"],
    "processor": ["groupId", "type", "processorName", "id"],
    "remote_process_group": ["remoteProcessorName", "id"],
    "disk": ["path"],
    "memory": [],
    "jvm": [],
}
_PORT = [
    "activeThreadCount", "bytesReceived", "bytesSent", "flowFilesReceived", "flowFilesSent",
    "inputBytes", "inputCount", "outputBytes", "outputCount", "runStatus",
]
ENTITY_FIELDS = {
    "connection": [
        "backPressureBytesThreshold", "backPressureObjectThreshold", "inputBytes", "inputCount",
        "maxQueuedBytes", "maxQueuedCount", "outputBytes", "outputCount", "queuedBytes", "queued",
    ],
    "input_port": _PORT,
    "output_port": _PORT,
    "process_group": [
        "activeThreadCount", "bytesRead", "bytesReceived", "bytesSent", "bytesTransferred",
        "bytesWritten", "flowFilesReceived", "flowFilesSent", "flowFilesTransferred", "inputCount",
        "inputContentSize", "outputCount", "outputContentSize", "queued", "queuedContentSize",
    ],
    "processor": [
        "activeThreadCount", "bytesRead", "bytesReceived", "bytesSent", "bytesTransferred",
        "bytesWritten", "flowFilesReceived", "flowFilesRemoved", "flowFilesSent", "lineageDuration", "inputBytes",
        "inputCount", "outputBytes", "outputCount", "runStatus",
    ],
    "remote_process_group": [
        "activeThreadCount", "activeRemotePortCount", "averageLineageDuration",
        "inactiveRemotePortCount", "receivedContentSize", "receivedCount", "sentContentSize",
        "sentCount", "transmissionStatus",
    ],
    "disk": ["free", "total", "usedPercent"],
    "memory": ["free", "total", "usedPercent"],
    "jvm": [
        "jvm.uptime", "jvm.heap_used", "jvm.heap_usage", "jvm.non_heap_usage",
        "jvm.thread_states.runnable", "jvm.thread_states.blocked",
        "jvm.thread_states.timed_waiting", "jvm.thread_states.terminated", "jvm.thread_count",
        "jvm.daemon_thread_count", "jvm.file_descriptor_usage",
    ],
}
THREAD_STATES = ["blocked", "runnable", "terminated", "timed_waiting"]
STATE_PREFIX = "jvm.thread_states."
GC_RUNS, GC_TIME = "jvm.gc.runs", "jvm.gc.time"
LOCATION = "Metric Location"
DATUMS_PER_REQUEST = 20


def flatten_tree(nodes: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """All nodes below the roots with ``depth`` and ``path`` (root to node).

    ``nodes`` has ``id``, ``edges`` ``parent`` and ``child``, ``roots`` ``id``. Every node
    points up, at first to its parent; each round joins it to where its pointer's end
    points, so a tree of depth d takes the logarithm of d joins, each written to the shared
    folder. A way that begins at a root is ended there. A node below the roots that is its
    own ancestor is an error: its way up meets itself before it ends.
    """
    same = roots.schema["id"].dataType
    start = roots.select("id", F.lit(None).cast(same).alias("top"), F.array("id").alias("path"), F.lit(True).alias("done"))
    steps = edges.select(
        F.col("child").alias("id"), F.col("parent").alias("top"), F.array("child").alias("path"), F.lit(False).alias("done")
    )
    ways = materialize(start.unionAll(steps.filter(F.col("top").isNotNull())))
    ended, circles = [ways.filter("done").drop("done")], []
    while True:
        open_ = ways.filter("not done").drop("done")
        if open_.isEmpty():
            break
        # Ways of this round, which is twice as long as the last one, and all ended ones.
        upper = reduce(lambda a, b: a.unionAll(b), ended).withColumn("done", F.lit(True))
        upper = upper.unionAll(open_.withColumn("done", F.lit(False)))
        upper = upper.select(F.col("id").alias("_at"), F.col("top").alias("_far"), F.col("path").alias("_head"), "done")
        joined = join_hot(open_, upper, {"top": "_at"}, "inner").select(
            "id", F.col("_far").alias("top"), F.concat("_head", "path").alias("path"), "done",
            F.when(F.arrays_overlap("_head", "path"), F.col("top")).alias("_circle"),
        )
        ways = materialize(joined)
        circles.append(ways.filter("_circle is not null").select(F.col("_circle").alias("id")))
        ways = ways.filter("_circle is null").drop("_circle")
        ended.append(ways.filter("done").drop("done"))
    flat = reduce(lambda a, b: a.unionAll(b), ended)
    if circles:  # one that no root leads to is nobody's ancestor here
        around = reduce(lambda a, b: a.unionAll(b), circles)
        if not around.isEmpty() and not around.join(flat.select("id"), "id", "left_semi").isEmpty():
            raise ValueError("a node is its own ancestor")
    flat = flat.select("id", (F.size("path") - 1).alias("depth"), "path")
    return flat.join(nodes, "id")


def rollup_tree(flat: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Totals of each node over itself and everything below it.

    ``flat`` comes from ``flatten_tree``. Each node counts for its ancestors;
    sums combine before the shuffle, so the root is no hot key.
    """
    spread = flat.select(F.explode("path").alias("id"), *metrics)
    return spread.groupBy("id").agg(*[F.sum(m).alias(m) for m in metrics])


def status_to_points(
    df: DataFrame,
    measurement: str,
    tag_columns: Sequence[str] | None = None,
    field_columns: Sequence[str] | None = None,
    global_tags: dict[str, Column] | None = None,
    time: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One point per status row; names default to the entity's fixed lists.

    Global tags win over tags of the same name.
    """
    tags = list(tag_columns if tag_columns is not None else ENTITY_TAGS[measurement])
    fields = list(field_columns if field_columns is not None else ENTITY_FIELDS[measurement])
    values = {**{t: F.col(f"`{t}`") for t in tags}, **(global_tags or {})}
    tag_pairs = [x for n, c in values.items() for x in (F.lit(n), c.cast("string"))]
    field_pairs = [x for f in fields for x in (F.lit(f), F.col(f"`{f}`").cast("double"))]
    tag_map = F.create_map(*tag_pairs).cast("map<string,string>")
    field_columns_map = F.create_map(*field_pairs).cast("map<string,double>")
    return df.select(
        *keep,
        F.lit(measurement).alias("measurement"),
        F.map_filter(tag_map, lambda _, v: v.isNotNull()).alias("tags"),
        F.map_filter(field_columns_map, lambda _, v: v.isNotNull()).alias("fields"),
        (time if time is not None else F.current_timestamp()).alias("time"),
    )


def union_points(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def long_fields(points: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per field of a point."""
    return points.select(*keep, "measurement", F.explode("fields").alias("field", "value"))


def normalize_states(df: DataFrame, state: str, share: str) -> DataFrame:
    """Whole percent of each of the four reported thread states."""
    name = F.lower(F.col(state))
    return df.filter(name.isin(THREAD_STATES)).select(
        F.concat(F.lit(STATE_PREFIX), name).alias("field"), state_percent(share).alias("value")
    )


def flatten_gc(df: DataFrame, name: str, runs: str, time_ms: str) -> DataFrame:
    """Runs and time of each collector as two named fields."""
    bare = F.replace(F.col(name), F.lit(" "), F.lit(""))
    both = F.array(
        F.struct(
            F.concat(F.lit(f"{GC_RUNS}."), bare).alias("field"),
            F.col(runs).cast("double").alias("value"),
        ),
        F.struct(
            F.concat(F.lit(f"{GC_TIME}."), bare).alias("field"),
            F.col(time_ms).cast("double").alias("value"),
        ),
    )
    return df.select(F.inline(both))


def metric_datums(
    df: DataFrame,
    location: str,
    metrics: Sequence[str],
    dimensions: dict[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(name, value, dimensions) per metric that is a double.

    Rows without a location name, blank metric names, nulls and columns of
    another type give nothing. The location's own dimension wins over a given one.
    """
    doubles = [m for m in metrics if m.strip() and df.schema[m].dataType.typeName() == "double"]
    extra = {n: c for n, c in (dimensions or {}).items() if n != LOCATION}
    named = df.filter(F.trim(F.coalesce(F.col(location), F.lit(""))) != "").select(
        *keep,
        F.col(location).alias("_location"),
        *[c.cast("string").alias(f"_d_{i}") for i, c in enumerate(extra.values())],
        *doubles,
    )
    ids = [*keep, "_location", *[f"_d_{i}" for i in range(len(extra))]]
    long = named.unpivot(ids, doubles, "name", "value").filter(F.col("value").isNotNull())
    pairs = [x for i, n in enumerate(extra) for x in (F.lit(n), F.col(f"_d_{i}"))]
    all_dimensions = F.create_map(*pairs, F.lit(LOCATION), F.col("_location"))
    return long.select(*keep, "name", "value", all_dimensions.alias("dimensions"))


def chunk_rows(
    df: DataFrame,
    n: int,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "chunk",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Number of the group of ``n`` rows, in order, that a row falls in.

    (``by``, ``order``) identifies a row. ``keep`` names narrow columns that are cheaper
    to sort along than to join back.
    """
    ranked = rank_rows(df, by, order, "_rank", keep)
    chunk = F.call_function("div", F.col("_rank") - 1, F.lit(n))
    return ranked.withColumn(name, chunk.cast("long")).drop("_rank")


def metric_requests(datums: DataFrame, order: Sequence[str], n: int = DATUMS_PER_REQUEST) -> DataFrame:
    """One row per request with at most ``n`` data."""
    body = F.sort_array(F.collect_list(F.struct(*order, "name", "value")))
    rows = datums.select(*dict.fromkeys([*order, "name", "value"]))
    return chunk_rows(rows, n, order, keep=["name", "value"]).groupBy("chunk").agg(body.alias("data"))


def snapshot_json(
    df: DataFrame,
    by: Sequence[str],
    members: Sequence[str],
    order: Sequence[str],
    part_rows: int = 10_000,
) -> DataFrame:
    """JSON text of each group with its members, in parts of bounded size."""
    parted = chunk_rows(df, part_rows, order, by, "part")
    listed = F.sort_array(F.collect_list(F.struct(*order, F.struct(*members).alias("_m"))))
    grouped = parted.groupBy(*by, "part").agg(listed.alias("_list"))
    inner = F.transform("_list", lambda e: e["_m"])
    body = F.to_json(F.struct(*by, inner.alias("members")), {"ignoreNullFields": "false"})
    return grouped.select(*by, "part", body.alias("snapshot"))
