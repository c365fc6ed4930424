"""Line files, listings and file streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlark.operators.routing import REL
from flowlark.plans.skew import join_hot

LINE_END = r"\r\n|\n|\r"  # fixed value


def text_splits(
    df: DataFrame,
    text: str | Column,
    skip: int = 0,
    header: bool = False,
    per_split: int = 1,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Groups of ``per_split`` lines of a text column, without any shuffle.

    The first ``skip`` lines are left out; with ``header`` the next line is
    repeated at the head of every split. The last split may be short.
    """
    column = F.col(text) if isinstance(text, str) else text
    lines = F.split(F.regexp_replace(column, f"({LINE_END})$", ""), LINE_END, -1)
    start = skip + (1 if header else 0)
    # Generated, so that the text is split once and not again for every split.
    rows = df.select(*keep, F.explode(F.array(lines)).alias("_lines")).withColumn(
        "_n", F.greatest(F.size("_lines") - start, F.lit(0))
    )
    last = F.call_function("div", F.col("_n") - 1, F.lit(per_split)).cast("int")

    def body(split: Column) -> Column:
        part = F.slice("_lines", split * per_split + start + 1, F.lit(per_split))
        joined = F.array_join(part, "\n")
        if not header:
            return joined
        return F.concat(F.get("_lines", F.lit(skip)), F.lit("\n"), joined)

    # All splits first, then one row each: the lines are not copied per split.
    splits = F.transform(F.sequence(F.lit(0), last), body)
    return (
        rows.filter(F.col("_n") > 0)
        .select(*keep, splits.alias("_splits"))
        .select(*keep, F.posexplode("_splits").alias("split", "content"))
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line from 0, value) of text files of any size.

    Files are read in blocks. One narrow pass counts the lines of each block, which gives
    where its numbers begin. The ids that Spark gives to a task's rows are consecutive,
    and both passes plan the same tasks from one listing; so an id minus the least one of
    its block is the line's place in it, without sorting or numbering again.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    index = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )  # as many rows as the file has blocks
    offsets = index.select(
        F.struct(F.col("file").alias("f"), F.col("_block").alias("b")).alias("_on"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
    )
    block = F.struct(F.col("file").alias("f"), F.col("_block").alias("b"))
    numbered = lines.join(offsets, block == F.col("_on"))
    return numbered.select("file", (F.col("_at") + F.col("_offset")).alias("line"), "value")


def _pieces(start: int, per_split: int):
    """Consecutive lines of one split, joined; a piece ends where its split or task does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, split, first, held = None, None, 0, []
        for batch in batches:
            done = []
            for file, line, value in zip(*[c.to_pylist() for c in batch.columns]):
                at = (line - start) // per_split
                if held and (at != split or file != name or line != first + len(held)):
                    done.append((name, split, first, len(held), "\n".join(held)))
                    held = []
                if not held:
                    name, split, first = file, at, line
                held.append(value)
            yield _piece_rows(done)
        if held:
            yield _piece_rows([(name, split, first, len(held), "\n".join(held))])

    return run


def _piece_rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = [pa.array([x[i] for x in done], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "split", "first", "lines", "content"])


def file_splits(
    spark: SparkSession, path: str, skip: int = 0, header: bool = False, per_split: int = 1
) -> DataFrame:
    """Groups of ``per_split`` lines of text files, as ``text_splits``.

    Splits are cut in place, where a block is read. Only those that a border between
    blocks parts, and the last one of a file, are shuffled to be put together.
    """
    lines = numbered_lines(spark, path)
    start = skip + (1 if header else 0)
    inside = lines.filter(F.col("line") >= start).sortWithinPartitions("file", "line")
    pieces = inside.mapInArrow(
        _pieces(start, per_split), "file string, split int, first long, lines long, content string"
    )
    whole = pieces.filter(F.col("lines") == per_split).select("file", "split", "content")
    parts = F.sort_array(F.collect_list(F.struct("first", "content")))
    cut = (
        pieces.filter(F.col("lines") < per_split)
        .groupBy("file", "split")
        .agg(F.array_join(F.transform(parts, lambda e: e["content"]), "\n").alias("content"))
    )
    splits = whole.unionByName(cut)
    if not header:
        return splits
    heads = lines.filter(F.col("line") == skip).select("file", F.col("value").alias("_head"))
    joined = join_hot(splits, heads, {"file": "file"})
    content = F.concat_ws("\n", "_head", "content")
    return joined.select("file", "split", content.alias("content"))


def file_status(requests: DataFrame, path: str) -> DataFrame:
    """Route requested paths by opening each one where its row is.

    ``success``, ``not.found``, ``permission.denied`` or ``failure``.
    """
    schema = T.StructType([*requests.schema.fields, T.StructField(REL, T.StringType())])

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(**{REL: [_open_status(p) for p in pdf[path]]})

    return requests.mapInPandas(check, schema)


def _open_status(path: str) -> str:
    from pyarrow import fs

    try:
        system, name = fs.FileSystem.from_uri(path)
        with system.open_input_file(name) as handle:
            handle.read(1)
        return "success"
    except FileNotFoundError:
        return "not.found"
    except PermissionError:
        return "permission.denied"
    except (OSError, ValueError, TypeError):
        return "failure"


def file_listing(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Listing attributes of the files below a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    return files.select(
        F.regexp_replace("path", r"/[^/]*$", "").alias("bucket"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("filename"),
        F.col("path").alias("key"),
        F.col("modificationTime").alias("lastModified"),
        F.col("length").alias("size"),
        F.lit("STANDARD").alias("storageClass"),
    )


def read_stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    completion: str = "off",
    archive_dir: str | None = None,
    max_files: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """File stream; ``completion`` leaves, archives or deletes read files.

    Files of the last micro-batch are cleaned only when a later one runs.
    """
    if completion not in ("off", "archive", "delete"):
        raise ValueError(f"unknown completion: {completion}")
    reader = spark.readStream.format(fmt).schema(schema).option("cleanSource", completion)
    if completion == "archive":
        if not archive_dir:
            raise ValueError("archive needs archive_dir")
        reader = reader.option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def discard(df: DataFrame) -> None:
    """Compute every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
