"""Incremental listing of keys in key order."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlark.operators.metrics import chunk_rows

DEFAULT_PAGE = 100  # fixed value: keys per page


@dataclass(frozen=True)
class ListingState:
    """Where a listing stands; one per configuration."""

    config: str
    last_key: str | None = None
    complete: bool = False
    processed: int = 0


def list_keys(
    keys: DataFrame,
    prefix: str,
    start: str = "",
    end: str = "",
    state: ListingState | None = None,
    limit: int = DEFAULT_PAGE,
    key: str = "key",
) -> tuple[DataFrame, ListingState]:
    """Next page of keys and the state after it.

    Keys start with ``prefix``, come after ``prefix + start`` (or the last key
    seen) and before ``prefix + end``. The key range is a plain comparison that
    reaches the scan; a page is a top-k. Another configuration starts anew.
    """
    config = repr((prefix, start, end))
    if state is None or state.config != config:
        state = ListingState(config)
    if state.complete:
        return keys.limit(0), state
    after = state.last_key if state.last_key is not None else prefix + start
    rows = keys.filter(F.col(key).startswith(prefix) & (F.col(key) > after))
    if end:
        rows = rows.filter(F.col(key) < prefix + end)
    page = rows.orderBy(key).limit(limit)
    seen = page.agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("last")).first()
    return page, replace(
        state,
        last_key=seen["last"] if seen["n"] else state.last_key,
        complete=seen["n"] < limit,
        processed=state.processed + seen["n"],
    )


def all_pages(
    keys: DataFrame,
    prefix: str,
    start: str = "",
    end: str = "",
    limit: int = DEFAULT_PAGE,
    key: str = "key",
) -> DataFrame:
    """Every key with the number of the page that repeated listing gives it.

    One distributed rank instead of a run per page.
    """
    rows = keys.filter(F.col(key).startswith(prefix) & (F.col(key) > prefix + start))
    if end:
        rows = rows.filter(F.col(key) < prefix + end)
    return chunk_rows(rows, limit, [key], name="page")


def save_state(spark, state: ListingState, path: str) -> None:
    row = [(state.config, state.last_key, state.complete, state.processed)]
    schema = "config string, last_key string, complete boolean, processed long"
    spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").json(path)


def load_state(spark, path: str) -> ListingState:
    schema = "config string, last_key string, complete boolean, processed long"
    row = spark.read.schema(schema).json(path).first()
    return ListingState(row["config"], row["last_key"], row["complete"], row["processed"])
