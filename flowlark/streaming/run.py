"""Drive a stream over everything that is there and read its output table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from flowlark.operators.routing import REL
from flowlark.session import scratch_path

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(sdf: DataFrame, name: str = "stream") -> DataFrame:
    """Process all available input into a table in the shared folder."""
    spark = sdf.sparkSession
    out = scratch_path(spark, name)
    writer = (
        sdf.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, f"{name}-log"))
        .option("path", out)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)  # a query keeps what is set when it starts
    try:
        query = writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
    query.awaitTermination()
    return spark.read.schema(sdf.schema).parquet(out)


def route_batches(sinks: dict[str, Callable[[DataFrame, int], None]]):
    """``foreachBatch`` function that hands each output to its own sink."""

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, sink in sinks.items():
                sink(batch.filter(batch[REL] == name).drop(REL), epoch)
        finally:
            batch.unpersist()

    return handle
