"""A key set that lasts: bucketed, versioned by micro-batch, with a filter per bucket.

Below the set's path lie two tables, partitioned by ``batch``: the keys that each
micro-batch added, in order of their bucket, and for each bucket the bits of those keys. A
micro-batch is decided by what earlier ones added, and writes its own partition anew; so
one that is replayed, after a failure or by hand, gives the flags that it gave before.

A key's bit is looked up first. Keys whose bit is clear are new without reading any key;
for the others only the row groups of their buckets are read. Filters are one row of 4 KB
per bucket, ``buckets`` rows in all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from flowlark.functions.numbers import is_blank
from flowlark.plans.ordered import first_rows
from flowlark.session import drop_path, materialize

FILTER_BITS = 32_768  # of a row of Spark's bitmap functions
#: Batch under which ``compact`` folds all up to a batch; it comes before all others.
FOLDED = -1


class SeenKeys:
    """The set at ``path``; about ``buckets`` times 4,000 keys keep the filters selective.

    Keys are kept as texts.
    """

    SCHEMAS = {"keys": "bucket int, key string", "filters": "bucket int, bits binary"}

    def __init__(self, spark: SparkSession, path: str, buckets: int = 1024):
        self.spark, self.buckets = spark, buckets
        self.paths = {name: f"{path.rstrip('/')}/{name}" for name in self.SCHEMAS}

    # --- tables -----------------------------------------------------------------------

    def _read(self, name: str, more: str = "") -> DataFrame:
        schema = f"{self.SCHEMAS[name]}{more}, batch long"
        try:
            return self.spark.read.schema(schema).parquet(self.paths[name])
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, name: str, rows: DataFrame, batch: int) -> None:
        """Replace one batch's partition; a job that fails leaves the old one."""
        writer = rows.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.paths[name])

    def keys(self, before: int | None = None) -> DataFrame:
        """All keys, or those that batches before one have added."""
        rows = self._read("keys")
        return (rows if before is None else rows.filter(F.col("batch") < before)).select("bucket", "key")

    def _places(self) -> dict[str, Column]:
        h = F.xxhash64("key")
        return {
            "bucket": F.pmod(h, F.lit(self.buckets)).cast("int"),
            "bit": F.pmod(F.shiftright(h, 20), F.lit(FILTER_BITS).cast("long")),
        }

    # --- batches ----------------------------------------------------------------------

    def add(self, rows: DataFrame, key: str, order: Sequence[str], batch: int) -> DataFrame:
        """The rows with ``added``: true for the first row of a key not in the set before.

        ``order`` identifies a row. Blank keys are never added. ``batch`` grows from call
        to call, and batches that ``compact`` has folded cannot be replayed. The flags are
        those of the rows that were written, also when a row's batch is evaluated anew.
        """
        if batch <= FOLDED:
            raise ValueError("batches are numbered from 0")
        usable = rows.select(F.col(key).cast("string").alias("key"), *order).filter(~is_blank("key"))
        firsts = first_rows(usable, ["key"], order).withColumns(self._places())
        new = self._unseen(firsts, batch).repartitionByRange("bucket").sortWithinPartitions("bucket")
        new = materialize(new.select("bucket", "bit", "key", F.struct(*order).alias("at")))
        # Bits without keys cost a look-up; keys without bits would be missed.
        bits = new.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self._write("filters", bits, batch)
        self._write("keys", new.drop("bit"), batch)
        kind = T.StructType([rows.schema[c] for c in order]).simpleString()
        stored = self._read("keys", f", at {kind}").filter(F.col("batch") == batch)
        marks = stored.select(*[F.col("at")[c].alias(f"_first_{c}") for c in order], F.lit(True).alias("_new"))
        same = [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in order]
        out = rows.join(marks, same, "left").withColumn("added", F.coalesce("_new", F.lit(False)))
        return out.drop("_new", *[f"_first_{c}" for c in order])

    def _unseen(self, firsts: DataFrame, batch: int) -> DataFrame:
        """Rows whose key no earlier batch has added, by filter and then by key."""
        filters = self._read("filters").filter(F.col("batch") < batch)
        filters = filters.groupBy(F.col("bucket").alias("_b")).agg(F.bitmap_or_agg("bits").alias("_bits"))
        at = firsts.join(filters, F.col("bucket") == F.col("_b"), "left")
        byte = F.conv(F.hex(F.expr("substring(_bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        mask = F.expr("shiftleft(1, cast(bit % 8 as int))")
        hit = F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))
        at = at.withColumn("_hit", hit).drop("_b", "_bits")
        known = self.keys(batch).select(F.col("bucket").alias("_b"), F.col("key").alias("_known"))
        same = (F.col("bucket") == F.col("_b")) & (F.col("key") == F.col("_known"))
        doubtful = at.filter("_hit").join(known, same, "left_anti")
        return at.filter(~F.col("_hit")).unionByName(doubtful).drop("_hit")

    def compact(self, upto: int) -> None:
        """Fold the batches up to ``upto`` into one, sorted by bucket.

        The folded partition is written before the others are dropped, so a failure
        between leaves keys twice and loses none.
        """
        old = F.col("batch") <= upto
        keys = self._read("keys").filter(old).select("bucket", "key").distinct()
        keys = keys.repartitionByRange("bucket").sortWithinPartitions("bucket")
        bits = self._read("filters").filter(old).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        gone = [r["batch"] for r in self._read("keys").filter(old).select("batch").distinct().collect()]  # one per batch
        for name, rows in (("filters", bits), ("keys", keys)):
            self._write(name, rows, FOLDED)
        for name in ("keys", "filters"):
            for batch in set(gone) - {FOLDED}:
                drop_path(self.spark, f"{self.paths[name]}/batch={batch}")
