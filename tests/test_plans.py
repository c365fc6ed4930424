"""Plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from flowlark.operators import dedupe, documents, routing, stats
from flowlark.operators.listing import list_keys
from flowlark.plans.skew import join_hot
from flowlark.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    rows = spark.range(0, 300_000, 1, 20).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k")
    )
    yield rows
    for key in SKEW:
        spark.conf.unset(key)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_key_is_split_in_joins(skewed):
    totals = skewed.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    out = join_hot(skewed, totals, {"k": "key"})
    assert out.agg(F.sum(F.when(F.col("k") == 7, F.col("n")))).first()[0] == 100_200**2
    out.collect()
    assert "skew=true" in plan(out)


@pytest.mark.parametrize(
    "work",
    [
        lambda r: stats.with_stats(r, "id", "k"),
        lambda r: dedupe.contains(r, r.select(F.col("k").alias("s")), "k", "s"),
        lambda r: documents.delete_many(r, r.filter("k > 500").select("k"), {"k": "k"}),
        lambda r: documents.find(
            r.select("k").distinct().withColumnRenamed("k", "asked"), r, {"asked": "k"}
        ),
    ],
)
def test_operators_split_hot_keys(skewed, work):
    out = work(skewed)
    out.toPandas()
    assert "skew=true" in plan(out)


def test_duplicates_do_not_gather_a_key(skewed):
    out = dedupe.identify_duplicates(skewed, "k", ["id"])
    out.toPandas()
    text = plan(out)
    assert "Window" not in text and "partial_min" in text


def test_join_without_null_matches(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "id int, k string")
    right = spark.createDataFrame([(None, "x"), ("a", "y")], "r string, v string")
    got = {r["id"]: r["v"] for r in join_hot(left, right, {"k": "r"}).collect()}
    assert got == {1: None, 2: "y"}
    got = {r["id"]: r["v"] for r in join_hot(left, right, {"k": "r"}, null_safe=True).collect()}
    assert got == {1: "x", 2: "y"}


def test_filters_and_columns_reach_the_scan(spark):
    def scan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    text = scan(QUERIES["doc_expire"](spark, FOLDER))
    assert "GreaterThan(o_orderdate" in text and "struct<o_orderkey:bigint,o_orderdate" in text
    keys = spark.read.parquet(f"{FOLDER}/pages.parquet")
    page, _ = list_keys(keys, "http", ":", "s:", key="url")
    text = scan(page.select("url"))
    assert "TakeOrderedAndProject" in text and "StringStartsWith(url,http)" in text
    text = scan(QUERIES["attribute_moments"](spark, FOLDER))
    assert "ReadSchema: struct<event_type:string,value:double>" in text


def test_routing_is_one_scan_of_generated_code(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    out = routing.route_bitmask(lines, "l_linenumber", {"a": 1, "b": 2})
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
