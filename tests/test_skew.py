"""One key holds most of the rows: results stay whole and the work is split."""

import pytest
from builders import rows
from pyspark.sql import functions as F

from tidemark.functions import lookup_join
from tidemark.sources import tables

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@pytest.fixture
def tight(spark):
    """Thresholds small enough for adaptive execution to see skew in test-sized data."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    query = df._jdf.queryExecution()
    df._jdf.collect()
    return query.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_key_is_split_in_a_lookup_join(tight):
    facts = tight.range(0, 60000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    lookup = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup_join(facts, lookup, "k")
    assert "SortMergeJoin(skew=true)" in executed(joined)
    assert "skew=true" not in executed(facts.join(lookup, "k", "left"))
    totals = joined.agg(F.count(F.lit(1)), F.count("n"), F.countDistinct("payload"))
    assert rows(totals) == [(60000, 60000, 60000)]


def test_missing_and_null_keys_stay_in_a_lookup_join(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", 9), (None, 8)], "k string, n int")
    assert rows(lookup_join(facts, lookup, "k")) == [("a", 1, 9), ("b", 2, None), (None, 3, None)]
    assert rows(lookup_join(facts, lookup, "k", "inner")) == [("a", 1, 9)]


def test_hot_partition_value_is_written_by_several_tasks(tight, tmp_path):
    hot = tight.range(0, 60000, 1, 6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") % 10 < 8, 2024).otherwise(2023).alias("year"),
    )
    path = tmp_path / "t"
    tables.append_partitioned(hot, str(path), ["year"])
    assert len(list(path.glob("year=2024/*.parquet"))) > 1
    assert tables.read_table(tight, str(path)).count() == 60000
