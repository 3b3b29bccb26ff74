"""Joins and partitioned writes that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join facts to a frame that was grouped by ``key`` and so holds one row per key.

    Joined on the key alone, Spark reuses the grouping's partitions as the lookup side of the
    join. Adaptive execution splits a skewed join partition only where both inputs come
    straight from a shuffle, so the facts of a hot key would meet in one task. A second join
    column, the key's hash, makes both sides shuffle for the join itself: the lookup is then
    measured (and broadcast if it is small) and hot keys are split. It changes no result.
    """
    spread = F.xxhash64(key)
    joined = facts.withColumn("_spread", spread).join(
        lookup.withColumn("_spread", spread), [key, "_spread"], how
    )
    return joined.drop("_spread")


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    Without it every task writes a file into every partition. The rebalance hint,
    unlike a hash repartition, lets adaptive execution split a value that holds a
    large share of the rows over many tasks.
    """
    return df.hint("rebalance", *by)
