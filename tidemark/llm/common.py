"""What several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole_text(text: Column | str) -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separator: str, strip: str | None = None) -> Column:
    """The words between separators, without the empty strings that split leaves at the ends."""
    if strip is not None:
        bare = F.trim(text, F.lit(strip))
    else:
        bare = F.regexp_replace(text, f"^{separator}|{separator}$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, separator))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs then need none of its inputs."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
