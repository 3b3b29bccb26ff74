"""Landing files: headered CSV in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import double_of
from tidemark.schemas import RAW_PRICES, RAW_TRADES


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Headered CSV. Without a schema the types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_raw_trades(spark: SparkSession, path: str) -> DataFrame:
    """Trade files under a folder or glob, read with the fixed schema."""
    return read_csv(spark, path, RAW_TRADES)


def read_raw_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price files under a folder or glob, read with the fixed schema."""
    return read_csv(spark, path, RAW_PRICES)


def read_demo_trades(spark: SparkSession, path: str) -> DataFrame:
    """Demo trades: every column arrives as text and is converted; bad text becomes NULL."""
    text = spark.read.option("header", True).csv(path)
    return text.withColumns(
        {
            "qty": double_of("qty"),
            "price": double_of("price"),
            "trade_date": F.try_to_date("trade_date"),
        }
    )


def read_demo_prices(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Demo prices: types inferred (or given), the date column parsed."""
    prices = read_csv(spark, path, schema)
    return prices.withColumn("date", F.try_to_date(F.col("date").cast("string")))


def stage_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Expose a CSV under a staging name with detected types."""
    staged = read_csv(spark, path)
    staged.createOrReplaceTempView(name)
    return spark.table(name)


LINE, REASON = "raw_line", "reason"


def read_checked_csv(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """Headered CSV with a schema, and beside it the whole line (``raw_line``) of rows that do not parse.

    Such a row keeps the fields that could be read. Read all columns together: Spark judges a line by
    the columns asked for.
    """
    wide = StructType([StructField(f.name, f.dataType, True) for f in schema.fields] + [StructField(LINE, StringType())])
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}
    return spark.read.options(**options).schema(wide).csv(paths)


def parse_reason(schema: StructType) -> Column:
    """Why a line of ``read_checked_csv`` does not parse, NULL where it does.

    The fields that hold text which is no value of their type, by name; where there is none the line
    has too few or too many fields.
    """
    texts = F.from_csv(F.col(LINE), ", ".join(f"`{f.name}` string" for f in schema.fields))
    unread = [
        F.when((F.trim(texts[f.name]) != "") & F.col(f.name).isNull(), F.lit(f.name))
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    ]
    names = F.array_compact(F.array(*unread))
    told = F.when(F.size(names) > 0, F.concat(F.lit("not readable: "), F.array_join(names, ", ")))
    return F.when(F.col(LINE).isNotNull(), F.coalesce(told, F.lit("wrong number of fields")))
