"""Tables by path and by name, and every way the jobs write them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from tidemark.functions import clustered
from tidemark.schemas import MODEL

DEFAULT_FORMAT = "parquet"  # "delta" works too where its jar is on the classpath


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at a path, asked of the file system the path belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def newest_partition(spark: SparkSession, path: str, column: str, before: object = None, fmt: str = DEFAULT_FORMAT) -> object:
    """The largest value of a partition column (below ``before``), or None. No data column is read."""
    if not table_exists(spark, path):
        return None
    stored = read_table(spark, path, fmt)
    if before is not None:
        stored = stored.filter(F.col(column) < F.lit(before))
    return fetch_row(stored.agg(F.max(column).alias("newest")))["newest"]


def named_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    """A writer of stored tables. Their Parquet files are compressed with zstd, a quarter smaller than by default."""
    found = df.write.format(fmt)
    return found.option("compression", "zstd") if fmt == "parquet" else found


def overwrite(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace an unpartitioned table."""
    writer(df, fmt).mode("overwrite").save(path)


def append_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = DEFAULT_FORMAT) -> None:
    """Add rows to a partitioned table. Running the same batch twice stores it twice."""
    writer(clustered(df, by), fmt).mode("append").partitionBy(*by).save(path)


def replace_partitioned(
    df: DataFrame, path: str, by: Sequence[str], fmt: str = DEFAULT_FORMAT, together: bool = False
) -> None:
    """Replace a whole partitioned table, its schema included. ``together``: the rows lie so already."""
    to = writer(df if together else clustered(df, by), fmt).mode("overwrite").partitionBy(*by)
    if fmt == "delta":
        to = to.option("overwriteSchema", True)
    else:
        to = to.option("partitionOverwriteMode", "static")
    to.save(path)


def replace_touched_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = DEFAULT_FORMAT) -> None:
    """Replace only the partitions present in ``df``: the rerun-safe form of an append."""
    (
        writer(clustered(df, by), fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .save(path)
    )


def _save_as_table(df: DataFrame, name: str, mode: str, fmt: str, path: str | None) -> None:
    to = df.write.format(fmt).mode(mode)
    if path is not None:
        to = to.option("path", path)
    to.saveAsTable(name)


def create_or_replace_table(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, path: str | None = None) -> None:
    _save_as_table(df, name, "overwrite", fmt, path)


def create_table_if_absent(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, path: str | None = None) -> None:
    """Create from a query, or leave an existing table untouched (a rerun keeps the old rows)."""
    _save_as_table(df, name, "ignore", fmt, path)


def create_model_tables(
    spark: SparkSession,
    database: str,
    fmt: str = DEFAULT_FORMAT,
    path: str | None = None,
) -> None:
    """Create the six typed tables that are missing, with their partitions and comments."""
    for name, (schema, partition, comment) in MODEL.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        layout = f"PARTITIONED BY ({partition}) " if partition else ""
        location = f"LOCATION '{path}/{name}' " if path else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING {fmt} "
            f"{layout}{location}COMMENT '{comment}'"
        )


def insert_rows(df: DataFrame, name: str) -> None:
    """Add rows to an existing table, matching columns by name (a partition column is stored last)."""
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    rows = df.select(*spark.table(name).columns)
    (clustered(rows, partitions) if partitions else rows).write.insertInto(name)


def create_views(views: Mapping[str, DataFrame]) -> None:
    """Publish reporting frames as session views, replacing views of the same name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def create_bucketed_table(
    df: DataFrame, name: str, by: str, buckets: int, fmt: str = DEFAULT_FORMAT, path: str | None = None
) -> None:
    """Store a table in hash buckets of a join key, a file or more per bucket, sorted within.

    Tables in equally many buckets of the same key are joined and grouped by it without a shuffle. Rows are
    brought together by bucket before the write, so that a task writes a bucket, not a piece of all.
    """
    to = df.repartition(buckets, by).write.format(fmt).mode("overwrite").bucketBy(buckets, by).sortBy(by)
    if path is not None:
        to = to.option("path", path)
    to.saveAsTable(name)


# The published definitions; each fact is summed per key before the join, with the result of the row-level one.
_VIEWS = {
    "vw_portfolio_summary": """
        WITH held AS (
            SELECT instrument_id, as_of_date, count(*) AS held_rows, sum(market_value) AS market_value,
                   sum(unrealized_pnl) AS unrealized_pnl
            FROM {0}.fct_positions GROUP BY instrument_id, as_of_date),
        risked AS (
            SELECT instrument_id, as_of_date, count(*) AS risk_rows, sum(var_95) AS var_95,
                   count(var_95) AS var_95_rows, sum(daily_pnl) AS daily_pnl
            FROM {0}.fct_risk_metrics GROUP BY instrument_id, as_of_date)
        SELECT h.as_of_date, i.asset_class, i.sector, count(DISTINCT h.instrument_id) AS instrument_count,
               sum(h.market_value * coalesce(r.risk_rows, 1)) AS total_market_value,
               sum(h.unrealized_pnl * coalesce(r.risk_rows, 1)) AS total_unrealized_pnl,
               try_divide(sum(r.var_95 * h.held_rows), sum(r.var_95_rows * h.held_rows)) AS avg_var_95,
               sum(r.daily_pnl * h.held_rows) AS total_daily_pnl
        FROM held h LEFT JOIN risked r ON h.instrument_id = r.instrument_id AND h.as_of_date = r.as_of_date
        LEFT JOIN {0}.dim_instruments i ON h.instrument_id = i.instrument_id
        GROUP BY h.as_of_date, i.asset_class, i.sector""",
    "vw_counterparty_risk": """
        WITH risked AS (
            SELECT counterparty_id, as_of_date, sum(credit_exposure) AS credit_exposure, sum(var_95) AS var_95,
                   count(var_95) AS var_95_rows
            FROM {0}.fct_risk_metrics GROUP BY counterparty_id, as_of_date)
        SELECT r.as_of_date, c.counterparty_id, c.counterparty_name, c.credit_rating,
               sum(r.credit_exposure) AS total_credit_exposure,
               try_divide(sum(r.var_95), sum(r.var_95_rows)) AS avg_var_95
        FROM risked r LEFT JOIN {0}.dim_counterparties c ON r.counterparty_id = c.counterparty_id
        GROUP BY r.as_of_date, c.counterparty_id, c.counterparty_name, c.credit_rating""",
}


def create_model_views(spark: SparkSession, database: str) -> None:
    """Create or replace both reporting views over the model tables: by name, for every session."""
    for name, text in _VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text.format(database)}")


def sample_rows(df: DataFrame, rows: int = 10, key: str | None = None) -> DataFrame:
    """A few rows to look at: arbitrary ones, or with ``key`` those whose key has the smallest hash.

    The latter are the same whatever the partitioning; each task keeps its own few, which are merged.
    """
    if key is None:
        return df.limit(rows)
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(rows)


def fetch_row(df: DataFrame) -> dict[str, object]:
    """Bring a one-row result to the client; refuses anything longer."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError(f"expected exactly one row, found {'several' if rows else 'none'}")
    return rows[0].asDict()


