"""The model's inputs, derived from the order and line-item tables.

Lines stand for trades and price quotes, suppliers for instruments, customers for
counterparties, order priorities for books. Some codes are made untidy and some quotes
wrong on purpose, so that cleaning has work to do.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.sources.tables import fetch_row


class Tables:
    """Lazy access to the parquet tables of one folder and to the frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def last_day(self) -> date:
        """The job's date: the newest trade or price date, which a scheduler would hand over."""
        shipped = self.read("lineitem").agg(F.max("l_shipdate")).scalar()
        ordered = self.read("orders").agg(F.max("o_orderdate")).scalar()
        newest = self.spark.range(1).select(F.to_date(F.greatest(shipped, ordered)).alias("day"))
        return fetch_row(newest)["day"]

    def raw_trades(self) -> DataFrame:
        """One trade per line, in the layout of ``schemas.RAW_TRADES``."""
        lines = self.read("lineitem")
        orders = self.read("orders")
        flag = F.col("l_returnflag")
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
            F.to_date("o_orderdate").alias("trade_date"),
            F.to_date("l_shipdate").alias("settlement_date"),
            F.col("l_suppkey").cast("string").alias("instrument_id"),
            F.col("o_custkey").cast("string").alias("counterparty_id"),
            F.when(F.col("l_linenumber") == 7, "XFER")
            .when(flag == "R", " sell ")
            .when(flag == "A", "Buy")
            .otherwise("BUY")
            .alias("trade_type"),
            F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
            unit_price().cast("decimal(18,4)").alias("price"),
            F.when(F.col("l_linestatus") == "O", " usd").otherwise("EUR ").alias("currency"),
            F.concat(F.lit("T"), F.col("l_linenumber").cast("string")).alias("trader_id"),
            F.col("o_orderpriority").alias("book_id"),
            F.when(F.col("o_orderstatus") == "O", " open")
            .when(F.col("o_orderstatus") == "F", "Settled")
            .alias("status"),
        )

    def raw_prices(self) -> DataFrame:
        """One quote per line, in the layout of ``schemas.RAW_PRICES``; some are wrong."""
        price = unit_price()
        above = F.floor(price * (1 + F.col("l_tax")) * 100) / 100
        below = F.floor(price * (1 - F.col("l_discount")) * 100) / 100
        inverted = F.col("l_tax") > 0.075
        money = "decimal(18,4)"
        return self.read("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("price_id"),
            F.to_date("l_shipdate").alias("price_date"),
            F.col("l_suppkey").cast("string").alias("instrument_id"),
            price.cast(money).alias("open_price"),
            F.when(inverted, below).otherwise(above).cast(money).alias("high_price"),
            F.when(inverted, above).otherwise(below).cast(money).alias("low_price"),
            F.when(F.col("l_discount") > 0.095, -price).otherwise(price).cast(money).alias("close_price"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            below.cast(money).alias("bid_price"),
            above.cast(money).alias("ask_price"),
            F.when(F.col("l_returnflag") == "N", "MANUAL").otherwise("REUTERS").alias("source"),
        )

    def daily_prices(self, instrument: str = "l_suppkey") -> DataFrame:
        """Volume-weighted close per instrument and day: unique by construction.

        The sums are decimal, so the close does not depend on the order of addition.
        """
        amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
        volume = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
        return (
            self.read("lineitem")
            .groupBy(
                F.col(instrument).cast("string").alias("instrument_id"),
                F.to_date("l_shipdate").alias("price_date"),
            )
            .agg((amount / volume).alias("close_price"))
        )

    def instruments(self) -> DataFrame:
        supplier, nation, region = self.read("supplier"), self.read("nation"), self.read("region")
        return (
            supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                F.col("s_suppkey").cast("string").alias("instrument_id"),
                F.col("s_name").alias("instrument_name"),
                F.lit("EQUITY").alias("instrument_type"),
                F.col("r_name").alias("asset_class"),
                F.col("n_name").alias("sector"),
                F.lit("USD").alias("currency"),
                F.lit(True).alias("is_active"),
            )
        )

    def counterparties(self) -> DataFrame:
        customer, nation = self.read("customer"), self.read("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").cast("string").alias("counterparty_id"),
            F.col("c_name").alias("counterparty_name"),
            F.lit("CORPORATE").alias("counterparty_type"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("credit_rating"),
            F.lit(True).alias("is_active"),
        )

    def demo_trades(self) -> DataFrame:
        return self.read("lineitem").select(
            F.concat(F.lit("I"), F.col("l_suppkey").cast("string")).alias("instrument"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
            .otherwise(F.col("l_quantity"))
            .alias("qty"),
            unit_price().alias("price"),
            F.to_date("l_shipdate").alias("trade_date"),
        )

    def demo_prices(self) -> DataFrame:
        return self.daily_prices().select(
            F.concat(F.lit("I"), F.col("instrument_id")).alias("instrument"),
            (F.floor(F.col("close_price") * 100) / 100).alias("close"),
            F.col("price_date").alias("date"),
        )


def unit_price() -> Column:
    """Price per unit, cut to whole cents (cutting, unlike rounding, has no ties to break)."""
    return F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / 100
