"""Small inline inputs."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql.types import StructType

from tidemark.schemas import RAW_PRICES, RAW_TRADES

DAY0 = date(2024, 1, 1)


def day(offset: int) -> date:
    return DAY0 + timedelta(days=offset)


def nullable(schema: StructType) -> StructType:
    """The schema as a CSV scan delivers it: nothing is enforced."""
    relaxed = StructType()
    for f in schema.fields:
        relaxed.add(f.name, f.dataType, True)
    return relaxed


def trades(spark, *rows: dict, stamp: bool = False):
    base = {
        "trade_id": "t1", "trade_date": day(0), "settlement_date": day(2), "instrument_id": "A",
        "counterparty_id": "c1", "trade_type": "BUY", "quantity": Decimal(10), "price": Decimal(5),
        "currency": "USD", "trader_id": None, "book_id": "b1", "status": None,
    }
    schema = nullable(RAW_TRADES)
    if stamp:
        base["ingestion_timestamp"] = datetime(2024, 1, 1)
        schema.add("ingestion_timestamp", "timestamp")
    return spark.createDataFrame([tuple((base | r)[f.name] for f in schema.fields) for r in rows], schema)


def prices(spark, *rows: dict):
    base = {
        "price_id": "p1", "price_date": day(0), "instrument_id": "A", "open_price": None, "high_price": None,
        "low_price": None, "close_price": Decimal(100), "volume": 1, "bid_price": None, "ask_price": None,
        "source": "X",
    }
    schema = nullable(RAW_PRICES)
    return spark.createDataFrame([tuple((base | r)[f.name] for f in schema.fields) for r in rows], schema)


def closes(spark, rows):
    """(instrument_id, price_date, close_price) rows."""
    return spark.createDataFrame(list(rows), "instrument_id string, price_date date, close_price double")


def rows(df, *columns):
    """Rows as a sorted list of tuples (NULLs last), for order-free comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=nulls_last)


def nulls_last(row):
    return tuple((v is None, 0 if v is None else v) for v in row)
