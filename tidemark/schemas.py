"""Column names and types of every table in the model.

Spark's CSV reader does not enforce NOT NULL: required columns are checked by
``operators.quality``. Names, types and partition columns are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

def _columns(text: str) -> StructType:
    """A schema from "name type, name type not null, ..."; needs no running session, unlike DDL."""
    schema = StructType()
    for column in text.split(", "):
        name, kind, *required = column.split()
        schema.add(name, kind, nullable=not required)
    return schema


RAW_TRADES = _columns(
    "trade_id string not null, trade_date date not null, settlement_date date, "
    "instrument_id string not null, counterparty_id string not null, trade_type string not null, "
    "quantity decimal(18,4) not null, price decimal(18,4) not null, currency string not null, "
    "trader_id string, book_id string, status string"
)

RAW_PRICES = _columns(
    "price_id string not null, price_date date not null, instrument_id string not null, "
    "open_price decimal(18,4), high_price decimal(18,4), low_price decimal(18,4), "
    "close_price decimal(18,4) not null, volume long, "
    "bid_price decimal(18,4), ask_price decimal(18,4), source string"
)

DEMO_TRADES = _columns("instrument string, qty double, price double, trade_date date")
DEMO_PRICES = _columns("instrument string, close double, date date")

_CREATED = "created_at timestamp"
_AUDIT = "created_at timestamp, updated_at timestamp"


def _extend(base: StructType, text: str) -> StructType:
    return StructType(base.fields + _columns(text).fields)


DIM_TRADES = _extend(RAW_TRADES, _AUDIT)

DIM_INSTRUMENTS = _columns(
    "instrument_id string not null, instrument_name string not null, instrument_type string not null, "
    "asset_class string, sector string, issuer string, currency string not null, "
    f"maturity_date date, coupon_rate decimal(10,4), is_active boolean, {_AUDIT}"
)

DIM_COUNTERPARTIES = _columns(
    "counterparty_id string not null, counterparty_name string not null, counterparty_type string, "
    f"country string, sector string, credit_rating string, is_active boolean, {_AUDIT}"
)

FCT_MARKET_PRICES = _extend(RAW_PRICES, _CREATED)

FCT_POSITIONS = _columns(
    "position_id string not null, as_of_date date not null, instrument_id string not null, "
    "book_id string not null, quantity decimal(18,4) not null, cost_basis decimal(18,2), "
    f"market_value decimal(18,2), unrealized_pnl decimal(18,2), currency string not null, {_CREATED}"
)

FCT_RISK_METRICS = _columns(
    "metric_id string not null, as_of_date date not null, instrument_id string, book_id string, "
    "counterparty_id string, "
    "var_95 decimal(18,2), var_99 decimal(18,2), cvar_95 decimal(18,2), cvar_99 decimal(18,2), "
    "delta decimal(18,6), gamma decimal(18,6), vega decimal(18,6), theta decimal(18,6), rho decimal(18,6), "
    "daily_pnl decimal(18,2), mtd_pnl decimal(18,2), ytd_pnl decimal(18,2), "
    f"notional_exposure decimal(18,2), market_exposure decimal(18,2), credit_exposure decimal(18,2), {_CREATED}"
)

# name -> (schema, partition column or None, comment)
MODEL = {
    "dim_trades": (DIM_TRADES, "trade_date", "All trade transactions"),
    "dim_instruments": (DIM_INSTRUMENTS, None, "Instrument master data"),
    "dim_counterparties": (DIM_COUNTERPARTIES, None, "Counterparty master data"),
    "fct_market_prices": (FCT_MARKET_PRICES, "price_date", "End-of-day prices of all instruments"),
    "fct_positions": (FCT_POSITIONS, "as_of_date", "Position snapshots of all books"),
    "fct_risk_metrics": (FCT_RISK_METRICS, "as_of_date", "Risk metrics: VaR, P&L, exposures"),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a model schema: cast what exists, typed NULL for what does not."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
