"""The queries once more, as SQL over the same tables, written for DuckDB.

A query is a final SELECT over named steps; only the steps it needs go into its WITH clause.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# step name -> (the steps it reads, its SELECT); a step follows the steps it reads
_STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def _step(name: str, select: str, *reads: str) -> None:
    _STEPS[name] = (reads, select)


def _oracle(name: str, select: str, *reads: str) -> None:
    needed: set[str] = set()
    pending = list(reads)
    while pending:
        step = pending.pop()
        if step not in needed:
            needed.add(step)
            pending += _STEPS[step][0]
    steps = ",\n".join(f"{s} AS ({_STEPS[s][1]})" for s in _STEPS if s in needed)
    ORACLE[name] = f"WITH {steps}\n{select}" if steps else select


def _money(*columns: str, digits: int = 2) -> str:
    return ", ".join(f"CAST(round({c}, {digits}) AS DOUBLE) AS {c}" for c in columns)


# --- inputs -----------------------------------------------------------------------------

_UNIT = "floor(l_extendedprice / l_quantity * 100) / 100"
_ABOVE = f"floor({_UNIT} * (1 + l_tax) * 100) / 100"
_BELOW = f"floor({_UNIT} * (1 - l_discount) * 100) / 100"
_LAST_DAY = (
    "CAST(greatest((SELECT max(l_shipdate) FROM lineitem), (SELECT max(o_orderdate) FROM orders)) AS DATE)"
)

_step(
    "raw_trades",
    f"""
    SELECT l_orderkey || '-' || l_linenumber AS trade_id,
           CAST(o_orderdate AS DATE) AS trade_date,
           CAST(l_shipdate AS DATE) AS settlement_date,
           CAST(l_suppkey AS VARCHAR) AS instrument_id,
           CAST(o_custkey AS VARCHAR) AS counterparty_id,
           CASE WHEN l_linenumber = 7 THEN 'XFER' WHEN l_returnflag = 'R' THEN ' sell '
                WHEN l_returnflag = 'A' THEN 'Buy' ELSE 'BUY' END AS trade_type,
           CAST(l_quantity AS DECIMAL(18,4)) AS quantity,
           CAST({_UNIT} AS DECIMAL(18,4)) AS price,
           CASE WHEN l_linestatus = 'O' THEN ' usd' ELSE 'EUR ' END AS currency,
           'T' || l_linenumber AS trader_id,
           o_orderpriority AS book_id,
           CASE WHEN o_orderstatus = 'O' THEN ' open' WHEN o_orderstatus = 'F' THEN 'Settled' END AS status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
_step(
    "raw_prices",
    f"""
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS price_id,
           CAST(l_shipdate AS DATE) AS price_date,
           CAST(l_suppkey AS VARCHAR) AS instrument_id,
           CAST({_UNIT} AS DECIMAL(18,4)) AS open_price,
           CAST(CASE WHEN l_tax > 0.075 THEN {_BELOW} ELSE {_ABOVE} END AS DECIMAL(18,4)) AS high_price,
           CAST(CASE WHEN l_tax > 0.075 THEN {_ABOVE} ELSE {_BELOW} END AS DECIMAL(18,4)) AS low_price,
           CAST(CASE WHEN l_discount > 0.095 THEN -({_UNIT}) ELSE {_UNIT} END AS DECIMAL(18,4)) AS close_price,
           CAST(l_quantity AS BIGINT) AS volume,
           CAST({_BELOW} AS DECIMAL(18,4)) AS bid_price,
           CAST({_ABOVE} AS DECIMAL(18,4)) AS ask_price,
           CASE WHEN l_returnflag = 'N' THEN 'MANUAL' ELSE 'REUTERS' END AS source
    FROM lineitem""",
)


def _daily_prices(instrument: str) -> str:
    return f"""
    SELECT CAST({instrument} AS VARCHAR) AS instrument_id, CAST(l_shipdate AS DATE) AS price_date,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
           / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close_price
    FROM lineitem GROUP BY ALL"""


_step("daily_prices", _daily_prices("l_suppkey"))
_step("part_prices", _daily_prices("l_partkey"))
_step(
    "instruments",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS instrument_id, r_name AS asset_class, n_name AS sector
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
_step(
    "counterparties",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS counterparty_id, c_name AS counterparty_name,
           c_mktsegment AS credit_rating
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
_step(
    "demo_trades",
    f"""
    SELECT 'I' || l_suppkey AS instrument,
           CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS qty,
           {_UNIT} AS price, CAST(l_shipdate AS DATE) AS trade_date
    FROM lineitem""",
)
_step(
    "demo_prices",
    """
    SELECT 'I' || instrument_id AS instrument, floor(close_price * 100) / 100 AS close, price_date AS date
    FROM daily_prices""",
    "daily_prices",
)

# --- returns and VaR --------------------------------------------------------------------


def _returns(prices: str) -> str:
    return f"""
    SELECT * FROM (
        SELECT *, (close_price - prev_close) / nullif(prev_close, 0) AS daily_return
        FROM (SELECT *, lag(close_price) OVER (PARTITION BY instrument_id ORDER BY price_date) AS prev_close
              FROM {prices}))
    WHERE daily_return IS NOT NULL"""


def _recent(history: str) -> str:
    return f"SELECT * FROM {history} WHERE price_date >= (SELECT max(price_date) FROM {history}) - 252"


def _ranked(recent: str) -> str:
    return f"""
    SELECT instrument_id, daily_return,
           row_number() OVER (PARTITION BY instrument_id ORDER BY daily_return) - 1 AS position,
           count(*) OVER (PARTITION BY instrument_id) AS n
    FROM {recent}"""


def _tail(level: float) -> str:
    return f"floor((1 - CAST({level} AS DOUBLE)) * n)"


def _level_columns(level: float, var: str, cvar: str) -> str:
    return (
        f"max(CASE WHEN n >= 30 AND position = {_tail(level)} THEN daily_return END) AS {var}, "
        f"avg(CASE WHEN n >= 30 AND position <= {_tail(level)} THEN daily_return END) AS {cvar}"
    )


def _var(ranked: str) -> str:
    return f"""
    SELECT instrument_id, {_level_columns(0.95, "var_95_pct", "cvar_95_pct")},
           {_level_columns(0.99, "var_99_pct", "cvar_99_pct")}, count(*) AS returns
    FROM {ranked} GROUP BY instrument_id"""


_step("returns", _returns("daily_prices"), "daily_prices")
_step("recent", _recent("returns"), "returns")
_step("ranked", _ranked("recent"), "recent")
_step("var", _var("ranked"), "ranked")
_step("part_returns", _returns("part_prices"), "part_prices")
_step("part_recent", _recent("part_returns"), "part_returns")
_step("part_ranked", _ranked("part_recent"), "part_recent")
_step("part_var", _var("part_ranked"), "part_ranked")

_RETURN_COLUMNS = (
    "SELECT instrument_id, price_date, close_price, prev_close, " + _money("daily_return", digits=6)
)
_VAR_COLUMNS = "SELECT instrument_id, returns, " + _money(
    "var_95_pct", "cvar_95_pct", "var_99_pct", "cvar_99_pct", digits=6
)
_oracle("daily_returns", f"{_RETURN_COLUMNS} FROM returns", "returns")
_oracle("lookback_filter", f"{_RETURN_COLUMNS} FROM recent", "recent")
_oracle("lookback_returns", f"{_RETURN_COLUMNS} FROM recent", "recent")
_oracle("instrument_var", f"{_VAR_COLUMNS} FROM var", "var")
_oracle("instrument_var_full_history", f"{_VAR_COLUMNS} FROM var", "var")
_oracle("instrument_var_short_history", f"{_VAR_COLUMNS} FROM part_var", "part_var")
_oracle("instrument_var_from_tails", f"{_VAR_COLUMNS} FROM var", "var")
_oracle(
    "var_by_level",
    "\nUNION ALL\n".join(
        f"SELECT instrument_id, returns, CAST({level} AS DOUBLE) AS level, "
        + _money("var_pct", "cvar_pct", digits=6)
        + f" FROM (SELECT instrument_id, count(*) AS returns, {_level_columns(level, 'var_pct', 'cvar_pct')} "
        "FROM ranked GROUP BY instrument_id)"
        for level in (0.9, 0.95, 0.975, 0.99)
    ),
    "ranked",
)

# --- silver -----------------------------------------------------------------------------


def _latest(source: str, key: str, rest: str) -> str:
    order = ", ".join(f"{c.strip()} DESC NULLS LAST" for c in rest.split(","))
    return f"""
    SELECT * EXCLUDE (copy) FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS copy FROM {source})
    WHERE copy = 1"""


def _normalized(source: str) -> str:
    return f"""
    SELECT *, CAST(settlement_date - trade_date AS INTEGER) AS settlement_days,
           quantity * price AS notional_value,
           coalesce(quantity > 0 AND price > 0 AND trade_type IN ('BUY', 'SELL')
                    AND settlement_date >= trade_date, false) AS is_valid
    FROM (SELECT * REPLACE (upper(trim(trade_type)) AS trade_type, upper(trim(currency)) AS currency,
                            coalesce(upper(trim(status)), 'OPEN') AS status) FROM {source})"""


_step("normalized", _normalized("raw_trades"), "raw_trades")
_step(
    "latest_trades",
    _latest(
        "raw_trades",
        "trade_id",
        "trade_date, settlement_date, instrument_id, counterparty_id, trade_type, quantity, price, "
        "currency, trader_id, book_id, status",
    ),
    "raw_trades",
)
_step("distinct_trades", _normalized("latest_trades"), "latest_trades")
_step("silver_trades", "SELECT * FROM distinct_trades WHERE is_valid", "distinct_trades")
_step(
    "good_prices",
    """
    SELECT * FROM raw_prices
    WHERE NOT coalesce(close_price < 0, false) AND NOT coalesce(high_price < low_price, false)""",
    "raw_prices",
)
_step(
    "silver_prices",
    _latest(
        "good_prices",
        "instrument_id, price_date",
        "price_id, open_price, high_price, low_price, close_price, volume, bid_price, ask_price, source",
    ),
    "good_prices",
)

_TRADE_COLUMNS = (
    "SELECT * EXCLUDE (quantity, price, notional_value), "
    + _money("quantity", "price", "notional_value", digits=4)
)
_PRICE_NAMES = ("open_price", "high_price", "low_price", "close_price", "bid_price", "ask_price")
_PRICE_COLUMNS = f"SELECT * EXCLUDE ({', '.join(_PRICE_NAMES)}), " + _money(*_PRICE_NAMES, digits=4)
_SUMMARY = (
    "SELECT trade_type, currency, status, count(*) AS trade_count, "
    "CAST(round(sum(notional_value), 2) AS DOUBLE) AS total_notional, "
    "CAST(round(avg(price), 4) AS DOUBLE) AS avg_price "
    "FROM silver_trades GROUP BY ALL"
)
_oracle("normalized_trades", f"{_TRADE_COLUMNS} FROM normalized", "normalized")
_oracle(
    "trade_expressions",
    "SELECT trade_id, settlement_date, instrument_id, trade_type AS clean_type, currency AS clean_currency, "
    "status AS clean_status, settlement_days, "
    "CAST(round(notional_value, 4) AS DOUBLE) AS notional_value, CAST(year(trade_date) AS INTEGER) AS year, "
    "CAST(month(trade_date) AS INTEGER) AS month FROM normalized",
    "normalized",
)
_oracle("distinct_trades", f"{_TRADE_COLUMNS} FROM distinct_trades", "distinct_trades")
_oracle("silver_trades", f"{_TRADE_COLUMNS} FROM silver_trades", "silver_trades")
_oracle(
    "validity_flags",
    "SELECT trade_type, is_valid, count(*) AS trades FROM normalized GROUP BY ALL",
    "normalized",
)
_oracle("trade_summary", _SUMMARY, "silver_trades")
_oracle("silver_prices", f"{_PRICE_COLUMNS} FROM silver_prices", "silver_prices")

_step(
    "silver_closes",
    "SELECT instrument_id, price_date, CAST(close_price AS DOUBLE) AS close_price FROM silver_prices",
    "silver_prices",
)
_step("silver_returns", _returns("silver_closes"), "silver_closes")
_step("silver_recent", _recent("silver_returns"), "silver_returns")
_step("silver_ranked", _ranked("silver_recent"), "silver_recent")
_step("silver_var", _var("silver_ranked"), "silver_ranked")
_oracle(
    "extended_prices_job",
    "SELECT instrument_id, price_date, round(close_price, 4) AS close_price, round(prev_close, 4) AS prev_close, "
    "round((close_price - prev_close) / nullif(prev_close, 0), 6) AS daily_return FROM "
    "(SELECT *, lag(close_price) OVER (PARTITION BY instrument_id ORDER BY price_date) AS prev_close FROM silver_closes)",
    "silver_closes",
)
_oracle("stored_instrument_var", f"{_VAR_COLUMNS} FROM silver_var", "silver_var")

# --- positions --------------------------------------------------------------------------

_SIGNED = "CASE trade_type WHEN 'BUY' THEN quantity WHEN 'SELL' THEN -quantity END"
_COST = "CASE trade_type WHEN 'BUY' THEN quantity * price WHEN 'SELL' THEN -(quantity * price) END"
_PART = r"coalesce(replace(replace({}, '\', '\\'), '|', '\|'), '\N')"
_VALUE_COLUMNS = f"""
           {" || '|' || ".join(map(_PART.format, ("instrument_id", "book_id", "currency")))} AS position_id, instrument_id, book_id, currency,
           quantity, round(cost_basis, 2) AS cost_basis, round(quantity * close_price, 2) AS market_value,
           round(quantity * close_price, 2) - round(cost_basis, 2) AS unrealized_pnl"""

_step(
    "last_closes",
    "SELECT instrument_id, max_by(close_price, price_date) AS close_price FROM silver_prices GROUP BY ALL",
    "silver_prices",
)
_step(
    "current_positions",
    f"""
    SELECT {_LAST_DAY} AS as_of_date, {_VALUE_COLUMNS}
    FROM (SELECT instrument_id, book_id, currency, sum({_SIGNED}) AS quantity,
                 sum({_COST}) AS cost_basis
          FROM silver_trades GROUP BY ALL)
    LEFT JOIN last_closes USING (instrument_id)""",
    "silver_trades",
    "last_closes",
)


def _carried(source: str, key: str, frequency: str) -> str:
    following = f"lead(period) OVER (PARTITION BY {key} ORDER BY period) - 1"
    until = f"coalesce({following}, CAST(date_trunc('{frequency}', {_LAST_DAY}) AS DATE))"
    return f"""
    SELECT * EXCLUDE (period, until),
           CAST(unnest(generate_series(CAST(period AS TIMESTAMP), CAST(until AS TIMESTAMP),
                                       INTERVAL 1 {frequency})) AS DATE) AS period
    FROM (SELECT *, {until} AS until FROM ({source}))"""


def _snapshot_steps(frequency: str, period_end: str) -> None:
    _step(
        f"held_{frequency}",
        _carried(
            f"""
            SELECT instrument_id, book_id, currency, period, sum(quantity) OVER w AS quantity,
                   sum(cost_basis) OVER w AS cost_basis
            FROM (SELECT instrument_id, book_id, currency,
                         CAST(date_trunc('{frequency}', trade_date) AS DATE) AS period,
                         sum({_SIGNED}) AS quantity, sum({_COST}) AS cost_basis
                  FROM silver_trades GROUP BY ALL)
            WINDOW w AS (PARTITION BY instrument_id, book_id, currency ORDER BY period)""",
            "instrument_id, book_id, currency",
            frequency,
        ),
        "silver_trades",
    )
    _step(
        f"closes_{frequency}",
        _carried(
            f"""
            SELECT instrument_id, CAST(date_trunc('{frequency}', price_date) AS DATE) AS period,
                   max_by(close_price, price_date) AS close_price
            FROM silver_prices GROUP BY ALL""",
            "instrument_id",
            frequency,
        ),
        "silver_prices",
    )
    _step(
        f"snapshots_{frequency}",
        f"""
        SELECT {period_end} AS as_of_date, {_VALUE_COLUMNS}
        FROM held_{frequency} LEFT JOIN closes_{frequency} USING (instrument_id, period)""",
        f"held_{frequency}",
        f"closes_{frequency}",
    )
    _step(
        f"pnl_{frequency}",
        f"""
        SELECT *, sum(daily_pnl) OVER (PARTITION BY position_id, date_trunc('month', as_of_date)
                                       ORDER BY as_of_date) AS mtd_pnl,
               sum(daily_pnl) OVER (PARTITION BY position_id, date_trunc('year', as_of_date)
                                    ORDER BY as_of_date) AS ytd_pnl
        FROM (SELECT *, unrealized_pnl - coalesce(last_value(unrealized_pnl IGNORE NULLS) OVER (
                         PARTITION BY position_id ORDER BY as_of_date
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS daily_pnl
              FROM snapshots_{frequency})""",
        f"snapshots_{frequency}",
    )


_snapshot_steps("month", "last_day(period)")
_snapshot_steps("week", "period + 6")
_snapshot_steps("day", "period")

_POSITION_COLUMNS = "SELECT position_id, as_of_date, instrument_id, book_id, currency, " + _money(
    "quantity", "cost_basis", "market_value", "unrealized_pnl"
)
_oracle("current_positions", f"{_POSITION_COLUMNS} FROM current_positions", "current_positions")
_oracle("publish_positions_job", f"{_POSITION_COLUMNS} FROM current_positions", "current_positions")
_oracle("position_snapshots", f"{_POSITION_COLUMNS} FROM snapshots_month", "snapshots_month")
_oracle(
    "latest_snapshot",
    f"{_POSITION_COLUMNS} FROM snapshots_month "
    "WHERE as_of_date = (SELECT max(as_of_date) FROM snapshots_month)",
    "snapshots_month",
)
_oracle(
    "position_pnl",
    "SELECT position_id, as_of_date, instrument_id, book_id, currency, "
    + _money("unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")
    + " FROM pnl_month",
    "pnl_month",
)
_oracle(
    "latest_pnl",
    "SELECT position_id, as_of_date, instrument_id, book_id, currency, "
    + _money("unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")
    + " FROM pnl_week WHERE as_of_date = (SELECT max(as_of_date) FROM pnl_week)",
    "pnl_week",
)
for _query, _frequency in (("book_pnl_weekly", "week"), ("book_pnl_daily", "day")):
    _oracle(
        _query,
        "SELECT book_id, currency, as_of_date, "
        + _money("daily_pnl", "mtd_pnl", "ytd_pnl")
        + " FROM (SELECT book_id, currency, as_of_date, sum(daily_pnl) AS daily_pnl, sum(mtd_pnl) AS mtd_pnl, "
        f"sum(ytd_pnl) AS ytd_pnl FROM pnl_{_frequency} GROUP BY ALL)",
        f"pnl_{_frequency}",
    )
_oracle(
    "advanced_positions_job",
    f"{_POSITION_COLUMNS} FROM snapshots_day WHERE as_of_date >= {_LAST_DAY} - 3",
    "snapshots_day",
)
_oracle(
    "advanced_pnl_job",
    "SELECT position_id, as_of_date, instrument_id, book_id, currency, "
    + _money("unrealized_pnl", "daily_pnl", "mtd_pnl", "ytd_pnl")
    + f" FROM pnl_day WHERE as_of_date >= {_LAST_DAY} - 2",
    "pnl_day",
)

# --- position VaR and gold --------------------------------------------------------------


def _risk_columns(level: str) -> str:
    return f"CAST(market_value AS DOUBLE) * abs({level}_pct) AS {level}"


_LEVEL_COLUMNS = ", ".join(_risk_columns(c) for c in ("var_95", "cvar_95", "var_99", "cvar_99"))
_step(
    "position_var",
    f"SELECT p.*, {_LEVEL_COLUMNS} FROM current_positions p LEFT JOIN var USING (instrument_id)",
    "current_positions",
    "var",
)
_step(
    "monthly_risk",
    f"SELECT p.*, {_LEVEL_COLUMNS} FROM pnl_month p LEFT JOIN var USING (instrument_id)",
    "pnl_month",
    "var",
)
_step(
    "risk_metrics",
    """
    SELECT position_id || '_var' AS metric_id, as_of_date, instrument_id, book_id,
           CAST(NULL AS VARCHAR) AS counterparty_id, var_95, var_99,
           market_value AS notional_exposure, market_value AS market_exposure,
           CAST(NULL AS DECIMAL(18,2)) AS daily_pnl
    FROM position_var""",
    "position_var",
)

_oracle(
    "position_var",
    "SELECT position_id, as_of_date, instrument_id, book_id, "
    + _money("market_value", "var_95", "cvar_95", "var_99", "cvar_99")
    + " FROM position_var",
    "position_var",
)
_oracle(
    "portfolio_var",
    "SELECT round(sum(var_95), 2) AS total_var_95, round(sum(var_99), 2) AS total_var_99, "
    "CAST(sum(market_value) AS DOUBLE) AS total_market_value, max(as_of_date) AS as_of_date FROM position_var",
    "position_var",
)


def _nulls(*columns: str) -> str:
    return ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in columns)


_GREEKS = ("delta", "gamma", "vega", "theta", "rho")
_oracle(
    "risk_metrics",
    "SELECT metric_id, as_of_date, instrument_id, book_id, counterparty_id, "
    + _money("var_95", "var_99", "notional_exposure", "market_exposure")
    + ", "
    + _nulls("cvar_95", "cvar_99", *_GREEKS, "daily_pnl", "mtd_pnl", "ytd_pnl", "credit_exposure")
    + " FROM risk_metrics",
    "risk_metrics",
)
_oracle(
    "complete_risk_metrics",
    "SELECT position_id || '_var' AS metric_id, as_of_date, instrument_id, book_id, "
    + _money("var_95", "var_99", "cvar_95", "cvar_99", "daily_pnl", "mtd_pnl", "ytd_pnl")
    + ", CAST(market_value AS DOUBLE) AS notional_exposure, CAST(market_value AS DOUBLE) AS market_exposure, "
    + _nulls(*_GREEKS, "credit_exposure")
    + f" FROM monthly_risk WHERE as_of_date = last_day({_LAST_DAY})",
    "monthly_risk",
)
_BOOK_SUMMARY = (
    "SELECT book_id, count(*) AS position_count, round(sum(var_95), 2) AS total_var_95, "
    "round(sum(var_99), 2) AS total_var_99, CAST(sum(market_exposure) AS DOUBLE) AS total_exposure "
    "FROM risk_metrics GROUP BY book_id"
)
_oracle("book_var_summary", _BOOK_SUMMARY, "risk_metrics")

# --- exposure and views -----------------------------------------------------------------

_oracle(
    "instrument_exposure",
    "SELECT as_of_date, instrument_id, currency, CAST(sum(market_value) AS DOUBLE) AS net_exposure, "
    "CAST(sum(abs(market_value)) AS DOUBLE) AS gross_exposure, count(*) AS position_count "
    "FROM current_positions GROUP BY ALL",
    "current_positions",
)
_oracle(
    "sector_exposure",
    "SELECT as_of_date, asset_class, sector, currency, CAST(sum(market_value) AS DOUBLE) AS net_exposure, "
    "CAST(sum(abs(market_value)) AS DOUBLE) AS gross_exposure, count(*) AS position_count "
    "FROM snapshots_month LEFT JOIN instruments USING (instrument_id) GROUP BY ALL",
    "snapshots_month",
    "instruments",
)
_oracle(
    "counterparty_exposure",
    """
    SELECT t.counterparty_id, t.currency, counterparty_name, credit_rating,
           CAST(round(sum(CASE trade_type WHEN 'BUY' THEN notional_value ELSE -notional_value END), 2) AS DOUBLE)
               AS net_notional,
           CAST(round(sum(notional_value), 2) AS DOUBLE) AS gross_notional, count(*) AS trade_count
    FROM silver_trades t LEFT JOIN counterparties c ON t.counterparty_id = c.counterparty_id GROUP BY ALL""",
    "silver_trades",
    "counterparties",
)


def _portfolio(positions: str, risk: str) -> str:
    """The published view: positions joined to risk row by row."""
    return f"""
    SELECT p.as_of_date, i.asset_class, i.sector, count(DISTINCT p.instrument_id) AS instrument_count,
           CAST(sum(p.market_value) AS DOUBLE) AS total_market_value,
           CAST(sum(p.unrealized_pnl) AS DOUBLE) AS total_unrealized_pnl,
           round(avg(r.var_95), 2) AS avg_var_95, CAST(sum(r.daily_pnl) AS DOUBLE) AS total_daily_pnl
    FROM {positions} p LEFT JOIN instruments i ON p.instrument_id = i.instrument_id
    LEFT JOIN {risk} r ON p.instrument_id = r.instrument_id AND p.as_of_date = r.as_of_date
    GROUP BY ALL"""


for _query in ("portfolio_summary", "portfolio_summary_of_facts"):
    _oracle(
        _query, _portfolio("current_positions", "risk_metrics"),
        "current_positions", "risk_metrics", "instruments",
    )
_oracle(
    "portfolio_summary_once",
    """
    SELECT as_of_date, asset_class, sector, count(DISTINCT instrument_id) AS instrument_count,
           CAST(sum(market_value) AS DOUBLE) AS total_market_value,
           CAST(sum(unrealized_pnl) AS DOUBLE) AS total_unrealized_pnl,
           round(avg(var_95), 2) AS avg_var_95, CAST(NULL AS DOUBLE) AS total_daily_pnl
    FROM position_var LEFT JOIN instruments USING (instrument_id) GROUP BY ALL""",
    "position_var",
    "instruments",
)
_oracle(
    "portfolio_history", _portfolio("snapshots_month", "monthly_risk"),
    "snapshots_month", "monthly_risk", "instruments",
)
_step(
    "trade_risk",
    """
    SELECT last_day(trade_date) AS as_of_date, counterparty_id, notional_value AS credit_exposure,
           CAST(notional_value AS DOUBLE) * abs(var_95_pct) AS var_95
    FROM silver_trades LEFT JOIN var USING (instrument_id)""",
    "silver_trades",
    "var",
)
_COUNTERPARTY_VIEW = """
    SELECT r.as_of_date, c.counterparty_id, c.counterparty_name, c.credit_rating,
           CAST(round(sum(r.credit_exposure), 2) AS DOUBLE) AS total_credit_exposure,
           round(avg(r.var_95), 2) AS avg_var_95
    FROM {} r LEFT JOIN counterparties c ON r.counterparty_id = c.counterparty_id GROUP BY ALL"""
_oracle("counterparty_risk", _COUNTERPARTY_VIEW.format("trade_risk"), "trade_risk", "counterparties")
_oracle(
    "counterparty_risk_unnamed",
    _COUNTERPARTY_VIEW.format("(SELECT *, CAST(NULL AS DECIMAL(18,2)) AS credit_exposure FROM risk_metrics)"),
    "risk_metrics",
    "counterparties",
)


def _view_rows(positions: str, risk: str) -> str:
    """Both views over the model tables, in common columns. Gold names no counterparty and has no credit exposure."""
    return f"""
    SELECT 'portfolio' AS view_name, as_of_date, asset_class AS name_1, sector AS name_2, CAST(instrument_count AS DOUBLE) AS instruments,
           total_market_value AS amount, total_unrealized_pnl AS pnl, avg_var_95
    FROM ({_portfolio(positions, risk)})
    UNION ALL
    SELECT 'counterparty', as_of_date, NULL, NULL, NULL, NULL, NULL, round(avg(var_95), 2) FROM {risk} GROUP BY as_of_date"""


_step(
    "stored_risk",
    "SELECT * REPLACE (CAST(round(var_95, 2) AS DECIMAL(18,2)) AS var_95) FROM risk_metrics",
    "risk_metrics",
)
_oracle("reporting_views", _view_rows("current_positions", "stored_risk"), "current_positions", "stored_risk", "instruments")
_step(
    "lane_var",
    f"""
    SELECT as_of_date, instrument_id, CAST(round(CAST(market_value AS DOUBLE) * abs(var_95_pct), 2) AS DECIMAL(18,2)) AS var_95,
           CAST(NULL AS DECIMAL(18,2)) AS daily_pnl
    FROM current_positions LEFT JOIN silver_var USING (instrument_id)""",
    "current_positions",
    "silver_var",
)
_oracle("files_to_views_job", _view_rows("current_positions", "lane_var"), "current_positions", "lane_var", "instruments")
_oracle(
    "bucketed_position_var",
    "SELECT position_id, as_of_date, instrument_id, book_id, "
    + _money("market_value", "var_95", "cvar_95", "var_99", "cvar_99")
    + " FROM position_var",
    "position_var",
)

# --- data quality -----------------------------------------------------------------------


def _rule(source: str, table: str, rule: str, evaluated: str, failed: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, CAST(count({evaluated}) AS BIGINT) AS evaluated, "
        f"CAST(count(*) FILTER (WHERE {failed}) AS BIGINT) AS failed, "
        f"count(*) FILTER (WHERE {failed}) = 0 AS passed FROM {source}"
    )


def _unique(source: str, table: str, rule: str, column: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{rule}' AS rule, CAST(coalesce(sum(copies), 0) AS BIGINT) AS evaluated, "
        f"CAST(count(*) FILTER (WHERE copies > 1) AS BIGINT) AS failed, "
        f"count(*) FILTER (WHERE copies > 1) = 0 AS passed "
        f"FROM (SELECT count(*) AS copies FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"
    )


def _trade_rules(source: str) -> list[str]:
    return [
        _unique(source, "trades", "trades_unique_id", "trade_id"),
        _rule(source, "trades", "trades_no_null_id", "*", "trade_id IS NULL"),
        _rule(source, "trades", "trades_valid_type", "trade_type", "trade_type NOT IN ('BUY', 'SELL')"),
        _rule(source, "trades", "trades_positive_quantity", "quantity", "quantity NOT BETWEEN 0 AND 1000000"),
        _rule(source, "trades", "trades_positive_price", "price", "price NOT BETWEEN 0 AND 100000"),
    ]


def _checkpoint(name: str, rules: list[str]) -> str:
    return f"SELECT '{name}' AS checkpoint, * FROM (" + " UNION ALL ".join(rules) + ")"


_PRICE_RULES = [
    _unique("raw_prices", "prices", "prices_unique_id", "price_id"),
    _rule("raw_prices", "prices", "prices_no_null_close", "*", "close_price IS NULL"),
    _rule("raw_prices", "prices", "prices_positive_close", "close_price",
          "close_price NOT BETWEEN 0 AND 1000000"),
    _rule("raw_prices", "prices", "prices_high_low_check", "high_price > low_price",
          "NOT (high_price > low_price)"),
]
_RISK_RULES = [
    _rule("risk_metrics", "risk_metrics", "var_95_bounds", "var_95", "var_95 NOT BETWEEN 0 AND 100000000"),
    _rule("risk_metrics", "risk_metrics", "var_99_greater_than_95", "var_99 > var_95",
          "NOT (var_99 > var_95)"),
    _rule("risk_metrics", "risk_metrics", "pnl_reasonable_bounds", "daily_pnl",
          "daily_pnl NOT BETWEEN -50000000 AND 50000000"),
]
_oracle(
    "bronze_validation", _checkpoint("bronze_validation", _trade_rules("raw_trades") + _PRICE_RULES),
    "raw_trades", "raw_prices",
)
_oracle("silver_validation", _checkpoint("silver_validation", _trade_rules("silver_trades")), "silver_trades")
_oracle("gold_validation", _checkpoint("gold_validation", _RISK_RULES), "risk_metrics")
_oracle(
    "threshold_gate",
    """
    SELECT metric, round(value, 6) AS value, threshold,
           CASE metric WHEN 'row_count' THEN value >= threshold ELSE value <= threshold END AS passed
    FROM (SELECT 'null_ratio' AS metric,
                 CAST(count(*) FILTER (WHERE trade_id IS NULL) + count(*) FILTER (WHERE instrument_id IS NULL)
                      + count(*) FILTER (WHERE status IS NULL) AS DOUBLE) / (count(*) * 3) AS value,
                 CAST(0.05 AS DOUBLE) AS threshold FROM raw_trades
          UNION ALL SELECT 'row_count', CAST(count(*) AS DOUBLE), CAST(100 AS DOUBLE) FROM raw_trades
          UNION ALL SELECT 'duplicate_ratio',
                 CAST(count(trade_id) - count(DISTINCT trade_id) AS DOUBLE) / count(*), CAST(0.01 AS DOUBLE)
          FROM raw_trades)""",
    "raw_trades",
)
_TRADE_WARNINGS = """
    SELECT 'rows' AS "check", count(*) AS failed FROM raw_trades
    UNION ALL SELECT 'duplicate_trade_id', count(*)
        FROM (SELECT trade_id FROM raw_trades GROUP BY trade_id HAVING count(*) > 1)
    UNION ALL SELECT 'null_trade_id', count(*) FROM raw_trades WHERE trade_id IS NULL
    UNION ALL SELECT 'null_trade_date', count(*) FROM raw_trades WHERE trade_date IS NULL
    UNION ALL SELECT 'null_instrument_id', count(*) FROM raw_trades WHERE instrument_id IS NULL"""
_PRICE_WARNINGS = """
    SELECT 'rows' AS "check", count(*) AS failed FROM raw_prices
    UNION ALL SELECT 'negative_close', count(*) FROM raw_prices WHERE close_price < 0
    UNION ALL SELECT 'high_below_low', count(*) FROM raw_prices WHERE high_price < low_price"""
_oracle("trade_warnings", _TRADE_WARNINGS, "raw_trades")
_oracle("price_warnings", _PRICE_WARNINGS, "raw_prices")
_oracle(
    "duplicate_trade_ids",
    "SELECT trade_id, count(*) AS copies FROM raw_trades GROUP BY trade_id HAVING count(*) > 1",
    "raw_trades",
)
_oracle(
    "validity_counts",
    "SELECT count(*) FILTER (WHERE is_valid) AS valid, count(*) FILTER (WHERE NOT is_valid) AS invalid "
    "FROM distinct_trades",
    "distinct_trades",
)

# --- demo lane --------------------------------------------------------------------------

_step(
    "demo_positions",
    "SELECT instrument, sum(qty) AS position_qty, avg(price) AS avg_price FROM demo_trades GROUP BY instrument",
    "demo_trades",
)
_step(
    "demo_risk",
    "SELECT instrument, position_qty, close AS last_price, position_qty * close AS pnl_mock "
    "FROM demo_positions JOIN demo_prices USING (instrument)",
    "demo_positions",
    "demo_prices",
)
_DEMO_POSITIONS = f"SELECT instrument, {_money('position_qty', 'avg_price', digits=6)} FROM demo_positions"
_DEMO_RISK = f"SELECT instrument, {_money('position_qty', 'last_price', 'pnl_mock', digits=4)} FROM demo_risk"
_oracle("demo_positions", _DEMO_POSITIONS, "demo_positions")
_oracle("demo_risk_metrics", _DEMO_RISK, "demo_risk")
_oracle(
    "demo_risk_metrics_at_last_price",
    f"SELECT instrument, {_money('position_qty', 'last_price', 'pnl_mock', digits=4)} "
    "FROM (SELECT instrument, position_qty, close AS last_price, position_qty * close AS pnl_mock "
    "FROM demo_positions JOIN (SELECT instrument, max_by(close, date) AS close FROM demo_prices GROUP BY ALL) "
    "USING (instrument))",
    "demo_positions",
    "demo_prices",
)
_oracle(
    "table_row_counts",
    "SELECT (SELECT count(*) FROM demo_trades) AS trades_cnt, (SELECT count(*) FROM demo_prices) AS prices_cnt, "
    "(SELECT count(*) FROM demo_positions) AS positions_cnt, (SELECT count(*) FROM demo_risk) AS risk_cnt",
    "demo_trades",
    "demo_prices",
    "demo_positions",
    "demo_risk",
)
_oracle(
    "null_instruments",
    "SELECT count(*) AS null_instrument FROM demo_trades WHERE instrument IS NULL",
    "demo_trades",
)

# --- sources and sinks ------------------------------------------------------------------

_YEAR_MONTH = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month"
_oracle(
    "bronze_trades_from_csv",
    "SELECT * EXCLUDE (quantity, price), "
    + _money("quantity", "price", digits=4)
    + f", {_YEAR_MONTH.format('trade_date')}, true AS stamped FROM raw_trades",
    "raw_trades",
)
_oracle(
    "bronze_prices_from_csv",
    f"{_PRICE_COLUMNS}, {_YEAR_MONTH.format('price_date')} FROM raw_prices",
    "raw_prices",
)
_oracle(
    "ingest_trades_job",
    f"{_TRADE_WARNINGS} UNION ALL SELECT 'stored_rows', 2 * count(*) FROM raw_trades",
    "raw_trades",
)
_oracle("ingest_prices_job", _PRICE_WARNINGS, "raw_prices")
_oracle("refine_trades_job", _SUMMARY, "silver_trades")
_step(
    "judged_trades",
    """
    SELECT *, nullif(concat_ws(', ', CASE WHEN trade_id LIKE '%-5' THEN 'trade_date' END,
                               CASE WHEN trade_id LIKE '%5-1' OR trade_id LIKE '%5-5' THEN 'quantity' END), '') AS unread
    FROM raw_trades""",
    "raw_trades",
)
_oracle(
    "quarantined_trades", "SELECT trade_id, 'not readable: ' || unread AS reason, true AS has_file FROM judged_trades",
    "judged_trades",
)
_oracle(
    "ingested_once_job", "SELECT * EXCLUDE (quantity, price), " + _money("quantity", "price", digits=4) + " FROM raw_trades",
    "raw_trades",
)
_step("read_trades", "SELECT * EXCLUDE (unread) FROM judged_trades WHERE unread IS NULL", "judged_trades")
_step(
    "read_latest",
    _latest(
        "read_trades",
        "trade_id",
        "trade_date, settlement_date, instrument_id, counterparty_id, trade_type, quantity, price, "
        "currency, trader_id, book_id, status",
    ),
    "read_trades",
)
_step("read_silver", _normalized("read_latest"), "read_latest")
_oracle(
    "gated_refine_job",
    "SELECT trade_id, CAST(round(notional_value, 4) AS DOUBLE) AS notional_value, "
    "CAST((SELECT count(*) FROM read_silver WHERE is_valid AND currency <> 'USD') > 0 AS INTEGER) AS refusals "
    "FROM read_silver WHERE is_valid",
    "read_silver",
)
_oracle(
    "refine_prices_job",
    f"SELECT price_id, price_date, instrument_id, {_money('close_price', digits=4)} FROM silver_prices",
    "silver_prices",
)
_step(
    "stored_metrics",
    "SELECT * REPLACE (CAST(round(var_95, 2) AS DECIMAL(18,2)) AS var_95, "
    "CAST(round(var_99, 2) AS DECIMAL(18,2)) AS var_99) FROM risk_metrics",
    "risk_metrics",
)
for _job in ("publish_risk_metrics_job", "appended_risk_metrics_job"):
    _oracle(
        _job,
        "SELECT book_id, count(*) AS position_count, CAST(sum(var_95) AS DOUBLE) AS total_var_95, "
        "CAST(sum(var_99) AS DOUBLE) AS total_var_99, CAST(sum(market_exposure) AS DOUBLE) AS total_exposure "
        "FROM stored_metrics GROUP BY book_id",
        "stored_metrics",
    )
_step(
    "dated_prices",
    f"SELECT *, {_YEAR_MONTH.format('price_date')} FROM raw_prices",
    "raw_prices",
)
_oracle(
    "appended_partitions",
    "SELECT year, month, count(*) * CASE WHEN year = 1996 THEN 1 ELSE 2 END AS stored_rows "
    "FROM dated_prices GROUP BY year, month",
    "dated_prices",
)
_oracle(
    "replaced_table",
    "SELECT price_id, instrument_id, year, month FROM dated_prices",
    "dated_prices",
)
_DEMO_PRICES = "SELECT instrument, round(close, 2) AS close, date FROM demo_prices"
_oracle("staged_demo_tables", _DEMO_PRICES, "demo_prices")
_oracle("demo_prices_job", _DEMO_PRICES, "demo_prices")
_oracle("demo_positions_job", _DEMO_POSITIONS, "demo_positions")
_oracle("demo_risk_job", _DEMO_RISK, "demo_risk")


def _shown(table: str, source: str, key: str, day: str, text_1: str, text_2: str, number_1: str, number_2: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, {key} AS row_key, CAST({day} AS DATE) AS row_date, CAST({text_1} AS VARCHAR) AS text_1, "
        f"CAST({text_2} AS VARCHAR) AS text_2, CAST(round({number_1}, 2) AS DOUBLE) AS number_1, "
        f"CAST(round({number_2}, 2) AS DOUBLE) AS number_2 FROM {source}"
    )


_oracle(
    "model_tables",
    " UNION ALL ".join(
        [
            _shown("dim_trades", "silver_trades", "trade_id", "trade_date", "trade_type", "status", "quantity", "price"),
            _shown("dim_instruments", "instruments", "instrument_id", "NULL", "asset_class", "sector", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
            _shown("dim_counterparties", "counterparties", "counterparty_id", "NULL", "counterparty_name", "credit_rating",
                   "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"),
            _shown("fct_market_prices", "silver_prices", "price_id", "price_date", "instrument_id", "source", "close_price", "volume"),
            _shown("fct_positions", "current_positions", "position_id", "as_of_date", "book_id", "currency", "quantity", "unrealized_pnl"),
            _shown("fct_risk_metrics", "stored_risk", "metric_id", "as_of_date", "instrument_id", "book_id", "var_95", "market_exposure"),
        ]
    ),
    "silver_trades", "instruments", "counterparties", "silver_prices", "current_positions", "stored_risk",
)
_oracle(
    "demo_lane_job",
    f"SELECT *, (SELECT count(*) FROM demo_trades) AS trades_cnt, (SELECT count(*) FROM demo_prices) AS prices_cnt, "
    "(SELECT count(*) FROM demo_positions) AS positions_cnt, (SELECT count(*) FROM demo_risk) AS risk_cnt "
    f"FROM ({_DEMO_RISK})",
    "demo_trades", "demo_prices", "demo_positions", "demo_risk",
)
_oracle(
    "bronze_sample",
    "SELECT price_id, price_date, instrument_id, CAST(round(close_price, 4) AS DOUBLE) AS close_price "
    "FROM raw_prices ORDER BY md5(price_id), price_id LIMIT 10",
    "raw_prices",
)
_oracle("bronze_sample_size", "SELECT least(10, count(*)) AS sampled_rows FROM lineitem")
