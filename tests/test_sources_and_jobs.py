from datetime import date, datetime, timezone
from decimal import Decimal as D
from pathlib import Path
from types import SimpleNamespace

import pytest
from builders import closes, day, rows
from pyspark.sql import functions as F

from tidemark.operators import demo, quality
from tidemark.plans import jobs, queries
from tidemark.schemas import DEMO_PRICES, FCT_POSITIONS, MODEL, conform
from tidemark.sources import files, tables
from tidemark.sources.scratch import scratch_folder

TRADES_CSV = """trade_id,trade_date,settlement_date,instrument_id,counterparty_id,trade_type,quantity,price,currency,trader_id,book_id,status
t1,2024-01-30,2024-02-01,A,c1, buy ,10,5.5, usd,,b1,
t1,2024-01-30,2024-02-01,A,c1,BUY,10,5.5,USD,,b1,OPEN
t2,2024-02-02,2024-02-05,A,c1,SELL,4,oops,USD,,b1,OPEN
,2024-02-03,2024-02-05,,c1,SELL,4,6,USD,,b1,OPEN
t4,not-a-date,2024-02-05,B,c1,SELL,4,6,USD,,b1,OPEN
"""
PRICES_CSV = """price_id,price_date,instrument_id,open_price,high_price,low_price,close_price,volume,bid_price,ask_price,source
p1,2024-01-30,A,1,2,1,1.5,10,1,2,X
p2,2024-01-31,A,1,1,2,1.5,10,1,2,X
p3,2024-01-31,A,1,2,1,-1.5,10,1,2,X
p4,2024-02-01,A,1,,1,2.5,10,1,2,X
"""
# Demo rows and their results are fixed values.
DEMO_TRADES_CSV = """instrument,qty,price,trade_date
EURUSD,100000,1.08,2025-10-01
EURUSD,-25000,1.09,2025-10-02
AAPL,50,180.0,2025-10-01
AAPL,25,182.0,2025-10-03
"""
DEMO_PRICES_CSV = """instrument,close,date
EURUSD,1.10,2025-10-05
AAPL,185.2,2025-10-05
"""


def landed(tmp_path, name, text):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_fixed_schema_scan_turns_bad_values_into_null(spark, tmp_path):
    df = files.read_raw_trades(spark, landed(tmp_path, "t", TRADES_CSV) + "/*.csv")
    assert rows(df, "trade_id", "trade_date", "price") == [
        ("t1", date(2024, 1, 30), D("5.5")), ("t1", date(2024, 1, 30), D("5.5")), ("t2", date(2024, 2, 2), None),
        ("t4", None, D(6)), (None, date(2024, 2, 3), D(6))]


def test_demo_scans(spark, tmp_path):
    bad = DEMO_TRADES_CSV + "X,abc,1,2025-13-01\n"
    df = files.read_demo_trades(spark, landed(tmp_path, "t", bad))
    assert df.dtypes == [("instrument", "string"), ("qty", "double"), ("price", "double"), ("trade_date", "date")]
    assert rows(df.filter("instrument = 'X'")) == [("X", None, 1.0, None)]
    source = landed(tmp_path, "p", DEMO_PRICES_CSV)
    inferred, given = files.read_demo_prices(spark, source), files.read_demo_prices(spark, source, DEMO_PRICES)
    assert inferred.dtypes == given.dtypes and rows(inferred) == rows(given)


def test_bronze_batches(spark, tmp_path):
    source, bronze = landed(tmp_path, "t", TRADES_CSV), str(tmp_path / "bronze")
    jobs.ingest_trades(spark, source + "/*.csv", bronze, ingested_at=datetime(2024, 3, 1, tzinfo=timezone.utc))
    warnings = dict(rows(jobs.ingest_trades(spark, source + "/*.csv", bronze)))
    assert warnings == {
        "rows": 5, "duplicate_trade_id": 1, "null_trade_id": 1, "null_trade_date": 1, "null_instrument_id": 1}
    stored = tables.read_table(spark, bronze)
    assert stored.count() == 10
    assert rows(stored.select("year", "month").distinct()) == [(2024, 1), (2024, 2), (None, None)]
    assert stored.filter("source_file not like 'file:%part.csv'").count() == 0
    later = TRADES_CSV.splitlines()[0] + "\nt9,2025-05-01,2025-05-03,A,c1,BUY,1,1,USD,,b1,OPEN\n"
    third = jobs.ingest_trades(spark, landed(tmp_path, "later", later), bronze)
    assert dict(rows(third))["rows"] == 1
    plan = third._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    dateless = TRADES_CSV.splitlines()[0] + "\nt9,soon,2025-05-03,A,c1,BUY,1,1,USD,,b1,OPEN\n"
    assert dict(rows(jobs.ingest_trades(spark, landed(tmp_path, "dateless", dateless), bronze)))["null_trade_date"] == 1

    silver = str(tmp_path / "silver")
    summary = jobs.refine_trades(spark, bronze, silver)
    # A missing trade_id is a key like any other: one of its copies stays, valid as it is.
    assert rows(summary) == [("BUY", "USD", "OPEN", 1, D(55), D("5.5")), ("SELL", "USD", "OPEN", 1, D(24), D(6))]
    assert "silver_processed_at" in tables.read_table(spark, silver).columns


def test_price_jobs(spark, tmp_path):
    source, bronze = landed(tmp_path, "p", PRICES_CSV), str(tmp_path / "bronze")
    assert dict(rows(jobs.ingest_prices(spark, source, bronze))) == {
        "rows": 4, "negative_close": 1, "high_below_low": 1}
    refined = jobs.refine_prices(spark, bronze, str(tmp_path / "silver"))
    assert rows(refined, "price_id") == [("p1",), ("p4",)]


def test_gold_appends_or_replaces_its_snapshot(spark, tmp_path):
    prices, held, gold = (str(tmp_path / n) for n in ("prices", "held", "gold"))
    tables.overwrite(closes(spark, [("A", day(d), 100.0 + (d % 7)) for d in range(60)]), prices)
    snapshot = spark.createDataFrame(
        [("p1", day(1), "A", "b1", D(10)), ("p2", day(59), "A", "b1", D(20)), ("p3", day(59), "Z", "b2", D(30))],
        "position_id string, as_of_date date, instrument_id string, book_id string, market_value decimal(18,2)")
    tables.append_partitioned(snapshot, held, ["as_of_date"])
    first = rows(jobs.publish_risk_metrics(spark, prices, held, gold))
    assert [(r[0], r[1], r[4]) for r in first] == [("b1", 1, D(20)), ("b2", 1, D(30))]
    jobs.publish_risk_metrics(spark, prices, held, gold, as_of=day(1))
    assert rows(jobs.publish_risk_metrics(spark, prices, held, gold, rerunnable=True)) == first
    stored = tables.read_table(spark, gold)
    assert dict(stored.dtypes)["var_95"] == "decimal(18,2)"
    assert rows(stored, "metric_id") == [("p1_var",), ("p2_var",), ("p3_var",)]
    # An appended rerun sums up its own rows; a run older than gold returns its own snapshot.
    assert rows(jobs.publish_risk_metrics(spark, prices, held, gold)) == first
    assert tables.read_table(spark, gold).count() == 5
    older = str(tmp_path / "older")
    tables.append_partitioned(snapshot.filter("position_id = 'p1'"), older, ["as_of_date"])
    assert [r[4] for r in rows(jobs.publish_risk_metrics(spark, prices, older, gold))] == [D(10)]
    nothing = str(tmp_path / "nothing")
    tables.overwrite(snapshot.filter("false"), nothing)
    assert rows(jobs.publish_risk_metrics(spark, prices, nothing, gold, complete=False)) == []


def test_gold_with_cvar_and_pnl(spark, tmp_path):
    prices, held, gold = (str(tmp_path / n) for n in ("prices", "held", "gold"))
    tables.overwrite(closes(spark, [("A", day(d), 100.0 + (d % 7)) for d in range(60)]), prices)
    snapshot = spark.createDataFrame(
        [("p1", day(58), "A", "b1", D(10), D(4)), ("p1", day(59), "A", "b1", D(20), D(9))],
        "position_id string, as_of_date date, instrument_id string, book_id string, market_value decimal(18,2), "
        "unrealized_pnl decimal(18,2)")
    tables.append_partitioned(snapshot, held, ["as_of_date"])
    jobs.publish_risk_metrics(spark, prices, held, gold, complete=True)
    jobs.publish_risk_metrics(spark, prices, held, gold, complete=True, as_of=day(58))
    stored = tables.read_table(spark, gold)
    assert rows(stored, "as_of_date", "daily_pnl", "ytd_pnl", "market_exposure") == [
        (day(58), D(4), D(4), D(10)), (day(59), D(5), D(9), D(20))]
    assert stored.filter("cvar_95 is null or cvar_95 < var_95").count() == 0


def test_newest_snapshot_prunes_partitions(spark, tmp_path):
    from tidemark.operators.var import latest_snapshot

    path = str(tmp_path / "held")
    tables.append_partitioned(
        spark.range(4).selectExpr("id", f"date_add(date'{day(0)}', cast(id as int)) as as_of_date"), path, ["as_of_date"])
    plan = latest_snapshot(tables.read_table(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "as_of_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_partitioned_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2), (3, 2024, 1)], "id int, year int, month int")
    tables.append_partitioned(first, path, ["year", "month"])
    tables.append_partitioned(first, path, ["year", "month"])
    assert tables.read_table(spark, path).count() == 6
    tables.replace_touched_partitions(first.filter("year = 2023"), path, ["year", "month"])
    assert rows(tables.read_table(spark, path), "id") == [(1,), (2,), (3,), (3,)]
    tables.replace_partitioned(first.filter("id = 1").selectExpr("'x' as name", "year", "month"), path, ["year", "month"])
    assert rows(tables.read_table(spark, path)) == [("x", 2023, 1)]


def test_model_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS model_test")
    for _ in range(2):
        tables.create_model_tables(spark, "model_test", path=str(tmp_path / "model"))
    for name, (schema, partition, _) in MODEL.items():
        columns = {c.name: c for c in spark.catalog.listColumns(f"model_test.{name}")}
        assert {n: c.dataType for n, c in columns.items()} == {f.name: f.dataType.simpleString() for f in schema.fields}
        assert [n for n, c in columns.items() if c.isPartition] == ([partition] if partition else [])
    one = spark.createDataFrame(
        [("p", day(0), "A", "b", D(1), "USD")],
        "position_id string, as_of_date date, instrument_id string, book_id string, quantity decimal(18,4), currency string")
    tables.insert_rows(conform(one, FCT_POSITIONS), "model_test.fct_positions")
    assert rows(tables.named_table(spark, "model_test.fct_positions"), "position_id", "as_of_date", "created_at") == [
        ("p", day(0), None)]


def test_demo_lane_golden_result(spark, tmp_path):
    held, prices = str(tmp_path / "positions"), str(tmp_path / "prices")
    jobs.ingest_demo_prices(spark, landed(tmp_path, "p", DEMO_PRICES_CSV), prices)
    found = jobs.build_demo_positions(spark, landed(tmp_path, "t", DEMO_TRADES_CSV), held)
    assert rows(found) == [("AAPL", 75.0, 181.0), ("EURUSD", 75000.0, pytest.approx(1.085))]

    target = str(tmp_path / "risk")
    risk = jobs.publish_demo_risk_metrics(spark, held, prices, "demo_risk", path=target)
    golden = [("AAPL", 75.0, 185.2, pytest.approx(13890)), ("EURUSD", 75000.0, 1.1, pytest.approx(82500))]
    assert rows(risk) == golden
    empty = str(tmp_path / "empty")
    tables.overwrite(tables.read_table(spark, prices).filter("false"), empty)
    kept = jobs.publish_demo_risk_metrics(spark, held, empty, "demo_risk", path=target, keep_existing=True)
    assert rows(kept) == golden
    replaced = jobs.publish_demo_risk_metrics(spark, held, empty, "demo_risk", path=target)
    assert rows(replaced) == []


def test_demo_lane_checks(spark, tmp_path):
    trades = files.stage_csv(spark, landed(tmp_path, "t", DEMO_TRADES_CSV), "stg_trades")
    prices = files.stage_csv(spark, landed(tmp_path, "p", DEMO_PRICES_CSV), "stg_prices")
    held = demo.demo_positions(tables.named_table(spark, "stg_trades"))
    risk = demo.demo_risk_metrics(held, prices)
    counts = quality.row_counts({"trades": trades, "prices": prices, "positions": held, "risk": risk})
    assert tables.fetch_row(counts) == {"trades_cnt": 4, "prices_cnt": 2, "positions_cnt": 2, "risk_cnt": 2}
    assert tables.fetch_row(quality.null_count(trades, "instrument", "null_instrument")) == {"null_instrument": 0}


def test_every_price_date_gives_a_row_but_only_the_newest_in_the_variant(spark):
    held = spark.createDataFrame([("A", 10.0, 1.0), ("B", 5.0, 1.0)], "instrument string, position_qty double, avg_price double")
    quoted = spark.createDataFrame(
        [("A", 2.0, day(0)), ("A", 3.0, day(1)), ("C", 9.0, day(1))], DEMO_PRICES)
    assert rows(demo.demo_risk_metrics(held, quoted)) == [("A", 10.0, 2.0, 20.0), ("A", 10.0, 3.0, 30.0)]
    assert rows(demo.demo_risk_metrics_at_last_price(held, quoted)) == [("A", 10.0, 3.0, 30.0)]


def test_client_side_fetch_refuses_tables(spark):
    with pytest.raises(ValueError):
        tables.fetch_row(spark.range(2))
    with pytest.raises(ValueError):
        tables.fetch_row(spark.range(0))
    assert tables.sample_rows(spark.range(50)).count() == 10


def test_views_are_replaced(spark):
    tables.create_views({"v": spark.range(2)})
    tables.create_views({"v": spark.range(3)})
    assert spark.sql("select * from v").count() == 3


def test_scratch_folders_differ_and_follow_the_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert a != b and (not shared or a.startswith(shared))


def test_rebalanced_write_keeps_files_few(spark, tmp_path):
    path = tmp_path / "t"
    scattered = spark.range(0, 1000, 1, 8).selectExpr("id", "cast(id % 5 as int) as bucket")
    tables.append_partitioned(scattered, str(path), ["bucket"])
    assert len(list(path.glob("bucket=*/*.parquet"))) == 5


def test_positions_from_silver_files(spark, tmp_path):
    """The whole chain on storage: landing files to a position snapshot."""
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    jobs.ingest_trades(spark, landed(tmp_path, "t", TRADES_CSV), bronze)
    jobs.refine_trades(spark, bronze, silver)
    quotes = str(tmp_path / "pb")
    jobs.ingest_prices(spark, landed(tmp_path, "p", PRICES_CSV), quotes)
    jobs.refine_prices(spark, quotes, str(tmp_path / "ps"))
    held = str(tmp_path / "held")
    jobs.publish_positions(spark, silver, str(tmp_path / "ps"), held, date(2024, 2, 9))
    jobs.publish_positions(spark, silver, str(tmp_path / "ps"), held, date(2024, 2, 10))
    df = jobs.publish_positions(spark, silver, str(tmp_path / "ps"), held, date(2024, 2, 10), rerunnable=True)
    assert tables.read_table(spark, held).count() == 4
    assert rows(df, "position_id", "quantity", "cost_basis", "market_value") == [
        ("A|b1|USD", D(10), D(55), D(25)), (r"\N|b1|USD", D(-4), D(-24), None)]
    again = jobs.publish_positions(spark, silver, str(tmp_path / "ps"), held, date(2024, 2, 10))
    assert tables.read_table(spark, held).count() == 6 and again.count() == 2


def test_model_tables_are_filled_from_the_stored_ones(spark, monkeypatch, tmp_path):
    """Trades and prices are cleaned once for all tables that hold or follow from them."""
    from tidemark.plans import queries

    when = "l_shipdate timestamp"
    made = {
        "lineitem": ([(k, k % 5, k % 3, k % 2 + 1, 10.0 + k, 1000.0 + 7 * k, 0.01, 0.02, "AN"[k % 2], "OF"[k % 2],
                       datetime(2024, 1, 1 + k % 9)) for k in range(40)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     f"l_discount double, l_tax double, l_returnflag string, l_linestatus string, {when}"),
        "orders": ([(k, k % 4, "O", "1-URGENT", datetime(2024, 1, 1)) for k in range(40)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "supplier": ([(k, f"s{k}", 0) for k in range(3)], "s_suppkey long, s_name string, s_nationkey int"),
        "customer": ([(k, f"c{k}", 0, "M") for k in range(4)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, (content, schema) in made.items():
        spark.createDataFrame(content, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    cleaned = []
    for name in ("_silver_trades", "_silver_prices"):
        clean = getattr(queries, name)
        monkeypatch.setattr(queries, name, lambda t, name=name, clean=clean: cleaned.append(name) or clean(t))
    t = queries.Tables(spark, str(tmp_path))
    with queries._database(t, "filled") as (database, path):
        filled = queries._filled_model(t, database, path)
        assert sorted(cleaned) == ["_silver_prices", "_silver_trades"]
        held = filled["fct_positions"].drop("created_at")
        assert rows(held) == rows(queries._current_positions(t).select(*held.columns)) != []
        assert filled["fct_risk_metrics"].count() == held.count()


def test_landing_files_and_stored_tables_are_compressed(spark, tmp_path):
    """Landing files were plain text, the largest part of what the file jobs wrote; tables had a lighter codec."""
    df = spark.range(2000).select(F.lit("the same text").alias("a"), "id")
    landed_at = Path(queries._landed_csv(SimpleNamespace(spark=spark), df, "packed-csv").removeprefix("file:"))
    assert [p for p in landed_at.iterdir() if p.name.endswith(".csv.gz")] and not list(landed_at.glob("*.csv"))
    assert sorted(r.id for r in spark.read.csv(str(landed_at), header=True).collect()) == sorted(map(str, range(2000)))
    tables.append_partitioned(df.withColumn("year", F.lit(2024)), str(tmp_path / "t"), ["year"])
    assert all(".zstd." in p.name for p in (tmp_path / "t").glob("year=*/*.parquet"))
