"""Staged and published batches, the gate on the way, and lines that do not parse."""

import pytest
from builders import rows
from pyspark.sql import functions as F
from test_sources_and_jobs import PRICES_CSV, TRADES_CSV, landed

from tidemark.operators import quality
from tidemark.plans import ingest, jobs
from tidemark.schemas import RAW_TRADES
from tidemark.sources import batches, files, tables

OPEN = quality.Gate(min_rows=0)
HEAD = TRADES_CSV.splitlines()[0]
BROKEN = TRADES_CSV + "t7,2024-02-30,2024-02-05,A,c1,SELL,1e,6,USD,,b1,OPEN\nt8,2024-02-03\nt9,2024-02-03,2024-02-05,A,c1,SELL,4,6,USD,,b1,OPEN,more\n"


def test_the_same_files_are_taken_once(spark, tmp_path):
    bronze, source = str(tmp_path / "bronze"), landed(tmp_path, "t", TRADES_CSV)
    first = dict(rows(ingest.ingest_trades(spark, f"{source}/*.csv", bronze, OPEN)))
    assert first["rows"] == 5 and first["unread_lines"] == 2
    again = dict(rows(ingest.ingest_trades(spark, f"{source}/*.csv", bronze, OPEN)))
    assert set(again) == set(first) and set(again.values()) == {0}
    assert batches.read_batches(spark, bronze).count() == 5
    (tmp_path / "t" / "next.csv").write_text(f"{HEAD}\nn1,2025-05-01,2025-05-03,A,c1,BUY,1,1,USD,,b1,OPEN\n")
    assert dict(rows(ingest.ingest_trades(spark, f"{source}/*.csv", bronze, OPEN)))["rows"] == 1
    assert batches.read_batches(spark, bronze).count() == 6
    assert {r.source_file.rsplit("/", 1)[1] for r in batches.ledger(spark, bronze).collect()} == {"part.csv", "next.csv"}


def test_a_job_killed_before_it_publishes_shows_nothing(spark, tmp_path, monkeypatch):
    bronze, source = str(tmp_path / "bronze"), landed(tmp_path, "t", TRADES_CSV)
    ingest.ingest_trades(spark, source, bronze, OPEN)
    before = rows(batches.read_batches(spark, bronze))
    (tmp_path / "t" / "next.csv").write_text(f"{HEAD}\nn1,2025-05-01,2025-05-03,A,c1,BUY,1,1,USD,,b1,OPEN\n")

    def killed(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(batches, "publish", killed)
        with pytest.raises(KeyboardInterrupt):
            ingest.ingest_trades(spark, source, bronze, OPEN)
    assert len(list((tmp_path / "bronze" / "data").iterdir())) == 2  # written, but not published
    assert rows(batches.read_batches(spark, bronze)) == before
    assert dict(rows(ingest.ingest_trades(spark, source, bronze, OPEN)))["rows"] == 1
    assert batches.read_batches(spark, bronze).count() == 6


def test_lines_that_do_not_parse(spark, tmp_path):
    bronze, source = str(tmp_path / "bronze"), landed(tmp_path, "t", BROKEN)
    counts = dict(rows(ingest.ingest_trades(spark, source, bronze, OPEN)))
    good, bad = ingest.bronze_rows(spark, bronze), ingest.quarantined_rows(spark, bronze)
    assert rows(good, "trade_id") == [("t1",), ("t1",), (None,)]
    assert rows(bad, "trade_id", "reason") == [
        ("t2", "not readable: price"), ("t4", "not readable: trade_date"), ("t7", "not readable: trade_date, quantity"),
        ("t8", "wrong number of fields"), ("t9", "wrong number of fields")]
    assert {r.raw_line for r in bad.collect()} <= set(BROKEN.splitlines())
    assert bad.filter("source_file like 'file:%part.csv'").count() == 5
    lines = spark.read.text(source).count() - 1
    assert good.count() + bad.count() == lines == counts["rows"] and counts["unread_lines"] == 5
    assert set(good.columns) == {*RAW_TRADES.names, "ingestion_timestamp", "source_file", "year", "month"}


def test_a_closed_gate_leaves_the_target_as_it_was(spark, tmp_path):
    bronze, target = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest.ingest_trades(spark, landed(tmp_path, "t", TRADES_CSV), bronze, OPEN)
    summary = rows(ingest.refine_trades(spark, bronze, target, OPEN))
    before = rows(ingest.silver_rows(spark, target))
    rules = tuple(r for r in quality.RULES["trades"] if not isinstance(r, quality.Unique))
    for gate, reason in (
        (quality.Gate(min_rows=100), "2 rows, at least 100 wanted"),
        (quality.Gate(critical=("trade_id", "status"), max_null_ratio=0.2, min_rows=0), "1 of 4 critical cells are NULL"),
        (quality.Gate(min_rows=0, rules=rules), "1 rows fail trades_no_null_id"),
    ):
        with pytest.raises(batches.Refused, match=reason):
            ingest.refine_trades(spark, bronze, target, gate)
        assert rows(ingest.silver_rows(spark, target)) == before
    ingest.ingest_trades(spark, landed(tmp_path, "more", HEAD + "\nm1,2024-03-01,2024-03-03,A,c1,BUY,1,1,USD,,b1,OPEN\n"), bronze, OPEN)
    assert len(rows(ingest.refine_trades(spark, bronze, target, quality.Gate(critical=("trade_date",), min_rows=3)))) == len(summary)
    assert ingest.silver_rows(spark, target).count() == 3  # replaced, not added to
    with pytest.raises(batches.Refused):
        ingest.ingest_trades(spark, landed(tmp_path, "bad", HEAD + "\n,,,,c1,BUY,1,1,USD,,b1,OPEN\n"), bronze)
    assert dict(rows(ingest.ingest_trades(spark, str(tmp_path / "bad"), bronze, OPEN)))["rows"] == 1  # refused files stay new


def test_one_pass_writes_and_counts(spark, tmp_path):
    source = landed(tmp_path, "t", TRADES_CSV)
    scan = files.read_checked_csv(spark, source, RAW_TRADES)
    counters = quality.Gate(critical=("trade_id", "trade_date")).counters()
    df = scan.withColumns({"year": F.year("trade_date"), "month": F.month("trade_date")})
    written, _ = batches.counted(df, ("year", "month"), counters)
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1 and plan.index("CollectMetrics") < plan.index("Exchange")
    spark.sparkContext.setJobGroup("one-pass", "one pass")
    try:
        staged = batches.stage(df, str(tmp_path / "table"), ("year", "month"), counters)
        jobs_run = spark.sparkContext.statusTracker().getJobIdsForGroup("one-pass")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert staged.counts == {"rows": 5, "null_trade_id": 1, "null_trade_date": 1}
    assert len(jobs_run) <= 2  # the shuffle for the partitions, and the write
    with pytest.raises(ValueError):
        batches.read_batches(spark, str(tmp_path / "table"))


def test_price_batches_and_empty_files(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    counts = dict(rows(ingest.ingest_prices(spark, landed(tmp_path, "p", PRICES_CSV), bronze)))
    assert counts["negative_close"] == 1 and counts["high_below_low"] == 1 and counts["null_close_price"] == 0
    empty = landed(tmp_path, "empty", PRICES_CSV.splitlines()[0] + "\n")
    with pytest.raises(batches.Refused):
        ingest.ingest_prices(spark, empty, bronze)
    ingest.ingest_prices(spark, empty, bronze, OPEN)
    assert ingest.bronze_rows(spark, bronze).count() == 4


def test_uniqueness_is_no_row_rule():
    with pytest.raises(ValueError):
        quality.Gate(rules=quality.RULES["trades"]).counters()


def test_plain_ingest_reads_its_files_once(spark, tmp_path):
    """One outlying date opens its own month, not those in between."""
    far = TRADES_CSV + "t5,2019-01-01,2024-02-05,B,c1,SELL,4,6,USD,,b1,OPEN\n"
    checks = jobs.ingest_trades(spark, landed(tmp_path, "t", far), str(tmp_path / "bronze"))
    assert dict(rows(checks))["rows"] == 6
    plan = checks._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert str(12 * 2019 + 1) in filters and "IN (" in filters.upper()
    assert tables.read_table(spark, str(tmp_path / "bronze")).count() == 6
