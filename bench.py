"""Time the headline queries and print one JSON line.

Each query is executed in full into a sink that discards the rows; the reported time is the
better of two runs, after one run of a small query has started the engine.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import local_session

HEADLINES = (
    "instrument_var",
    "daily_returns",
    "silver_trades",
    "silver_prices",
    "position_snapshots",
    "position_pnl",
    "position_var",
    "book_var_summary",
    "portfolio_summary",
    "counterparty_risk",
    "counterparty_exposure",
    "bronze_validation",
    "demo_risk_metrics",
)
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("null_instruments")
    seconds = {name: round(min(run(name) for _ in range(RUNS)), 3) for name in HEADLINES}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
