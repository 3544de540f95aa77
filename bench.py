"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_QUERIES comma-separated names (default: the headline queries; "all" for every one)

Each query is planned and run to the end (no rows are collected); the time
is the better of two runs, after one warm-up query for the session.
"""

from __future__ import annotations

import json
import os
import time

from vecindad.registry.queries import QUERIES
from vecindad.session import build_session

HEADLINE = (
    "weekly_cash_flow",
    "monthly_collection_pivot",
    "top_months",
    "monthly_cost_totals",
    "installment_schedule",
    "quota_table_totals",
    "generate_documents",
    "link_costs",
    "financial_position",
    "unit_accounts",
    "unit_accounts_last_payment",
    "unit_statement",
    "paid_within_month",
    "payment_match",
    "payment_detail_fanout",
    "units_import",
    "accounts_update",
    "insert_if_missing",
    "parse_amount",
    "week_of_year",
    "dq_unique",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = tuple(QUERIES) if chosen == "all" else tuple(filter(None, chosen.split(","))) or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_custkey").count().write.format(
        "noop"
    ).mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
