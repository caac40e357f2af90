"""Time the headline queries and the stored-table jobs; prints one JSON line.

Each query is written to Spark's noop sink, so all its columns are computed and
nothing comes back to the driver. The value is the sum of the medians of three
runs after one run to warm up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from datetime import datetime, timedelta  # noqa: E402

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import daily, sync  # noqa: E402
from tidemark.plans.collections import Sources  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload.standins import Tables  # noqa: E402

HEADLINE = (
    "append_incremental",
    "append_five_products",
    "refresh_full",
    "missing_keys",
    "repair_missing",
    "event_fact_requested",
    "event_fact_authorized",
    "event_fact_paid",
    "pending_table_wm",
    "pending_row_wm",
    "upsert",
    "upsert_stamp_changed",
    "upsert_counts",
    "collections_month",
    "collections_late_changes",
    "collections_load",
    "rebuild_months",
    "cleanup_monthly",
    "delete_reverted",
    "delete_orphans",
    "gold_clients",
    "gold_client_detail",
    "gold_phones",
    "active_clients",
    "expire_contracts",
    "update_column",
    "recon_requested",
    "recon_authorized",
    "recon_paid",
    "recon_amount",
    "corp_year_report",
    "orphan_audit",
    "audit_catalogue",
    "audit_pending",
    "latest_change",
    "null_profile",
    "runlog_summary",
    "load_metrics",
    "recon_requested_rows",
    "recon_authorized_rows",
    "recon_amount_rows",
    "missing_keys_by_runs",
    "totals_month_amount",
    "first_last_requests",
    "rate_on_date",
)
RUNS = 3
AT = datetime(2001, 7, 20, 5, 30)


def timed(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def jobs(spark: SparkSession, folder: str) -> dict[str, Callable[[], object]]:
    """Jobs that write parquet.

    ``write_*`` are first loads, each run into a table of its own. ``again_*`` load one table
    once, when they warm up, and then what has changed: 1 % of the source between runs, which for
    requests is scattered over all months or (``recent``) all in the last ones.
    """
    t = Tables(spark, folder)
    s = Sources(t.cardcollec, t.tickets, t.ticket_items, t.clients, t.developers)
    base = tempfile.mkdtemp(prefix="bench-")
    n = iter(range(10_000))

    def new() -> str:
        return f"{base}/t{next(n)}"

    steps = {name: iter(range(10_000)) for name in ("requests", "recent", "collections", "clients")}
    kept = {name: new() for name in steps}

    def some(key: str, step: int):
        """The rows that are another 1 % in each step; none in the first one."""
        return (F.col(key) % 100 == step) & F.lit(step > 0)

    last = t.redeems.agg(F.max("fcorreo")).first()[0]

    def requests(name: str = "requests") -> None:
        k = next(steps[name])
        hit = some("indice", k)
        if name == "recent":  # about 1 % of all days
            hit = (F.col("fcorreo") > F.lit(last - timedelta(days=24))) & F.lit(k > 0)
        moved = t.redeems.withColumns(
            {
                "monto": F.when(hit, F.col("monto") + k).otherwise(F.col("monto")).cast("decimal(11,2)"),
                "updateat": F.when(hit, F.lit(AT + timedelta(days=k))).otherwise(F.col("updateat")).cast("timestamp_ntz"),
            }
        )
        daily.sync_requested(kept[name], moved, t.clients, t.developers, AT)

    def collections() -> None:
        hit = some("indice", k := next(steps["collections"]))
        monto = F.when(hit, F.col("monto") + k).otherwise(F.col("monto")).cast("decimal(18,6)")
        moved = s._replace(cardcollec=t.cardcollec.withColumn("monto", monto))
        if k == 0:
            daily.load_collections(kept["collections"], moved, t.colleclog, AT, 199501, 200112)
        else:
            daily.load_collections(kept["collections"], moved, t.colleclog, AT, 200005)

    top = t.client_view.agg(F.max("clientid")).first()[0]

    def clients() -> None:
        share = 0.9 + 0.01 * next(steps["clients"])
        sync.append_load(t.client_view.where(F.col("clientid") <= int(top * share)), kept["clients"], "clientid", AT)

    return {
        "again_requested_sync": requests,
        "again_requested_recent": lambda: requests("recent"),
        "again_collections_month": collections,
        "again_client_append": clients,
        "write_phone_refresh": lambda: sync.refresh_table(t.phones, new(), AT),
        "write_client_append": lambda: sync.append_load(t.client_view, new(), "clientid", AT, 1),
        "write_requested_sync": lambda: daily.sync_requested(
            new(), t.redeems, t.clients, t.developers, AT
        ),
        "write_collections_month": lambda: daily.load_collections(new(), s, t.colleclog, AT, 200005),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    runs: dict[str, Callable[[], object]] = {
        name: lambda name=name: QUERIES[name](spark, folder)
        .write.format("noop")
        .mode("overwrite")
        .save()
        for name in (sys.argv[1:] or HEADLINE)
    }
    if not sys.argv[1:]:
        runs |= jobs(spark, folder)
    seconds = {}
    for name, run in runs.items():
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    result = {
        "metric": "warehouse sync and reconciliation, sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
