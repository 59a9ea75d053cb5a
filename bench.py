"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query's whole
result is computed and discarded; the better of two runs counts, since the first one pays for
starting up code generation and Python workers.
"""

from __future__ import annotations

import json
import os
import time

from tidelog.plans.catalog import REGISTRY
from tidelog.plans.fixtures import Fixtures
from tidelog.session import build_session

HEADLINE = (
    "json_table_view apply_oplog checkpoint_cut partial_checkpoint bucket_checksum compact_oplog checkpoint_history "
    "capture_changes apply_crud optimistic_view crud_transactions take_until_size upload_outcome stalled_queue "
    "download_progress progress_timeline status_for_priority subscription_fold subscription_expiry bucket_scope "
    "reconcile_attachments sync_outcome left_join_group left_join_lookup atomic_batch on_change throttle changed_only "
    "oplog_explode state_sink"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for _ in range(2):
        for name in HEADLINE:
            start = time.perf_counter()
            REGISTRY[name].build(Fixtures(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            took = round(time.perf_counter() - start, 3)
            seconds[name] = min(took, seconds.get(name, took))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
