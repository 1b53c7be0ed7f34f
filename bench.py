"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of local threads, ``BENCH_RUNS`` the timed runs per
query, of which the best counts. A query is run to its last row without collecting it. Broadcast joins are off, so
that the small tables are joined as large ones are.
"""

from __future__ import annotations

import json
import os
import time

from ledgerlake import queries, session
from ledgerlake.plans import gold
from ledgerlake.queries import QUERIES

HEADLINE = (
    "back_data", "back_data_fullouter", "back_data_known_accounts", "front_data",
    "dim_erc_ranking", "erc_ranking_known_accounts", "dim_back_account", "market_turnover_daily", "latest_version",
    "cdc_parse", "cdc_latest", "cdc_apply_changes", "market_turnover_stream", "bronze_to_silver", "upsert_by_key",
    "refresh_touched_days", "cdc_apply_deltas", "dim_back_account_incremental", "back_data_indexed",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session.build("bench", {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds("dim_back_account")
    timed = {name: round(min(seconds(name) for _ in range(runs)), 3) for name in HEADLINE}
    facts = queries._keyed_facts(spark, folder, session.new_folder(spark, "facts"))

    def stored_seconds() -> float:
        start = time.perf_counter()
        gold.back_data(*(table.read(spark) for table in facts.values())).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed["back_data_stored"] = round(min(stored_seconds() for _ in range(runs)), 3)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
