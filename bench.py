"""Headline queries, timed. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from coinfold.plans.library import CATALOG  # noqa: E402
from coinfold.session import build_session  # noqa: E402

HEADLINES = (
    "explicit_output_by_day",
    "transaction_rows",
    "input_rows",
    "output_rows",
    "transaction_items",
    "filter_logic_on_missing",
    "filter_order",
    "enriched_inputs",
    "enriched_items",
    "spent_outputs",
    "kept_blocks",
    "tables_without_losers",
    "interior_gaps",
    "merged_ranges",
    "block_ranges_by_day",
    "source_field_audit",
    "field_check_score",
    "outputs_updated_by_key",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINES
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in wanted:
        began = time.perf_counter()
        result = CATALOG[name].build(spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    line = {
        "metric": "headline queries, total wall clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
