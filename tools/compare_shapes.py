"""Time one silver load in two shapes on the same rows.

"separate" counts before and after each cleaning step and runs two counting jobs per
check, recomputing the rows each time, then writes. "shared" is ``load_orders``.

usage: python tools/compare_shapes.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import make_session  # noqa: E402
from oreflow.operators.cleaning import (  # noqa: E402
    AddAuditColumns,
    CastColumns,
    ComputeDerivedColumns,
    DropDuplicates,
    DropNullKeys,
    TrimStrings,
)
from oreflow.plans.flows import VALID_STATUSES, load_orders  # noqa: E402
from oreflow.sources.paths import scratch_path  # noqa: E402
from workload.inputs import raw_orders  # noqa: E402


def separate(raw, path):
    raw.count()
    df = TrimStrings()(raw)
    for step in (DropDuplicates(["order_id"]), DropNullKeys(["order_id", "customer_id"])):
        df.count()
        df = step(df)
        df.count()
    df = CastColumns({"quantity": "integer", "unit_price": "decimal(18,4)"})(df)
    df = ComputeDerivedColumns(
        {
            "total_amount": "round(cast(quantity as decimal(18,4)) * unit_price, 2)",
            "status": "upper(coalesce(status, 'UNKNOWN'))",
        }
    )(df)
    df = AddAuditColumns("orders_etl")(df)
    df.count()
    df.count()
    for failing in (
        df.filter("order_id is null"),
        df.filter("customer_id is null"),
        df.select("order_id").distinct(),
        df.filter("unit_price < 0"),
        df.filter(~df.status.isin(VALID_STATUSES)),
    ):
        df.count()
        failing.count()
    df.write.parquet(path)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = make_session("8")
    source = scratch_path(spark, "raw")
    raw_orders(spark, sf_dir).repartition(8).write.parquet(source)
    raw = spark.read.parquet(source)
    for name, run in (("separate", separate), ("shared", load_orders)):
        times = []
        for _ in range(4):
            start = time.monotonic()
            run(raw, scratch_path(spark, name))
            times.append(round(time.monotonic() - start, 2))
        print(f"{name:9} first {times[0]}, then {times[1:]} s for {raw.count()} rows")
    spark.stop()


if __name__ == "__main__":
    main()
