"""Rows and bytes of state after compaction, per variant; prints one JSON line.

The whole-document variant keeps the input tables and the documents; the partial
variant keeps the inputs and field-stamped documents; with ``refresh="none"`` the
facts pass through and only the dimensions and documents are kept.
"""

from __future__ import annotations

import json
import os
import time

from starweave.session import build_session, scratch_dir
from starweave.sources import files, streams
from starweave.sources import tables as t
from starweave.streaming.maintain import Maintainer
from starweave.streaming.sinks import MergeSink, ReplaceSink


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("state", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    inputs = {
        "orders": t.order_log(spark, sf_dir).select("order_id", "product_id", "customer_id", "ts", "version"),
        "customers": t.customer_log(spark, sf_dir).select("customer_id", "name", "segment", "version"),
        "products": t.product_log(spark, sf_dir).drop("ts", "op"),
    }
    schemas = {n: r.schema for n, r in inputs.items()}
    report = {}
    for variant, mode, refresh in (("full", "full", "all"), ("partial", "partial", "all"), ("stream", "full", "none")):
        root = scratch_dir(spark, f"state-{variant}")
        keep = Maintainer(spark, t.STAR, root, schemas, mode=mode, refresh=refresh, buckets=4)
        start = time.perf_counter()
        keep(streams.tagged(inputs), 0)
        seconds = time.perf_counter() - start
        keep.compact(0)
        fields = ["ts", "customer", "product"]
        sink = (
            MergeSink(spark, f"{root}/docs", "order_id", fields, ["version"], keep.output.schema)
            if mode == "partial"
            else ReplaceSink(spark, f"{root}/docs", "order_id", keep.output.schema)
        )
        sink(keep.output.read(), 0)
        sink.compact(0)
        tables = {
            n: (log.read().count(), files.size(spark, f"{log.path}/base"))
            for n, log in keep.inputs.items()
            if not (refresh == "none" and n == "orders")
        }
        tables["documents"] = (sink.documents().count(), files.size(spark, f"{sink.docs.path}/base"))
        report[variant] = {
            "batch_seconds": round(seconds, 2),
            "rows": {n: r for n, (r, _) in tables.items()},
            "bytes": {n: b for n, (_, b) in tables.items()},
        }
    print(json.dumps({"metric": "state_after_compaction", "sf": os.path.basename(sf_dir), "variants": report}))
    spark.stop()


if __name__ == "__main__":
    main()
