"""Scale check: the driver tables replicated xN, then the main keys timed.

Env: SCALE_FROM (default /root/testdata/sf0.1), SCALE_COPIES (default 50),
SCALE_KEYS (comma list), BENCH_CPUS (default 8).  Copies get shifted order
and customer keys (so athletes multiply too); the feed rules then derive
events, dates and countries from the new keys as usual.  The replicated
tables are written once under the shared checkpoint folder.  Prints ONE
JSON line with the row counts and per-key seconds (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from paceline.plans.queries import all_queries  # noqa: E402
from paceline.session import build_session, fresh_dir  # noqa: E402

DEFAULT_KEYS = ("results_clean,dim_athlete,dim_event,dim_date,distance_races,country_representation,"
                "events_per_year,gender_distribution,unique_counts,null_profile,gender_by_event,"
                "stream_results_clean")


def replicate(spark, src: str, copies: int, out: str) -> dict:
    orders = spark.read.parquet(f"{src}/orders.parquet")
    customer = spark.read.parquet(f"{src}/customer.parquet")
    ko = orders.agg(F.max("o_orderkey")).first()[0] + 1
    kc = customer.agg(F.max("c_custkey")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
    big_orders = (orders.select("*", copy)
                  .withColumn("o_orderkey", F.col("o_orderkey") + F.col("_copy") * ko)
                  .withColumn("o_custkey", F.col("o_custkey") + F.col("_copy") * kc)
                  .drop("_copy"))
    big_customer = (customer.select("*", copy)
                    .withColumn("c_custkey", F.col("c_custkey") + F.col("_copy") * kc)
                    .drop("_copy"))
    cores = spark.sparkContext.defaultParallelism
    big_orders.repartition(cores).write.parquet(f"{out}/orders.parquet")
    big_customer.repartition(cores).write.parquet(f"{out}/customer.parquet")
    spark.read.parquet(f"{src}/nation.parquet").write.parquet(f"{out}/nation.parquet")
    return {"orders": spark.read.parquet(f"{out}/orders.parquet").count(),
            "customer": spark.read.parquet(f"{out}/customer.parquet").count()}


def main() -> None:
    src = os.environ.get("SCALE_FROM", "/root/testdata/sf0.1")
    copies = int(os.environ.get("SCALE_COPIES", "50"))
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = os.environ.get("SCALE_KEYS", DEFAULT_KEYS).split(",")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=4 * cpus,
                          extra={"spark.driver.memory": "20g"})
    out = fresh_dir(spark, f"scaled-x{copies}")
    t0 = time.perf_counter()
    rows = replicate(spark, src, copies, out)
    build_sec = round(time.perf_counter() - t0, 2)
    queries = all_queries()
    timings = {}
    for key in keys:
        t = time.perf_counter()
        queries[key](spark, out).write.format("noop").mode("overwrite").save()
        timings[key] = round(time.perf_counter() - t, 2)
    print(json.dumps({"metric": "scaled_query_seconds", "copies": copies, "from": src,
                      "rows": rows, "replicate_sec": build_sec, "queries": timings,
                      "value": round(sum(timings.values()), 2), "unit": "sec", "cpus": cpus}))


if __name__ == "__main__":
    main()
