"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
cores, BENCH_QUERIES (comma-separated) a selection. Each query runs to a sink
that discards the rows; one small run of another query warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from walkvec.plans import audience, catalog, inputs  # noqa: E402


def walks_10x10(spark, d):
    cfg = replace(inputs.CONFIG, walks_per_node=10, walk_steps=10)
    return audience.build_walks(catalog._transitions(spark, d), cfg)


def member_vectors(spark, d):
    """Two walks per node and 32 components, as measured since the first build."""
    cfg = replace(inputs.CONFIG, walks_per_node=2, vector_size=32)
    return audience.member_vectors(catalog._origin(spark, d), cfg)


NAMES = (
    "selected_records",
    "node_index",
    "user_graph",
    "weighted_degree",
    "transitions",
    "skipgram_pairs",
    "side_encode",
    "attention_embed",
    "similar_topk",
    "similar_lsh",
    "similar_ann",
    "similar_minhash",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: catalog.queries()[n] for n in NAMES}
    queries |= {"member_vectors": member_vectors, "walks_weighted_10x10": walks_10x10}
    chosen = os.environ.get("BENCH_QUERIES")
    if chosen:
        queries = {n: queries[n] for n in chosen.split(",")}
    catalog.queries()["clean_interactions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in queries.items():
        start = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
