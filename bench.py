"""Times the headline queries and prints one JSON line.

Besides the registered queries it times k-means in each of its ways on ``BENCH_VECTORS`` vectors
(200,000) made from the embeddings by small shifts, with the default passes.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from nestmeans.catalog.queries import QUERIES  # noqa: E402
from nestmeans.operators import kmeans  # noqa: E402
from nestmeans.options import HierarchyOptions, KMeansOptions  # noqa: E402
from nestmeans.plans.hierarchy import hierarchical_cluster  # noqa: E402
from nestmeans.scratch import materialize  # noqa: E402
from nestmeans.shipping import ship  # noqa: E402

HEADLINE = [
    "lines_parse", "lines_parse_report", "dedup_per_source", "dedup_global", "dedup_report",
    "fingerprint_qgram", "fingerprint_documents", "fingerprint_lines", "fingerprint_union",
    "assign", "assign_streamed", "representatives", "kmeans_fit", "kmeans_fit_broadcast",
    "kmeans_fit_streamed", "kmeans_objective",
    "stage1", "stage2_details", "stage2_details_streamed", "stage2_centers", "document_representatives",
    "export_csv", "write_preprocessed", "split_parts", "profile",
]
STREAMED = {"local_bytes": 0, "broadcast_bytes": 0}


def many_vectors(spark: SparkSession, folder: str, wanted: int):
    """The embeddings again and again, shifted a little each time."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    copies = -(-wanted // rows.count())
    every = rows.crossJoin(spark.range(copies)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    shift = F.transform("embedding", lambda x, i: x + F.sin(F.col("id") * 7 + i) * 0.05)
    return materialize(every.select((F.col("id") * 10_000_000 + F.col("vec_id")).alias("row_id"), shift.alias("fp")), "bench")


def scale_runs(spark: SparkSession, folder: str):
    """(name, rows, job) of the runs on many vectors."""
    rows = many_vectors(spark, folder, int(os.environ.get("BENCH_VECTORS", "200000")))
    n = rows.count()
    model = kmeans.kmeans_fit(rows.limit(20_000), 100, options=KMeansOptions(max_iter=2)).persist()
    model.count()
    done = lambda df: df.write.format("noop").mode("overwrite").save()
    yield "scale_assign_100", n, lambda: done(kmeans.kmeans_assign(rows, model, options=KMeansOptions(scale=10_000)))
    yield "scale_assign_100_streamed", n, lambda: done(
        kmeans.kmeans_assign(rows, model, options=KMeansOptions(scale=10_000, **STREAMED)))
    yield "scale_fit_100", n, lambda: done(kmeans.kmeans_fit(rows, 100))
    yield "scale_fit_100_broadcast", n, lambda: done(kmeans.kmeans_fit(rows, 100, options=KMeansOptions(local_bytes=0)))
    yield "scale_fit_100_streamed_2_passes", n, lambda: done(
        kmeans.kmeans_fit(rows, 100, options=KMeansOptions(max_iter=2, **STREAMED)))
    o = HierarchyOptions(100, "ratio", 8.0, 2, KMeansOptions(max_iter=10), KMeansOptions(max_iter=10))
    yield "scale_two_stages", n, lambda: done(hierarchical_cluster(rows, o).centers)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    names = sys.argv[1:] or HEADLINE
    QUERIES["lines_parse"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds, per_million = {}, {}

    def timed(name, job, rows=None):
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
        if rows:
            per_million[name] = round(seconds[name] / rows * 1e6, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)

    for name in names:
        timed(name, lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    if not sys.argv[1:]:
        for name, rows, job in scale_runs(spark, folder):
            timed(name, job, rows)
    spark.stop()
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "seconds_per_million_rows": per_million,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
