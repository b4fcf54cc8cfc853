"""Command line jobs, for ``spark-submit``: input path, output path, printed result.

    python -m partwise.jobs error-count               <input> <output>
    python -m partwise.jobs status-count              <input> <output>
    python -m partwise.jobs friend-list-intersection  <input> <output>
    python -m partwise.jobs common-friends            <input> <output>
    python -m partwise.jobs compact                   <input> <output>
    python -m partwise.jobs partition-trips           <csv>   <output>
    python -m partwise.jobs compare-layouts           <csv>   <output>

``partition-trips`` writes ``<output>/flat``, ``<output>/partitioned`` and ``<output>/audit``;
``compare-layouts`` times the selective count on the CSV and on both of them.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partwise.functions.lists import bracketed
from partwise.operators import graph, layout, logs, trips
from partwise.session import written
from partwise.sources import pair_lines, readers, writers


def error_count(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Write the error counts and give the line counters, all from one scan."""
    summary = written(logs.log_summary(readers.read_lines(spark, src)), "log-summary")
    errors = summary.filter(F.col("outcome") == "error")
    writers.write_tsv(errors, F.col("status"), F.col("n"), dst)
    return _named(summary.groupBy("outcome").agg(F.sum("n").alias("n")), logs.COUNTER_NAMES)


def status_count(spark: SparkSession, src: str, dst: str) -> DataFrame:
    counts = logs.status_counts(readers.read_lines(spark, src))
    writers.write_tsv(counts, F.col("status"), F.col("n"), dst)
    return readers.read_tsv(spark, dst, "status", "n", "bigint")


def friend_list_intersection(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Write ``(a,b)<TAB>[x, y]`` lines and give the line and pair counters, from one scan."""
    pairs, outcomes = graph.intersection_and_outcomes(readers.read_lines(spark, src))
    key = F.concat(F.lit("("), F.col("f1"), F.lit(","), F.col("f2"), F.lit(")"))
    seen = Observation()
    counted = pairs.observe(seen, F.count(F.lit(1)).alias("n"))
    writers.write_tsv(counted, key, bracketed(F.col("members")), dst, per_file=True)
    n = seen.get["n"]
    found = spark.createDataFrame([("pairs_with_members", n)] if n else [], "outcome string, n bigint")
    return _named(outcomes.unionByName(found), graph.COUNTER_NAMES)


def common_friends(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Write ``a,b<TAB>[x, y]`` lines, a complete one for each pair, and give their number."""
    pairs = graph.friend_pairs(graph.parse_arrow_lines(readers.read_lines(spark, src)))
    pair_lines.write_member_lines(pairs, F.concat_ws(",", "f1", "f2"), F.col("user"), dst)
    found = readers.read_lines(spark, dst).agg(F.count("*").alias("n"))
    return _named(found.select(F.lit("pairs_with_members").alias("outcome"), "n"), graph.COUNTER_NAMES)


def compact(spark: SparkSession, src: str, dst: str) -> DataFrame:
    writers.compact_lines(spark, src, dst)
    return layout.directory_size(spark, dst)


def partition_trips(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Write the prepared trips flat and, from there, partitioned, and the audit of the latter.

    The CSV is scanned once. The audit is also written to ``<output>/audit``.
    """
    writers.write_flat(trips.prepare_trips(readers.read_trips(spark, src)), f"{dst}/flat")
    flat = readers.read_prepared(spark, f"{dst}/flat")
    writers.write_partitioned(flat, f"{dst}/partitioned", trips.PARTITION_KEYS)
    audit = layout.layout_audit(spark, f"{dst}/partitioned", trips.PARTITION_KEYS)
    audit.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{dst}/audit")
    return audit


def compare_layouts(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """The count of vendor 1 in January on the CSV and on both written layouts."""
    csv = trips.with_month(readers.read_trips_as_text(spark, src))
    flat, partitioned = f"{dst}/flat", f"{dst}/partitioned"
    typed = trips.vendor_month(1, 1)
    chosen = (F.col("VendorID") == "1") & (F.col("Month") == "1")
    keyed = layout.bytes_behind(spark, partitioned, trips.PARTITION_KEYS, chosen)
    layouts = {
        "csv": layout.Layout(
            trips.count_where(csv, trips.vendor_month("1", 1)), layout.bytes_behind(spark, src)
        ),
        "flat": layout.Layout(
            trips.count_where(spark.read.parquet(flat), typed), layout.bytes_behind(spark, flat)
        ),
        "partitioned": layout.Layout(
            trips.count_where(spark.read.parquet(partitioned), typed), keyed
        ),
    }
    return layout.compare_layouts(spark, layouts)


def _named(outcomes: DataFrame, names: dict[str, str]) -> DataFrame:
    """The outcomes a job reports, under their printed names."""
    label = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    named = outcomes.select(label[F.col("outcome")].alias("counter"), "n")
    return named.filter(F.col("counter").isNotNull())


JOBS: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {
    "error-count": error_count,
    "status-count": status_count,
    "friend-list-intersection": friend_list_intersection,
    "common-friends": common_friends,
    "compact": compact,
    "partition-trips": partition_trips,
    "compare-layouts": compare_layouts,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="partwise.jobs")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("input")
    parser.add_argument("output")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(chosen.job).config("spark.ui.enabled", "false").getOrCreate()
    report = JOBS[chosen.job](spark, chosen.input, chosen.output)
    print(*report.columns, sep="\t")
    for row in report.toLocalIterator():  # all of it, a partition at a time
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
