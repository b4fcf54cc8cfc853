"""File layouts: size audit, bytes behind a predicate, and the timed comparison."""

from __future__ import annotations

import statistics
import time
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.sources.folders import BLOCK_BYTES
from partwise.sources.readers import file_inventory, listed_files, parquet_chunks

# Fixed value: the folder name that stands for a null key.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _key_from_path(key: str) -> Column:
    """The text of ``key=…`` in a path; null outside such a folder or for a null key."""
    text = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    # Folder names escape as %XX only, so a plus sign is itself.
    text = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(~text.isin("", NULL_FOLDER), text)


def keyed_inventory(spark: SparkSession, root: str, keys: Sequence[str], in_tasks: bool = False) -> DataFrame:
    """The file inventory with the partition keys of each file, as text; on request listed by tasks."""
    files = (listed_files if in_tasks else file_inventory)(spark, root)
    return files.withColumns({key: _key_from_path(key) for key in keys})


def directory_size(spark: SparkSession, root: str) -> DataFrame:
    """One row: files and bytes under a folder."""
    return file_inventory(spark, root).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def layout_audit(
    spark: SparkSession, root: str, keys: Sequence[str], block_bytes: int = BLOCK_BYTES, in_tasks: bool = False
) -> DataFrame:
    """Files, bytes, blocks and small files per partition of a layout.

    A file below the block size still takes a block entry, so a partition is
    ``fragmented`` when its bytes would fit into fewer blocks than it uses. With ``in_tasks``
    the folders are listed by tasks, for layouts of very many files.
    """
    blocks = F.greatest(F.ceil(F.col("length") / block_bytes), F.lit(1))
    per_partition = keyed_inventory(spark, root, keys, in_tasks).groupBy(*keys).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.avg("length").alias("mean_bytes"),
        F.max("length").alias("max_bytes"),
        F.sum(blocks).alias("blocks"),
        F.count_if(F.col("length") < block_bytes).alias("small_files"),
    )
    needed = F.greatest(F.ceil(F.col("bytes") / block_bytes), F.lit(1))
    return per_partition.withColumn("fragmented", F.col("blocks") > needed)


def bytes_behind(
    spark: SparkSession, root: str, keys: Sequence[str] = (), condition: Column | None = None
) -> DataFrame:
    """One row: the bytes of the files a query has to open.

    Only partition keys can spare files, so ``condition`` speaks of the keys (text).
    """
    files = keyed_inventory(spark, root, keys)
    files = files if condition is None else files.filter(condition)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def bytes_read(
    spark: SparkSession,
    root: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    condition: Column | None = None,
    equal: Mapping[str, object] | None = None,
) -> DataFrame:
    """One row: what a query over Parquet has to read of ``columns``, by the files' footers.

    ``files`` and ``rows`` are those left by the keys (``condition`` speaks of them, as text)
    and by the row groups' statistics for the values in ``equal``; ``bytes`` are the stored
    column chunks of ``columns`` in them, ``file_bytes`` the whole row groups.
    """
    files = keyed_inventory(spark, root, keys)
    files = files if condition is None else files.filter(condition)
    chunks = parquet_chunks(files.filter(F.col("length") > 0), equal or {}).filter("may_match")
    group = chunks.groupBy("path", "row_group").agg(
        F.first("rows").alias("rows"),
        F.sum("bytes").alias("file_bytes"),
        F.sum(F.when(F.split_part("column", F.lit("."), F.lit(1)).isin(*columns), F.col("bytes")).otherwise(0)).alias("bytes"),
    )
    per_file = group.groupBy("path").agg(*(F.sum(name).alias(name) for name in ("rows", "bytes", "file_bytes")))
    total = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("rows", "bytes", "file_bytes")]
    return per_file.agg(F.count("*").alias("files"), *total)


class Layout(NamedTuple):
    """One stored form of a table and the count to run on it."""

    count: DataFrame  # one row, column n
    size: DataFrame  # one row, column bytes


def compare_layouts(spark: SparkSession, layouts: Mapping[str, Layout], runs: int = 1) -> DataFrame:
    """Run the count of each layout and report rows found, seconds and bytes.

    With several ``runs`` the layouts take turns, so that what else the machine does meets
    all of them; ``seconds`` is the median, ``spread`` the longest less the shortest. One
    action per layout and run is the measurement; only its one-row result reaches the
    driver. Opening the tables and listing the files is outside the clock.
    """
    sizes = {name: layout.size.first()["bytes"] for name, layout in layouts.items()}
    seconds: dict[str, list[float]] = {name: [] for name in layouts}
    found = {}
    for _ in range(runs):
        for name, layout in layouts.items():
            start = time.perf_counter()
            found[name] = layout.count.first()["n"]
            seconds[name].append(time.perf_counter() - start)
    rows = [
        (name, found[name], statistics.median(times), max(times) - min(times), sizes[name]) for name, times in seconds.items()
    ]
    return spark.createDataFrame(rows, "layout string, n bigint, seconds double, spread double, bytes bigint")
