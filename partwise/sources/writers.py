"""Writers. Each one is an action and replaces what was at the path.

The old result stays readable until the new one is complete; see ``folders.replace_folder``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.sources.folders import BLOCK_BYTES, packing_session, replace_folder, replace_partitions

def write_flat(df: DataFrame, path: str) -> None:
    """Parquet files in one folder; each task writes what it has, without a shuffle."""
    replace_folder(df.sparkSession, path, lambda fresh: df.write.parquet(fresh))


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Parquet in ``key=value`` folders, with few and evenly filled files in each.

    Without a shuffle every task would write a file into every folder. A plain
    ``repartition`` on the keys would put each folder, however large, into one task.
    A rebalance does neither: adaptive execution merges small key groups and splits
    large ones at the advisory size, which the session is made with
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``).
    """
    replace_folder(df.sparkSession, path, lambda fresh: _write_rebalanced(df, fresh, keys))


def update_partitioned(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """The same, but only for the ``key=value`` folders that ``df`` has rows for; others stay."""
    replace_partitions(df, path, keys, lambda part, fresh: _write_rebalanced(part, fresh, keys))


def _write_rebalanced(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    rebalanced = df.hint("rebalance", *[F.col(key) for key in keys])
    rebalanced.write.partitionBy(*keys).parquet(path)


def write_tsv(
    df: DataFrame, key: Column, value: Column, path: str, files: int | None = None, per_file: bool = False
) -> None:
    """``key<TAB>value`` lines sorted by the key.

    Across all part files, for small results; within each file, with ``per_file`` or a
    number of ``files``. That needs no sampling of the keys, so what makes the lines
    runs once. With ``per_file`` the lines stay in the tasks that make them, unshuffled.
    """
    lines = df.select(key.cast("string").alias("key"), value.cast("string").alias("text"))
    if files is not None or per_file:
        spread = lines.repartition(files, "key") if files is not None else lines
        lines = spread.sortWithinPartitions("key")
    else:
        lines = lines.orderBy("key")
    joined = lines.select(F.concat_ws("\t", "key", "text").alias("value"))
    replace_folder(df.sparkSession, path, lambda fresh: joined.write.text(fresh))


def compact_lines(spark: SparkSession, src: str, dst: str, target_bytes: int = BLOCK_BYTES) -> None:
    """Merge the text files of a folder into files of about ``target_bytes``.

    The scan itself packs small files into one split up to the target (and cuts
    larger ones there), and every split becomes one file: no shuffle, and a single
    file only when all of it fits the target. The lines stay the same; the order of
    the source files does not.
    """
    packed = packing_session(spark, target_bytes).read.text(src)
    replace_folder(spark, dst, lambda fresh: packed.write.text(fresh))
