"""What the operators share: written intermediates, free column names, kept rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partwise.session import new_scratch_path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    This cuts the lineage with a table that outlives any executor, and it fixes the rows,
    so that a recomputed task later on cannot see others.
    """
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until ``df`` has no such column."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def keep_ids_once(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each id in ``ids``, with all columns; rows without an id stay.

    Of rows that repeat an id it is the first by a hash of all columns. The join and the
    ranking share one shuffle.
    """
    key, rank = free_name(docs, "wanted_id"), free_name(docs, "rank")
    found = docs.join(ids.select(F.col(id_col).alias(key)), F.col(id_col) == F.col(key), "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.xxhash64(*docs.columns))
    ranked = found.withColumn(rank, F.row_number().over(order))
    return ranked.where(F.col(rank) == 1).drop(rank).unionByName(docs.where(F.col(id_col).isNull()))


def drop_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids``, with all columns; rows without an id stay."""
    key = free_name(docs, "unwanted_id")
    return docs.join(ids.select(F.col(id_col).alias(key)), F.col(id_col) == F.col(key), "left_anti")
