"""A corpus from raw documents to token ids: the stages in order, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last one keep the
columns of ``docs``, extra ones included. Documents with a null id are never dropped by a
comparison with others; null and empty texts count as texts without words.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.llm import bpe, decontaminate, lines, minhash, quality
from partwise.llm.common import free_name, settle
from partwise.llm.queries import VOCABULARY, ship, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more; it learns from ``labels`` on ``docs`` themselves."""
    ship(spark)
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that match an earlier one; ``n_chars`` follows, emptied documents go."""
    ship(spark)
    return lines.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, their number, and whether the ids decode to the text.

    If ``docs`` has a column token_ids, n_tokens or round_trip, the new one has underscores before it.
    """
    ship(spark)
    ids = free_name(docs, "token_ids")
    encoded = bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN, to=ids)
    back = free_name(encoded, "decoded")
    decoded = bpe.decode(encoded, VOCABULARY, ids, to=back)
    same = F.col(back) == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    counted = decoded.withColumn(free_name(docs, "n_tokens"), F.size(ids).cast("long"))
    return counted.withColumn(free_name(docs, "round_trip"), same).drop(back)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_filter", benchmark_filter),
    ("tokens", tokens),
]

#: Stages train a model, hash, align and encode; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, all but the last written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
