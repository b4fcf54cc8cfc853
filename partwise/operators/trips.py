"""Taxi trips: typing, the derived month and the selective count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the trip data.
PICKUP_PATTERN = "MM/dd/yyyy hh:mm:ss a"
PARTITION_KEYS = ("VendorID", "Month")


def _pickup() -> Column:
    return F.try_to_timestamp(F.col("tpep_pickup_datetime"), F.lit(PICKUP_PATTERN))


def with_month(trips: DataFrame) -> DataFrame:
    """Add ``Pickup_Datetime`` and ``Month``; both are null where the text is no date."""
    return trips.withColumn("Pickup_Datetime", _pickup()).withColumn("Month", F.month("Pickup_Datetime"))


def prepare_trips(trips: DataFrame) -> DataFrame:
    """Typed trips that have both partition keys.

    Parsing the dates is most of the work. As a generated value a date is filtered
    where it is made; as a plain column it would be parsed once more for the filter.
    """
    known = trips.filter(F.col("VendorID").isNotNull())
    dated = known.withColumn("Pickup_Datetime", F.explode(F.array(_pickup())))
    return dated.filter(F.col("Pickup_Datetime").isNotNull()).withColumn("Month", F.month("Pickup_Datetime"))


def count_where(trips: DataFrame, condition: Column | None = None) -> DataFrame:
    """One row with the number of trips that meet a condition."""
    chosen = trips if condition is None else trips.filter(condition)
    return chosen.agg(F.count("*").alias("n"))


def vendor_month(vendor: int | str, month: int) -> Column:
    """``VendorID = vendor AND Month = month``.

    Give the vendor as text for the untyped CSV: comparing its text column to an
    integer would cast every row and fail on junk.
    """
    return (F.col("VendorID") == F.lit(vendor)) & (F.col("Month") == month)


def preview(trips: DataFrame, order_by: str, n: int = 5, columns: tuple[str, ...] = ()) -> DataFrame:
    """The first rows by a key, of all or some columns."""
    top = trips.orderBy(order_by).limit(n)
    return top.select(*columns) if columns else top
