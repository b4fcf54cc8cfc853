"""The operators' inputs, derived from the given tables and written once per session.

Every row of a source table has its part in the derived data:

* access log: a request per event; parts, customers, suppliers and nations add the
  irregular lines (odd codes, too few fields, comments, blanks);
* friend lists: the suppliers, or the parts, of each order, repeats included;
  suppliers, nations and regions add comments, lines without a list and blanks;
* trips: a trip per order; the pickup of every 97th order key is junk.
"""

from __future__ import annotations

from collections.abc import Callable
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partwise.operators.trips import PARTITION_KEYS, PICKUP_PATTERN, prepare_trips
from partwise.session import new_scratch_path, written
from partwise.sources.readers import read_trips
from partwise.sources.writers import write_flat, write_partitioned

# Fixed values of the derived data.
TRIP_KINDS = {"trip_id": "bigint", "VendorID": "int"}
JUNK_EVERY = 97
LINES_PER_FILE = 250
MAX_FRIENDS = 5
EVENT_KEYS = ("event_type",)
# Small files that one task writes, about.
FILES_PER_TASK = 256

_written: dict[tuple[str, str, str], str] = {}
_locks: dict[tuple[str, str, str], Lock] = {}
_lock = Lock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a dataset under the shared scratch folder, written at first use."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    with _lock:
        own = _locks.setdefault(key, Lock())
    with own:  # a second caller waits for the first to write
        if key not in _written:
            path = new_scratch_path(spark, label)
            write(path)
            _written[key] = path
        return _written[key]


def _piped(*parts: Column | str) -> Column:
    return F.concat_ws(" | ", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _numbered(df: DataFrame, kind: str, key: str, value: Column) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.col(key).cast("bigint").alias("line_no"), value.alias("value"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, line_no, value): the access log lines of the events."""
    amount = F.floor("value").cast("bigint")
    status = F.when(F.col("event_type") == "error", F.lit(400) + amount).otherwise(F.lit(200))
    line = _piped(
        F.date_format("ts", "yyyy-MM-dd"),
        F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")),
        F.concat(F.lit("/"), F.col("event_type")),
        status.cast("string"),
        amount.cast("string"),
    )
    return _numbered(table(spark, sf_dir, "events"), "event", "event_id", line)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, line_no, value): the whole access log, irregular lines included."""
    head = _piped("2024-01-15", F.col("p_brand"), "/x")
    kind = F.col("p_type")
    odd = (
        F.when(kind == "STANDARD", F.concat(head, F.lit(" | n/a | 5")))
        .when(kind == "ECONOMY", F.concat(head, F.lit(" |  |")))
        .when(kind == "MEDIUM", F.concat(head, F.lit(" || ")))
        .when(kind == "PROMO", F.concat(head, F.lit(" | 0404 | 1")))
        .when(kind == "LARGE", F.concat(head, F.lit(" | \t+500\t | 1")))
        .when(F.col("p_retailprice") < 1000, F.concat(head, F.lit(" | -404 | 1")))
        .otherwise(F.concat(head, F.lit(" | 99999999999 | 1")))
    )
    short = _piped("2024-01-15", F.col("c_name"), "/x")
    comment = F.concat(F.lit("  # "), F.col("s_name"))
    return (
        event_lines(spark, sf_dir)
        .unionByName(_numbered(table(spark, sf_dir, "part"), "part", "p_partkey", odd))
        .unionByName(_numbered(table(spark, sf_dir, "customer"), "customer", "c_custkey", short))
        .unionByName(_numbered(table(spark, sf_dir, "supplier"), "supplier", "s_suppkey", comment))
        .unionByName(_numbered(table(spark, sf_dir, "nation"), "nation", "n_nationkey", F.lit("  \t")))
    )


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        log_lines(spark, sf_dir).select("value").write.text(path)

    return written_once(spark, sf_dir, "log", write)


def small_log_files(spark: SparkSession, sf_dir: str) -> str:
    """The access log as many small text files, of ``LINES_PER_FILE`` lines; only one may hold fewer."""

    def write(path: str) -> None:
        # Written first: the lines are numbered in two reads that see the same splits.
        lines = written(log_lines(spark, sf_dir).select("value"), "log-lines")
        placed = lines.select(F.spark_partition_id().alias("split"), F.monotonically_increasing_id().alias("at"), "value")
        sizes = placed.groupBy("split").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = sizes.select("split", before.alias("start"))
        number = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)
        total = sizes.agg(F.sum("n")).head()[0] or 0
        # A task gets whole chunks of files, so each of its files is full but the last of all.
        chunk = F.floor(number / (LINES_PER_FILE * FILES_PER_TASK)).alias("chunk")
        tasks = max(spark.sparkContext.defaultParallelism, -(-total // (LINES_PER_FILE * FILES_PER_TASK)))
        chunks = placed.join(starts, "split").select("value", chunk).repartition(tasks, "chunk")
        # The second algorithm has tasks rename their files, not the driver all of them one by one.
        out = chunks.select("value").write.option("maxRecordsPerFile", LINES_PER_FILE)
        out.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)

    return written_once(spark, sf_dir, "small-log-files", write)


def ordered_log(spark: SparkSession, sf_dir: str) -> str:
    """The event lines by their number, in files whose names follow that order."""

    def write(path: str) -> None:
        event_lines(spark, sf_dir).orderBy("line_no").select("value").write.text(path)

    return written_once(spark, sf_dir, "ordered-log", write)


def event_layout(spark: SparkSession, sf_dir: str) -> str:
    """The event lines as text in ``event_type=…/part=…`` folders, a file in each."""

    def write(path: str) -> None:
        events = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("user_id") % 3).alias("part"))
        lines = event_lines(spark, sf_dir).join(events, F.col("line_no") == F.col("event_id"))
        lines = lines.select("value", "event_type", "part").repartition("event_type", "part")
        lines.write.partitionBy("event_type", "part").text(path)

    return written_once(spark, sf_dir, "event-layout", write)


def adjacency_lines(spark: SparkSession, sf_dir: str, friend: str, sep: str) -> DataFrame:
    """``order<sep>friend,friend,…`` lines, a friend for each line item of the order.

    As ``kinds`` the friends are the parts with their brands and types, so that many
    pairs are on several lists.
    """
    items = table(spark, sf_dir, "lineitem")
    if friend == "kinds":
        items = items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        each = F.array(F.col("l_partkey").cast("string"), F.col("p_brand"), F.col("p_type"))
        items = items.select("l_orderkey", F.explode(each).alias("kinds"))
    names = F.array_join(F.sort_array(F.collect_list(F.col(friend).cast("string"))), ",")
    lists = items.groupBy("l_orderkey").agg(names.alias("names"))
    lines = lists.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(sep), F.col("names")).alias("value"))
    comments = table(spark, sf_dir, "supplier").select(F.concat(F.lit("# "), F.col("s_name")).alias("value"))
    lonely = table(spark, sf_dir, "nation").select(F.concat(F.col("n_name"), F.lit("\t ")).alias("value"))
    blank = table(spark, sf_dir, "region").select(F.lit("   ").alias("value"))
    return lines.unionByName(comments).unionByName(lonely).unionByName(blank)


def adjacency_folder(spark: SparkSession, sf_dir: str, friend: str, sep: str) -> str:
    label = f"{friend}-{'tab' if sep.isspace() else 'arrow'}"

    def write(path: str) -> None:
        adjacency_lines(spark, sf_dir, friend, sep).write.text(path)

    return written_once(spark, sf_dir, label, write)


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trip per order: no vendor for pending ones, no date for every ``JUNK_EVERY``-th key."""
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    vendor = F.when(status == "F", 1).when(status == "O", 2)
    pickup = F.when(F.col("o_orderkey") % JUNK_EVERY != 0, F.date_format(date, PICKUP_PATTERN))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        vendor.alias("VendorID"),
        F.coalesce(pickup, F.lit("unknown")).alias("tpep_pickup_datetime"),
    )


def trips_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        order_trips(spark, sf_dir).write.option("header", True).csv(path)

    return written_once(spark, sf_dir, "trips-csv", write)


def prepared_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_trips(read_trips(spark, trips_csv(spark, sf_dir), TRIP_KINDS))


def trips_flat(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        write_flat(prepared_trips(spark, sf_dir), path)

    return written_once(spark, sf_dir, "trips-flat", write)


def trips_partitioned(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        flat = spark.read.parquet(trips_flat(spark, sf_dir))
        write_partitioned(flat, path, PARTITION_KEYS)

    return written_once(spark, sf_dir, "trips-partitioned", write)


def _customers_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return placed.join(region, nation.n_regionkey == region.r_regionkey).select(
        "c_custkey", "c_name", "c_acctbal", "r_name", "n_name"
    )


def census_layout(spark: SparkSession, sf_dir: str) -> str:
    """Customers in ``r_name=…/n_name=…`` folders."""

    def write(path: str) -> None:
        write_partitioned(_customers_by_place(spark, sf_dir), path, ["r_name", "n_name"])

    return written_once(spark, sf_dir, "census", write)


def utility_layout(spark: SparkSession, sf_dir: str) -> str:
    """Orders in ``r_name=…/month=…`` folders."""

    def write(path: str) -> None:
        orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
        people = _customers_by_place(spark, sf_dir).select("c_custkey", "r_name")
        usage = orders.join(people, orders.o_custkey == people.c_custkey)
        usage = usage.select("o_orderkey", "o_totalprice", "r_name", "month")
        write_partitioned(usage, path, ["r_name", "month"])

    return written_once(spark, sf_dir, "utility", write)


def machine_layout(spark: SparkSession, sf_dir: str) -> str:
    """Parts in ``p_type=…`` folders."""

    def write(path: str) -> None:
        write_partitioned(table(spark, sf_dir, "part"), path, ["p_type"])

    return written_once(spark, sf_dir, "machine", write)
