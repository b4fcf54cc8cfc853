"""The registered queries: each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwise.functions.lists import bracketed
from partwise.operators import graph, layout, logs, trips
from partwise.plans import derived
from partwise.session import new_scratch_path
from partwise.sources import folders, pair_lines, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the registered queries.
VENDOR, MONTH = 1, 1
ERROR_PATTERN = r"\| 4[0-9][0-9] \|"
AUDIT_BLOCK = 20_000
MAX_FRIENDS = derived.MAX_FRIENDS


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Access logs -----------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_lines(spark, derived.log_folder(spark, sf_dir))


@query
def http_error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.error_counts(_log(spark, sf_dir)).orderBy("status")


@query
def http_status_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.status_counts(_log(spark, sf_dir)).orderBy("status")


@query
def http_server_error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.error_counts(_log(spark, sf_dir), threshold=500)


@query
def log_line_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.line_outcomes(_log(spark, sf_dir))


@query
def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.log_summary(_log(spark, sf_dir))


@query
def log_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_log(_log(spark, sf_dir))


@query
def error_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.grep_lines(_log(spark, sf_dir), ERROR_PATTERN)


@query
def log_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.first_lines(spark, derived.ordered_log(spark, sf_dir), 10)


@query
def log_head_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.event_lines(spark, sf_dir).select("line_no", "value")
    return logs.head_lines(lines, "line_no", 10)


@query
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "status-counts")
    counts = logs.status_counts(_log(spark, sf_dir))
    writers.write_tsv(counts, F.col("status"), F.col("n"), path)
    return readers.read_tsv(spark, path, "status", "n", "bigint")


@query
def overwritten_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second result at the path of a first one replaces it."""
    path = new_scratch_path(spark, "overwritten")
    for counts in (logs.status_counts(_log(spark, sf_dir)), logs.error_counts(_log(spark, sf_dir))):
        writers.write_tsv(counts, F.col("status"), F.col("n"), path)
    return readers.read_tsv(spark, path, "status", "n", "bigint")


@query
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_path(spark, "compacted")
    writers.compact_lines(spark, derived.small_log_files(spark, sf_dir), path)
    return readers.read_lines(spark, path)


@query
def compacted_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = derived.small_log_files(spark, sf_dir)
    dst = new_scratch_path(spark, "compacted")
    writers.compact_lines(spark, src, dst)
    before, after = layout.directory_size(spark, src), layout.directory_size(spark, dst)
    return before.select(F.lit("before").alias("stage"), "files", "bytes").unionByName(
        after.select(F.lit("after").alias("stage"), "files", "bytes")
    )


def _compacted_in_place(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The log as small files beside one full one, compacted where they are, and the inventory before."""
    path = new_scratch_path(spark, "log-in-place")
    writers.compact_lines(spark, derived.small_log_files(spark, sf_dir), path)
    small = readers.read_lines(spark, derived.small_log_files(spark, sf_dir))
    small.write.mode("append").text(path)
    target = layout.directory_size(spark, path).first()["bytes"] // 2
    before = layout.directory_size(spark, path).first()
    folders.compact_folder(spark, path, target_bytes=target)
    return path, before


@query
def compact_folder_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a folder that was compacted where it is: the log twice, a full file and small ones."""
    path, _ = _compacted_in_place(spark, sf_dir)
    return readers.read_lines(spark, path)


@query
def compact_folder_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and files of that folder, and whether the bytes and the full file are as before."""
    path, before = _compacted_in_place(spark, sf_dir)
    after = layout.directory_size(spark, path)
    full = readers.file_inventory(spark, path).filter(~F.contains("path", F.lit("/compacted-"))).agg(F.count("*").alias("untouched"))
    whole = after.select(F.lit("folder").alias("stage"), "files", "bytes", (F.col("bytes") == before["bytes"]).alias("same_bytes"))
    return whole.join(full.withColumn("stage", F.lit("folder")), "stage")


@query
def updated_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition after those of one vendor were replaced by its first half of the year."""
    path = new_scratch_path(spark, "updated-trips")
    flat = spark.read.parquet(derived.trips_flat(spark, sf_dir))
    writers.write_partitioned(flat, path, ["VendorID"])
    writers.update_partitioned(flat.filter((F.col("VendorID") == VENDOR) & (F.col("Month") <= 6)), path, ["VendorID"])
    return spark.read.parquet(path).groupBy("VendorID", "Month").agg(F.count("*").alias("n"))


# Social graphs ---------------------------------------------------------------


def _by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = derived.adjacency_folder(spark, sf_dir, "l_suppkey", graph.ARROW)
    return graph.parse_arrow_lines(readers.read_lines(spark, folder))


def _part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_lines(spark, derived.adjacency_folder(spark, sf_dir, "l_partkey", graph.TAB))


def _by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.parse_tab_lines(_part_lines(spark, sf_dir))


def _printed(pairs: DataFrame) -> DataFrame:
    return pairs.select("f1", "f2", bracketed(F.col("members")).alias("members"))


@query
def friend_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _by_part(spark, sf_dir)
    return lists.select("user", F.array_join(F.array_sort("friends"), ",").alias("friends"))


@query
def friend_lists_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _by_supplier(spark, sf_dir)
    return lines.select("user", F.array_join(F.array_sort("friends"), ",").alias("friends"))


@query
def friend_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.friend_pairs(_by_supplier(spark, sf_dir))


@query
def common_friend_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.common_friend_rows(_by_supplier(spark, sf_dir))


@query
def common_friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(graph.common_friends(_by_supplier(spark, sf_dir)))


@query
def common_friends_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most pairs gathered in parts and every list tiled: the same rows."""
    return _printed(graph.common_friends(_by_supplier(spark, sf_dir), block=2, part_members=20))


def _written_lines(spark: SparkSession, pairs: DataFrame, key: F.Column) -> DataFrame:
    path = new_scratch_path(spark, "pair-lines")
    writers.write_tsv(pairs, key, bracketed(F.col("members")), path, per_file=True)
    return readers.read_lines(spark, path)


@query
def common_friends_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written ``a,b<TAB>[x, y]`` lines."""
    pairs = graph.common_friends(_by_supplier(spark, sf_dir))
    return _written_lines(spark, pairs, F.concat_ws(",", "f1", "f2"))


@query
def common_friends_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines from the pair rows, written member by member: no pair is gathered."""
    path = new_scratch_path(spark, "member-lines")
    pairs = graph.friend_pairs(_by_supplier(spark, sf_dir))
    pair_lines.write_member_lines(pairs, F.concat_ws(",", "f1", "f2"), F.col("user"), path)
    return readers.read_lines(spark, path)


@query
def friend_list_intersection_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written ``(a,b)<TAB>[x, y]`` lines."""
    pairs = graph.friend_list_intersection(_by_part(spark, sf_dir))
    key = F.concat(F.lit("("), F.col("f1"), F.lit(","), F.col("f2"), F.lit(")"))
    return _written_lines(spark, pairs, key)


@query
def common_friends_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(graph.common_friends(graph.clean_lists(_by_supplier(spark, sf_dir))))


@query
def friend_list_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(graph.friend_list_intersection(_by_part(spark, sf_dir)))


@query
def friend_list_intersection_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every list tiled."""
    return _printed(graph.friend_list_intersection(_by_part(spark, sf_dir), block=2))


def _kind_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_lines(spark, derived.adjacency_folder(spark, sf_dir, "kinds", graph.TAB))


@query
def friend_list_intersection_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists that share many pairs: parts with their brands and types."""
    lists = graph.parse_tab_lines(_kind_lines(spark, sf_dir))
    return _printed(graph.friend_list_intersection(lists))


@query
def friend_list_intersection_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the lists of more than ``MAX_FRIENDS`` names, as a caller may ask for."""
    return _printed(graph.friend_list_intersection(_by_part(spark, sf_dir), max_friends=MAX_FRIENDS))


@query
def common_friends_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _printed(graph.common_friends(_by_supplier(spark, sf_dir), max_friends=MAX_FRIENDS))


@query
def graph_outcomes_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes with the lines left out by the guard."""
    return graph.graph_outcomes(_part_lines(spark, sf_dir), max_friends=MAX_FRIENDS)


@query
def graph_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_outcomes(_part_lines(spark, sf_dir))


@query
def graph_outcomes_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_outcomes(_kind_lines(spark, sf_dir))


# Trips and layouts -----------------------------------------------------------


def _typed_rows(trips_df: DataFrame) -> DataFrame:
    pickup = F.date_format("Pickup_Datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup")
    return trips_df.select("trip_id", "VendorID", "Month", "tpep_pickup_datetime", pickup)


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_trips(spark, derived.trips_csv(spark, sf_dir), derived.TRIP_KINDS)


@query
def trips_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed_rows(derived.prepared_trips(spark, sf_dir))


@query
def trips_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readers.read_trips(spark, derived.trips_csv(spark, sf_dir), infer=True)
    typed = trips.prepare_trips(read)
    return _typed_rows(typed.withColumn("trip_id", F.col("trip_id").cast("bigint")))


@query
def trips_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_where(derived.prepared_trips(spark, sf_dir))


@query
def trips_rows_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_where(_trips(spark, sf_dir))


@query
def trips_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.preview(_trips(spark, sf_dir), "trip_id")


@query
def trips_preview_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("VendorID", "tpep_pickup_datetime", "Month")
    return trips.preview(derived.prepared_trips(spark, sf_dir), "trip_id", columns=columns)


def _csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.with_month(readers.read_trips_as_text(spark, derived.trips_csv(spark, sf_dir)))


@query
def trips_count_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.count_where(_csv_trips(spark, sf_dir), trips.vendor_month(str(VENDOR), MONTH))


@query
def trips_count_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = readers.read_prepared(spark, derived.trips_flat(spark, sf_dir))
    return trips.count_where(flat, trips.vendor_month(VENDOR, MONTH))


@query
def trips_count_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    partitioned = readers.read_prepared(spark, derived.trips_partitioned(spark, sf_dir))
    return trips.count_where(partitioned, trips.vendor_month(VENDOR, MONTH))


@query
def trips_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count as SQL text over the partitioned table."""
    taxi = readers.read_prepared(spark, derived.trips_partitioned(spark, sf_dir))
    return spark.sql(
        "SELECT COUNT(*) AS n FROM {taxi} WHERE VendorID = {vendor} AND Month = {month}",
        taxi=taxi,
        vendor=VENDOR,
        month=MONTH,
    )


@query
def trips_partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    partitioned = readers.read_prepared(spark, derived.trips_partitioned(spark, sf_dir))
    return partitioned.groupBy("VendorID", "Month").agg(F.count("*").alias("n"))


@query
def layout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count from the three layouts, side by side."""
    named = {
        "csv": trips_count_csv(spark, sf_dir),
        "flat": trips_count_flat(spark, sf_dir),
        "partitioned": trips_count_partitioned(spark, sf_dir),
    }
    counts = [df.select(F.lit(name).alias("layout"), "n") for name, df in named.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def layout_timing(spark: SparkSession, sf_dir: str, runs: int = 1) -> DataFrame:
    """The timed comparison, for the bench: rows found, seconds and bytes per layout."""
    chosen = (F.col("VendorID") == str(VENDOR)) & (F.col("Month") == str(MONTH))
    csv, flat = derived.trips_csv(spark, sf_dir), derived.trips_flat(spark, sf_dir)
    partitioned = derived.trips_partitioned(spark, sf_dir)
    keyed = layout.bytes_behind(spark, partitioned, trips.PARTITION_KEYS, chosen)
    layouts = {
        "csv": layout.Layout(trips_count_csv(spark, sf_dir), layout.bytes_behind(spark, csv)),
        "flat": layout.Layout(trips_count_flat(spark, sf_dir), layout.bytes_behind(spark, flat)),
        "partitioned": layout.Layout(trips_count_partitioned(spark, sf_dir), keyed),
    }
    return layout.compare_layouts(spark, layouts, runs)


@query
def layout_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison without its seconds: rows found, and whether fewer bytes are behind them."""
    timed = layout_timing(spark, sf_dir)
    size = {row.layout: row.bytes for row in timed.collect()}  # three rows
    return timed.select(
        "layout",
        "n",
        (F.col("bytes") < size["csv"]).alias("below_csv"),
        (F.col("bytes") < size["flat"]).alias("below_flat"),
    )


@query
def layout_bytes_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the count reads of each Parquet layout, by its footers: rows left, and less than the files hold."""
    chosen = (F.col("VendorID") == str(VENDOR)) & (F.col("Month") == str(MONTH))
    flat, keyed = derived.trips_flat(spark, sf_dir), derived.trips_partitioned(spark, sf_dir)
    parts = {
        "flat": layout.bytes_read(spark, flat, ["VendorID", "Month"]),
        "flat_no_vendor": layout.bytes_read(spark, flat, ["VendorID"], equal={"VendorID": -1}),
        "partitioned": layout.bytes_read(spark, keyed, [], trips.PARTITION_KEYS, chosen),
        "partitioned_ids": layout.bytes_read(spark, keyed, ["trip_id"], trips.PARTITION_KEYS, chosen),
    }
    named = [
        df.select(
            F.lit(name).alias("layout"),
            "rows",
            (F.col("bytes") > 0).alias("reads_columns"),
            (F.col("bytes") < F.col("file_bytes")).alias("below_files"),
        )
        for name, df in parts.items()
    ]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@query
def layout_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a text layout, whose bytes follow from its lines."""
    root = derived.event_layout(spark, sf_dir)
    return layout.layout_audit(spark, root, derived.EVENT_KEYS, block_bytes=AUDIT_BLOCK)


@query
def layout_audit_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same audit, with the folders listed by tasks."""
    root = derived.event_layout(spark, sf_dir)
    return layout.layout_audit(spark, root, derived.EVENT_KEYS, block_bytes=AUDIT_BLOCK, in_tasks=True)


@query
def trips_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type that inference gives each column, with the number of its values."""
    read = readers.read_trips(spark, derived.trips_csv(spark, sf_dir), infer=True)
    counts = read.agg(*(F.count(name).alias(name) for name in read.columns))
    columns = [F.struct(F.lit(name).alias("column"), F.lit(kind).alias("kind"), F.col(name).alias("n")) for name, kind in read.dtypes]
    return counts.select(F.inline(F.array(*columns)))


@query
def layout_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions that use more blocks than their bytes need."""
    audit = layout_audit(spark, sf_dir)
    return audit.filter("fragmented").select(*derived.EVENT_KEYS, "files", "blocks", "small_files")


@query
def layout_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition, by the keys in the paths of the inventory's files."""
    root = derived.trips_partitioned(spark, sf_dir)
    files = layout.keyed_inventory(spark, root, trips.PARTITION_KEYS).filter(F.col("length") > 0)
    end = r"([^/]+/[^/]+/[^/]+)$"
    rows = spark.read.parquet(root).select(F.regexp_extract("_metadata.file_path", end, 1).alias("file"))
    rows = rows.groupBy("file").agg(F.count("*").alias("rows"))
    found = files.withColumn("file", F.regexp_extract("path", end, 1)).join(rows, "file")
    return found.groupBy(*trips.PARTITION_KEYS).agg(F.sum("rows").alias("rows"))


@query
def layout_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions found by the audit, from the file paths alone."""
    audit = layout.layout_audit(spark, derived.trips_partitioned(spark, sf_dir), trips.PARTITION_KEYS)
    return audit.select(*[F.col(key).cast("int").alias(key) for key in trips.PARTITION_KEYS])


@query
def census_layout_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.census_layout(spark, sf_dir))
    return trips.count_where(stored, F.col("n_name") == "NATION_3")


@query
def utility_layout_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.utility_layout(spark, sf_dir))
    return trips.count_where(stored, (F.col("r_name") == "ASIA") & (F.col("month") == 3))


@query
def machine_layout_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.machine_layout(spark, sf_dir))
    return trips.count_where(stored, F.col("p_type") == "PROMO")


@query
def census_partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.census_layout(spark, sf_dir))
    return stored.groupBy("r_name", "n_name").agg(F.count("*").alias("n"))


@query
def utility_partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.utility_layout(spark, sf_dir))
    return stored.groupBy("r_name", "month").agg(F.count("*").alias("n"))


@query
def machine_partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.read.parquet(derived.machine_layout(spark, sf_dir))
    return stored.groupBy("p_type").agg(F.count("*").alias("n"))
