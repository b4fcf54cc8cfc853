"""Readers: trips, text lines and the file inventory."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from partwise.session import child_session, written

if TYPE_CHECKING:
    import pyarrow as pa

# The named columns of a trips file that are no text.
TRIP_TYPES = {"VendorID": "int"}


def read_trips(spark: SparkSession, path: str, types: dict[str, str] | None = None, infer: bool = False) -> DataFrame:
    """Trips from CSV with a header: all its columns, in its order, known by their names.

    The columns of ``types`` (by default ``TRIP_TYPES``) that the file has get their
    type, a value that does not fit becomes null; the others are text. Inference takes
    the types from all of the data: the CSV is read once, written on as columns of text, and
    the types come from an aggregation over those.
    """
    if infer:
        text = written(read_trips_as_text(spark, path), "trips-as-text")
        kinds = infer_types(text)
        return text.select(*(F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in kinds.items()))
    read = read_trips_as_text(spark, path)
    types = TRIP_TYPES if types is None else types
    return read.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items() if name in read.columns})


# The types that inference knows, narrow ones first. A text column is what is left.
_WHOLE = r"^[+-]?[0-9]+$"
_KINDS = ("int", "bigint", "double", "date", "timestamp", "boolean")


def infer_types(text: DataFrame) -> dict[str, str]:
    """The narrowest type for each column of text that takes all its values; text if it has none.

    One aggregation of fixed size: per column and type, whether a value has not fitted so
    far. That merges over tasks in any order, unlike a choice made value by value. Blanks
    around a value make it text.
    """

    def fits(column: Column, kind: str) -> Column:
        cast = column.try_cast(kind).isNotNull() & (F.trim(column) == column)
        if kind in ("int", "bigint"):
            return cast & column.rlike(_WHOLE)
        if kind == "date":
            return cast & (F.length(column) == 10)
        if kind == "timestamp":
            return cast & (F.length(column) > 10)
        return cast if kind == "double" else F.lower(column).isin("true", "false")

    columns = [F.col(f"`{name}`") for name in text.columns]
    found = text.agg(
        *(
            F.struct(*(F.bool_and(F.isnull(column) | fits(column, kind)).alias(kind) for kind in _KINDS), F.count(column).alias("n"))
            .alias(str(i))
            for i, column in enumerate(columns)
        )
    ).first()
    return {
        name: next((kind for kind in _KINDS if found[i]["n"] and found[i][kind]), "string") for i, name in enumerate(text.columns)
    }


def read_trips_as_text(spark: SparkSession, path: str) -> DataFrame:
    """The same CSV with every column a string."""
    return spark.read.option("header", True).csv(path)


def read_prepared(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Prepared trips from Parquet, flat or with keys in the folder names.

    Without a schema Spark reads it from a file footer, in a job of its own.
    """
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value``) of a text file or a folder of them."""
    return spark.read.text(path)


def first_lines(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first ``n`` lines by file path and place: (line_no, value), counted from 1.

    As many files as are needed for ``n`` lines are read, in the order of their paths.
    """
    files = sorted(spark.read.text(path).inputFiles())
    known = 0
    while True:
        known = min(len(files), max(1, 2 * known))
        lines = spark.read.text(files[:known]) if files else spark.read.text(path)
        # Rows of a split stay in order; splits are ordered by file and offset.
        placed = lines.select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("offset"),
            F.monotonically_increasing_id().alias("row"),
        )
        head = placed.orderBy("file", "offset", "row").limit(n)
        if known == len(files) or head.count() >= n:
            numbered = F.row_number().over(Window.orderBy("file", "offset", "row")).cast("bigint")
            return head.select(numbered.alias("line_no"), "value")


def read_tsv(spark: SparkSession, path: str, key: str, value: str, value_type: str = "string") -> DataFrame:
    """Read ``key<TAB>value`` lines back; the first tab parts the two.

    A line without a tab has a null value, as has one whose value is not of the type.
    """
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(
        parts[0].alias(key), F.get(parts, F.lit(1)).try_cast(value_type).alias(value)
    )


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per file under a folder, at any depth: path, length, modificationTime.

    The file content is a column too; as it is not selected, no file is opened. So the
    sizes say nothing about the work: the splits are made as large as can be, which
    leaves about as many tasks as the cluster has cores, however many bytes there are.
    """
    listing = child_session(
        spark, spark__sql__files__maxPartitionBytes=1 << 60, spark__sql__files__openCostInBytes=0
    )
    files = listing.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "modificationTime")


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """The rows of :func:`file_inventory`, listed by tasks: the driver never holds the files' names.

    One task lists the root, and the folders in it are dealt to all tasks, each of which is
    listed with all below it. Names that Spark's readers pass over are left out. File
    systems are those that Arrow opens; for others there is :func:`file_inventory`.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = system.makeQualified(place).toString()

    # Nested, so that executors need nothing of this package.
    def lister(recursive: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import pyarrow as arrow
            from pyarrow import fs

            names = ("path", "is_folder", "length", "modificationTime")

            def list_folder(uri: str) -> list[tuple]:
                if uri.startswith("file:"):
                    files, path = fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
                else:
                    files, path = fs.FileSystem.from_uri(uri)
                rows = []
                for info in files.get_file_info(fs.FileSelector(path)):
                    name = info.base_name
                    if name.startswith(".") or (name.startswith("_") and "=" not in name):
                        continue
                    folder = info.type == fs.FileType.Directory
                    rows.append((f"{uri}/{name}", folder, None if folder else info.size, info.mtime))
                return rows

            for batch in batches:
                waiting = []
                for row in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
                    if row[1]:
                        waiting.append(row[0])
                    else:
                        yield arrow.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema=batch.schema)
                while waiting:
                    rows = list_folder(waiting.pop())
                    if recursive:
                        waiting += [row[0] for row in rows if row[1]]
                        rows = [row for row in rows if not row[1]]
                    yield arrow.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in rows], schema=batch.schema)

        return read

    schema = "path string, is_folder boolean, length bigint, modificationTime timestamp"
    start = spark.createDataFrame([(whole.rstrip("/"), True, None, None)], schema).coalesce(1)
    top = start.mapInArrow(lister(False), schema)
    dealt = top.repartition(spark.sparkContext.defaultParallelism, "path")
    return dealt.mapInArrow(lister(True), schema).select("path", "length", "modificationTime")


def parquet_chunks(files: DataFrame, equal: Mapping[str, object]) -> DataFrame:
    """The column chunks of Parquet files, from their footers alone: one row per row group and column.

    ``files`` has a ``path`` column; its footers are read in tasks, by the files' own number.
    Columns: path, row_group, rows, column (with its parents), bytes as stored, and whether
    the row group ``may_match`` all values in ``equal``, a top-level column each: it cannot if a
    value is outside the least and greatest, or if there are only nulls. Without statistics it may.
    """
    wanted = dict(equal)

    # Nested, so that executors need nothing of this package.
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as arrow
        from pyarrow import fs, parquet

        def opened(uri: str) -> object:
            if uri.startswith("file:"):
                return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
            if "://" not in uri:
                return fs.LocalFileSystem().open_input_file(uri)
            system, path = fs.FileSystem.from_uri(uri)
            return system.open_input_file(path)

        def excludes(chunk: object, value: object, rows: int) -> bool:
            stats = chunk.statistics
            if stats is None:
                return False
            if stats.has_null_count and stats.null_count == rows:
                return True
            return stats.has_min_max and not stats.min <= value <= stats.max

        for batch in batches:
            for uri in batch.column("path").to_pylist():
                with opened(uri) as file:
                    footer = parquet.ParquetFile(file).metadata
                found: dict[str, list] = {name: [] for name in ("path", "row_group", "rows", "column", "bytes", "may_match")}
                for i in range(footer.num_row_groups):
                    group = footer.row_group(i)
                    chunks = [group.column(j) for j in range(group.num_columns)]
                    out = any(excludes(c, wanted[c.path_in_schema], group.num_rows) for c in chunks if c.path_in_schema in wanted)
                    for chunk in chunks:
                        row = (uri, i, group.num_rows, chunk.path_in_schema, chunk.total_compressed_size, not out)
                        for values, value in zip(found.values(), row, strict=True):
                            values.append(value)
                if found["path"]:
                    yield arrow.RecordBatch.from_pydict(found)

    schema = "path string, row_group bigint, rows bigint, column string, bytes bigint, may_match boolean"
    return files.select("path").mapInArrow(read, schema)
