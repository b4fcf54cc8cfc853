"""A text sink for ``key<TAB>[member, member]`` lines that are written member by member.

Rows come sorted by key and member; a line is never held as a whole. So a key may have more
members than fit into a row, or into the memory of a task: the sort spills, the sink streams.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from partwise.sources.folders import replace_folder

FORMAT = "member_lines"


def _source() -> type[DataSource]:
    """The data source; made here, so that executors get it whole and need nothing of this package."""

    class LineWriter(DataSourceWriter):
        def __init__(self, path: str):
            self.path = path

        def _folder(self) -> tuple[object, str]:
            from pyarrow import fs

            if self.path.startswith("file:") or "://" not in self.path:
                return fs.LocalFileSystem(), "/" + self.path.removeprefix("file:").lstrip("/")
            return fs.FileSystem.from_uri(self.path)

        def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
            import uuid

            from pyspark import TaskContext

            message = WriterCommitMessage()
            system, folder = self._folder()
            system.create_dir(folder, recursive=True)
            # A hidden name until the job commits: an attempt that fails or repeats leaves no lines.
            task = TaskContext.get().partitionId()
            message.name = f"part-{task:05d}-{uuid.uuid4().hex}.txt"
            message.lines = 0
            with system.open_output_stream(f"{folder}/.{message.name}", buffer_size=1 << 20) as out:
                key = member = None
                for now, name in rows:
                    if now != key:
                        out.write(f"{']' + chr(10) if key is not None else ''}{now}\t[{name}".encode())
                        message.lines += 1
                    elif name != member:
                        out.write(f", {name}".encode())
                    key, member = now, name
                if key is not None:
                    out.write(b"]\n")
            return message

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            system, folder = self._folder()
            system.create_dir(folder, recursive=True)
            for message in messages:
                if message is not None and message.lines:
                    system.move(f"{folder}/.{message.name}", f"{folder}/{message.name}")

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            pass  # hidden files go with the folder

    class MemberLines(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return LineWriter(self.options["path"])

    return MemberLines


def write_member_lines(rows: DataFrame, key: Column, member: Column, path: str) -> None:
    """One ``key<TAB>[a, b]`` line per key, its distinct members sorted, replacing what was at ``path``.

    ``rows`` has a row per key and member, in any order and repeated at will; rows with a
    null are left out. All rows of a key meet in one task, as its line is in one file, but
    only the sort holds them, and it spills. Keys are sorted within a file.
    """
    spark = rows.sparkSession
    spark.dataSource.register(_source())
    pairs = rows.select(key.cast("string").alias("key"), member.cast("string").alias("member")).dropna()
    ordered = pairs.repartition("key").sortWithinPartitions("key", "member")
    replace_folder(spark, path, lambda fresh: ordered.write.format(FORMAT).mode("append").save(fresh))
