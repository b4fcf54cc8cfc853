"""Whole folders as units: replaced by renames, and compacted where they are.

Spark writes into a fresh folder beside the old one; only names change after that, and
they are put back if one of the changes fails. What is written in part is never seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from partwise.session import child_session

# Fixed value: the block size that a file should fill.
BLOCK_BYTES = 128 * 1024 * 1024
# However small the files, a task opens no more of them than this when it merges them.
FILES_PER_TASK = 65_536


class Renames:
    """Renames on the file system of a path, which ``undo`` takes back in reverse order."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs: JavaObject = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._done: list[tuple[JavaObject, JavaObject]] = []

    def path(self, *parts: str) -> JavaObject:
        found = self._path(parts[0])
        for part in parts[1:]:
            found = self._path(found, part)
        return found

    def exists(self, path: JavaObject) -> bool:
        return bool(self.fs.exists(path))

    def move(self, src: JavaObject, dst: JavaObject) -> None:
        self.fs.mkdirs(dst.getParent())
        if not self.fs.rename(src, dst):
            raise OSError(f"cannot rename {src} to {dst}")
        self._done.append((src, dst))

    def undo(self) -> None:
        for src, dst in reversed(self._done):
            self.fs.rename(dst, src)
        self._done.clear()

    def delete(self, path: JavaObject) -> None:
        self.fs.delete(path, True)

    def below(self, path: JavaObject) -> list[JavaObject]:
        return [status.getPath() for status in self.fs.listStatus(path)]


def _beside(path: str, kind: str) -> str:
    """A hidden name in the same folder, which readers of that folder pass over."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}.{kind}-{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a fresh folder and put that in the place of ``path``.

    If writing or a rename fails, what was at ``path`` is there as before.
    """
    fresh, old = _beside(path, "new"), _beside(path, "old")
    renames = Renames(spark, path)
    there = renames.path(path)
    try:
        write(fresh)
        if renames.exists(there):
            renames.move(there, renames.path(old))
        renames.move(renames.path(fresh), there)
    except BaseException:
        renames.undo()
        raise
    finally:
        renames.delete(renames.path(fresh))
    renames.delete(renames.path(old))


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str], write: Callable[[DataFrame, str], None]) -> None:
    """Replace those ``key=value`` folders of ``path`` that ``df`` has rows for; others stay.

    All folders are written before the first one is replaced; if a rename fails, all are put back.
    """
    spark = df.sparkSession
    fresh, old = _beside(path, "new"), _beside(path, "old")
    renames = Renames(spark, path)

    def folders(at: JavaObject, names: tuple[str, ...]) -> list[tuple[str, ...]]:
        if len(names) == len(keys):
            return [names]
        below = [found for found in renames.below(at) if found.getName().startswith(f"{keys[len(names)]}=")]
        return [full for found in below for full in folders(found, (*names, found.getName()))]

    try:
        write(df, fresh)
        for names in folders(renames.path(fresh), ()):
            there = renames.path(path, *names)
            if renames.exists(there):
                renames.move(there, renames.path(old, *names))
            renames.move(renames.path(fresh, *names), there)
    except BaseException:
        renames.undo()
        raise
    finally:
        renames.delete(renames.path(fresh))
    renames.delete(renames.path(old))


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session whose scans pack small files into splits of about ``target_bytes``.

    Many paths are listed by as many tasks as there are cores, not by a task each.
    """
    return child_session(
        spark,
        spark__sql__files__maxPartitionBytes=target_bytes,
        spark__sql__files__openCostInBytes=target_bytes // FILES_PER_TASK,
        spark__sql__files__minPartitionNum=1,
        spark__sql__sources__parallelPartitionDiscovery__parallelism=spark.sparkContext.defaultParallelism,
    )


def compact_folder(spark: SparkSession, path: str, target_bytes: int = BLOCK_BYTES, full: float = 0.75) -> None:
    """Merge the small text files of a folder, where they are; files near the target stay untouched.

    Files below ``full`` times ``target_bytes`` are small, by the listing; the others are never
    opened. The scan packs the small ones into splits of up to the target, every split becomes
    one file, and only then names change: the small files leave the folder, the new ones enter,
    and if that fails all go back. The lines stay the same. Files that come in meanwhile stay.
    """
    fresh, old = _beside(path, "new"), _beside(path, "old")
    paths = sorted(_files(spark, path, below=int(target_bytes * full)))
    if len(paths) < 2:
        return
    renames = Renames(spark, path)
    try:
        packing_session(spark, target_bytes).read.text(paths).write.text(fresh)
        for file in paths:
            renames.move(renames.path(file), renames.path(old, renames.path(file).getName()))
        stamp = uuid.uuid4().hex
        for file in renames.below(renames.path(fresh)):
            if not file.getName().startswith(("_", ".")):
                renames.move(file, renames.path(path, f"compacted-{stamp}-{file.getName()}"))
    except BaseException:
        renames.undo()
        raise
    finally:
        renames.delete(renames.path(fresh))
    renames.delete(renames.path(old))


def _files(spark: SparkSession, path: str, below: int) -> list[str]:
    """The paths of a folder's visible files of fewer than ``below`` bytes."""
    renames = Renames(spark, path)
    found = renames.fs.listStatus(renames.path(path))
    visible = (s for s in found if s.isFile() and not s.getPath().getName().startswith(("_", ".")))
    return [s.getPath().toString() for s in visible if s.getLen() < below]
