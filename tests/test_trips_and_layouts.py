"""Trip typing, the three layouts, the audit, compaction and the jobs."""

from __future__ import annotations

import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from partwise import jobs
from partwise.operators import layout, trips
from partwise.session import child_session, new_scratch_path, written
from partwise.sources import folders, readers, writers

ROWS = [
    (1, 1, "01/05/2023 11:59:59 PM"),
    (2, 1, "01/31/2023 12:00:00 AM"),
    (3, 2, "01/05/2023 01:00:00 am"),
    (4, 1, "12/05/2023 01:00:00 PM"),
    (5, 1, "1/5/2023 01:00:00 PM"),
    (6, 1, "13/05/2023 01:00:00 PM"),
    (7, 1, "junk"),
    (8, 1, None),
    (9, None, "01/05/2023 01:00:00 PM"),
]


@pytest.fixture
def csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    kind = "trip_id bigint, VendorID int, tpep_pickup_datetime string"
    spark.createDataFrame(ROWS, kind).write.option("header", True).csv(path)
    return path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prepare_keeps_typed_rows(spark, csv):
    for read in (readers.read_trips(spark, csv), readers.read_trips(spark, csv, infer=True)):
        found = trips.prepare_trips(read).orderBy("trip_id").collect()
        assert [(int(r.trip_id), r.VendorID, r.Month) for r in found] == [
            (1, 1, 1), (2, 1, 1), (3, 2, 1), (4, 1, 12),
        ]
        assert found[0].Pickup_Datetime.hour == 23 and found[1].Pickup_Datetime.hour == 0


def test_dates_are_parsed_once(spark, csv):
    plan = plan_of(trips.prepare_trips(readers.read_trips(spark, csv)))
    assert plan.count("gettimestamp") == 1 and "IsNotNull(VendorID)" in plan


def test_three_layouts_agree_and_prune(spark, csv, tmp_path):
    prepared = trips.prepare_trips(readers.read_trips(spark, csv))
    flat, parts = str(tmp_path / "flat"), str(tmp_path / "parts")
    writers.write_flat(prepared, flat)
    writers.write_partitioned(prepared, parts, trips.PARTITION_KEYS)
    as_text = trips.with_month(readers.read_trips_as_text(spark, csv))
    counts = {
        "csv": trips.count_where(as_text, trips.vendor_month("1", 1)),
        "flat": trips.count_where(spark.read.parquet(flat), trips.vendor_month(1, 1)),
        "partitioned": trips.count_where(readers.read_prepared(spark, parts), trips.vendor_month(1, 1)),
    }
    assert set(spark.read.parquet(parts).dtypes) == set(readers.read_prepared(spark, parts).dtypes)
    assert {name: df.first().n for name, df in counts.items()} == dict.fromkeys(counts, 2)
    pruned = plan_of(counts["partitioned"])
    assert "PushedFilters: []" in pruned and "ReadSchema: struct<>" in pruned
    assert "isnotnull(VendorID" in pruned.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan_of(counts["flat"])
    assert "EqualTo(VendorID,1)" in pushed and "ReadSchema: struct<VendorID:int,Month:int>" in pushed


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 2):
        writers.write_partitioned(spark.range(n).withColumn("k", F.lit(1)), path, ["k"])
        assert spark.read.parquet(path).count() == n


def test_large_partition_is_split_into_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    small = child_session(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=2 * 1024 * 1024)
    wide = small.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") < 190_000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") / 1000).cast("int").cast("string"))).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    writers.write_partitioned(wide, path, ["k"])
    audit = {r.k: r.files for r in layout.layout_audit(spark, path, ["k"]).collect()}
    assert audit.pop("hot") > 3
    assert set(audit.values()) == {1} and len(audit) == 10
    assert spark.read.parquet(path).count() == 200_000


def test_audit_reads_escaped_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "odd")
    keys = ["a/b", "x=y", "1+1 %", None]
    spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k string").write.partitionBy("k").parquet(path)
    audit = layout.layout_audit(spark, path, ["k"]).collect()
    assert {r.k for r in audit} == set(keys)
    assert all(r.files == r.blocks == r.small_files == 1 and not r.fragmented for r in audit)


def test_audit_flags_fragments(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(40).repartition(8).withColumn("k", F.lit("x")).write.partitionBy("k").parquet(path)
    row = layout.layout_audit(spark, path, ["k"]).first()
    assert (row.files, row.blocks, row.small_files, row.fragmented) == (8, 8, 8, True)
    assert row.bytes == layout.directory_size(spark, path).first().bytes


def test_bytes_behind_a_partition(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.range(1000).withColumn("k", (F.col("id") / 500).cast("int")).write.partitionBy("k").parquet(path)
    whole = layout.bytes_behind(spark, path).first().bytes
    first = layout.bytes_behind(spark, path, ["k"], F.col("k") == "0").first().bytes
    second = layout.bytes_behind(spark, path, ["k"], F.col("k") == "1").first().bytes
    assert 0 < first < whole and first + second == whole


def test_compaction_keeps_every_line(spark, tmp_path):
    src, one, some = (str(tmp_path / name) for name in ("src", "one", "some"))
    lines = spark.range(5000).select(F.concat(F.lit("line "), F.col("id")).alias("value"))
    lines.repartition(50).write.text(src)
    writers.compact_lines(spark, src, one)
    writers.compact_lines(spark, src, some, target_bytes=16 * 1024)
    assert layout.directory_size(spark, one).first().files == 1
    assert 3 <= layout.directory_size(spark, some).first().files <= 8
    wanted = sorted(r.value for r in lines.collect())
    for path in (one, some):
        assert sorted(r.value for r in spark.read.text(path).collect()) == wanted


def test_tsv_is_sorted_across_files_and_read_back(spark, tmp_path):
    path = str(tmp_path / "tsv")
    rows = [("404", 2), ("STATUS", 1), ("0404", 7), ("a", 3), ("", 5)]
    df = spark.createDataFrame(rows, "k string, n bigint").repartition(3)
    writers.write_tsv(df, F.col("k"), F.col("n"), path)
    back = readers.read_tsv(spark, path, "k", "n", "bigint")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    parts = sorted((tmp_path / "tsv").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text == "\t5\n0404\t7\n404\t2\nSTATUS\t1\na\t3\n"


def test_tsv_sorted_within_files(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), "id")
    writers.write_tsv(df, F.col("k"), F.col("id"), str(tmp_path / "tsv"), files=2)
    parts = [p.read_text().splitlines() for p in (tmp_path / "tsv").glob("part-*")]
    assert len(parts) == 2 and sum(map(len, parts)) == 100
    assert all(part == sorted(part, key=lambda line: line.split("\t")[0]) for part in parts)


def test_child_session_leaves_the_parent_alone(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    assert child_session(spark, spark__sql__files__maxPartitionBytes=7).conf.get(key) == "7"
    assert spark.conf.get(key) == before


def test_written_rows_stay_the_same(spark):
    df = written(spark.range(100).withColumn("r", F.rand()), "random")
    assert df.collect() == df.collect()


def test_scratch_paths_differ(spark):
    assert new_scratch_path(spark, "x") != new_scratch_path(spark, "x")


def test_log_jobs(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    lines = ["# c", "d|i|/x|404|1", "d|i|/x|404|1", "d|i|/x|500|1", "d|i|/x|200|1", "d|i", "d|i|/x|?|1"]
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(src)
    counters = {r.counter: r.n for r in jobs.error_count(spark, src, dst).collect()}
    assert counters == {
        "Lignes malformées": 1, "Erreurs émises": 3, "Requêtes OK ignorées": 1, "Codes invalides": 1,
    }
    assert sorted(r.value for r in spark.read.text(dst).collect()) == ["404\t2", "500\t1"]
    found = {r.status: r.n for r in jobs.status_count(spark, src, dst).collect()}
    assert found == {"404": 2, "500": 1, "200": 1, "?": 1}


def test_friend_jobs(spark, tmp_path):
    tab, arrow, dst = (str(tmp_path / name) for name in ("tab", "arrow", "out"))
    spark.createDataFrame([("A\tB,C,D",), ("E\tB,C",), ("x",)], "value string").write.text(tab)
    counters = {r.counter: r.n for r in jobs.friend_list_intersection(spark, tab, dst).collect()}
    assert counters == {
        "Lignes malformées": 1, "Utilisateurs traités": 2, "Paires avec amis communs": 2,
    }
    assert sorted(r.value for r in spark.read.text(dst).collect()) == ["(B,D)\t[C]", "(C,D)\t[B]"]
    spark.createDataFrame([("A -> B,C",), ("E -> C,B",)], "value string").write.text(arrow)
    assert [tuple(r) for r in jobs.common_friends(spark, arrow, dst).collect()] == [("Paires avec amis communs", 1)]
    assert [r.value for r in spark.read.text(dst).collect()] == ["B,C\t[A, E]"]  # the lines stay in the output


def test_trip_jobs(spark, csv, tmp_path):
    dst = str(tmp_path / "layouts")
    audit = jobs.partition_trips(spark, csv, dst).collect()
    assert {(r.VendorID, r.Month) for r in audit} == {("1", "1"), ("2", "1"), ("1", "12")}
    found = {r.layout: r for r in jobs.compare_layouts(spark, csv, dst).collect()}
    assert {name: r.n for name, r in found.items()} == {"csv": 2, "flat": 2, "partitioned": 2}
    assert all(r.bytes > 0 and r.seconds > 0 for r in found.values())


def test_trips_are_known_by_their_names(spark, tmp_path):
    path = str(tmp_path / "other.csv")
    rows = [("9.5", "01/05/2023 11:59:59 PM", "x", "2"), ("1", "junk", "y", "1"), ("3", "02/05/2023 01:00:00 AM", None, "?")]
    kind = "fare string, tpep_pickup_datetime string, note string, VendorID string"
    spark.createDataFrame(rows, kind).write.option("header", True).csv(path)
    read = readers.read_trips(spark, path)
    assert read.columns == ["fare", "tpep_pickup_datetime", "note", "VendorID"]
    found = trips.prepare_trips(read).collect()
    assert [(r.fare, r.note, r.VendorID, r.Month) for r in found] == [("9.5", "x", 2, 1)]
    dst = str(tmp_path / "layouts")
    jobs.partition_trips(spark, path, dst)
    assert set(spark.read.parquet(f"{dst}/partitioned").columns) == {*read.columns, "Pickup_Datetime", "Month"}
    assert spark.read.option("header", True).csv(f"{dst}/audit").count() == 1


def test_partitioned_trips_come_from_the_flat_ones(spark, csv, tmp_path, monkeypatch):
    scans = []
    read = readers.read_trips_as_text
    monkeypatch.setattr(readers, "read_trips_as_text", lambda *a: scans.append(a) or read(*a))
    jobs.partition_trips(spark, csv, str(tmp_path / "layouts"))
    assert len(scans) == 1


def test_first_lines_follow_the_paths(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "a.txt").write_text("a1\na2\n")
    (folder / "b.txt").write_text("".join(f"b{i}\n" for i in range(5000)))
    (folder / "c.txt").write_text("c1\n")
    small = child_session(spark, spark__sql__files__maxPartitionBytes=4096)
    for session in (spark, small):
        for n in (1, 2, 4, 3000, 5002, 9999):
            found = sorted(map(tuple, readers.first_lines(session, str(folder), n).collect()))
            want = ["a1", "a2", *(f"b{i}" for i in range(5000)), "c1"][:n]
            assert found == list(enumerate(want, 1))


def test_tsv_lines_without_tab_or_number(spark, tmp_path):
    path = str(tmp_path / "odd")
    spark.createDataFrame([("a\t1",), ("b",), ("c\tx",), ("d\t2\t3",), ("",)], "value string").write.text(path)
    found = sorted(map(tuple, readers.read_tsv(spark, path, "k", "n", "bigint").collect()))
    assert found == [("", None), ("a", 1), ("b", None), ("c", None), ("d", None)]


def test_inventory_tasks_do_not_follow_bytes(spark, tmp_path):
    path = str(tmp_path / "files")
    small = child_session(spark, spark__sql__files__maxPartitionBytes=1024, spark__sql__files__openCostInBytes=0)
    small.range(20_000).repartition(60).write.parquet(path)
    files = readers.file_inventory(small, path)
    assert files.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert files.count() >= 60


def test_pair_lines_need_no_range_shuffle(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), "id")
    path = tmp_path / "pairs"
    writers.write_tsv(df, F.col("k"), F.col("id"), str(path), per_file=True)
    for part in path.glob("part-*"):
        keys = [line.split("\t")[0] for line in part.read_text().splitlines()]
        assert keys == sorted(keys)


def contents(path):
    return {p.name: (p.stat().st_mtime_ns, p.read_bytes()) for p in path.iterdir() if not p.name.startswith(("_", "."))}


def test_a_failed_overwrite_leaves_the_first_result(spark, tmp_path):
    path = str(tmp_path / "result")
    good = spark.range(50).withColumn("k", F.col("id") % 3)
    bad = good.withColumn("id", F.when(F.col("id") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    for write in (
        lambda df: writers.write_flat(df, path),
        lambda df: writers.write_partitioned(df, path, ["k"]),
        lambda df: writers.write_tsv(df, F.col("id"), F.col("k"), path),
    ):
        write(good)
        kept = sorted(p.name for p in (tmp_path / "result").iterdir())
        with pytest.raises(Exception, match="broken"):
            write(bad)
        assert sorted(p.name for p in (tmp_path / "result").iterdir()) == kept
    assert readers.read_tsv(spark, path, "id", "k").count() == 50
    assert [p.name for p in tmp_path.iterdir()] == ["result"]  # nothing is left over


def test_failed_renames_are_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "keyed")
    rows = spark.range(60).withColumn("k", F.col("id") % 4)
    writers.write_partitioned(rows, path, ["k"])
    move, moves = folders.Renames.move, []

    def failing(self, src, dst):
        moves.append(src)
        if len(moves) == 4:
            raise OSError("no more")
        move(self, src, dst)

    monkeypatch.setattr(folders.Renames, "move", failing)
    with pytest.raises(OSError, match="no more"):
        writers.update_partitioned(rows.filter("id < 8"), path, ["k"])
    monkeypatch.setattr(folders.Renames, "move", move)
    assert spark.read.parquet(path).count() == 60
    writers.update_partitioned(rows.filter("id < 8 and k < 2"), path, ["k"])
    counts = {r.k: r["count"] for r in spark.read.parquet(path).groupBy("k").count().collect()}
    assert counts == {0: 2, 1: 2, 2: 15, 3: 15}


def test_compaction_in_place_leaves_full_files_alone(spark, tmp_path, monkeypatch):
    folder = tmp_path / "logs"
    folder.mkdir()
    (folder / "full").write_text("".join(f"full line {i}\n" for i in range(1000)))
    for i in range(30):
        (folder / f"small-{i:02d}").write_text(f"small line {i}\n" * 3)
    before = contents(folder)
    lines = sorted(r.value for r in spark.read.text(str(folder)).collect())
    target = len(before["full"][1])
    move, moves = folders.Renames.move, []

    def failing(self, src, dst):
        moves.append(src)
        if len(moves) == 31:
            raise OSError("no more")
        move(self, src, dst)

    monkeypatch.setattr(folders.Renames, "move", failing)
    with pytest.raises(OSError, match="no more"):
        folders.compact_folder(spark, str(folder), target_bytes=target)
    assert contents(folder) == before
    monkeypatch.setattr(folders.Renames, "move", move)
    folders.compact_folder(spark, str(folder), target_bytes=target)
    after = contents(folder)
    assert after["full"] == before["full"] and len(after) == 2
    assert sorted(r.value for r in spark.read.text(str(folder)).collect()) == lines
    folders.compact_folder(spark, str(folder), target_bytes=target)
    assert contents(folder) == after  # one small file is left as it is


def test_bytes_read_follow_columns_and_row_groups(spark, tmp_path):
    """Against the footers read here, file by file."""
    path = tmp_path / "table"
    wide = spark.range(0, 4000, 1, 4).withColumns({"k": F.col("id") % 2, "text": F.sha2(F.col("id").cast("string"), 256)})
    wide.write.partitionBy("k").parquet(str(path))
    sizes = {"id": 0, "text": 0}
    within = {"id": 0, "rows": 0, "files": 0}
    for file in path.rglob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        for i in range(footer.num_row_groups):
            for j in range(footer.num_columns):
                chunk = footer.row_group(i).column(j)
                sizes[chunk.path_in_schema] += chunk.total_compressed_size
                if chunk.path_in_schema == "id" and chunk.statistics.min <= 1001 <= chunk.statistics.max and "k=1" in str(file):
                    within["id"] += chunk.total_compressed_size
                    within["rows"] += footer.row_group(i).num_rows
                    within["files"] += 1
    whole = layout.bytes_read(spark, str(path), ["id"]).first()
    assert (whole.rows, whole.bytes, whole.file_bytes, whole.files) == (4000, sizes["id"], sum(sizes.values()), 8)
    some = layout.bytes_read(spark, str(path), ["id"], ["k"], F.col("k") == "1", {"id": 1001}).first()
    assert (some.rows, some.bytes, some.files) == (within["rows"], within["id"], within["files"]) and some.files == 1
    assert tuple(layout.bytes_read(spark, str(path), ["id"], equal={"id": -5}).first()) == (0, 0, 0, 0)


def test_comparison_takes_turns(spark, tmp_path):
    spark.range(9).write.parquet(str(tmp_path / "t"))
    count = spark.read.parquet(str(tmp_path / "t")).agg(F.count("*").alias("n"))
    entry = layout.Layout(count, layout.bytes_behind(spark, str(tmp_path / "t")))
    rows = layout.compare_layouts(spark, {"a": entry, "b": entry}, runs=3).collect()
    assert [(r.layout, r.n) for r in rows] == [("a", 9), ("b", 9)] and all(0 <= r.spread and r.seconds > 0 for r in rows)


def test_inference_reads_the_csv_once(spark, tmp_path):
    """The narrowest type that takes every value of all files, and one scan of the CSV."""
    path = str(tmp_path / "typed")
    rows = [
        ("1", "1", "1.5", "2024-01-31", "2024-01-31 10:00:00", "true", None, " 1", "x"),
        (None, "3000000000", "-2", "2024-02-01", "2024-02-01 00:00:00", "FALSE", None, "2", "1"),
    ]
    names = ["i", "l", "d", "day", "at", "flag", "none", "spaced", "te.xt"]
    frame = spark.createDataFrame(rows * 50, ", ".join(f"`{name}` string" for name in names))
    frame.repartition(4).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    read = readers.read_trips(spark, path, infer=True)
    kinds = ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string", "string"]
    assert read.dtypes == list(zip(names, kinds, strict=True))
    assert read.count() == 100 and read.where("i = 1 and d = 1.5 and flag").count() == 50
    assert "csv" not in read._jdf.queryExecution().executedPlan().toString().lower()


def test_files_listed_by_tasks(spark, tmp_path):
    """The same rows as the listing by the driver: nested folders, hidden names, odd characters, files at the top."""
    root = tmp_path / "lay out"
    for name in ("a=1/b=x y", "a=1/b=%2F", "a=2", "_hidden", ".dot", "_k=1", "empty"):
        (root / name).mkdir(parents=True)
        if name != "empty":
            (root / name / "part-0").write_text("x" * len(name))
            (root / name / "_SUCCESS").write_text("")
    (root / "top").write_text("abc")
    found = sorted(map(tuple, readers.listed_files(spark, str(root)).select("path", "length").collect()))
    assert found == sorted(map(tuple, readers.file_inventory(spark, str(root)).select("path", "length").collect()))
    assert len(found) == 5
    plan = readers.listed_files(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "InMemoryFileIndex" not in plan


def test_lines_sorted_per_file_are_not_shuffled(spark, tmp_path):
    """Before, all lines went through a shuffle by their key."""
    path = tmp_path / "lines"
    rows = spark.range(40, numPartitions=3).select((F.lit(99) - F.col("id")).alias("k"), F.spark_partition_id().alias("at"))
    writers.write_tsv(rows, F.col("k"), F.col("at"), str(path), per_file=True)
    files = [[line.split("\t") for line in file.read_text().splitlines()] for file in path.glob("part-*")]
    assert sorted(len(file) for file in files) == [13, 13, 14]
    assert all(len({at for _, at in file}) == 1 and file == sorted(file) for file in files)


def test_small_log_files_need_few_tasks(spark, monkeypatch, tmp_path):
    """Before, a task wrote each small file, so tasks grew with the files and shuffle blocks with their square."""
    from partwise.plans import derived

    rows = spark.range(1103, numPartitions=5).select(F.col("id").cast("string").alias("value"))
    monkeypatch.setattr(derived, "log_lines", lambda *_: rows.unionByName(rows.limit(0)))
    monkeypatch.setattr(derived, "LINES_PER_FILE", 10)
    monkeypatch.setattr(derived, "FILES_PER_TASK", 4)
    path = derived.small_log_files(spark, str(tmp_path))
    read = spark.read.text(path)
    assert sorted(int(r.value) for r in read.collect()) == list(range(1103))
    sizes = [len(Path(file.removeprefix("file:")).read_text().splitlines()) for file in read.inputFiles()]
    assert sorted(sizes) == [3] + [10] * 110
    tasks = {re.search(r"part-(\d+)", file).group(1) for file in read.inputFiles()}
    assert len(tasks) <= 28
