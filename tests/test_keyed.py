import os

import pytest
from pyspark.sql import functions as F

from tidelake.operators.keyed import (
    incremental_scan, latest_commit, precombine, scan_since_latest_commit, stamp_commit,
)
from tidelake.schemas import struct_of
from tidelake.sinks.keyed import upsert_partitioned, upsert_unpartitioned
from tidelake.sources.tables import (
    commits_of, current_snapshot, incremental_table_scan, latest_table_commit,
    partitioned_parquet_scan, scan_commits, snapshot_scan,
)
from tidelake.versions import (
    current_folders, merge_log, part_name, read_folders, remove_unpublished, replace_partitions,
)

COLUMNS = "k bigint, v string, ts bigint, p string"
SCHEMA = struct_of("k bigint, v string, ts bigint, _commit_time string, p string")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_precombine_keeps_the_largest_and_breaks_ties(spark):
    df = batch(
        spark, (1, "old", 1, "a"), (1, "new", 2, "a"), (2, "x", 5, "a"), (2, "y", 5, "a"),
        (3, None, None, "a"), (3, "n", None, "a"), (3, "z", 1, None),
    )
    assert rows(precombine(df, ["k"], "ts")) == [
        (1, "new", 2, "a"), (2, "y", 5, "a"), (3, "z", 1, None),
    ]
    assert rows(precombine(df, ["k"], "ts", ["p"]))[-2:] == [(3, "n", None, "a"), (3, "z", 1, None)]


def test_precombine_combines_before_the_shuffle(spark, capsys):
    precombine(batch(spark, (1, "a", 1, "p")), ["k"], "ts").explain()
    text = capsys.readouterr().out
    assert "partial_max" in text.split("Exchange hashpartitioning")[1]


def test_a_null_key_is_an_error(spark):
    with pytest.raises(Exception, match="record key k is NULL"):
        precombine(batch(spark, (None, "a", 1, "p")), ["k"], "ts").collect()


def test_stamp(spark):
    assert stamp_commit(spark.range(1), "20200101000000").first()._commit_time == "20200101000000"


def upsert(df, path, instant, **options):
    upsert_partitioned(df, path, ["k"], "ts", ["p"], instant, **options)


def read(spark, path):
    return partitioned_parquet_scan(spark, path, SCHEMA)


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def test_upsert_rewrites_touched_partitions_only(spark, path):
    upsert(batch(spark, (1, "a", 9, "x"), (2, "b", 1, "x"), (3, "c", 1, "y"), (4, "d", 1, None)),
           path, "01")
    before = files(path)
    second = batch(spark, (1, "A", 1, "x"), (5, "e", 1, "x"), (4, "D", 2, None), (4, "D1", 1, None))
    upsert(second, path, "02")
    want = [
        (1, "A", 1, "02", "x"), (2, "b", 1, "01", "x"), (3, "c", 1, "01", "y"),
        (4, "D", 2, "02", None), (5, "e", 1, "02", "x"),
    ]
    assert rows(read(spark, path)) == want
    after = files(path)
    assert {f for f in before if "p=y" in f} == {f for f in after if "p=y" in f}
    assert all(after[f] == before[f] for f in before if "p=y" in f)
    upsert(second, path, "02")  # a rerun changes nothing
    assert rows(read(spark, path)) == want


def test_a_stored_row_with_a_larger_value_may_be_kept(spark, path, tmp_path):
    first = batch(spark, (1, "a", 9, "x"), (2, "b", 1, "x"))
    second = batch(spark, (1, "A", 1, "x"), (2, "B", 1, "x"), (3, "C", 0, "x"))
    want = [(1, "a", 9, "01"), (2, "B", 1, "02"), (3, "C", 0, "02")]
    upsert(first, path, "01")
    upsert(second, path, "02", keep_newer=True)
    assert rows(read(spark, path), "k", "v", "ts", "_commit_time") == want
    whole = str(tmp_path / "whole")
    for df, instant in ((first, "01"), (second, "02")):
        upsert_unpartitioned(df, whole, ["k"], "ts", instant, keep_newer=True)
    assert rows(snapshot_scan(spark, whole), "k", "v", "ts", "_commit_time") == want


def test_a_moved_key_stays_in_both_partitions_unless_it_is_global(spark, path, tmp_path):
    first = batch(spark, (1, "a", 1, "x"), (2, "b", 1, "x/y z"), (3, "c", 1, "z"))
    moved = batch(spark, (1, "A", 2, "z"), (2, "B", 2, "z"), (9, "I", 2, None))
    upsert(first, path, "01")
    upsert(moved, path, "02")
    assert rows(read(spark, path), "k", "p") == [
        (1, "x"), (1, "z"), (2, "x/y z"), (2, "z"), (3, "z"), (9, None),
    ]
    other = str(tmp_path / "global")
    upsert(first, other, "01", global_key=True)
    upsert(moved, other, "02", global_key=True)
    want = [(1, "A", "z"), (2, "B", "z"), (3, "c", "z"), (9, "I", None)]
    assert rows(read(spark, other), "k", "v", "p") == want
    upsert(batch(spark, (9, "J", 3, "x")), other, "03", global_key=True, schema=SCHEMA)
    assert rows(read(spark, other), "k", "v", "p")[-1] == (9, "J", "x")


def test_upsert_reads_only_touched_partitions_however_many(spark, path):
    many = spark.range(300).select(
        F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).cast("bigint").alias("ts"),
        F.concat(F.lit("p,{1} "), F.col("id").cast("string")).alias("p"),
    ).coalesce(1)
    upsert(many, path, "01")
    before = set(read(spark, path).inputFiles())
    few = many.filter("k < 250")
    touched = {part_name(r.asDict()) for r in few.select("p").collect()}
    stored = read_folders(
        spark, path, SCHEMA, list(current_folders(spark, path, parts=touched).values())
    )
    assert len(stored.inputFiles()) == 250 and stored.count() == 250
    upsert(few.withColumn("v", F.lit("b")), path, "02", schema=SCHEMA)
    got = read(spark, path)
    assert got.filter("v = 'b'").count() == 250 and got.filter("v = 'a'").count() == 50
    assert len(before & set(got.inputFiles())) == 50
    assert current_folders(spark, path, parts={part_name({"p": "nowhere"})}) == {}


def test_empty_batches(spark, path, tmp_path):
    empty = batch(spark, (1, "a", 1, "x")).limit(0)
    upsert(empty, path, "01")
    upsert(batch(spark, (1, "a", 1, "x")), path, "02")
    upsert(empty, path, "03")
    assert rows(read(spark, path), "k", "_commit_time") == [(1, "02")]
    whole = str(tmp_path / "whole")
    for df, instant in ((empty, "01"), (batch(spark, (1, "a", 1, "x")), "02"), (empty, "03")):
        upsert_unpartitioned(df, whole, ["k"], "ts", instant)
    assert rows(snapshot_scan(spark, whole), "k", "_commit_time") == [(1, "02")]


def test_new_and_missing_columns(spark, path):
    upsert(batch(spark, (1, "a", 1, "x"), (2, "b", 1, "x")), path, "01")
    wider = batch(spark, (1, "A", 2, "x")).drop("v").withColumn("w", F.lit(5))
    upsert(wider, path, "02")
    got = spark.read.option("mergeSchema", True).parquet(path)
    assert rows(got, "k", "v", "w") == [(1, None, 5), (2, "b", None)]
    with pytest.raises(ValueError):
        upsert(wider, path, "03", schema=SCHEMA)


def test_unpartitioned_upsert_switches_snapshots(spark, path):
    first = batch(spark, (1, "a", 9, "x"), (2, "b", 1, "y"))
    upsert_unpartitioned(first, path, ["k"], "ts", "01")
    old = snapshot_scan(spark, path)
    upsert_unpartitioned(batch(spark, (1, "A", 1, "z"), (3, "c", 1, "z")), path, ["k"], "ts", "02")
    want = [(1, "A", "02"), (2, "b", "01"), (3, "c", "02")]
    assert rows(snapshot_scan(spark, path), "k", "v", "_commit_time") == want
    assert rows(old, "k", "v") == [(1, "a"), (2, "b")]
    # A rerun of the newest commit reads the snapshot it replaces.
    upsert_unpartitioned(batch(spark, (1, "A", 1, "z"), (3, "c", 1, "z")), path, ["k"], "ts", "02")
    assert rows(snapshot_scan(spark, path), "k", "v", "_commit_time") == want
    # A version that is not in the log does not count.
    first.write.parquet(f"{path}/_bucket=0-of-1/_version=v03")
    assert current_snapshot(spark, path)[0] == "02"
    assert rows(snapshot_scan(spark, path), "k", "v", "_commit_time") == want
    left = remove_unpublished(spark, path, [f"{path}/_bucket=0-of-1/_version=v03"])
    assert len(left) == 1 and rows(snapshot_scan(spark, path), "k", "v", "_commit_time") == want


def test_a_failed_upsert_raises_and_leaves_the_table(spark, path):
    upsert_unpartitioned(batch(spark, (1, "a", 1, "x")), path, ["k"], "ts", "01")
    bad = batch(spark, (1, "A", 1, "x"), (None, "b", 1, "x"))
    with pytest.raises(Exception, match="is NULL"):
        upsert_unpartitioned(bad, path, ["k"], "ts", "02")
    assert rows(snapshot_scan(spark, path), "k", "v") == [(1, "a")]


def commits(spark, path):
    for instant, low in (("20200101", 0), ("20200201", 10), ("20200301", 5)):
        df = spark.range(low, low + 10).select(
            F.col("id").alias("k"), F.lit(instant).alias("v"), F.lit(1).alias("ts"),
            F.when(F.col("id") < 8, "a").otherwise("b").alias("p"),
        )
        upsert_partitioned(df, path, ["k"], "ts", ["p"], f"{instant}000000")
    return partitioned_parquet_scan(
        spark, path, struct_of("k bigint, v string, ts int, _commit_time string, p string")
    )


def keys(df):
    return sorted(r.k for r in df.collect())


def test_incremental_scan(spark, path):
    df = commits(spark, path)
    assert latest_commit(df) == "20200301000000"
    everything = incremental_scan(df, "0")
    assert keys(everything) == list(range(20))
    # An updated key appears only in its last commit.
    assert keys(incremental_scan(df, "0", 1)) == list(range(5))
    assert keys(incremental_scan(df, "0", 2)) == list(range(5)) + list(range(15, 20))
    assert keys(incremental_scan(df, "20200101000000", 1)) == list(range(15, 20))
    assert keys(incremental_scan(df, "20200101000000", 9)) == list(range(5, 20))
    assert keys(incremental_scan(df, "20200301000000", 1)) == []
    assert keys(incremental_scan(df, "20200201000000", where=F.col("p") == "a")) == [5, 6, 7]


def test_commits_add_up_to_the_snapshot(spark, path):
    df = commits(spark, path)
    at, seen = "0", []
    while True:
        part = incremental_scan(df, at, 1)
        if latest_commit(part) is None:
            break
        at = latest_commit(part)
        seen += keys(part)
    assert sorted(seen) == keys(df)


def test_scan_since_the_latest_commit(spark, path):
    df = commits(spark, path)
    assert keys(scan_since_latest_commit(df)) == []
    known = df.filter("_commit_time < '20200301'")
    assert keys(scan_since_latest_commit(df, known)) == list(range(5, 15))
    assert keys(scan_since_latest_commit(df, df.limit(0))) == list(range(20))


def test_commit_bounds_and_partitions_reach_the_scan(spark, path, capsys):
    df = commits(spark, path)
    capsys.readouterr()
    incremental_scan(df, "0", 2, F.col("p") == "a").select("k").explain("formatted")
    text = capsys.readouterr().out
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThan(_commit_time,0)" in pushed and "LessThanOrEqual(_commit_time" in pushed
    assert "(p#" in next(line for line in text.splitlines() if "PartitionFilters" in line)
    assert "v:string" not in text


def test_precombine_of_any_column_type(spark):
    """Maps cannot be compared: they are carried, and ties go by their text."""
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, 1L, map('a', 1), 'x', array(map('n', 1))), (1, 2L, map('b', 2), 'x', NULL),
          (2, 5L, map('a', 1), 'x', NULL), (2, 5L, map('b', 1), 'x', NULL),
          (2, 5L, NULL, 'x', NULL), (3, NULL, NULL, 'y', array(map('n', 2)))
        AS t (k, ts, m, p, a)
    """).repartition(2)
    found = sorted((r.k, r.p, r.m) for r in precombine(df, ["k"], "ts", ["p"]).collect())
    assert found == [(1, "x", {"b": 2}), (2, "x", {"b": 1}), (3, "y", None)]
    variants = df.selectExpr("k", "ts", "parse_json('[' || ts || ']') AS v")
    assert sorted(str(r.v) for r in precombine(variants, ["k"], "ts").collect()) == [
        "None", "[2]", "[5]",
    ]


def test_precombine_of_maps_combines_before_the_shuffle(spark, capsys):
    df = spark.sql("SELECT 1 AS k, 2 AS ts, map('a', 1) AS m")
    precombine(df, ["k"], "ts").explain()
    text = capsys.readouterr().out
    assert "partial_max_by" in text.split("Exchange hashpartitioning")[1]


def test_tables_with_maps_are_upserted_and_rerun(spark, path):
    df = spark.sql("SELECT 1L AS k, map('a', 1) AS v, 1L AS ts, 'x' AS p")
    for instant in ("01", "01", "02"):
        upsert(df, path, instant)
    assert [r.stamp for r in commits_of(spark, path).orderBy("stamp").collect()] == ["01", "02"]
    assert snapshot_scan(spark, path).first().v == {"a": 1}


def test_a_repeated_instant_with_other_rows_is_a_commit_of_its_own(spark, path):
    upsert(batch(spark, (1, "a", 1, "x"), (2, "b", 1, "x")), path, "01")
    upsert(batch(spark, (1, "a", 1, "x"), (3, "c", 1, "y")), path, "01")
    got = rows(read(spark, path), "k", "_commit_time")
    assert got == [(1, "01"), (2, "01"), (3, "01001")]
    upsert(batch(spark, (2, "B", 1, "x")), path, "01")
    assert rows(read(spark, path), "k", "_commit_time")[1] == (2, "01002")
    # None of the first two changes anything when it is given again, and y is not rewritten.
    before = files(path)
    upsert(batch(spark, (2, "B", 1, "x"), (3, "c", 1, "y")), path, "01")
    assert {f for f in files(path) if "_commits" not in f} == {
        f for f in before if "_commits" not in f
    }


def test_a_late_commit_leaves_later_rows_alone(spark, path, tmp_path):
    first, second, late = (
        batch(spark, (1, "a", 1, "x"), (2, "b", 1, "x")),
        batch(spark, (1, "A", 2, "x")),
        batch(spark, (1, "late", 3, "x"), (4, "d", 3, "x"), (2, "B", 3, "x")),
    )
    whole = str(tmp_path / "whole")
    for df, instant in ((first, "01"), (second, "03"), (late, "02"), (first, "01")):
        upsert(df, path, instant)
        upsert_unpartitioned(df, whole, ["k"], "ts", instant, buckets=3)
    want = [(1, "A", "03"), (2, "B", "02"), (4, "d", "02")]
    assert rows(read(spark, path), "k", "v", "_commit_time") == want
    assert rows(snapshot_scan(spark, whole), "k", "v", "_commit_time") == want


def test_only_touched_buckets_are_read_and_rewritten(spark, path, capsys):
    many = spark.range(400).select(
        F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).cast("bigint").alias("ts"),
    )
    upsert_unpartitioned(many, path, ["k"], "ts", "01", buckets=16)
    before = current_folders(spark, path)
    assert len(before) == 16
    one = many.filter("k = 7").withColumn("v", F.lit("b"))
    upsert_unpartitioned(one, path, ["k"], "ts", "02")
    after = current_folders(spark, path)
    moved = {part for part in after if after[part] != before[part]}
    assert len(moved) == 1 and set(after) == set(before)
    rows_now = snapshot_scan(spark, path)
    assert rows_now.count() == 400 and rows_now.filter("v = 'b'").count() == 1
    # A reader of the commit lists one bucket.
    taken = scan_commits(spark, path, None, commits_of(spark, path).filter("stamp = '02'").collect())
    assert rows(taken, "k") == [(7,)] and all(f"/{moved.copy().pop()}/" in f for f in taken.inputFiles())


def test_incremental_table_scans_read_the_log_and_the_partitions_of_the_commits(spark, path, capsys):
    commits(spark, path)
    schema = struct_of("k bigint, v string, ts int, _commit_time string, p string")
    scan = lambda *a, **o: incremental_table_scan(spark, path, schema, *a, **o)
    assert latest_table_commit(spark, path) == "20200301000000"
    assert keys(scan("0")) == list(range(20))
    assert keys(scan("0", 1)) == list(range(5))
    assert keys(scan("20200101000000", 1)) == list(range(15, 20))
    assert keys(scan("20200301000000")) == []
    assert keys(scan("20200201000000", where={"p": "a"})) == [5, 6, 7]
    upsert_partitioned(
        spark.range(99, 100).selectExpr("id AS k", "'v' AS v", "1 AS ts", "'b' AS p"), path, ["k"],
        "ts", ["p"], "20200401000000",
    )
    last = scan("20200301000000")
    assert keys(last) == [99] and all("/p=b/" in f for f in last.inputFiles())
    capsys.readouterr()
    last.explain("formatted")
    text = capsys.readouterr().out
    assert "/p=b/" in text and "/p=a/" not in text
    assert "EqualTo(_commit_time,20200401000000)" in text


def test_a_run_that_fails_before_the_switch_leaves_the_old_rows(spark, path, monkeypatch):
    """All partitions are switched at once, when the log is written."""
    from tidelake import versions

    df = batch(spark, (1, "a", 1, "x"), (2, "b", 1, "y"))
    replace_partitions(df, path, ["p"])
    publish = versions.publish

    def fail(*args):
        raise RuntimeError("the driver dies")

    monkeypatch.setattr(versions, "publish", fail)
    with pytest.raises(RuntimeError):
        replace_partitions(df.withColumn("v", F.lit("new")), path, ["p"])
    with pytest.raises(RuntimeError):
        upsert(df.withColumn("v", F.lit("new")), path, "09")
    schema = struct_of("k bigint, v string, ts bigint, p string")
    now = lambda: rows(partitioned_parquet_scan(spark, path, schema), "k", "v")
    assert now() == [(1, "a"), (2, "b")]
    monkeypatch.setattr(versions, "publish", publish)
    old = current_folders(spark, path)
    replace_partitions(df.withColumn("v", F.lit("new")), path, ["p"])
    assert now() == [(1, "new"), (2, "new")]
    assert not any(os.path.exists(folder) for folder in old.values())


def test_a_merged_log_says_the_same(spark, path, monkeypatch):
    given = [batch(spark, (i, f"v{i}", 1, "xyz"[i % 3])) for i in range(4)]
    for i, df in enumerate(given):
        upsert(df, path, "01" if i < 2 else f"0{i}")
    log = f"{path}/_commits"
    before, commits = rows(read(spark, path)), rows(commits_of(spark, path))
    assert merge_log(spark, log) == 4 and len(spark.read.parquet(log).inputFiles()) == 1
    assert (rows(read(spark, path)), rows(commits_of(spark, path))) == (before, commits)
    assert merge_log(spark, log) == 1  # nothing left to do
    # Used stamps stay used, and late rows still know the later ones.
    upsert(batch(spark, (9, "new", 1, "x")), path, "01")
    assert (9, "01002") in rows(read(spark, path), "k", "_commit_time")
    upsert(batch(spark, (3, "late", 9, "x")), path, "02")  # changes nothing: no commit
    assert (3, "v3") in rows(read(spark, path), "k", "v")
    before, commits = rows(read(spark, path)), rows(commits_of(spark, path))
    latest = latest_table_commit(spark, path)

    def dies(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("tidelake.versions.remove_folders", dies)
        with pytest.raises(OSError):
            merge_log(spark, log)
    assert len(spark.read.parquet(log).inputFiles()) == 3  # merged rows and the ones they repeat
    assert rows(read(spark, path)) == before
    assert rows(commits_of(spark, path).distinct()) == commits
    assert rows(incremental_table_scan(spark, path, SCHEMA, "02")) == [
        r for r in before if r[3] > "02"
    ]
    upsert(batch(spark, (10, "z", 1, "z")), path, "04")
    assert latest_table_commit(spark, path) > latest and len(rows(read(spark, path))) == len(before) + 1
    assert merge_log(spark, log) == 4 and len(spark.read.parquet(log).inputFiles()) == 1
    assert rows(commits_of(spark, path).filter("stamp < '04'")) == commits
