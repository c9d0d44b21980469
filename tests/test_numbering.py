import struct

import pytest
import xxhash
from pyspark.sql import functions as F


from proofs import scans
from tidelake.lake import Lake
from tidelake.operators.numbering import (
    chunk_number, preview, preview_tables, sample_by_key, sample_every_nth, surrogate_key,
)
from tidelake.sinks.ranges import base_of_range
from tidelake.sources.csv import number_lines, sample_lines


def numbers(df, name="dwid"):
    return sorted(r[name] for r in df.collect())


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_are_dense_in_any_order(spark, parts):
    df = spark.range(1000).repartition(parts)
    numbered = surrogate_key(df)
    assert numbered.columns == ["dwid", "id"]
    assert dict(numbered.dtypes)["dwid"] == "bigint"
    rows = numbered.collect()
    assert sorted(r.dwid for r in rows) == list(range(1, 1001))
    assert sorted(r.id for r in rows) == list(range(1000))
    again = numbered.collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(5)
    for unique in (True, False):
        rows = surrogate_key(df, "n", ["k"], unique).collect()
        assert sorted((r.k, r.n) for r in rows) == [(i, i + 1) for i in range(1000)]


def test_a_large_group_of_equal_rows_is_spread(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id")).alias("k")
    ).repartition(6)
    rows = surrogate_key(df, "n", ["k"]).collect()
    assert sorted(r.n for r in rows) == list(range(1, 3001))
    by_number = [r.k for r in sorted(rows, key=lambda r: r.n)]
    assert by_number == sorted(by_number)


def test_rows_in_skewed_partitions_and_none_at_all(spark):
    skewed = spark.range(500).repartitionByRange(4, F.when(F.col("id") < 490, 0).otherwise(F.col("id")))
    assert numbers(surrogate_key(skewed)) == list(range(1, 501))
    assert surrogate_key(spark.range(0)).collect() == []
    assert surrogate_key(spark.range(0), "n", ["id"]).collect() == []
    with pytest.raises(ValueError):
        surrogate_key(spark.range(3), "id")


def test_numbers_of_files_cut_by_a_record_limit(spark):
    names = {
        "part-00001-1f4b0a52-c123-4c5d-9e1f-c77a00aa11bb-c012.snappy.parquet": 12,
        "part-00001-1f4b0a52-c123-4c5d-9e1f-c77a00aa11bb.c003.snappy.parquet": 3,
        "part-00001-c4b0a522-aaaa-4c5d-9e1f-177a00aa11bb.parquet": 0,
    }
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = df.select("name", chunk_number(F.col("name")).alias("chunk")).collect()
    assert {r.name: r.chunk for r in found} == names
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        rows = surrogate_key(spark.range(200), "n", ["id"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted((r.id, r.n) for r in rows) == [(i, i + 1) for i in range(200)]


@pytest.mark.parametrize("rows, want", [(0, []), (99, []), (100, [99]), (1000, None)])
def test_every_hundredth_row(spark, rows, want):
    got = numbers(sample_every_nth(spark.range(rows), 100, ["id"], unique=True), "id")
    assert got == (list(range(99, 1000, 100)) if want is None else want)


def test_lines_are_numbered_within_each_file(spark, tmp_path):
    sizes = {"a.csv": 0, "b.csv": 99, "c.csv": 100, "d.csv": 1000, "e.csv": 2501}
    for name, size in sizes.items():
        (tmp_path / name).write_text("".join(f"{name},{i + 1}\n" for i in range(size)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 5
        rows = number_lines(lines).collect()
        assert len(rows) == sum(sizes.values())
        assert all(r.value.split(",")[1] == str(r.line) for r in rows)
        got = sorted(r.value for r in sample_lines(spark, str(tmp_path), 100).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [
        f"{name},{i}" for name, size in sizes.items() for i in range(100, size + 1, 100)
    ]
    assert got == sorted(want)


def test_preview(spark):
    assert preview(spark.range(10)).count() == 1
    assert [r.id for r in preview(spark.range(10), 2, [F.desc("id")]).collect()] == [9, 8]
    spark.range(3).createOrReplaceTempView("t_preview")
    shown = preview_tables(Lake(spark, "unused"), ["t_preview"])
    assert shown["t_preview"].count() == 1


def chosen(key, n, pick=0):
    """Whether a bigint key is in the sample: xxHash64 with seed 42 of its 8 bytes, signed."""
    code = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    return (code - (1 << 64 if code >> 63 else 0)) % n == pick


def test_sample_by_key(spark):
    df = spark.range(-500, 2000).withColumn("other", F.lit(1))
    for pick in (0, 3):
        got = numbers(sample_by_key(df.repartition(5), 10, ["id"], pick), "id")
        assert got == [k for k in range(-500, 2000) if chosen(k, 10, pick)]
    # All remainders together are the table, and a key is there with all of its rows.
    parts = [sample_by_key(df.union(df), 4, ["id"], pick).count() for pick in range(4)]
    assert sum(parts) == 5000 and all(p % 2 == 0 for p in parts)
    nothing = spark.createDataFrame([(None,)] * 3, "id bigint")
    assert sum(sample_by_key(nothing, 4, ["id"], pick).count() for pick in range(4)) == 3
    with pytest.raises(ValueError):
        sample_by_key(df, 4, ["id"], 4)


def test_sample_by_key_does_not_shuffle(spark, capsys):
    sample_by_key(spark.range(9), 3, ["id"]).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_sample_by_key_query(spark):
    sf = "/root/testdata/sf0.001"
    orders = [r.o_orderkey for r in spark.read.parquet(f"{sf}/orders.parquet").collect()]
    lines = [r.l_orderkey for r in spark.read.parquet(f"{sf}/lineitem.parquet").collect()]
    got = scans.every_nth_key(spark, sf).collect()
    sampled = {k for k in orders if chosen(k, 100)}
    assert {r.o_orderkey for r in got} == sampled
    assert sum(r.l_orderkey is not None for r in got) == sum(k in sampled for k in lines)


def test_ranges_never_overlap(spark, path):
    base = lambda part, n: base_of_range(spark, path, part, n)
    assert [base("a", 10), base("b", 5), base("a", 8), base("a", 10)] == [0, 10, 0, 0]
    assert base("a", 11) == 15  # outgrown
    assert [base("b", 5), base("a", 11), base("a", 3), base("c", 0)] == [10, 15, 0, 26]


def test_a_base_shifts_the_numbers(spark):
    counted = []
    df = surrogate_key(spark.range(7), "n", base_of=lambda n: counted.append(n) or 100)
    assert numbers(df, "n") == list(range(101, 108)) and counted == [7]


@pytest.mark.parametrize("order", [[], ["k"]])
def test_rows_to_number_are_picked_once(spark, order):
    """Not also for the sample that finds the ranges of the order."""
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(5)
    counted, seen = [], spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def third(k):
        seen.add(1)
        return k % 3 == 0

    def keep(rows):
        return rows.filter(third.asNondeterministic()("k"))

    numbered = surrogate_key(df, "n", order, True, lambda n: counted.append(n) or 100, keep)
    rows = numbered.collect()
    assert counted == [334] and seen.value == 1000
    assert sorted(r.k for r in rows) == list(range(0, 1000, 3))
    assert sorted(r.n for r in rows) == list(range(101, 435))
    assert not order or all(r.n == 101 + r.k // 3 for r in rows)
