"""Every proof query against its SQL twin, and the plans of some."""

import contextlib
import glob
import io
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import compare
from proofs.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


#: Queries that SQL cannot express, with the tests that compare them with brute force.
WITHOUT_SQL = {"sample_by_key": "test_numbering.py"}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) | set(WITHOUT_SQL)
    assert set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, con, name):
    ok, _, note = compare(
        spark, con, name, spark_entry.queries()[name], spark_entry.oracle_sql()[name], SF_DIR
    )
    assert ok, note


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize(
    "name", ["wide_trips", "union_sources", "join_hour_dim", "join_dropoff_zone", "trip_mart"]
)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        spark_entry.queries()[name](spark, SF_DIR).explain("formatted")
    for word in ("CartesianProduct", "NestedLoop", "Python", "SortMergeJoin"):
        assert word not in out.getvalue()


def test_feeds_read_their_own_lines_only(spark):
    from proofs.frames import line_feeds

    for feed, df in line_feeds(spark, SF_DIR).items():
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        assert "PartitionFilters: [isnotnull(feed#" in out.getvalue()
        assert f"= {feed})]" in out.getvalue()


def test_dense_numbers_are_told_from_others(spark):
    from proofs.marts import dense

    def told(*numbers):
        row = dense(spark.createDataFrame([(n, 0) for n in numbers], "dwid bigint, x int")).first()
        return row.lowest, row.highest, row.numbers, row.n

    assert told(*range(1, 40001)) == (1, 40000, 40000, 40000)
    assert told(1, 2, 2, 70000) == (1, 70000, 3, 4)
    assert told(-3, 0, 5, 5) == (-3, 5, 3, 4)


def test_a_part_of_the_mixed_files_goes_to_many_tasks(spark, tmp_path):
    """With small pieces asked for, each of the three parts lies in several files."""
    rows = spark.range(0, 20000, 1, 8).selectExpr(
        "id AS o_orderkey", "cast(id % 500 as int) AS o_custkey",
        "id / 2 AS o_totalprice", "'1-URGENT' AS o_orderpriority",
    )
    for i in range(8):
        own = rows.filter(f"o_orderkey div 2500 = {i}").coalesce(1)
        own.write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "4KB")
    try:
        found = spark_entry.queries()["widen_types"](spark, str(tmp_path))
    finally:
        spark.conf.unset(size)
    files = [f.split("/part=")[1].split("/")[0] for f in found.inputFiles()]
    assert {part: files.count(part) > 1 for part in files} == {"0": True, "1": True, "2": True}
    assert sorted(r.k for r in found.collect()) == list(range(20000))
