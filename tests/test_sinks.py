import os

import pytest
from pyspark.sql import functions as F

from tidelake.schemas import TABLES, struct_of
from tidelake import versions
from tidelake.sinks.catalog import create_databases, register_catalog
from tidelake.sinks.parquet import (
    append_table, land_domain, overwrite_partitions, overwrite_table, replace_landing,
)
from tidelake.sources.csv import (
    KINDS, csv_scan_with_schema, found_types, infer_csv_schema, infer_merge_schema, joined_type,
    merge_schemas, widened_columns, widened_schema,
)
from tidelake.sources.tables import partitioned_parquet_scan, snapshot_scan

SCHEMA = struct_of("v bigint, year string, month string")


def month(spark, value, *months):
    return spark.createDataFrame([(value, "2020", m) for m in months], "v int, year string, month string").withColumn("v", F.col("v").cast("bigint"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def listing(path):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


@pytest.mark.parametrize("rebalance", [True, False])
def test_overwrite_replaces_present_partitions_only(spark, path, rebalance):
    overwrite_partitions(month(spark, 1, "01", "02"), path, ["year", "month"], rebalance)
    january = {f for f in listing(path) if "month=01" in f}
    for _ in range(2):
        overwrite_partitions(month(spark, 2, "02", "03"), path, ["year", "month"], rebalance)
        assert rows(partitioned_parquet_scan(spark, path, SCHEMA)) == [
            (1, "2020", "01"), (2, "2020", "02"), (2, "2020", "03"),
        ]
    assert {f for f in listing(path) if "month=01" in f} == january
    assert rows(partitioned_parquet_scan(spark, path, SCHEMA, month="01")) == [(1, "2020", "01")]


def test_partitions_are_pruned(spark, path, capsys):
    overwrite_partitions(month(spark, 1, "01", "02"), path, ["year", "month"])
    partitioned_parquet_scan(spark, path, SCHEMA, year="2020", month="01").explain("formatted")
    line = next(x for x in capsys.readouterr().out.splitlines() if "PartitionFilters" in x)
    assert "month" in line and "year" in line


def test_append_adds_rows_again(spark, path):
    for _ in range(2):
        append_table(month(spark, 1, "01"), path, ["year", "month"])
    assert rows(partitioned_parquet_scan(spark, path, SCHEMA)) == [(1, "2020", "01")] * 2
    append_table(spark.range(1), f"{path}_plain")
    assert spark.read.parquet(f"{path}_plain").count() == 1


def test_a_table_may_be_overwritten_from_itself(spark, path):
    overwrite_table(spark.range(3), path)
    overwrite_table(snapshot_scan(spark, path).filter("id > 0"), path)
    assert rows(snapshot_scan(spark, path)) == [(1,), (2,)]
    with pytest.raises(Exception):
        overwrite_table(snapshot_scan(spark, path).select(F.raise_error(F.lit("no"))), path)
    assert rows(snapshot_scan(spark, path)) == [(1,), (2,)]


def test_a_dead_driver_leaves_the_table_as_it_was(spark, path, monkeypatch):
    """Neither an overwrite of the table nor one of a partition is half done."""
    overwrite_table(spark.range(3), path)

    def die(*args):
        raise RuntimeError("the driver dies")

    monkeypatch.setattr(versions, "publish", die)
    with pytest.raises(RuntimeError):
        overwrite_table(snapshot_scan(spark, path).filter("id > 0"), path)
    monkeypatch.undo()
    assert rows(snapshot_scan(spark, path)) == [(0,), (1,), (2,)]
    # It dies after the switch and before the old files are removed: the new rows count.
    monkeypatch.setattr(versions, "remove_folders", die)
    with pytest.raises(RuntimeError):
        overwrite_table(spark.range(1), path)
    assert rows(snapshot_scan(spark, path)) == [(0,)]


def test_the_catalog_moves_before_the_old_files_go(spark, lake, monkeypatch):
    create_databases(lake)
    path, name = f"{lake.root}/ods/m", lake.catalog_name("ods.m")
    by = ["year", "month"]

    def register(touched):
        register_catalog(spark, name, SCHEMA, path, by, touched.written, (), touched.folders)

    overwrite_partitions(month(spark, 1, "01", "02"), path, by, then=register)

    def check(folders):
        assert [os.path.exists(folder) for folder in folders] == [True]
        assert rows(spark.table(name)) == [(1, "2020", "01"), (2, "2020", "02")]

    monkeypatch.setattr(versions, "remove_folders", lambda spark, folders: check(folders))
    overwrite_partitions(month(spark, 2, "02"), path, by, then=register)
    monkeypatch.undo()

    def fail(touched):
        raise RuntimeError("the catalog is away")

    with pytest.raises(RuntimeError):
        overwrite_partitions(month(spark, 3, "02"), path, by, then=fail)
    assert rows(spark.table(name)) == [(1, "2020", "01"), (2, "2020", "02")]
    register_catalog(spark, name, SCHEMA, path, by)  # from the log
    assert rows(spark.table(name)) == [(1, "2020", "01"), (3, "2020", "02")]


def test_rows_are_not_appended_to_versions(spark, path):
    overwrite_partitions(month(spark, 1, "01"), path, ["year", "month"])
    with pytest.raises(ValueError):
        append_table(month(spark, 1, "01"), path, ["year", "month"])


def test_new_columns_keep_the_entry_and_its_partitions(spark, lake, monkeypatch):
    create_databases(lake)
    path, name = f"{lake.root}/ods/w", lake.catalog_name("ods.w")
    by = ["year", "month"]

    def write(df, schema):
        overwrite_partitions(
            df, path, by, then=lambda t: register_catalog(
                spark, name, schema, path, by, t.written, t.emptied, t.folders
            ),
        )

    write(month(spark, 1, "01", "02"), SCHEMA)
    wider = struct_of("v bigint, w string, year string, month string")
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), sql(self, q, *a, **k))[1])
    write(month(spark, 2, "02").withColumn("w", F.lit("x")), wider)
    monkeypatch.undo()
    assert any("ADD COLUMNS" in q for q in said)
    assert not any(q.startswith(("MSCK", "DROP TABLE")) for q in said)
    got = spark.table(name)
    assert rows(got.select("v", "w", "month")) == [(1, None, "01"), (2, "x", "02")]
    # A column that changes its type makes the entry anew, from the log.
    other = struct_of("v string, w string, year string, month string")
    write(month(spark, 3, "03").select(F.col("v").cast("string"), F.lit("y").alias("w"), *by), other)
    assert spark.table(name).filter("month = '03'").first().v == "3"


def test_csv_under_a_positional_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,Name,Extra\n1,"a, b",x\n2\n3,c,y,surplus\nbad,,\n')
    (tmp_path / "b.csv").write_text("ID,Name,Extra\n5,d,z\n")
    schema = struct_of("locationid bigint, zone string, other string")
    df = csv_scan_with_schema(spark, str(tmp_path), schema)
    assert rows(df) == sorted(
        [(1, "a, b", "x"), (2, None, None), (3, "c", "y"), (None, None, None), (5, "d", "z")],
        key=str,
    )
    with_first = csv_scan_with_schema(spark, str(tmp_path / "b.csv"), schema, header=False)
    assert rows(with_first) == sorted([(None, "Name", "Extra"), (5, "d", "z")], key=str)


def test_inferred_schemas_are_merged(spark, tmp_path):
    (tmp_path / "zone").mkdir()
    (tmp_path / "zone" / "a.csv").write_text("LocationID,Borough\n1,x\n")
    found = infer_csv_schema(spark, str(tmp_path / "zone"))
    assert [(f.name, f.dataType.simpleString()) for f in found] == [
        ("locationid", "int"), ("borough", "string"),
    ]
    known = {"geo_zone": struct_of("locationid bigint, old double"), "geo_other": found}
    merged = infer_merge_schema(spark, str(tmp_path), "geo", ["zone"], known)
    assert [(f.name, f.dataType.simpleString()) for f in merged["geo_zone"]] == [
        ("locationid", "bigint"), ("old", "double"), ("borough", "string"),
    ]
    assert merged["geo_other"] == found
    assert merge_schemas(None, found) == found


def types_of(schema):
    return {f.name: f.dataType.simpleString() for f in schema}


def test_types_are_widened_over_files(spark, tmp_path):
    folder = tmp_path / "raw" / "t"
    folder.mkdir(parents=True)
    header = "A,B,C,D,E,F,G\n"
    (folder / "1.csv").write_text(header + "1,1,1,true,2020-01-01,,7\n2,,2,false,,,8\n")
    (folder / "2.csv").write_text(header + f"{1 << 40},2,,true,2020-01-01 10:00:00,,9\n")
    (folder / "3.csv").write_text(header + f"1.5,x,3,1,soon,,{'9' * 25}\n")
    (folder / "4.csv").write_text(header)
    known = struct_of("a int, b bigint, c int, z double, g int")
    found = found_types(spark, str(folder))
    wide = widened_schema(found, known)
    assert types_of(wide) == {
        "a": "double", "b": "string", "c": "int", "z": "double", "g": "string", "d": "string",
        "e": "string", "f": "string",
    }
    assert list(types_of(wide)) == ["a", "b", "c", "z", "g", "d", "e", "f"]
    report = {
        (r.column, r.file[-5:], r.known, r.holds) for r in widened_columns(found, known).collect()
    }
    assert report == {
        ("a", "2.csv", "int", "bigint"), ("a", "3.csv", "int", "double"),
        ("b", "3.csv", "bigint", "string"), ("g", "3.csv", "int", "string"),
    }
    first = found_types(spark, str(folder / "1.csv"))
    assert types_of(widened_schema(first)) == {
        "a": "int", "b": "int", "c": "int", "d": "boolean", "e": "timestamp_ntz", "f": "string",
        "g": "int",
    }
    merged = infer_merge_schema(spark, str(tmp_path / "raw"), "x", ["t"], {"x_t": known}, widen=True)
    assert merged["x_t"] == wide
    # Without widening, cells that do not fit would be NULL.
    assert csv_scan_with_schema(spark, str(folder), wide).filter("a = 1.5").count() == 1


def test_kinds_join_in_any_order():
    bits = KINDS
    assert joined_type(0) is None and joined_type(bits["boolean"]) == "boolean"
    assert joined_type(bits["int"] | bits["double"]) == "double"
    assert joined_type(bits["int"] | bits["boolean"]) == "string"
    assert joined_type(bits["timestamp_ntz"] | bits["string"]) == "string"


def test_landing_replaces_files(spark, path):
    replace_landing(spark.range(3), path)
    replace_landing(spark.range(1), path)
    assert rows(csv_scan_with_schema(spark, path, struct_of("id bigint"))) == [(0,)]
    replace_landing(spark.createDataFrame([("a,1",)], "value string"), path)
    assert rows(spark.read.text(path)) == [("a,1",)]


def test_landing_a_domain_empties_what_is_not_fed(lake):
    zone = lake.spark.createDataFrame([(1, "b", "z", "s")], lake.schema("stg.geo_taxi_zone"))
    land_domain(lake, "geo", {"stg.geo_taxi_zone": zone})
    land_domain(lake, "geo", {})
    raw = csv_scan_with_schema(
        lake.spark, lake.path("stg.geo_taxi_zone"), TABLES["stg.geo_taxi_zone"].schema
    )
    assert raw.count() == 0
    with pytest.raises(ValueError):
        land_domain(lake, "geo", {"stg.geo_other": zone})


def test_partitions_are_written_without_a_sort_of_the_rows(spark, path):
    """Nor in the session's setting is anything left behind."""
    from tidelake.lake import OPEN_PARTITIONS, WRITERS_SETTING, open_partitions, stage

    before = spark.conf.get(WRITERS_SETTING)
    with open_partitions(spark):
        assert int(spark.conf.get(WRITERS_SETTING)) == OPEN_PARTITIONS
    with pytest.raises(KeyError), open_partitions(spark):
        raise KeyError
    assert spark.conf.get(WRITERS_SETTING) == before
    # More partitions than files that may be open, in one task, in no order.
    rows = spark.range(5000).selectExpr("id", "cast(id * 7 % 40 as string) AS p").coalesce(1)
    overwrite_partitions(rows, path, ["p"], rebalance=False)
    schema = rows.schema
    got = partitioned_parquet_scan(spark, path, schema).collect()
    assert sorted((r.id, r.p) for r in got) == [(i, str(i * 7 % 40)) for i in range(5000)]
    # A task's rows of few partitions are written as they come, however they alternate.
    staged = stage(spark.range(1000).selectExpr("id", "cast(id % 3 as string) AS p").coalesce(1),
                   partition_by=["p"])
    assert [r.id for r in staged.filter("p = '1'").collect()] == list(range(1, 1000, 3))
    assert len(staged.inputFiles()) == 3
