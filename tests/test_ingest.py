import json
import sys
from pathlib import Path

import pytest

from astrolode.operators import ingest
from astrolode.operators.ingest import (
    ingest_all,
    ingest_table,
    new_files,
    read_bronze,
    total_new_rows,
    unseen_rows,
)
from astrolode.sources.files import or_none
from astrolode.spec import CATALOG, TableSpec

SPEC = TableSpec("things", "id BIGINT, name STRING", keys=("id",))


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    text = "".join((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)
    (folder / name).write_text(text)


@pytest.fixture
def zone(tmp_path):
    return tmp_path / "landing", str(tmp_path / "bronze")


def run(spark, zone, **options):
    result = ingest_table(spark, SPEC, str(zone[0]), zone[1], **options)
    return result.status, result.new_rows


def test_nothing_landed(spark, zone):
    zone[0].mkdir()
    assert run(spark, zone) == ("no files", 0)


def test_each_file_is_taken_in_once(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1, "name": "x"}, {"id": 2}])
    assert run(spark, zone) == ("ingested", 2)
    assert run(spark, zone) == ("nothing new", 0)
    land(zone[0], "things_b.json", [{"id": 3}])
    land(zone[0], "other_c.json", [{"id": 4}])
    assert run(spark, zone) == ("ingested", 1)
    bronze = spark.read.parquet(zone[1])
    assert sorted(r.id for r in bronze.collect()) == [1, 2, 3]
    assert bronze.filter("source_file IS NULL OR bronze_ingestion_time IS NULL").isEmpty()


def test_a_rewritten_file_of_the_same_name_is_ignored(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}])
    run(spark, zone)
    land(zone[0], "things_a.json", [{"id": 1}, {"id": 2}])
    assert run(spark, zone) == ("nothing new", 0)


def test_awkward_file_names(spark, zone):
    for name in ("things_a b.json", "things_[1].json", "things_{x,y}.json", "things_50%25.json", "things_ü.json"):
        land(zone[0], name, [{"id": 1}])
    assert run(spark, zone) == ("ingested", 5)
    assert run(spark, zone) == ("nothing new", 0)
    assert spark.read.parquet(zone[1]).select("source_file").distinct().count() == 5


def test_more_files_than_one_append_takes(spark, zone):
    for i in range(7):
        land(zone[0], f"things_{i}.json", [{"id": i}] if i != 2 else [])
    land(zone[0], "things_blank.json", ["", " "])
    assert run(spark, zone, max_files=2) == ("ingested", 6)
    assert run(spark, zone, max_files=2) == ("nothing new", 0)
    assert spark.read.parquet(zone[1]).count() == 6


def test_files_without_rows_leave_no_table(spark, zone, tmp_path):
    land(zone[0], "things_a.json", [])
    assert run(spark, zone) == ("nothing new", 0)
    assert or_none(lambda: spark.read.parquet(zone[1])) is None
    assert run(spark, zone) == ("nothing new", 0)


def test_bad_lines_are_kept_as_text(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}, "{broken", {"id": "text", "name": "n"}])
    assert run(spark, zone) == ("ingested", 3)
    rows = {r._corrupt_record: (r.id, r.name) for r in spark.read.parquet(zone[1]).collect()}
    assert rows[None] == (1, None)
    assert rows["{broken"] == (None, None)
    assert rows['{"id": "text", "name": "n"}'] == (None, "n")


def test_a_fixed_schema_keeps_bronze_readable_when_types_drift(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}])
    run(spark, zone)
    land(zone[0], "things_b.json", [{"id": 1.5}, {"id": 2, "extra": True}])
    assert run(spark, zone) == ("ingested", 2)
    rows = {str(r.id): r._undeclared for r in spark.read.parquet(zone[1]).collect()}
    assert rows == {"1": None, "2": {"extra": "true"}, "None": None}


def test_an_append_that_was_cut_off_is_done_again(spark, zone, monkeypatch):
    land(zone[0], "things_a.json", [{"id": 1}])
    assert run(spark, zone) == ("ingested", 1)
    land(zone[0], "things_b.json", [{"id": 2}])
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "ledger_path", lambda bronze: (_ for _ in ()).throw(OSError("lost"))
                      if sys._getframe(1).f_code.co_name == "_append" else f"{bronze}/_ledger")
        with pytest.raises(OSError):
            run(spark, zone)
    assert spark.read.parquet(zone[1]).count() == 2
    assert [r.id for r in read_bronze(spark, zone[1]).collect()] == [1]
    land(zone[0], "things_0.json", [{"id": 3}])
    assert run(spark, zone) == ("ingested", 2)
    assert sorted(r.id for r in spark.read.parquet(zone[1]).collect()) == [1, 2, 3]
    assert sorted(r.id for r in read_bronze(spark, zone[1]).collect()) == [1, 2, 3]


def plant_append(spark, zone, number):
    """What an append that never finished has left behind."""
    spark.read.parquet(zone[1]).drop("append_number").write.parquet(f"{zone[1]}/append_number={number}")


def test_unfinished_appends_are_pruned_not_read(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}, {"id": 2}])
    run(spark, zone)
    plant_append(spark, zone, 1)
    for file in Path(zone[1]).glob("append_number=1/*.parquet"):
        file.write_bytes(b"half a file")
    for crc in Path(zone[1]).glob("append_number=1/.*.crc"):
        crc.unlink()
    schema = spark.read.parquet(f"{zone[1]}/append_number=0").schema.add("append_number", "integer")
    ledger = spark.read.parquet(f"{zone[1]}/_ledger")
    rows = ingest.committed(spark.read.schema(schema).parquet(zone[1]), ledger)
    assert sorted(r.id for r in rows.collect()) == [1, 2] and rows.count() == 2
    assert "append_number" not in rows.columns


def test_a_first_append_that_never_finished_shows_no_rows(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}])
    run(spark, zone)
    rows = ingest.committed(spark.read.parquet(zone[1]), None)
    assert rows.isEmpty() and "id" in rows.columns
    plain = spark.range(3)
    assert ingest.committed(plain, None) is plain


def test_a_run_with_nothing_new_opens_no_data(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}])
    run(spark, zone)
    for file in Path(zone[1]).glob("append_number=*/*.parquet"):
        file.write_bytes(b"not to be read")
    assert run(spark, zone) == ("nothing new", 0)


def test_listing_reads_names_only(spark, zone):
    land(zone[0], "things_a.json", [{"id": 1}])
    plan = new_files(spark, f"{zone[0]}/*.json", zone[1])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_unseen_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id INT, source_file STRING")
    seen = spark.createDataFrame([("b",), ("b",), ("c",)], "source_file STRING")
    assert sorted(r.id for r in unseen_rows(rows, seen).collect()) == [1, 4]
    assert unseen_rows(rows, None).count() == 4
    assert unseen_rows(rows, seen.withColumnRenamed("source_file", "x")).count() == 4


def test_unseen_rows_are_not_shuffled_by_file(spark, plan_of):
    rows = spark.createDataFrame(
        [(i, None if i % 9 == 0 else f"f{i % 5}") for i in range(500)], "id INT, source_file STRING")
    left = unseen_rows(rows, rows.filter("source_file IN ('f0', 'f3')"))
    assert {r.id for r in left.collect()} == {i for i in range(500) if i % 9 == 0 or i % 5 not in (0, 3)}
    plan = plan_of(left)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_all_tables(spark, tmp_path):
    zone = tmp_path / "landing"
    land(zone, "shippers_1.json", [{"ShipperID": 1}, {"ShipperID": 2}])
    land(zone, "orders_1.json", [{"OrderID": 1, "Customer key": "A"}])
    land(zone, "order_details_1.json", [{"OrderID": 1, "ProductID": 2}])
    for parallel in (1, 4):
        base = tmp_path / f"bronze{parallel}"
        results = ingest_all(spark, str(zone), lambda t: f"{base}/{t}", CATALOG.values(), parallel)
        assert [r.table for r in results] == list(CATALOG)
        assert {r.table: r.new_rows for r in results if r.new_rows} == {
            "shippers": 2, "orders": 1, "order_details": 1,
        }
        assert total_new_rows(results) == 4
