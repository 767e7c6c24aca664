import time
from pathlib import Path

import pytest

from astrolode.operators.quality import QualityError
from astrolode.plans import jobs
from astrolode.plans.lake import BRONZE, GOLD, SILVER, Lake
from astrolode.session import DROP_SHUFFLES, run_each
from astrolode.sources import sinks
from astrolode.spec import CATALOG, GOLD_TABLES

# A small world: one blank row, one repeated row and one line without its order.
FEED = {
    "orders": [
        (1, "A", 1, "7/4/1996 0:00", "8/1/1996 0:00", "7/16/1996 0:00", 1, 3.5),
        (1, "A", 1, "7/4/1996 0:00", "8/1/1996 0:00", "7/16/1996 0:00", 1, 3.5),
        (2, "B", 1, "7/6/1996 0:00", "8/1/1996 0:00", None, 1, 1.5),
        (None,) * 8,
    ],
    "order_details": [(1, 10, 2.0, 5, 0.1), (2, 11, 3.0, 1, 0.0), (3, 10, 1.0, 1, 0.0)],
    "customers": [("A", "Ann") + (None,) * 9, ("B ", " Bob ") + (None,) * 9],
    "employees": [(1, "L", "F", "T", "Ms.", "12/8/1968", "5/1/1992") + (None,) * 10],
    "products": [(10, "Tea", 5, 7, "box", 2.0, 1, 2, 3, False)],
    "categories": [(7, "Drinks", "wet", None)],
    "suppliers": [(5, "Sup") + (None,) * 10],
    "shippers": [(1, "Fast", "555")],
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")), prefix="shop_")
    for table, rows in FEED.items():
        df = spark.createDataFrame(rows, CATALOG[table].landing_ddl)
        jobs.land_batch(df.coalesce(1), lake, table, "20240101_000000")
    return lake


def test_landing_to_gold(spark, lake, tmp_path):
    ingested = {r.table: r.new_rows for r in jobs.landing_to_bronze(spark, lake, parallel=4)}
    assert ingested == {t: len(rows) for t, rows in FEED.items()}
    assert {r.new_rows for r in jobs.landing_to_bronze(spark, lake)} == {0}
    assert lake.path(BRONZE, "orders").endswith("bronze/shop_orders")
    assert lake.read(spark, BRONZE, "orders").filter("ingestion_time IS NULL").isEmpty()

    report = {
        (r.table_name, r.check_name, r.column_name): r.value
        for r in jobs.bronze_report(spark, lake).filter("flagged").collect()
    }
    assert report["orders", "fully_blank_rows", None] == 1
    assert report["orders", "duplicate_groups", None] == 1
    assert report["categories", "blank_values", "Picture"] == 1

    counts = {r.table_name: r for r in jobs.clean_counts(spark, lake).collect()}
    assert set(counts) == set(CATALOG)
    assert tuple(counts["orders"])[1:] == (4, 1, 0, 0, 1, 2)
    cleaned = {r.table: (r.rows_before, r.rows_after) for r in jobs.bronze_to_silver(spark, lake, parallel=3)}
    assert cleaned["orders"] == (4, 2) and cleaned["customers"] == (2, 2)
    assert lake.read(spark, SILVER, "customers").filter("CustomerID = 'B'").first().CompanyName == "Bob"

    gate = {r.table_name: r.status for r in jobs.silver_gate(spark, lake, strict=True).collect()}
    assert set(gate.values()) == {"CLEAN"} and set(gate) == set(CATALOG)

    presence = jobs.gold_presence(spark, lake).collect()
    assert [(r.table_name, r.found, r.rows) for r in presence] == [(t, False, 0) for t in GOLD_TABLES]
    built = jobs.silver_to_gold(spark, lake, "shop", parallel=3)
    assert built == {
        "dim_dates": 2, "dim_customers": 2, "dim_employees": 1, "dim_products": 1,
        "dim_suppliers": 1, "dim_shippers": 1, "fact_orders": 2,
    }
    presence = jobs.gold_presence(spark, lake).collect()
    assert all(r.found for r in presence) and {r.table_name: r.rows for r in presence} == built
    gold = lake.read_layer(spark, GOLD, GOLD_TABLES)
    assert {r.table_name: r.rows for r in jobs.gold_summary(gold).collect()} == built
    facts = {r.OrderID: r for r in gold["fact_orders"].collect()}
    assert (facts[1].TotalAmount, facts[1].SupplierID, facts[1].date_key) == (9.0, 5, 19960704)
    assert facts[2].SupplierID is None
    assert gold["dim_products"].first().CategoryName == "Drinks"
    assert gold["dim_employees"].first().source_system == "shop"

    published = jobs.publish_gold(spark, lake, sinks.files("parquet", str(tmp_path / "dw")), parallel=2)
    assert published == {t.upper(): n for t, n in built.items()}
    assert spark.read.parquet(str(tmp_path / "dw" / "FACT_ORDERS")).count() == 2

    again = jobs.silver_to_gold(spark, lake, "shop", partition_fact_by_year=True)
    assert again == built
    assert (spark.read.parquet(lake.path(GOLD, "fact_orders")).filter("year = 1996").count()) == 2


def _bytes(folder, files):
    return sum(p.stat().st_size for p in Path(folder).rglob(files))


def _shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    return {n for n in disk.getAllBlocks().mkString(" ").split() if n.startswith("shuffle_")}


def test_layers_take_little_room(spark, tmp_path, conf):
    conf(autoBroadcastJoinThreshold="-1")
    lake = Lake(str(tmp_path))
    days = [f"'7/4/1996 0:00' AS {name}" for name in ("OrderDate", "RequiredDate", "ShippedDate")]
    feed = {"order_details": spark.range(20_000).selectExpr(
                "id DIV 4 AS OrderID", "id % 4 AS ProductID", "id * 0.5D AS UnitPrice", "id % 7 AS Quantity",
                "0.1D AS Discount"),
            "orders": spark.range(5_000).selectExpr(
                "id AS OrderID", "'A' AS `Customer key`", "1L AS EmployeeID", *days, "1L AS ShipVia",
                "1D AS Freight")}
    feed |= {t: spark.createDataFrame(FEED[t], CATALOG[t].landing_ddl) for t in CATALOG if t not in feed}
    for table, df in feed.items():
        jobs.land_batch(df, lake, table, "1")
    text = feed["order_details"].selectExpr("sum(length(to_json(struct(*)))) AS n").first().n
    assert _bytes(f"{lake.landing}/order_details_batch_1.json", "part-*") < text / 4

    taken = {r.table: r.new_rows for r in jobs.landing_to_bronze(spark, lake)}
    assert (taken["order_details"], taken["orders"]) == (20_000, 5_000)
    old = _shuffle_files(spark)
    silver = {r.table: r.rows_after for r in jobs.bronze_to_silver(spark, lake, parallel=2)}
    assert (silver["order_details"], silver["orders"]) == (20_000, 5_000)
    assert jobs.silver_to_gold(spark, lake, "shop")["fact_orders"] == 20_000
    until = time.time() + 20
    while _shuffle_files(spark) - old and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - old
    assert spark.conf.get(DROP_SHUFFLES) == "false"
    for layer in (SILVER, GOLD):
        assert all(".zstd." in p.name for p in Path(tmp_path, layer).rglob("part-*.parquet"))


def test_the_strict_gate_stops(spark, tmp_path):
    lake = Lake(str(tmp_path))
    spec = CATALOG["shippers"]
    spark.createDataFrame([(None, None, None)], spec.landing_ddl).write.parquet(lake.path(SILVER, "shippers"))
    with pytest.raises(QualityError, match="shippers"):
        jobs.silver_gate(spark, lake, {"shippers": spec}, strict=True)


def test_errors_in_parallel_work_surface(spark):
    with pytest.raises(ZeroDivisionError):
        run_each(spark, lambda x: 1 // x, [1, 0], parallel=2)
    assert run_each(spark, lambda x: x * 2, range(5), parallel=3) == [0, 2, 4, 6, 8]
