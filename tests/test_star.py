import datetime as dt

from pyspark.sql import functions as F

from astrolode.operators import star

PRODUCTS = (
    "ProductID INT, ProductName STRING, SupplierID INT, CategoryID INT, QuantityPerUnit STRING, "
    "UnitPrice DOUBLE, UnitsInStock INT, UnitsOnOrder INT, ReorderLevel INT, Discontinued BOOLEAN"
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dim_dates(spark):
    orders = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP '2024-01-01 10:00:00'), (TIMESTAMP '2024-01-01 11:00:00'), "
        "(TIMESTAMP '2024-01-04 00:00:00'), (NULL) AS t(OrderDate)"
    )
    sparse = star.dim_dates(orders)
    assert [c for c in sparse.columns] == [
        "date", "date_key", "year", "month", "day", "day_name", "day_of_week", "week_of_year",
        "quarter", "is_weekend",
    ]
    assert sorted(str(r.date_key) for r in sparse.collect()) == ["20240101", "20240104", "None"]
    assert star.dim_dates(orders, drop_null=True).count() == 2
    dense = star.dim_dates(orders, dense=True)
    assert [r.date.day for r in dense.sort("date").collect()] == [1, 2, 3, 4]


def test_dim_products_keeps_products_without_a_category(spark):
    products = spark.createDataFrame(
        [(1, "Tea", 9, 1, "box", 2.0, 1, 2, 3, False), (2, "Hat", 9, 7, "pc", 3.0, 1, 2, 3, True),
         (3, "Pen", 9, None, "pc", 1.0, 1, 2, 3, True)], PRODUCTS)
    categories = spark.createDataFrame(
        [(1, "Drinks", "wet")], "CategoryID INT, CategoryName STRING, Description STRING")
    got = star.dim_products(products, categories, "src")
    assert got.columns == [
        "ProductID", "ProductName", "SupplierID", "CategoryID", "CategoryName",
        "CategoryDescription", "QuantityPerUnit", "ProductListPrice", "UnitsInStock",
        "UnitsOnOrder", "ReorderLevel", "Discontinued", "source_system",
    ]
    assert [(r[0], r[3], r[4], r[5]) for r in rows(got)] == [
        (1, 1, "Drinks", "wet"), (2, 7, None, None), (3, None, None, None)]


def fact_inputs(spark):
    lines = spark.createDataFrame(
        [(1, 10, 2.0, 3, 0.5), (1, 11, 4.0, 1, 0.0), (2, 10, 1.0, 1, None), (9, 10, 1.0, 1, 0.0)],
        "OrderID INT, ProductID INT, UnitPrice DOUBLE, Quantity INT, Discount DOUBLE")
    orders = spark.sql(
        "SELECT * FROM VALUES (1, 'A', 5, TIMESTAMP '2024-02-29 01:00:00', NULL, NULL, 3, 7.5), "
        "(2, 'B', 6, NULL, NULL, NULL, 2, 8.5) AS t(OrderID, CustomerID, EmployeeID, OrderDate, "
        "RequiredDate, ShippedDate, ShipVia, Freight)")
    products = spark.createDataFrame([(10, 77)], "ProductID INT, SupplierID INT")
    return lines, orders, products


def test_fact_orders(spark):
    fact = star.fact_orders(*fact_inputs(spark))
    assert fact.columns == [
        "OrderID", "ProductID", "SupplierID", "CustomerID", "EmployeeID", "ShipperID", "date_key",
        "UnitPrice", "Quantity", "Discount", "TotalAmount", "Freight", "OrderDate", "RequiredDate",
        "ShippedDate", "gold_created_at",
    ]
    assert [tuple(r)[:12] for r in rows(fact)] == [
        (1, 10, 77, "A", 5, 3, 20240229, 2.0, 3, 0.5, 3.0, 7.5),
        (1, 11, None, "A", 5, 3, 20240229, 4.0, 1, 0.0, 4.0, 7.5),
        (2, 10, 77, "B", 6, 2, None, 1.0, 1, None, None, 8.5),
    ]
    assert fact.filter("gold_created_at IS NULL").isEmpty()


def test_decimal_amount(spark):
    fact = star.fact_orders(*fact_inputs(spark), decimal=True)
    assert dict(fact.dtypes)["TotalAmount"] == "decimal(18,4)"
    assert sorted(str(r.TotalAmount) for r in fact.collect()) == ["3.0000", "4.0000", "None"]


def test_projected_dimensions(spark):
    shippers = spark.createDataFrame([(1, "Fast", "555", "x")], "ShipperID INT, CompanyName STRING, Phone STRING, source_file STRING")
    assert [r.asDict() for r in star.dim_shippers(shippers).collect()] == [
        {"ShipperID": 1, "ShipperName": "Fast", "Phone": "555"}]


def test_run_time_skew_handling_splits_the_plain_join(spark, conf, plan_of):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="10KB", shuffle__partitions="16",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    lines = spark.range(0, 200000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS OrderID", "id AS ProductID", "rand(1) AS UnitPrice", "1 AS Quantity", "0.0D AS Discount")
    orders = spark.range(200000).selectExpr(
        "id AS OrderID", "string(id) AS CustomerID", "1 AS EmployeeID", "1 AS ShipVia", "1.0D AS Freight",
        "TIMESTAMP '2024-01-01 00:00:00' AS OrderDate", "CAST(NULL AS TIMESTAMP) AS RequiredDate",
        "CAST(NULL AS TIMESTAMP) AS ShippedDate")
    fact = star.fact_orders(lines, orders, spark.range(200000).selectExpr("id AS ProductID", "1 AS SupplierID"))
    plan = plan_of(fact.selectExpr("count(1)", "sum(TotalAmount)", "count(CustomerID)"))
    assert "skew=true" in plan
    assert fact.count() == 200000


def test_the_lines_are_scanned_once_also_with_hot_keys(spark, tmp_path, conf, plan_of):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    lines = spark.range(0, 30000, 1, 4).selectExpr(
        "IF(id % 3 = 0, 0, id) AS OrderID", "IF(id % 2 = 0, 7, id) AS ProductID", "1.0D AS UnitPrice",
        "1 AS Quantity", "0.0D AS Discount")
    _, orders, products = fact_inputs(spark)
    for name, df in (("l", lines), ("o", orders), ("p", products)):
        df.write.parquet(str(tmp_path / name))
    plan = plan_of(star.fact_orders(*(spark.read.parquet(str(tmp_path / n)) for n in "lop")))
    final = plan.split("Initial Plan")[0]
    assert final.count("Scan parquet") == 3 or final.count("FileScan parquet") == 3


def test_join_reads_only_needed_columns(spark, tmp_path):
    lines, orders, products = fact_inputs(spark)
    for name, df in (("l", lines), ("o", orders), ("p", products)):
        df.withColumn("unused", F.lit("x" * 50)).write.parquet(str(tmp_path / name))
    frames = [spark.read.parquet(str(tmp_path / n)) for n in "lop"]
    plan = star.fact_orders(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan


def test_days_use_the_session_clock(spark):
    orders = spark.sql("SELECT TIMESTAMP '2024-01-01 23:59:59' AS OrderDate")
    assert star.dim_dates(orders).first().date == dt.date(2024, 1, 1)
