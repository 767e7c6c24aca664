"""Raw landing-shaped tables derived from the given tables, dirt included.

Each covers its whole source table. The dirt (blank keys, text that does not parse, padded
names, exact copies, rows without content) follows from the key, so that the SQL side can
derive the same rows. `queries/sql.py` holds the same rules in DuckDB's dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE = "retail"
DATE_TIME = "'M/d/yyyy H:mm'"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _struct(columns: dict[str, str]) -> str:
    return "struct(" + ", ".join(f"{value} AS `{name}`" for name, value in columns.items()) + ")"


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{value} AS `{name}`" for name, value in columns.items()))


def _with_copies(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """The columns of each row once, and twice where the key ends in 0: one scan, no union."""
    return df.selectExpr(f"inline(array_repeat({_struct(columns)}, IF({key} % 10 = 0, 2, 1)))")


def _wide(key: str) -> str:
    """Some order keys lie beyond 32 bits."""
    return f"IF({key} % 43 = 0, {key} + 3000000000, {key})"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, some in two versions, and for some orders one more row without any content."""
    shipped = f"date_format(o_orderdate + INTERVAL 5 DAYS, {DATE_TIME})"
    content = {
        "OrderID": f"string({_wide('o_orderkey')})",
        "Customer key": "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN NULL "
                        "ELSE concat('  ', o_custkey, ' ') END",
        "EmployeeID": "IF(o_orderkey % 23 = 0, 'none', string(o_custkey % 9 + 1))",
        "OrderDate": "IF(o_orderkey % 17 = 0, date_format(o_orderdate, 'M/d/yyyy'), "
                     f"date_format(o_orderdate, {DATE_TIME}))",
        "RequiredDate": f"date_format(o_orderdate + INTERVAL 28 DAYS, {DATE_TIME})",
        "ShippedDate": f"IF(o_orderkey % 7 = 0, '', {shipped})",
        "ShipVia": "string(o_orderkey % 3 + 1)",
        "Freight": "string(o_totalprice)",
        "Region": "IF(o_orderkey % 7 = 0, ' ', o_orderpriority)",
    }
    source = {"source_file": "concat('batch_', o_orderkey % 5)"}
    blank = dict.fromkeys(content, "CAST(NULL AS STRING)")
    # An order that comes twice was first sent before it was shipped.
    early = content | source | {
        "ShippedDate": f"IF(o_orderkey % 7 = 0 OR o_orderkey % 10 = 0, '', {shipped})"}
    again = content | {"source_file": "'batch_9'"}
    rows = (
        f"array({_struct(early)})",
        f"array_repeat({_struct(again)}, IF(o_orderkey % 10 = 0, 1, 0))",
        f"array_repeat({_struct(blank | source)}, IF(o_orderkey % 97 = 0, 1, 0))",
    )
    return load(spark, sf_dir, "orders").selectExpr(f"inline(concat({', '.join(rows)}))")


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(load(spark, sf_dir, "lineitem"), {
        "OrderID": f"string({_wide('l_orderkey')})",
        "ProductID": "IF(l_orderkey % 19 = 0, '', string(l_partkey))",
        "LineNumber": "l_linenumber",
        "UnitPrice": "string(l_extendedprice)",
        "Quantity": "string(int(l_quantity))",
        "Discount": "IF(l_partkey % 23 = 0, 'n/a', string(l_discount))",
    })


def _place(k: str) -> dict[str, str]:
    return {
        "Address": f"concat({k}, ' Main St.\\nFloor 2')",
        "City": f"concat('City ', {k} % 50)",
    }


def _contact(k: str, title: str) -> dict[str, str]:
    return {
        "ContactName": f"concat('Contact ', {k})", "ContactTitle": f"'{title}'", **_place(k),
    }


def _post(k: str) -> dict[str, str]:
    return {
        "PostalCode": f"lpad(string({k} % 90000), 5, '0')",
        "Country": f"concat('Nation ', {k} % 25)",
    }


def _reach(k: str) -> dict[str, str]:
    return {
        **_post(k),
        "Phone": f"concat('555-', {k})",
        "Fax": f"IF({k} % 3 = 0, '', concat('556-', {k}))",
    }


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "c_custkey"
    return _with_copies(load(spark, sf_dir, "customer"), k, {
        "CustomerID": f"CASE WHEN {k} % 13 = 0 THEN '  ' WHEN {k} % 17 = 0 THEN NULL "
                      f"ELSE concat(' C', {k}, ' ') END",
        "CompanyName": "concat(c_name, ' ')",
        **_contact(k, "Buyer"),
        "Region": f"CASE WHEN {k} % 5 = 0 THEN '' WHEN {k} % 7 = 0 THEN NULL "
                  "ELSE c_mktsegment END",
        **_reach(k),
    })


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per customer, with a date-only birthday and a hire date with a time."""
    k = "c_custkey"
    return _with_copies(load(spark, sf_dir, "customer"), k, {
        "EmployeeID": f"IF({k} % 29 = 0, '?', string({k}))",
        "LastName": f"concat('Last ', {k})",
        "FirstName": f"concat('First ', {k})",
        "Title": "'Sales Agent'",
        "TitleOfCourtesy": f"IF({k} % 2 = 0, 'Dr.', 'Mx.')",
        "BirthDate": f"date_format(date_add(DATE '1950-01-01', int({k} % 15000)), 'M/d/yyyy')",
        "HireDate": f"concat(date_format(date_add(DATE '1990-01-01', int({k} % 9000)), 'M/d/yyyy'), "
                    "' 9:05')",
        **_place(k),
        "Region": f"IF({k} % 4 = 0, ' ', c_mktsegment)",
        **_post(k),
        "HomePhone": f"concat('557-', {k})",
        "Extension": f"{k} % 10000",
        "Photo": "'photo.bmp'",
        "Notes": f"concat('Joined.\\nNo. ', {k})",
        "ReportsTo": f"IF({k} % 11 <> 0, double({k} % 9 + 1), NULL)",
    })


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per part; the key is shifted by 100, so some order lines find no product."""
    k = "p_partkey"
    return _with_copies(load(spark, sf_dir, "part"), k, {
        "ProductID": f"string({k} + 100)",
        "ProductName": "p_name",
        "SupplierID": f"string({k} % 100 + 1)",
        "CategoryID": f"IF({k} % 31 <> 0, string(p_size + 10), NULL)",
        "QuantityPerUnit": "p_brand",
        "UnitPrice": f"IF({k} % 23 = 0, 'n/a', string(p_retailprice))",
        "UnitsInStock": "string(p_size)",
        "UnitsOnOrder": f"IF({k} % 7 = 0, '', string({k} % 40))",
        "ReorderLevel": f"string({k} % 30)",
        "Discontinued": f"{k} % 3 = 0",
    })


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part, so that every category repeats many times; two empty columns."""
    return _project(load(spark, sf_dir, "part"), {
        "CategoryID": "IF(p_partkey % 37 <> 0, string(p_size), NULL)",
        "CategoryName": "concat(' Size ', p_size, ' ')",
        "Description": "concat('Parts of size ', p_size)",
        "Picture": "CAST(NULL AS STRING)",
        "Remarks": "IF(p_partkey % 2 = 0, ' ', NULL)",
    })


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "s_suppkey"
    return _with_copies(load(spark, sf_dir, "supplier"), k, {
        "SupplierID": f"IF({k} % 41 = 0, ' ', string({k}))",
        "CompanyName": "concat(' ', s_name)",
        **_contact(k, "Seller"),
        "Region": f"CASE WHEN {k} % 3 = 0 THEN '' WHEN {k} % 4 = 0 THEN NULL "
                  "ELSE concat('Region ', s_nationkey) END",
        **_reach(k),
        "HomePage": f"IF({k} % 9 = 0, 'https://supplier.example', NULL)",
    })


def shippers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier, keyed by its nation: many rows per key."""
    return _project(load(spark, sf_dir, "supplier"), {
        "ShipperID": "string(s_nationkey)",
        "CompanyName": "concat('  Carrier ', s_nationkey, '  ')",
        "Phone": "concat('558-', s_nationkey)",
    })


BUILDERS = {
    "orders": orders,
    "order_details": order_details,
    "customers": customers,
    "employees": employees,
    "products": products,
    "categories": categories,
    "suppliers": suppliers,
    "shippers": shippers,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, sf_dir)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
