"""Silver to gold: calendar, projected and joined dimensions, and the order-line fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astrolode.functions.predicates import quoted
from astrolode.functions.provenance import built_at, source_system
from astrolode.functions.scalars import calendar_attributes, date_key, line_amount

# Columns of the gold tables, with the new name where a column is renamed.
CUSTOMER_COLUMNS = (
    "CustomerID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region",
    "PostalCode", "Country", "Phone", "Fax",
)
EMPLOYEE_COLUMNS = (
    "EmployeeID", "Title", "TitleOfCourtesy", "BirthDate", "HireDate", "Address", "City", "Region",
    "PostalCode", "Country", "HomePhone", "Extension", "ReportsTo",
)
SUPPLIER_COLUMNS = (
    "SupplierID", "CompanyName", "ContactName", "ContactTitle", "Address", "City", "Region",
    "PostalCode", "Country", "Phone", "Fax", "HomePage",
)
SUPPLIER_NAMES = {"CompanyName": "SupplierName"}
SHIPPER_COLUMNS = ("ShipperID", "CompanyName", "Phone")
SHIPPER_NAMES = {"CompanyName": "ShipperName"}


def project(df: DataFrame, columns: Sequence[str], names: Mapping[str, str] | None = None,
            source: str | None = None) -> DataFrame:
    """A dimension that is a selection of columns, some renamed, perhaps with its origin."""
    chosen = df.select(*map(quoted, columns)).withColumnsRenamed(dict(names or {}))
    return chosen.select("*", source_system(source)) if source else chosen


def dim_dates(orders: DataFrame, date_column: str = "OrderDate", drop_null: bool = False,
              dense: bool = False) -> DataFrame:
    """One row per distinct day, with its calendar attributes.

    Days are cut out before the distinct, so what is shuffled is days, not orders. An
    unreadable date gives a NULL row unless `drop_null`; `dense` fills the gaps between
    the first and the last day.
    """
    days = orders.select(F.to_date(quoted(date_column)).alias("date"))
    if dense:
        span = days.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        days = span.select(F.explode(F.sequence("first", "last")).alias("date"))
    else:
        days = days.distinct()
    if drop_null:
        days = days.filter(F.col("date").isNotNull())
    return days.withColumns(calendar_attributes(F.col("date")))


def dim_customers(customers: DataFrame) -> DataFrame:
    return project(customers, CUSTOMER_COLUMNS)


def dim_employees(employees: DataFrame, source: str) -> DataFrame:
    """Without names, photo and notes."""
    return project(employees, EMPLOYEE_COLUMNS, source=source)


def dim_products(products: DataFrame, categories: DataFrame, source: str) -> DataFrame:
    """Products with their category, if there is one."""
    category = categories.select(
        "CategoryID", "CategoryName", F.col("Description").alias("CategoryDescription")
    )
    return products.join(category, "CategoryID", "left").select(
        "ProductID", "ProductName", "SupplierID", "CategoryID", "CategoryName",
        "CategoryDescription", "QuantityPerUnit", F.col("UnitPrice").alias("ProductListPrice"),
        "UnitsInStock", "UnitsOnOrder", "ReorderLevel", "Discontinued", source_system(source),
    )


def dim_suppliers(suppliers: DataFrame, source: str) -> DataFrame:
    return project(suppliers, SUPPLIER_COLUMNS, SUPPLIER_NAMES, source)


def dim_shippers(shippers: DataFrame) -> DataFrame:
    return project(shippers, SHIPPER_COLUMNS, SHIPPER_NAMES)


def _amount(decimal: bool) -> Column:
    parts = [F.col(c) for c in ("UnitPrice", "Quantity", "Discount")]
    if not decimal:
        return line_amount(*parts)
    price, quantity, discount = parts
    exact = line_amount(
        price.cast("decimal(18,4)"), quantity.cast("decimal(10,0)"), discount.cast("decimal(6,4)")
    )
    return exact.cast("decimal(18,4)")


def fact_orders(order_details: DataFrame, orders: DataFrame, products: DataFrame,
                decimal: bool = False) -> DataFrame:
    """One row per order line; orders and products must have unique keys.

    `Freight` belongs to the order and repeats on each of its lines: do not add it up.
    The amount is a double; `decimal=True` computes it exactly.

    The lines are read once. A reference below Spark's size threshold is broadcast; otherwise
    both sides are sorted and merged, and run-time skew handling splits the partition of a hot
    key over several tasks, which it can as the joins are left and inner.
    """
    lines = order_details.select("OrderID", "ProductID", "UnitPrice", "Quantity", "Discount")
    # The date key is worked out once per order, not once per line.
    heads = orders.select(
        "OrderID", "CustomerID", "EmployeeID", F.col("ShipVia").alias("ShipperID"),
        date_key(F.col("OrderDate")).alias("date_key"),
        "Freight", "OrderDate", "RequiredDate", "ShippedDate",
    )
    goods = products.select("ProductID", "SupplierID")
    return lines.join(goods, "ProductID", "left").join(heads, "OrderID").select(
        "OrderID", "ProductID", "SupplierID", "CustomerID", "EmployeeID", "ShipperID", "date_key",
        "UnitPrice", "Quantity", "Discount", _amount(decimal).alias("TotalAmount"),
        "Freight", "OrderDate", "RequiredDate", "ShippedDate", built_at(),
    )
