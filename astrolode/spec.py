"""What is known about each table: landing schema, types, keys, required columns.

Operators read a `TableSpec`; none of them knows a table by name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# The formats and names the source feed and the report consumers use.
DATE_TIME_FORMAT = "M/d/yyyy H:mm"
DATE_OPTIONAL_TIME_FORMAT = "M/d/yyyy[ H:mm]"
BATCH_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
UNKNOWN = "Unknown"
SOURCE_FILE = "source_file"
INGESTED_AT = "bronze_ingestion_time"
BATCH_TIME = "ingestion_time"
PROVENANCE = (BATCH_TIME, SOURCE_FILE, INGESTED_AT)
CORRUPT_RECORD = "_corrupt_record"
UNDECLARED = "_undeclared"
# The folder column of bronze: one folder per append.
APPEND = "append_number"
# What ingest adds to a row; none of it is content of the source.
AUDIT = (*PROVENANCE, CORRUPT_RECORD, UNDECLARED, APPEND)


@dataclass(frozen=True)
class TableSpec:
    """Declarative description of one source table.

    `landing_ddl` is the schema of the landing files, `types` the silver casts,
    `keys` the business key, `not_null` the columns a silver row must carry. Of rows with the
    same key the one with the largest `prefer` columns (as far as it has them) stays: by default
    the one taken in last.
    """

    name: str
    landing_ddl: str
    keys: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)
    renames: Mapping[str, str] = field(default_factory=dict)
    trims: tuple[str, ...] = ()
    fill_unknown: tuple[str, ...] = ()
    drops: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    reject_blank_keys: bool = False
    drop_empty: bool = False
    protect: tuple[str, ...] = ()
    required_bronze: tuple[str, ...] = ()
    required_silver: tuple[str, ...] = ()
    date_format: str = DATE_OPTIONAL_TIME_FORMAT
    prefer: tuple[str, ...] = (INGESTED_AT, SOURCE_FILE)
    provenance: tuple[str, ...] = AUDIT

    @property
    def pattern(self) -> str:
        """Glob of this table's landing batches."""
        return f"{self.name}_*.json"

    @property
    def key_filter(self) -> tuple[str, ...]:
        """Columns that must be present for a row to be kept."""
        return self.not_null or self.keys

    def with_(self, **changes) -> TableSpec:
        """A copy with some fields replaced, e.g. `spec.with_(date_format=...)`."""
        return replace(self, **changes)


_CONTACT = (
    "ContactName STRING, ContactTitle STRING, Address STRING, City STRING, "
    "Region STRING, PostalCode STRING, Country STRING, Phone STRING, Fax STRING"
)

# Column names, types, keys and required columns of the eight tables.
CATALOG: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            name="orders",
            landing_ddl=(
                "OrderID BIGINT, `Customer key` STRING, EmployeeID BIGINT, OrderDate STRING, "
                "RequiredDate STRING, ShippedDate STRING, ShipVia BIGINT, Freight DOUBLE"
            ),
            keys=("OrderID",),
            types={
                "OrderID": "bigint",
                "EmployeeID": "bigint",
                "ShipVia": "bigint",
                "Freight": "double",
                "OrderDate": "timestamp",
                "RequiredDate": "timestamp",
                "ShippedDate": "timestamp",
            },
            renames={"Customer key": "CustomerID"},
            trims=("CustomerID",),
            not_null=("OrderID", "CustomerID"),
            required_bronze=(
                "OrderID", "Customer key", "EmployeeID", "OrderDate",
                "RequiredDate", "ShippedDate", "ShipVia", "Freight",
            ),
            required_silver=("OrderID", "CustomerID", "EmployeeID", "OrderDate", "ShipVia"),
            date_format=DATE_TIME_FORMAT,
        ),
        TableSpec(
            name="order_details",
            landing_ddl=(
                "OrderID BIGINT, ProductID BIGINT, UnitPrice DOUBLE, Quantity BIGINT, Discount DOUBLE"
            ),
            keys=("OrderID", "ProductID"),
            types={
                "OrderID": "bigint",
                "ProductID": "bigint",
                "UnitPrice": "double",
                "Quantity": "int",
                "Discount": "double",
            },
            required_bronze=("OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"),
            required_silver=("OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"),
        ),
        TableSpec(
            name="customers",
            landing_ddl=f"CustomerID STRING, CompanyName STRING, {_CONTACT}",
            keys=("CustomerID",),
            trims=("CustomerID", "CompanyName"),
            fill_unknown=("Region",),
            reject_blank_keys=True,
            required_bronze=("CustomerID", "CompanyName"),
            required_silver=("CustomerID", "CompanyName"),
        ),
        TableSpec(
            name="employees",
            landing_ddl=(
                "EmployeeID BIGINT, LastName STRING, FirstName STRING, Title STRING, "
                "TitleOfCourtesy STRING, BirthDate STRING, HireDate STRING, Address STRING, "
                "City STRING, Region STRING, PostalCode STRING, Country STRING, HomePhone STRING, "
                "Extension BIGINT, Photo STRING, Notes STRING, ReportsTo DOUBLE"
            ),
            keys=("EmployeeID",),
            types={
                "EmployeeID": "bigint",
                "ReportsTo": "bigint",
                "BirthDate": "timestamp",
                "HireDate": "timestamp",
            },
            fill_unknown=("Region",),
            required_bronze=("EmployeeID", "Region"),
            required_silver=("EmployeeID",),
        ),
        TableSpec(
            name="products",
            landing_ddl=(
                "ProductID BIGINT, ProductName STRING, SupplierID BIGINT, CategoryID BIGINT, "
                "QuantityPerUnit STRING, UnitPrice DOUBLE, UnitsInStock BIGINT, "
                "UnitsOnOrder BIGINT, ReorderLevel BIGINT, Discontinued BOOLEAN"
            ),
            keys=("ProductID",),
            types={
                "ProductID": "bigint",
                "SupplierID": "bigint",
                "CategoryID": "bigint",
                "UnitPrice": "double",
                "UnitsInStock": "int",
                "UnitsOnOrder": "int",
                "ReorderLevel": "int",
            },
            required_bronze=("ProductID", "ProductName", "SupplierID", "CategoryID"),
            required_silver=("ProductID", "ProductName", "SupplierID", "CategoryID"),
        ),
        TableSpec(
            name="categories",
            landing_ddl=(
                "CategoryID BIGINT, CategoryName STRING, Description STRING, Picture STRING"
            ),
            keys=("CategoryID",),
            types={"CategoryID": "bigint"},
            trims=("CategoryName",),
            drops=("Picture",),
            drop_empty=True,
            protect=("CategoryID", "CategoryName", "Description"),
            required_bronze=("CategoryID", "CategoryName", "Picture"),
            required_silver=("CategoryID", "CategoryName"),
        ),
        TableSpec(
            name="suppliers",
            landing_ddl=f"SupplierID BIGINT, CompanyName STRING, {_CONTACT}, HomePage STRING",
            keys=("SupplierID",),
            types={"SupplierID": "bigint"},
            trims=("CompanyName",),
            fill_unknown=("Region",),
            required_bronze=("SupplierID", "CompanyName"),
            required_silver=("SupplierID", "CompanyName"),
        ),
        TableSpec(
            name="shippers",
            landing_ddl="ShipperID BIGINT, CompanyName STRING, Phone STRING",
            keys=("ShipperID",),
            types={"ShipperID": "bigint"},
            trims=("CompanyName",),
            required_bronze=("ShipperID", "CompanyName"),
            required_silver=("ShipperID", "CompanyName"),
        ),
    )
}

# The seven gold tables, in build order.
GOLD_TABLES = (
    "dim_dates",
    "dim_customers",
    "dim_employees",
    "dim_products",
    "dim_suppliers",
    "dim_shippers",
    "fact_orders",
)
