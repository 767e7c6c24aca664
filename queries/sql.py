"""The oracle: the same raw tables, cleaning rules and gold shapes as DuckDB SQL."""

from __future__ import annotations

_COPIES = "FROM (SELECT *, unnest(CASE WHEN {k} % 10 = 0 THEN [0, 1] ELSE [0] END) FROM {t})"


def _contact(k: str, label: str) -> str:
    return f"""'Contact ' || {k} AS "ContactName", '{label}' AS "ContactTitle", {_place(k)}"""


def _place(k: str) -> str:
    return f"""{k} || ' Main St.' || chr(10) || 'Floor 2' AS "Address",
      'City ' || ({k} % 50) AS "City\""""


def _post(k: str) -> str:
    return f"""lpad(cast({k} % 90000 AS VARCHAR), 5, '0') AS "PostalCode",
      'Nation ' || ({k} % 25) AS "Country\""""


def _reach(k: str) -> str:
    return f"""{_post(k)}, '555-' || {k} AS "Phone",
      CASE WHEN {k} % 3 = 0 THEN '' ELSE '556-' || {k} END AS "Fax\""""


RAW = {
    "raw_orders": """
      SELECT
        CASE WHEN copy < 2 THEN cast(CASE WHEN o_orderkey % 43 = 0 THEN o_orderkey + 3000000000
             ELSE o_orderkey END AS VARCHAR) END AS "OrderID",
        CASE WHEN copy = 2 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
             WHEN o_orderkey % 13 = 0 THEN NULL
             ELSE '  ' || o_custkey || ' ' END AS "Customer key",
        CASE WHEN copy = 2 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'none'
             ELSE cast(o_custkey % 9 + 1 AS VARCHAR) END AS "EmployeeID",
        CASE WHEN copy = 2 THEN NULL
             WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
             ELSE strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') END AS "OrderDate",
        CASE WHEN copy < 2
             THEN strftime(o_orderdate + INTERVAL 28 DAY, '%-m/%-d/%Y %-H:%M') END AS "RequiredDate",
        CASE WHEN copy = 2 THEN NULL WHEN o_orderkey % 7 = 0 THEN ''
             WHEN o_orderkey % 10 = 0 AND copy = 0 THEN ''
             ELSE strftime(o_orderdate + INTERVAL 5 DAY, '%-m/%-d/%Y %-H:%M') END AS "ShippedDate",
        CASE WHEN copy < 2 THEN cast(o_orderkey % 3 + 1 AS VARCHAR) END AS "ShipVia",
        CASE WHEN copy < 2 THEN cast(o_totalprice AS VARCHAR) END AS "Freight",
        CASE WHEN copy = 2 THEN NULL WHEN o_orderkey % 7 = 0 THEN ' '
             ELSE o_orderpriority END AS "Region",
        CASE WHEN copy = 1 THEN 'batch_9' ELSE 'batch_' || (o_orderkey % 5) END AS source_file
      FROM (SELECT *, unnest([0] || CASE WHEN o_orderkey % 10 = 0 THEN [1] ELSE [] END
              || CASE WHEN o_orderkey % 97 = 0 THEN [2] ELSE [] END) AS copy FROM orders)
    """,
    "raw_order_details": """
      SELECT cast(CASE WHEN l_orderkey % 43 = 0 THEN l_orderkey + 3000000000
          ELSE l_orderkey END AS VARCHAR) AS "OrderID",
        CASE WHEN l_orderkey % 19 = 0 THEN '' ELSE cast(l_partkey AS VARCHAR) END AS "ProductID",
        l_linenumber AS "LineNumber",
        cast(l_extendedprice AS VARCHAR) AS "UnitPrice",
        cast(cast(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS "Quantity",
        CASE WHEN l_partkey % 23 = 0 THEN 'n/a' ELSE cast(l_discount AS VARCHAR) END AS "Discount"
      FROM lineitem
    """,
    "raw_customers": f"""
      SELECT CASE WHEN c_custkey % 13 = 0 THEN '  ' WHEN c_custkey % 17 = 0 THEN NULL
                  ELSE ' C' || c_custkey || ' ' END AS "CustomerID",
        c_name || ' ' AS "CompanyName", {_contact('c_custkey', 'Buyer')},
        CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN NULL
             ELSE c_mktsegment END AS "Region", {_reach('c_custkey')}
      {_COPIES.format(t='customer', k='c_custkey')}
    """,
    "raw_employees": f"""
      SELECT CASE WHEN c_custkey % 29 = 0 THEN '?' ELSE cast(c_custkey AS VARCHAR) END AS "EmployeeID",
        'Last ' || c_custkey AS "LastName", 'First ' || c_custkey AS "FirstName",
        'Sales Agent' AS "Title",
        CASE WHEN c_custkey % 2 = 0 THEN 'Dr.' ELSE 'Mx.' END AS "TitleOfCourtesy",
        strftime(DATE '1950-01-01' + cast(c_custkey % 15000 AS INTEGER), '%-m/%-d/%Y') AS "BirthDate",
        strftime(DATE '1990-01-01' + cast(c_custkey % 9000 AS INTEGER), '%-m/%-d/%Y')
          || ' 9:05' AS "HireDate",
        {_place('c_custkey')},
        CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_mktsegment END AS "Region", {_post('c_custkey')},
        '557-' || c_custkey AS "HomePhone", cast(c_custkey % 10000 AS BIGINT) AS "Extension",
        'photo.bmp' AS "Photo", 'Joined.' || chr(10) || 'No. ' || c_custkey AS "Notes",
        CASE WHEN c_custkey % 11 <> 0 THEN cast(c_custkey % 9 + 1 AS DOUBLE) END AS "ReportsTo"
      {_COPIES.format(t='customer', k='c_custkey')}
    """,
    "raw_products": f"""
      SELECT cast(p_partkey + 100 AS VARCHAR) AS "ProductID", p_name AS "ProductName",
        cast(p_partkey % 100 + 1 AS VARCHAR) AS "SupplierID",
        CASE WHEN p_partkey % 31 <> 0 THEN cast(p_size + 10 AS VARCHAR) END AS "CategoryID",
        p_brand AS "QuantityPerUnit",
        CASE WHEN p_partkey % 23 = 0 THEN 'n/a'
             ELSE cast(p_retailprice AS VARCHAR) END AS "UnitPrice",
        cast(p_size AS VARCHAR) AS "UnitsInStock",
        CASE WHEN p_partkey % 7 = 0 THEN '' ELSE cast(p_partkey % 40 AS VARCHAR) END AS "UnitsOnOrder",
        cast(p_partkey % 30 AS VARCHAR) AS "ReorderLevel", p_partkey % 3 = 0 AS "Discontinued"
      {_COPIES.format(t='part', k='p_partkey')}
    """,
    "raw_categories": """
      SELECT CASE WHEN p_partkey % 37 <> 0 THEN cast(p_size AS VARCHAR) END AS "CategoryID",
        ' Size ' || p_size || ' ' AS "CategoryName", 'Parts of size ' || p_size AS "Description",
        cast(NULL AS VARCHAR) AS "Picture",
        CASE WHEN p_partkey % 2 = 0 THEN ' ' END AS "Remarks"
      FROM part
    """,
    "raw_suppliers": f"""
      SELECT CASE WHEN s_suppkey % 41 = 0 THEN ' ' ELSE cast(s_suppkey AS VARCHAR) END AS "SupplierID",
        ' ' || s_name AS "CompanyName", {_contact('s_suppkey', 'Seller')},
        CASE WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 4 = 0 THEN NULL
             ELSE 'Region ' || s_nationkey END AS "Region", {_reach('s_suppkey')},
        CASE WHEN s_suppkey % 9 = 0 THEN 'https://supplier.example' END AS "HomePage"
      {_COPIES.format(t='supplier', k='s_suppkey')}
    """,
    "raw_shippers": """
      SELECT cast(s_nationkey AS VARCHAR) AS "ShipperID",
        '  Carrier ' || s_nationkey || '  ' AS "CompanyName", '558-' || s_nationkey AS "Phone"
      FROM supplier
    """,
}


def stamp(name: str, fmt: str = "'%-m/%-d/%Y %-H:%M'") -> str:
    return f'cast(try_strptime("{name}", {fmt}) AS TIMESTAMP) AS "{name}"'


# Read with a time if there is one, else as a plain date.
LENIENT = "['%-m/%-d/%Y %-H:%M', '%-m/%-d/%Y']"


def key(*names: str) -> str:
    return num(*names, to="BIGINT")


def num(*names: str, to: str = "INTEGER") -> str:
    return ", ".join(f'try_cast("{n}" AS {to}) AS "{n}"' for n in names)


def keep(*names: str) -> str:
    return ", ".join(f'"{n}"' for n in names)


def region() -> str:
    return """CASE WHEN "Region" IS NULL OR trim("Region") = '' THEN 'Unknown'
                   ELSE "Region" END AS "Region\""""


def one_per(keys: str, rest: str, newest: str = "") -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in rest.split(", "))
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {newest}{order}) = 1"


_PLACE = ("ContactName", "ContactTitle", "Address", "City")
_REACH = ("PostalCode", "Country", "Phone", "Fax")
_EMPLOYEE_TAIL = ("PostalCode", "Country", "HomePhone", "Extension", "Photo", "Notes")


def _employees(fmt: str) -> str:
    return f"""
      SELECT * FROM (
        SELECT {key('EmployeeID')}, {keep('LastName', 'FirstName', 'Title', 'TitleOfCourtesy')},
          {stamp('BirthDate', fmt)}, {stamp('HireDate', fmt)}, {keep('Address', 'City')}, {region()},
          {keep(*_EMPLOYEE_TAIL)}, cast("ReportsTo" AS BIGINT) AS "ReportsTo"
        FROM raw_employees)
      WHERE "EmployeeID" IS NOT NULL {one_per('"EmployeeID"', keep('LastName', 'Notes'))}
    """


SILVER = {
    "silver_orders": f"""
      SELECT * FROM (
        SELECT {key('OrderID')}, trim("Customer key") AS "CustomerID", {key('EmployeeID')},
          {stamp('OrderDate')}, {stamp('RequiredDate')}, {stamp('ShippedDate')}, {key('ShipVia')},
          {num('Freight', to='DOUBLE')}, "Region", source_file
        FROM raw_orders)
      WHERE "OrderID" IS NOT NULL AND "CustomerID" IS NOT NULL
      {one_per('"OrderID"', keep('CustomerID', 'OrderDate'), 'source_file DESC NULLS LAST, ')}
    """,
    "silver_order_details": f"""
      SELECT * FROM (
        SELECT {key('OrderID', 'ProductID')}, "LineNumber", {num('UnitPrice', to='DOUBLE')},
          {num('Quantity')}, {num('Discount', to='DOUBLE')}
        FROM raw_order_details)
      WHERE "OrderID" IS NOT NULL AND "ProductID" IS NOT NULL
      {one_per('"OrderID", "ProductID"', keep('LineNumber', 'UnitPrice', 'Quantity', 'Discount'))}
    """,
    "silver_customers": f"""
      SELECT * FROM (
        SELECT trim("CustomerID") AS "CustomerID", trim("CompanyName") AS "CompanyName",
          {keep(*_PLACE)}, {region()}, {keep(*_REACH)}
        FROM raw_customers)
      WHERE "CustomerID" IS NOT NULL AND "CustomerID" <> ''
      {one_per('"CustomerID"', keep('CompanyName'))}
    """,
    "silver_employees": _employees(LENIENT),
    "silver_products": f"""
      SELECT * FROM (
        SELECT {key('ProductID')}, "ProductName", {key('SupplierID', 'CategoryID')},
          "QuantityPerUnit", {num('UnitPrice', to='DOUBLE')},
          {num('UnitsInStock', 'UnitsOnOrder', 'ReorderLevel')}, "Discontinued"
        FROM raw_products)
      WHERE "ProductID" IS NOT NULL {one_per('"ProductID"', keep('ProductName'))}
    """,
    "silver_categories": f"""
      SELECT * FROM (
        SELECT {key('CategoryID')}, trim("CategoryName") AS "CategoryName", "Description"
        FROM raw_categories)
      WHERE "CategoryID" IS NOT NULL {one_per('"CategoryID"', keep('CategoryName'))}
    """,
    "silver_suppliers": f"""
      SELECT * FROM (
        SELECT {key('SupplierID')}, trim("CompanyName") AS "CompanyName", {keep(*_PLACE)}, {region()},
          {keep(*_REACH)}, "HomePage"
        FROM raw_suppliers)
      WHERE "SupplierID" IS NOT NULL {one_per('"SupplierID"', keep('CompanyName'))}
    """,
    "silver_shippers": f"""
      SELECT * FROM (
        SELECT {key('ShipperID')}, trim("CompanyName") AS "CompanyName", "Phone" FROM raw_shippers)
      WHERE "ShipperID" IS NOT NULL {one_per('"ShipperID"', keep('CompanyName'))}
    """,
}

_DATE_KEY = "cast(strftime({d}, '%Y%m%d') AS INTEGER)"

GOLD = {
    "dim_dates": f"""
      SELECT d AS "date", {_DATE_KEY.format(d='d')} AS date_key,
        cast(year(d) AS INTEGER) AS "year", cast(month(d) AS INTEGER) AS "month",
        cast(day(d) AS INTEGER) AS "day", dayname(d) AS day_name,
        cast(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
        cast(weekofyear(d) AS INTEGER) AS week_of_year, cast(quarter(d) AS INTEGER) AS "quarter",
        dayofweek(d) IN (0, 6) AS is_weekend
      FROM (SELECT DISTINCT cast("OrderDate" AS DATE) AS d FROM silver_orders)
    """,
    "dim_customers": f"""
      SELECT {keep('CustomerID', 'CompanyName', *_PLACE, 'Region', *_REACH)} FROM silver_customers
    """,
    "dim_employees": f"""
      SELECT {keep('EmployeeID', 'Title', 'TitleOfCourtesy', 'BirthDate', 'HireDate', 'Address',
                   'City', 'Region', 'PostalCode', 'Country', 'HomePhone', 'Extension', 'ReportsTo')},
        'retail' AS source_system
      FROM silver_employees
    """,
    "dim_products": """
      SELECT p."ProductID", p."ProductName", p."SupplierID", p."CategoryID", c."CategoryName",
        c."Description" AS "CategoryDescription", p."QuantityPerUnit",
        p."UnitPrice" AS "ProductListPrice", p."UnitsInStock", p."UnitsOnOrder", p."ReorderLevel",
        p."Discontinued", 'retail' AS source_system
      FROM silver_products p LEFT JOIN silver_categories c ON p."CategoryID" = c."CategoryID"
    """,
    "dim_suppliers": f"""
      SELECT "SupplierID", "CompanyName" AS "SupplierName", {keep(*_PLACE)}, "Region",
        {keep(*_REACH)}, "HomePage", 'retail' AS source_system
      FROM silver_suppliers
    """,
    "dim_shippers": """
      SELECT "ShipperID", "CompanyName" AS "ShipperName", "Phone" FROM silver_shippers
    """,
    "fact_orders": f"""
      SELECT d."OrderID", d."ProductID", p."SupplierID", o."CustomerID", o."EmployeeID",
        o."ShipVia" AS "ShipperID", {_DATE_KEY.format(d='o."OrderDate"')} AS date_key,
        d."UnitPrice", d."Quantity", d."Discount",
        d."UnitPrice" * d."Quantity" * (1 - d."Discount") AS "TotalAmount",
        o."Freight", o."OrderDate", o."RequiredDate", o."ShippedDate"
      FROM silver_order_details d
      JOIN silver_orders o ON d."OrderID" = o."OrderID"
      LEFT JOIN silver_products p ON d."ProductID" = p."ProductID"
    """,
}

_VIEWS = {**RAW, **SILVER, **GOLD}


def _uses(text: str) -> list[str]:
    """The shared views a query needs, in definition order."""
    wanted: set[str] = set()

    def visit(body: str) -> None:
        words = set(body.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in _VIEWS:
            if name in words and name not in wanted:
                wanted.add(name)
                visit(_VIEWS[name])

    visit(text)
    return [name for name in _VIEWS if name in wanted]


def with_views(query: str) -> str:
    """The query, preceded by the shared views it reads."""
    views = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in _uses(query))
    return f"WITH {views}\n{query}" if views else query


def blank(name: str) -> str:
    return f"""("{name}" IS NULL OR trim(cast("{name}" AS VARCHAR)) = '')"""


def column_checks(view: str, table: str, columns: list[str], required: list[str],
                  provenance: tuple[str, ...]) -> str:
    """Check rows of one table: rows, blanks, required columns, fully blank rows."""
    def row(check: str, column: str | None, value: str, flagged: str) -> str:
        named = f"'{column}'" if column else "cast(NULL AS VARCHAR)"
        return (
            f"SELECT '{table}' AS table_name, '{check}' AS check_name, {named} AS column_name, "
            f"cast({value} AS BIGINT) AS value, {flagged} AS flagged FROM {view}"
        )

    business = " AND ".join(blank(c) for c in columns if c not in provenance)
    count = "count(*) FILTER (WHERE {})".format
    parts = [
        row("rows", None, "count(*)", "false"),
        row("fully_blank_rows", None, count(business), f"{count(business)} > 0"),
    ]
    for c in columns:
        parts.append(row("blank_values", c, count(blank(c)), f"{count(blank(c))} = count(*)"))
    for c in required:
        if c in columns:
            parts.append(row("required_blank", c, count(blank(c)), f"{count(blank(c))} > 0"))
        missing = 0 if c in columns else 1
        parts.append(row("missing_required", c, f"min({missing})", "true" if missing else "false"))
    return "\nUNION ALL ".join(parts)


def duplicate_keys(view: str, keys: list[str], ignore_blank: bool = True) -> str:
    names = keep(*keys)
    where = " AND ".join(f"NOT {blank(k)}" for k in keys) if ignore_blank else "true"
    return f"""SELECT count(*) AS duplicate_groups,
        cast(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows
      FROM (SELECT count(*) AS n FROM {view} WHERE {where} GROUP BY {names} HAVING count(*) > 1)"""


def key_checks(view: str, table: str, keys: list[str], ignore_blank: bool = True) -> str:
    counts = duplicate_keys(view, keys, ignore_blank)
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS check_name, cast(NULL AS VARCHAR) AS column_name, "
        f"{c} AS value, {c} > 0 AS flagged FROM ({counts})"
        for c in ("duplicate_groups", "duplicate_rows")
    )


# Fixed values, written out here so that the SQL does not share them with the library.
REQUIRED_BRONZE = {
    "orders": ["OrderID", "Customer key", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate",
               "ShipVia", "Freight"],
    "order_details": ["OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"],
    "customers": ["CustomerID", "CompanyName"],
    "employees": ["EmployeeID", "Region"],
    "products": ["ProductID", "ProductName", "SupplierID", "CategoryID"],
    "categories": ["CategoryID", "CategoryName", "Picture"],
    "suppliers": ["SupplierID", "CompanyName"],
    "shippers": ["ShipperID", "CompanyName"],
}
REQUIRED_SILVER = {
    "orders": ["OrderID", "CustomerID", "EmployeeID", "OrderDate", "ShipVia"],
    "order_details": ["OrderID", "ProductID", "UnitPrice", "Quantity", "Discount"],
    "customers": ["CustomerID", "CompanyName"],
    "employees": ["EmployeeID"],
    "products": ["ProductID", "ProductName", "SupplierID", "CategoryID"],
    "categories": ["CategoryID", "CategoryName"],
    "suppliers": ["SupplierID", "CompanyName"],
    "shippers": ["ShipperID", "CompanyName"],
}
KEYS = {
    "orders": ["OrderID"], "order_details": ["OrderID", "ProductID"], "customers": ["CustomerID"],
    "employees": ["EmployeeID"], "products": ["ProductID"], "categories": ["CategoryID"],
    "suppliers": ["SupplierID"], "shippers": ["ShipperID"],
}
TABLES = tuple(KEYS)
AUDIT = ("ingestion_time", "source_file", "bronze_ingestion_time")


def clean_counts(table: str, columns: list[str], broken: str = "0") -> str:
    """One row per table: rows before, blank, unreadable, bad key, duplicate, after."""
    full = " AND ".join(blank(c) for c in columns if c not in AUDIT)
    rows = f"(SELECT count(*) FROM raw_{table})"
    empty = f"(SELECT count(*) FROM raw_{table} WHERE {full})"
    usable, names = _USABLE[table], keep(*KEYS[table])
    keyed = f"SELECT * FROM ({_KEYED[table]}) WHERE {usable}"
    good = f"(SELECT count(*) FROM ({keyed}))"
    kept = f"(SELECT count(*) FROM (SELECT DISTINCT {names} FROM ({keyed})))"
    return f"""SELECT '{table}' AS table_name, {rows} + {broken} AS rows_before, {empty} AS blank,
      cast({broken} AS BIGINT) AS unreadable, {rows} - {empty} - {good} AS bad_key,
      {good} - {kept} AS duplicate, {kept} AS rows_after"""


_KEYED = {
    "orders": f"""SELECT {key('OrderID')}, trim("Customer key") AS "CustomerID" FROM raw_orders""",
    "order_details": f"SELECT {key('OrderID', 'ProductID')} FROM raw_order_details",
    "customers": """SELECT trim("CustomerID") AS "CustomerID" FROM raw_customers""",
    "employees": f"SELECT {key('EmployeeID')} FROM raw_employees",
    "products": f"SELECT {key('ProductID')} FROM raw_products",
    "categories": f"SELECT {key('CategoryID')} FROM raw_categories",
    "suppliers": f"SELECT {key('SupplierID')} FROM raw_suppliers",
    "shippers": f"SELECT {key('ShipperID')} FROM raw_shippers",
}
_USABLE = {
    "orders": '"OrderID" IS NOT NULL AND "CustomerID" IS NOT NULL',
    "order_details": '"OrderID" IS NOT NULL AND "ProductID" IS NOT NULL',
    "customers": "\"CustomerID\" IS NOT NULL AND \"CustomerID\" <> ''",
    "employees": '"EmployeeID" IS NOT NULL',
    "products": '"ProductID" IS NOT NULL',
    "categories": '"CategoryID" IS NOT NULL',
    "suppliers": '"SupplierID" IS NOT NULL',
    "shippers": '"ShipperID" IS NOT NULL',
}
