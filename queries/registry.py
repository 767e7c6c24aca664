"""Every registered query: a Spark callable and, where SQL can say it, the oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astrolode.functions.provenance import built_at, source_system
from astrolode.operators import quality, star
from astrolode.operators.clean import clean, drop_empty_columns
from astrolode.operators.ingest import ingest_table, unseen_rows
from astrolode.plans import jobs
from astrolode.plans.lake import BRONZE, GOLD, SILVER, Lake
from astrolode.session import apply_defaults, run_each, shared_dir
from astrolode.sources import files, sinks
from astrolode.spec import (
    APPEND,
    CATALOG,
    CORRUPT_RECORD,
    DATE_TIME_FORMAT,
    PROVENANCE,
    SOURCE_FILE,
    UNDECLARED,
    TableSpec,
)
from astrolode.streaming.clean import (
    clean_stream,
    clean_stream_within,
    read_late,
    read_silver,
    read_within,
)
from astrolode.streaming.ingest import ingest_stream
from queries import raw, sql

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    oracle: str | None


ENTRIES: dict[str, Entry] = {}

PARALLEL = 4


def query(oracle: str | None) -> Callable[[Query], Query]:
    """Register a function under its own name, together with its SQL counterpart."""
    def register(run: Query) -> Query:
        def with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(apply_defaults(spark), sf_dir)

        ENTRIES[run.__name__] = Entry(with_defaults, sql.with_views(oracle) if oracle else None)
        return run

    return register


def naive_times(df: DataFrame) -> DataFrame:
    """Zoned timestamps as naive ones, the type of the given tables."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned})


def business(df: DataFrame, *also: str) -> DataFrame:
    return df.drop(*PROVENANCE, *also)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return clean(raw.table(spark, sf_dir, table), CATALOG[table])


# --- Gold ---------------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"), F.col("l_partkey").alias("ProductID"),
        F.col("l_extendedprice").alias("UnitPrice"), F.col("l_quantity").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
    )


def _heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return raw.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderID"), F.col("o_custkey").cast("string").alias("CustomerID"),
        (F.col("o_custkey") % 9 + 1).alias("EmployeeID"),
        (F.col("o_orderkey") % 3 + 1).alias("ShipVia"), F.col("o_totalprice").alias("Freight"),
        day.alias("OrderDate"), (day + F.expr("INTERVAL 28 DAYS")).alias("RequiredDate"),
        (day + F.expr("INTERVAL 5 DAYS")).alias("ShippedDate"),
    )


def _goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.load(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 100).alias("ProductID"), (F.col("p_partkey") % 100 + 1).alias("SupplierID")
    )


@query("""
    SELECT l_orderkey AS "OrderID", l_partkey AS "ProductID",
      CASE WHEN p_partkey IS NOT NULL THEN p_partkey % 100 + 1 END AS "SupplierID",
      cast(o_custkey AS VARCHAR) AS "CustomerID", o_custkey % 9 + 1 AS "EmployeeID",
      o_orderkey % 3 + 1 AS "ShipperID",
      cast(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
      l_extendedprice AS "UnitPrice", l_quantity AS "Quantity", l_discount AS "Discount",
      l_extendedprice * l_quantity * (1 - l_discount) AS "TotalAmount", o_totalprice AS "Freight",
      o_orderdate AS "OrderDate", o_orderdate + INTERVAL 28 DAY AS "RequiredDate",
      o_orderdate + INTERVAL 5 DAY AS "ShippedDate"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey + 100
""")
def fact_orders(spark, sf_dir):
    fact = star.fact_orders(_lines(spark, sf_dir), _heads(spark, sf_dir), _goods(spark, sf_dir))
    return fact.drop("gold_created_at")


@query("""
    SELECT l_orderkey AS "OrderID", l_partkey AS "ProductID", l_quantity AS "Quantity",
      cast(cast(l_extendedprice AS DECIMAL(18,4)) * cast(l_quantity AS DECIMAL(10,0))
        * (1 - cast(l_discount AS DECIMAL(6,4))) AS DECIMAL(18,4)) AS "TotalAmount"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def fact_amount_decimal(spark, sf_dir):
    frames = (part(spark, sf_dir) for part in (_lines, _heads, _goods))
    return star.fact_orders(*frames, decimal=True).select("OrderID", "ProductID", "Quantity", "TotalAmount")


@query("SELECT * FROM dim_dates")
def dim_dates(spark, sf_dir):
    return star.dim_dates(silver(spark, sf_dir, "orders"))


@query("""
    SELECT cast(d AS DATE) AS "date", cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
      cast(year(d) AS INTEGER) AS "year", cast(month(d) AS INTEGER) AS "month",
      cast(day(d) AS INTEGER) AS "day", dayname(d) AS day_name,
      cast(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
      cast(weekofyear(d) AS INTEGER) AS week_of_year, cast(quarter(d) AS INTEGER) AS "quarter",
      dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(min(cast(o_orderdate AS DATE)),
            max(cast(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)
""")
def dim_dates_dense(spark, sf_dir):
    return star.dim_dates(_heads(spark, sf_dir), dense=True)


@query("SELECT * FROM dim_customers")
def dim_customers(spark, sf_dir):
    return star.dim_customers(silver(spark, sf_dir, "customers"))


@query("SELECT * FROM dim_employees")
def dim_employees(spark, sf_dir):
    return naive_times(star.dim_employees(silver(spark, sf_dir, "employees"), raw.SOURCE))


@query("SELECT * FROM dim_products")
def dim_products(spark, sf_dir):
    products, categories = (silver(spark, sf_dir, t) for t in ("products", "categories"))
    return star.dim_products(products, categories, raw.SOURCE)


@query("SELECT * FROM dim_suppliers")
def dim_suppliers(spark, sf_dir):
    return star.dim_suppliers(silver(spark, sf_dir, "suppliers"), raw.SOURCE)


@query("SELECT * FROM dim_shippers")
def dim_shippers(spark, sf_dir):
    return star.dim_shippers(silver(spark, sf_dir, "shippers"))


_GOLD_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS \"rows\" FROM {t}" for t in sql.GOLD
)


@query(_GOLD_COUNTS)
def gold_summary(spark, sf_dir):
    """Rows per gold table, as the writes of the gold job have counted them."""
    _, written = _gold_lake(spark, sf_dir)
    return spark.createDataFrame(list(written.items()), "table_name STRING, rows BIGINT")


# --- Quality ------------------------------------------------------------------------------

_COLUMNS = {
    "orders": ["OrderID", "Customer key", "EmployeeID", "OrderDate", "RequiredDate", "ShippedDate",
               "ShipVia", "Freight", "Region", "source_file"],
    "order_details": ["OrderID", "ProductID", "LineNumber", "UnitPrice", "Quantity", "Discount"],
    "customers": ["CustomerID", "CompanyName", "ContactName", "ContactTitle", "Address", "City",
                  "Region", "PostalCode", "Country", "Phone", "Fax"],
    "employees": ["EmployeeID", "LastName", "FirstName", "Title", "TitleOfCourtesy", "BirthDate",
                  "HireDate", "Address", "City", "Region", "PostalCode", "Country", "HomePhone",
                  "Extension", "Photo", "Notes", "ReportsTo"],
    "products": ["ProductID", "ProductName", "SupplierID", "CategoryID", "QuantityPerUnit",
                 "UnitPrice", "UnitsInStock", "UnitsOnOrder", "ReorderLevel", "Discontinued"],
    "categories": ["CategoryID", "CategoryName", "Description", "Picture", "Remarks"],
    "suppliers": ["SupplierID", "CompanyName", "ContactName", "ContactTitle", "Address", "City",
                  "Region", "PostalCode", "Country", "Phone", "Fax", "HomePage"],
    "shippers": ["ShipperID", "CompanyName", "Phone"],
}


def _checks_sql(table: str, required: list[str] | None = None) -> str:
    wanted = sql.REQUIRED_BRONZE[table] if required is None else required
    return sql.column_checks(f"raw_{table}", table, _COLUMNS[table], wanted, sql.AUDIT)


@query(_checks_sql("orders"))
def dq_profile(spark, sf_dir):
    df = raw.table(spark, sf_dir, "orders")
    return quality.column_checks(df, "orders", CATALOG["orders"].required_bronze)


_WITH_ABSENT = [*sql.REQUIRED_BRONZE["orders"], "ShipCity"]


@query(f"""
    SELECT column_name, check_name, value, flagged FROM ({_checks_sql("orders", _WITH_ABSENT)})
    WHERE check_name IN ('missing_required', 'required_blank')
""")
def dq_required_columns(spark, sf_dir):
    checks = quality.column_checks(raw.table(spark, sf_dir, "orders"), "orders", _WITH_ABSENT)
    wanted = F.col("check_name").isin(quality.MISSING, quality.REQUIRED_BLANK)
    return checks.filter(wanted).select("column_name", "check_name", "value", "flagged")


@query(f"""
    SELECT column_name, value AS "rows" FROM ({_checks_sql("categories")})
    WHERE check_name = 'blank_values' AND flagged
""")
def dq_empty_columns(spark, sf_dir):
    checks = quality.column_checks(raw.table(spark, sf_dir, "categories"), "categories")
    empty = (F.col("check_name") == quality.BLANK) & F.col("flagged")
    return checks.filter(empty).select("column_name", F.col("value").alias("rows"))


@query(sql.duplicate_keys("raw_orders", ["OrderID"]))
def dq_dup_keys(spark, sf_dir):
    return quality.duplicate_keys(raw.table(spark, sf_dir, "orders"), ["OrderID"])


@query(sql.duplicate_keys("raw_orders", ["OrderID"], ignore_blank=False))
def dq_dup_keys_null_counts(spark, sf_dir):
    orders = raw.table(spark, sf_dir, "orders")
    return quality.duplicate_keys(orders, ["OrderID"], ignore_blank=False)


@query(sql.duplicate_keys("raw_order_details", ["OrderID", "ProductID"]))
def dq_dup_composite(spark, sf_dir):
    lines = raw.table(spark, sf_dir, "order_details")
    return quality.duplicate_keys(lines, ["OrderID", "ProductID"])


_REPORT = "\nUNION ALL ".join(
    f"{_checks_sql(t)}\nUNION ALL {sql.key_checks(f'raw_{t}', t, sql.KEYS[t])}"
    for t in sql.TABLES
)


@query(_REPORT)
def dq_bronze_report(spark, sf_dir):
    return quality.bronze_report(raw.tables(spark, sf_dir))


def _gate_sql(view: str, table: str, rename: str = "*") -> str:
    nulls = " + ".join(f"count(*) FILTER (WHERE {sql.blank(c)})" for c in sql.REQUIRED_SILVER[table])
    source = f"(SELECT {rename} FROM {view})"
    names = ["CustomerID" if c == "Customer key" else c for c in _COLUMNS[table]]
    dropped = {"Picture", "Remarks"}
    business = [c for c in names if c not in sql.AUDIT and c not in dropped]
    full = " AND ".join(sql.blank(c) for c in business)
    dups = sql.duplicate_keys(source, sql.KEYS[table], ignore_blank=False)
    return f"""
      SELECT '{table}' AS table_name, count(*) AS "rows", {nulls} AS required_nulls,
        cast(0 AS BIGINT) AS missing_columns,
        (SELECT duplicate_groups FROM ({dups})) AS duplicate_keys,
        count(*) FILTER (WHERE {full}) AS fully_null_rows,
        cast(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS empty_table
      FROM {source}"""


_CLEANED = "\nUNION ALL ".join(
    _gate_sql(f"silver_{t}", t) for t in sql.TABLES if t not in ("orders", "shippers")
)
_DIRTY = '* RENAME ("Customer key" AS "CustomerID")'
_GATE = f"""
    SELECT *, required_nulls + missing_columns + duplicate_keys + fully_null_rows + empty_table
        AS errors,
      CASE WHEN required_nulls + missing_columns + duplicate_keys + fully_null_rows + empty_table = 0
        THEN 'CLEAN' ELSE 'NEEDS REVIEW' END AS status
    FROM ({_gate_sql("raw_orders", "orders", _DIRTY)}
      UNION ALL {_gate_sql("(SELECT * FROM silver_shippers WHERE false)", "shippers")}
      UNION ALL {_CLEANED})
"""


def _gate(spark, sf_dir):
    """All eight tables: one of them never cleaned, one without rows."""
    tables = {t: silver(spark, sf_dir, t) for t in CATALOG}
    tables["orders"] = raw.table(spark, sf_dir, "orders").withColumnsRenamed(CATALOG["orders"].renames)
    tables["shippers"] = tables["shippers"].filter("false")
    return quality.silver_gate(tables)


@query(_GATE)
def dq_silver_gate(spark, sf_dir):
    return _gate(spark, sf_dir)


@query(f"""
    SELECT count(*) AS tables, cast(sum(errors) AS BIGINT) AS total_errors,
      CASE WHEN sum(errors) = 0 THEN 'PASSED' ELSE 'FAILED' END AS verdict
    FROM ({_GATE})
""")
def dq_silver_verdict(spark, sf_dir):
    return quality.verdict(_gate(spark, sf_dir))


def _dirty_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """All eight tables landed and taken in, with some lines of orders cut off half-way."""
    lake, specs = _land_all(spark, sf_dir)
    lines = raw.load(spark, sf_dir, "orders").filter(f"o_orderkey % {_BROKEN} = 0")
    lines.select(F.substring(F.to_json(F.struct("*")), 1, 25).alias("value")).write.text(
        f"{lake.landing}/orders_batch_broken.json")
    jobs.landing_to_bronze(spark, lake, specs, PARALLEL)
    return lake


_BROKEN = 89
_BROKEN_ROWS = f"(SELECT count(*) FROM orders WHERE o_orderkey % {_BROKEN} = 0)"
_LANDED_CHECKS = ("rows", "fully_blank_rows", "unreadable_rows", "rows_with_undeclared_fields")


def _landed_sql(table: str) -> str:
    """The checks of a landed table that do not name a column."""
    broken = _BROKEN_ROWS if table == "orders" else "0"
    full = " AND ".join(sql.blank(c) for c in _COLUMNS[table] if c not in sql.AUDIT)
    rows, empty = (f"(SELECT count(*) FROM raw_{table}{where}) + {broken}" for where in ("", f" WHERE {full}"))
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, cast({value} AS BIGINT) AS value, "
        f"{'false' if check == 'rows' else f'{value} > 0'} AS flagged"
        for check, value in zip(_LANDED_CHECKS, (rows, empty, broken, "0"), strict=True)
    )


@query("\nUNION ALL ".join(map(_landed_sql, sql.TABLES)))
def dq_bronze_landed(spark, sf_dir):
    report = jobs.bronze_report(spark, _dirty_lake(spark, sf_dir))
    return report.filter(F.col("check_name").isin(*_LANDED_CHECKS)).drop("column_name")


@query("\nUNION ALL ".join(
    sql.clean_counts(t, _COLUMNS[t], _BROKEN_ROWS if t == "orders" else "0") for t in sql.TABLES
))
def clean_counts(spark, sf_dir):
    return jobs.clean_counts(spark, _dirty_lake(spark, sf_dir))


# --- Cleaning -----------------------------------------------------------------------------


@query("SELECT * EXCLUDE (source_file) FROM silver_orders")
def clean_orders(spark, sf_dir):
    return naive_times(business(silver(spark, sf_dir, "orders")))


@query("SELECT * FROM silver_order_details")
def clean_order_details(spark, sf_dir):
    return silver(spark, sf_dir, "order_details")


@query("SELECT * FROM silver_customers")
def clean_customers(spark, sf_dir):
    return silver(spark, sf_dir, "customers")


@query("SELECT * FROM silver_employees")
def clean_employees(spark, sf_dir):
    return naive_times(silver(spark, sf_dir, "employees"))


@query(sql._employees("'%-m/%-d/%Y %-H:%M'"))
def clean_employees_strict_dates(spark, sf_dir):
    spec = CATALOG["employees"].with_(date_format=DATE_TIME_FORMAT)
    return naive_times(clean(raw.table(spark, sf_dir, "employees"), spec))


@query("SELECT * FROM silver_products")
def clean_products(spark, sf_dir):
    return silver(spark, sf_dir, "products")


@query("SELECT * FROM silver_categories")
def clean_categories(spark, sf_dir):
    return silver(spark, sf_dir, "categories")


@query("SELECT * FROM silver_suppliers")
def clean_suppliers(spark, sf_dir):
    return silver(spark, sf_dir, "suppliers")


@query("SELECT * FROM silver_shippers")
def clean_shippers(spark, sf_dir):
    return silver(spark, sf_dir, "shippers")


@query('SELECT "CategoryID", "CategoryName", "Description" FROM raw_categories')
def drop_empty(spark, sf_dir):
    return drop_empty_columns(raw.table(spark, sf_dir, "categories"))


# --- Ingest -------------------------------------------------------------------------------


def _lake(spark: SparkSession) -> Lake:
    return Lake(shared_dir(spark, "lake"))


def _landed(df: DataFrame, table: str, lake: Lake, batch: str) -> TableSpec:
    """Land a batch and return the spec that reads it back (raw tables are mostly text)."""
    landing = df.drop(SOURCE_FILE)
    jobs.land_batch(landing, lake, table, batch)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in landing.schema.fields)
    return CATALOG[table].with_(landing_ddl=ddl)


@query("SELECT * FROM orders")
def ing_jsonl_roundtrip(spark, sf_dir):
    orders = raw.load(spark, sf_dir, "orders")
    path = shared_dir(spark, "jsonl")
    sinks.write_json_lines(orders, path)
    return files.read_json_lines(spark, path, orders.schema)


@query("SELECT * FROM customer")
def ing_csv_header_trim(spark, sf_dir):
    customer = raw.load(spark, sf_dir, "customer")
    path = shared_dir(spark, "csv")
    sinks.write_csv(customer.toDF(*(f" {c} " for c in customer.columns)), path)
    text = files.read_csv(spark, path)
    return text.select(*(F.col(f.name).cast(f.dataType) for f in customer.schema.fields))


@query("SELECT * FROM raw_customers")
def ing_csv_multi_line(spark, sf_dir):
    customers = raw.table(spark, sf_dir, "customers")
    path = shared_dir(spark, "csv")
    # Told apart from NULL on the way back: CSV itself has one spelling for both.
    sinks.write_csv(customers.fillna("\\N"), path)
    text = files.read_csv(spark, path)
    return text.select(*(
        F.when(F.col(c) != "\\N", F.col(c)).when(F.col(c).isNull(), F.lit("")).alias(c)
        for c in text.columns
    ))


@query("""
    SELECT 'customer' AS table_name, true AS found, count(*) AS "rows" FROM customer
    UNION ALL SELECT 'orders', true, count(*) FROM orders
    UNION ALL SELECT 'returns', false, 0
""")
def ing_missing_source(spark, sf_dir):
    absent = shared_dir(spark, "absent")
    results = files.read_all({
        "customer": lambda: raw.load(spark, sf_dir, "customer"),
        "orders": lambda: raw.load(spark, sf_dir, "orders"),
        "returns": lambda: files.read_json_lines(spark, f"{absent}/returns_*.json", "id BIGINT"),
    })
    return quality.presence(spark, {t: r.df for t, r in results.items()})


_EARLY = f"{SOURCE_FILE} IN ('batch_0', 'batch_3')"
_LATE = f"NOT {_EARLY}"


def _three_runs(spark: SparkSession, sf_dir: str):
    """Ingest two source files, then the other three, then again with nothing new."""
    orders, lake = raw.table(spark, sf_dir, "orders"), _lake(spark)
    results = []
    for batch, files_of in (("early", _EARLY), ("late", _LATE)):
        spec = _landed(orders.filter(files_of), "orders", lake, batch)
        results.append(ingest_table(spark, spec, lake.landing, lake.path(BRONZE, "orders")))
    results.append(ingest_table(spark, spec, lake.landing, lake.path(BRONZE, "orders")))
    return lake, results


@query("""
    SELECT * EXCLUDE (source_file),
      CASE WHEN source_file IN ('batch_0', 'batch_3') THEN 'early' ELSE 'late' END AS batch
    FROM raw_orders
""")
def ing_incremental_anti(spark, sf_dir):
    lake, _ = _three_runs(spark, sf_dir)
    bronze = lake.read(spark, BRONZE, "orders")
    batch = F.regexp_extract(SOURCE_FILE, r"orders_batch_(\w+)\.json", 1).alias("batch")
    return business(bronze.select("*", batch), CORRUPT_RECORD, UNDECLARED)


@query("""
    SELECT 1 AS run, 'ingested' AS status,
      count(*) FILTER (WHERE source_file IN ('batch_0', 'batch_3')) AS new_rows FROM raw_orders
    UNION ALL SELECT 2, 'ingested',
      count(*) FILTER (WHERE source_file NOT IN ('batch_0', 'batch_3')) FROM raw_orders
    UNION ALL SELECT 3, 'nothing new', 0
""")
def ing_run_counts(spark, sf_dir):
    _, results = _three_runs(spark, sf_dir)
    rows = [(i, r.status, r.new_rows) for i, r in enumerate(results, 1)]
    return spark.createDataFrame(rows, "run INT, status STRING, new_rows BIGINT")


@query("""
    SELECT * EXCLUDE (source_file) FROM raw_orders WHERE source_file IN ('batch_0', 'batch_3')
""")
def ing_committed_reads(spark, sf_dir):
    """Bronze while a second append has written its rows but not yet entered its files."""
    orders, lake = raw.table(spark, sf_dir, "orders"), _lake(spark)
    spec = _landed(orders.filter(_EARLY), "orders", lake, "early")
    jobs.landing_to_bronze(spark, lake, {"orders": spec})
    sinks.overwrite_parquet(orders.filter(_LATE), f"{lake.path(BRONZE, 'orders')}/{APPEND}=1")
    return business(lake.read(spark, BRONZE, "orders"), CORRUPT_RECORD, UNDECLARED)


@query("SELECT * FROM raw_orders WHERE source_file NOT IN ('batch_0', 'batch_3')")
def ing_unseen_rows(spark, sf_dir):
    orders = raw.table(spark, sf_dir, "orders")
    return unseen_rows(orders, orders.filter(_EARLY)).select(orders.columns)


_ALL_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, 'ingested' AS status, count(*) AS new_rows FROM raw_{t}"
    for t in CATALOG
)


def _land_all(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, TableSpec]]:
    lake = _lake(spark)
    frames = raw.tables(spark, sf_dir)
    specs = run_each(spark, lambda t: _landed(frames[t], t, lake, "1"), frames, PARALLEL)
    return lake, dict(zip(frames, specs))


@query(_ALL_COUNTS)
def ing_all_tables(spark, sf_dir):
    lake, specs = _land_all(spark, sf_dir)
    results = jobs.landing_to_bronze(spark, lake, specs, PARALLEL)
    rows = [(r.table, r.status, r.new_rows) for r in results]
    return spark.createDataFrame(rows, "table_name STRING, status STRING, new_rows BIGINT")


@query("SELECT * EXCLUDE (source_file) FROM raw_orders")
def ing_stream_available_now(spark, sf_dir):
    lake = _lake(spark)
    bronze = lake.path(BRONZE, "orders")
    spec = _landed(raw.table(spark, sf_dir, "orders"), "orders", lake, "1")
    for _ in range(2):  # the second run finds every file in the checkpoint
        stream = ingest_stream(
            spark, spec, lake.landing, bronze, f"{lake.base}/checkpoint", max_files_per_trigger=4
        )
        stream.awaitTermination()
    return business(spark.read.parquet(bronze), CORRUPT_RECORD, UNDECLARED)


@query("""
    SELECT count(*) AS "rows", count(*) AS with_source_file, count(*) AS with_ingest_time,
      count(*) AS with_batch_time, count(*) AS with_source_system, count(*) AS with_build_time
    FROM raw_order_details
""")
def provenance_stamp(spark, sf_dir):
    lake = _lake(spark)
    bronze = lake.path(BRONZE, "order_details")
    spec = _landed(raw.table(spark, sf_dir, "order_details"), "order_details", lake, "1")
    ingest_table(spark, spec, lake.landing, bronze)
    stamped = spark.read.parquet(bronze).select("*", source_system(raw.SOURCE), built_at())
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("source_file").like("%order_details_batch_1.json%")).alias("with_source_file"),
        F.count("bronze_ingestion_time").alias("with_ingest_time"),
        F.count_if(F.col("ingestion_time").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"))
        .alias("with_batch_time"),
        F.count_if(F.col("source_system") == raw.SOURCE).alias("with_source_system"),
        F.count("gold_created_at").alias("with_build_time"),
    )


# --- Streaming clean ----------------------------------------------------------------------

EVENTS = TableSpec(
    name="events", landing_ddl="", keys=("event_id",), types={"value": "double"},
    trims=("event_type",),
)


def _events_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """All events in two overlapping appends, streamed one file at a time."""
    events = raw.load(spark, sf_dir, "events")
    for part in (events, events.filter(F.col("event_type") != "click")):
        part.write.mode("append").parquet(f"{folder}/in")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/in")


@query("SELECT * FROM events")
def stream_clean_dedupe(spark, sf_dir):
    folder = shared_dir(spark, "stream")
    stream = _events_stream(spark, sf_dir, folder)
    clean_stream(stream, EVENTS, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_silver(spark, f"{folder}/out", EVENTS)


@query("SELECT * EXCLUDE (source_file) FROM silver_orders")
def stream_clean_orders(spark, sf_dir):
    """Orders in two versions, streamed file by file: the rows that batch cleaning keeps."""
    folder, orders = shared_dir(spark, "stream"), raw.table(spark, sf_dir, "orders")
    for late in (True, False):  # the newer version comes first
        rows = orders.filter((F.col(SOURCE_FILE) == "batch_9") == F.lit(late))
        rows.write.mode("append").parquet(f"{folder}/in")
    reader = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1)
    stream, spec = reader.parquet(f"{folder}/in"), CATALOG["orders"]
    clean_stream(stream, spec, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return naive_times(business(read_silver(spark, f"{folder}/out", spec)))


@query("""
    SELECT *, false AS late FROM events
    UNION ALL SELECT *, true FROM events WHERE event_type <> 'click'
      AND ts < (SELECT max(ts) FROM events) - INTERVAL 2 DAY
""")
def stream_clean_watermark(spark, sf_dir):
    """All events, then most of them again: repeats within two days go, older ones are kept apart."""
    folder, events = shared_dir(spark, "stream"), raw.load(spark, sf_dir, "events")
    for part in (events, events.filter(F.col("event_type") != "click")):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        clean_stream_within(
            stream, EVENTS, "ts", "2 days", f"{folder}/out", f"{folder}/checkpoint"
        ).awaitTermination()
    kept = read_within(spark, f"{folder}/out").withColumn("late", F.lit(False))
    late = read_late(spark, f"{folder}/out").withColumn("late", F.lit(True))
    return naive_times(kept.unionByName(late))


# --- Sinks and whole runs -----------------------------------------------------------------


@query("SELECT * EXCLUDE (source_file) FROM silver_orders")
def silver_overwrite(spark, sf_dir):
    path = _lake(spark).path(SILVER, "orders")
    orders = silver(spark, sf_dir, "orders")
    sinks.overwrite_parquet(orders.filter(F.col("Region") == "1-URGENT"), path)
    sinks.overwrite_parquet(orders, path)
    return naive_times(business(spark.read.parquet(path)))


def _gold_lake(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, int]]:
    """Silver written from the raw tables, and gold built from it."""
    lake = _lake(spark)
    run_each(
        spark,
        lambda t: sinks.overwrite_parquet(silver(spark, sf_dir, t), lake.path(SILVER, t)),
        CATALOG, PARALLEL,
    )
    return lake, jobs.silver_to_gold(spark, lake, raw.SOURCE, parallel=PARALLEL)


def _medallion(spark: SparkSession, sf_dir: str) -> Lake:
    """Landing to gold over files, all eight tables."""
    lake, specs = _land_all(spark, sf_dir)
    jobs.landing_to_bronze(spark, lake, specs, PARALLEL)
    jobs.bronze_to_silver(spark, lake, specs, PARALLEL)
    jobs.silver_to_gold(spark, lake, raw.SOURCE, parallel=PARALLEL)
    return lake


@query("SELECT * FROM fact_orders")
def medallion_fact_orders(spark, sf_dir):
    fact = _medallion(spark, sf_dir).read(spark, GOLD, "fact_orders")
    return naive_times(fact.drop("gold_created_at"))


_WRITTEN = ("dim_dates", "dim_products")


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, true AS found, count(*) AS \"rows\" FROM {t}" if t in _WRITTEN
    else f"SELECT '{t}' AS table_name, false AS found, 0 AS \"rows\""
    for t in sql.GOLD
))
def gold_presence(spark, sf_dir):
    """A lake in which only two of the gold tables have been written yet."""
    lake = _lake(spark)
    frames = jobs.gold_frames({t: silver(spark, sf_dir, t) for t in CATALOG}, raw.SOURCE)
    for table in _WRITTEN:
        sinks.overwrite_parquet(frames[table], lake.path(GOLD, table))
    return jobs.gold_presence(spark, lake)


@query(" UNION ALL ".join(
    f"SELECT '{t.upper()}' AS table_name, count(*) AS \"rows\" FROM {t}" for t in sql.GOLD
))
def publish_gold(spark, sf_dir):
    """Gold as tables of the session's catalog, counted there."""
    lake, _ = _gold_lake(spark, sf_dir)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_DATABASE}")
    target = sinks.CatalogTarget(_DATABASE, f"{lake.base}/published")
    published = jobs.publish_gold(spark, lake, target, parallel=PARALLEL)
    return quality.row_counts({t: spark.table(f"{_DATABASE}.{t}") for t in published})


_DATABASE = "published"


@query("""
    SELECT "OrderID", "Region", CASE WHEN source_file IN ('batch_0', 'batch_3') THEN NULL
        ELSE 'Port ' || "ShipVia" END AS "ShipCity",
      CASE WHEN source_file IN ('batch_0', 'batch_3') THEN 'early' ELSE 'late' END AS batch
    FROM raw_orders
""")
def ing_undeclared_fields(spark, sf_dir):
    """A second batch brings a field more, and one field was never declared at all."""
    lake, orders = _lake(spark), raw.table(spark, sf_dir, "orders")
    declared = orders.drop(SOURCE_FILE, "Region")
    spec = CATALOG["orders"].with_(landing_ddl=", ".join(f"`{c}` STRING" for c in declared.columns))
    late = orders.withColumn("ShipCity", F.concat(F.lit("Port "), "ShipVia"))
    for name, rows in (("early", orders.filter(_EARLY)), ("late", late.filter(_LATE))):
        jobs.land_batch(rows.drop(SOURCE_FILE), lake, "orders", name)
        jobs.landing_to_bronze(spark, lake, {"orders": spec})
    bronze, more = lake.read(spark, BRONZE, "orders"), F.col(UNDECLARED)
    batch = F.regexp_extract(SOURCE_FILE, r"orders_batch_(\w+)\.json", 1).alias("batch")
    return bronze.select(
        "OrderID", more["Region"].alias("Region"), more["ShipCity"].alias("ShipCity"), batch)


@query("""
    SELECT "year", count(*) AS "rows" FROM
      (SELECT cast(year("OrderDate") AS INTEGER) AS "year" FROM fact_orders) GROUP BY "year"
""")
def fact_partitioned(spark, sf_dir):
    """The fact written by year, read back per partition."""
    frames = {t: silver(spark, sf_dir, t) for t in ("order_details", "orders", "products")}
    fact = star.fact_orders(frames["order_details"], frames["orders"], frames["products"])
    path = _lake(spark).path(GOLD, "fact_orders")
    sinks.overwrite_parquet(fact.withColumn("year", F.year("OrderDate")), path, ("year",))
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("rows"))
