"""Registered queries for sources, sinks and the flat-file jobs."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlake.checks import oracle, shop
from orderlake.checks.registry import check
from orderlake.operators.quality import split_missing
from orderlake.plans.flat_file import run_dimension, run_flat_file
from orderlake.scratch import scratch_path
from orderlake.sinks.quarantine import quarantine_missing
from orderlake.sinks.tables import (
    guarded_overwrite,
    overwrite_table,
    replace_slice,
    upsert_table,
)
from orderlake.sources.files import (
    landing_path,
    read_csv,
    read_csv_inferred,
    read_csv_split_bad,
    read_json,
    read_order_documents,
    read_parquet,
    read_path,
)
from orderlake.sources.tables import read_table

CUSTOMER_DDL = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
CUSTOMER_SQL = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"


def new_table(name: str) -> str:
    return f"orderlake_checks.{name}_{uuid4().hex}"


def _written(df: DataFrame, fmt: str, purpose: str, **options: object) -> str:
    path = scratch_path(df.sparkSession, purpose)
    df.write.format(fmt).options(**options).save(path)
    return path


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        F.col("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderstatus",
    )


_DOC_SCAN_SQL = oracle.DOCS + f"""
select code, {oracle.epoch_text('event_ts')} as event_date, o_totalprice as total_price, email,
       case when l_returnflag = 'R' then 2 when l_linenumber is not null then 1
            when o_orderstatus <> 'P' then 0 end as entries
from docs"""


def _document_scan(documents: DataFrame) -> DataFrame:
    return documents.select(
        "code",
        F.col("eventDate").alias("event_date"),
        F.col("totalPrice").alias("total_price"),
        F.col("deliveryAddress.email").alias("email"),
        F.when(F.col("entries").isNotNull(), F.size("entries")).alias("entries"),
    )


@check("scan_json_inferred", _DOC_SCAN_SQL)
def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(shop.documents(spark, sf_dir), "json", "documents", **shop.LINE_FILES)
    return _document_scan(read_json(spark, path, {"multiLine": "false"}))


@check("scan_json_schema", _DOC_SCAN_SQL)
def scan_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(shop.documents(spark, sf_dir), "json", "documents", **shop.LINE_FILES)
    return _document_scan(read_order_documents(spark, path))


@check("scan_csv_inferred", CUSTOMER_SQL)
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(shop.table(spark, sf_dir, "customer"), "csv", "customer", header=True, sep=";")
    rows = read_csv_inferred(spark, path, delimiter=";")
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@check("scan_csv_schema", CUSTOMER_SQL)
def scan_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(shop.table(spark, sf_dir, "customer"), "csv", "customer", header=True)
    return read_csv(spark, path, {"header": "true"}, CUSTOMER_DDL)


@check(
    "scan_csv_bad_records",
    """
select c_custkey, c_name, c_acctbal, 'good' as state from customer where c_acctbal >= 0
union all
select null, c_custkey || ',' || c_name || ',in debt', null, 'bad' from customer where c_acctbal < 0
""",
)
def scan_csv_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt are written with text where the number belongs."""
    customer = shop.table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit("in debt"))
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("c_acctbal"),
    )
    path = _written(customer, "csv", "customer", header=True)
    schema = StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double")
    good, bad = read_csv_split_bad(spark, path, schema, multiline=False)
    none = F.lit(None)
    return good.withColumn("state", F.lit("good")).unionByName(
        bad.select(
            none.cast("bigint").alias("c_custkey"),
            F.col("record").alias("c_name"),
            none.cast("double").alias("c_acctbal"),
            F.lit("bad").alias("state"),
        )
    )


@check("scan_table_path", "select p_partkey, p_name, p_brand, p_retailprice from part")
def scan_table_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(shop.table(spark, sf_dir, "part"), "parquet", "part")
    return read_path(spark, path).select("p_partkey", "p_name", "p_brand", "p_retailprice")


@check("scan_parquet", "select l_orderkey, l_linenumber, l_extendedprice from lineitem")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice")


@check("scan_catalog_table", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def scan_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = new_table("supplier")
    overwrite_table(shop.table(spark, sf_dir, "supplier"), name, scratch_path(spark, "supplier"))
    return read_table(spark, name)


@check(
    "scan_landing_date",
    "select event_id, user_id, event_type, value from events where cast(ts as date) = date '2024-01-05'",
)
def scan_landing_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landing day's folder of all that have landed."""
    base = scratch_path(spark, "landing")
    events = shop.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    events.write.partitionBy("day").parquet(f"{base}/events")
    rows = read_parquet(spark, landing_path(base, "events", "day=2024-01-05"))
    return rows.select("event_id", "user_id", "event_type", "value")


@check(
    "sink_overwrite",
    """
select o_orderkey, o_custkey, o_totalprice, o_orderpriority, cast(o_orderdate as varchar) as o_orderdate,
       o_orderstatus, 'second' as run
from orders where o_orderstatus <> 'P'
""",
)
def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write has fewer rows and one more column."""
    name, path = new_table("orders"), scratch_path(spark, "orders")
    orders = _orders(spark, sf_dir)
    overwrite_table(orders, name, path)
    overwrite_table(
        orders.filter(F.col("o_orderstatus") != "P").withColumn("run", F.lit("second")), name, path
    )
    return read_table(spark, name)


@check(
    "sink_partitioned",
    """
select o_orderkey, o_custkey, o_totalprice, o_orderpriority, cast(o_orderdate as varchar) as o_orderdate,
       o_orderstatus
from orders
""",
)
def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = new_table("orders")
    overwrite_table(_orders(spark, sf_dir), name, scratch_path(spark, "orders"), ["o_orderstatus"])
    return read_table(spark, name)


_LINES_SQL = """
select distinct l_orderkey, case when l_discount > 0.0 then l_partkey end as l_partkey, l_suppkey,
       l_linenumber, l_quantity, l_extendedprice, l_tax, l_linestatus, l_returnflag
from lineitem where l_discount > 0.0
"""


@check("sink_guarded_overwrite", _LINES_SQL)
def sink_guarded_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines written twice over, with a null part key where there is no discount."""
    name, path = new_table("lineitem"), scratch_path(spark, "lineitem")
    lines = shop.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_discount") > 0.0, F.col("l_partkey")).alias("l_partkey"),
        *["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_linestatus"],
        "l_returnflag",
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    guarded_overwrite(lines.unionAll(lines), name, path, keys, ["l_returnflag"])
    return read_table(spark, name)


@check(
    "sink_replace_slice",
    """
select event_id, user_id, event_type,
       case when cast(ts as date) = date '2024-01-05' then value * 2 else value end as value,
       2024 as year, 1 as month, cast(day(ts) as integer) as day
from events
""",
)
def sink_replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events by day, then one day replaced by its rows with doubled values."""
    name, path = new_table("events"), scratch_path(spark, "events")
    events = shop.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.day("ts").alias("day"),
    )
    overwrite_table(events, name, path, ["year", "month", "day"])
    day = {"year": 2024, "month": 1, "day": 5}
    fresh = events.filter("year = 2024 and month = 1 and day = 5")
    replace_slice(fresh.withColumn("value", F.col("value") * 2), name, path, day)
    return read_table(spark, name)


@check("upsert_create", _LINES_SQL)
def upsert_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert into a table that is not there creates it from the guarded distinct rows."""
    name, path = new_table("lineitem"), scratch_path(spark, "lineitem")
    lines = shop.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_discount") > 0.0, F.col("l_partkey")).alias("l_partkey"),
        *["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_linestatus"],
        "l_returnflag",
    )
    upsert_table(lines.unionAll(lines), name, path, ["l_orderkey", "l_partkey"], ["l_returnflag"])
    return read_table(spark, name)


@check(
    "sink_upsert",
    """
with target as (select * from orders where o_orderdate < timestamp '1999-01-01'),
source as (
  select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice,
         case when o_orderpriority = '5-LOW' then null else o_orderpriority end as o_orderpriority,
         o_orderdate, case when o_orderstatus = 'P' then 'F' else o_orderstatus end as o_orderstatus
  from orders where o_orderdate >= timestamp '1997-01-01')
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
       case when s.o_orderkey is null then t.o_custkey else s.o_custkey end as o_custkey,
       case when s.o_orderkey is null then t.o_totalprice else s.o_totalprice end as o_totalprice,
       case when s.o_orderkey is null then t.o_orderpriority else s.o_orderpriority end as o_orderpriority,
       cast(case when s.o_orderkey is null then t.o_orderdate else s.o_orderdate end as varchar) as o_orderdate,
       case when s.o_orderkey is null then t.o_orderstatus else s.o_orderstatus end as o_orderstatus
from target t full join source s on t.o_orderkey = s.o_orderkey
""",
)
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping order years: new prices, some nulls, some rows that change partition."""
    name, path = new_table("orders"), scratch_path(spark, "orders")
    orders = _orders(spark, sf_dir)
    overwrite_table(orders.filter("o_orderdate < '1999-01-01'"), name, path, ["o_orderstatus"])
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    changed = orders.filter("o_orderdate >= '1997-01-01'").withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1,
            "o_orderpriority": F.when(priority != "5-LOW", priority),
            "o_orderstatus": F.when(status == "P", F.lit("F")).otherwise(status),
        }
    )
    upsert_table(changed, name, path, ["o_orderkey"], ["o_orderstatus"])
    return read_table(spark, name)


@check(
    "upsert_schema_evolution",
    """
with target as (
  select o_orderkey, o_totalprice, o_orderpriority as old_only from orders
  where o_orderdate < timestamp '1999-01-01'),
source as (
  select o_orderkey, o_totalprice + 1 as o_totalprice, o_orderstatus as new_only from orders
  where o_orderdate >= timestamp '1997-01-01')
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
       case when s.o_orderkey is null then t.o_totalprice else s.o_totalprice end as o_totalprice,
       t.old_only, s.new_only
from target t full join source s on t.o_orderkey = s.o_orderkey
""",
)
def upsert_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column only in the table, another only in the new rows."""
    name, path = new_table("orders"), scratch_path(spark, "orders")
    orders = _orders(spark, sf_dir)
    overwrite_table(
        orders.filter("o_orderdate < '1999-01-01'").select(
            "o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("old_only")
        ),
        name,
        path,
    )
    changed = orders.filter("o_orderdate >= '1997-01-01'").select(
        "o_orderkey",
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.col("o_orderstatus").alias("new_only"),
    )
    upsert_table(changed, name, path, ["o_orderkey"])
    return read_table(spark, name)


def _customers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment"),
    )


@check("quarantine_good", "select c_custkey, c_acctbal, c_mktsegment from customer where c_acctbal >= 0")
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _customers_with_gaps(spark, sf_dir)
    return quarantine_missing(rows, ["c_mktsegment", "c_custkey"], scratch_path(spark, "quarantine"))


@check(
    "quarantine_bad",
    "select c_custkey, c_acctbal, cast(null as varchar) as c_mktsegment from customer where c_acctbal < 0",
)
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _customers_with_gaps(spark, sf_dir)
    path = scratch_path(spark, "quarantine")
    quarantine_missing(rows, ["c_mktsegment", "c_custkey"], path)
    _, bad = split_missing(rows, ["c_mktsegment", "c_custkey"])
    return spark.read.schema(bad.schema).parquet(path)


def _landed_customers(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "landing")
    customer = shop.table(spark, sf_dir, "customer")
    customer.write.option("header", True).csv(f"{base}/customer/2024-01-05/part")
    return base


@check("flat_file_silver", CUSTOMER_SQL.replace(" from", ", '2024-01-05' as load_date from"))
def flat_file_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, name = _landed_customers(spark, sf_dir), new_table("customer")
    run_flat_file(spark, base, "customer", "2024-01-05", scratch_path(spark, "silver"), name)
    return read_table(spark, name).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@check("dim_table", CUSTOMER_SQL.replace(" from", ", '2024-01-06' as at_load_date from"))
def dim_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, gold = _landed_customers(spark, sf_dir), new_table("dim_customer")
    silver_path = scratch_path(spark, "silver")
    run_flat_file(spark, base, "customer", "2024-01-05", silver_path, new_table("customer"))
    run_dimension(spark, silver_path, scratch_path(spark, "gold"), gold, "2024-01-06")
    return read_table(spark, gold).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@check(
    "upsert_null_partition",
    """
select o_orderkey,
       case when o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       case when o_orderkey % 3 <> 0 and o_orderstatus = 'F' then 'F' end as status
from orders
union all
select -o_orderkey - 1, o_totalprice, null from orders where o_orderkey % 5 = 0
""",
)
def upsert_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with null and empty partition texts; new and moved rows with empty ones."""
    name, path = new_table("orders"), scratch_path(spark, "orders")
    orders = shop.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    status = F.col("o_orderstatus")
    stored = F.when(status == "F", status).when(status == "O", F.lit(""))
    upsert_table(
        orders.withColumn("status", stored).drop("o_orderstatus"), name, path, ["o_orderkey"], ["status"]
    )
    moved = orders.filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = orders.filter("o_orderkey % 5 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    changes = moved.unionAll(new).withColumn("status", F.lit("")).drop("o_orderstatus")
    upsert_table(changes, name, path, ["o_orderkey"], ["status"])
    return read_table(spark, name)


@check(
    "upsert_nested_evolution",
    """
select o_orderkey,
       case when o_orderkey % 2 = 0 then o_totalprice + 1 else o_totalprice end as price,
       case when o_orderkey % 2 = 0 then null else o_orderpriority end as priority,
       case when o_orderkey % 2 = 0 then o_custkey end as customer
from orders
""",
)
def upsert_nested_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows whose struct has a field that the table's lacks, and lacks one that it has."""
    name, path = new_table("orders"), scratch_path(spark, "orders")
    orders = shop.table(spark, sf_dir, "orders")
    stored = F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    upsert_table(orders.select("o_orderkey", stored.alias("info")), name, path, ["o_orderkey"])
    changed = F.struct((F.col("o_totalprice") + 1).alias("price"), F.col("o_custkey").alias("customer"))
    upsert_table(
        orders.filter("o_orderkey % 2 = 0").select("o_orderkey", changed.alias("info")), name, path, ["o_orderkey"]
    )
    return read_table(spark, name).select("o_orderkey", "info.price", "info.priority", "info.customer")
