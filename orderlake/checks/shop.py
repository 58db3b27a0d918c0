"""A small web shop derived from the test tables, for the registered queries.

The flat SQL texts below run unchanged in Spark and in the oracle. Spark nests the flat rows
into order documents; the oracle computes expected results from the flat rows directly.

Every shop row comes from one order line by row-wise expressions, so no step gathers the rows
of an order: a document reports one line of an order event (with its service line, if it has
one), and an order has many documents, some of them for the same event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.schemas import order_schema

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# One event per order, and a later one for finished orders.
ORDER_EVENTS = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
       o_orderdate as event_ts
from {orders}
union all
select o_orderkey, o_custkey, 'C', o_totalprice, o_orderpriority, o_orderdate,
       o_orderdate + interval 26 hours
from {orders} where o_orderstatus = 'F'
"""

# One row per event and order line; orders without lines keep one row. Lines are on the left of
# an inner join, where adaptive execution can split an order that holds very many of them. The
# hint keeps small test tables from being broadcast, as large ones would not be.
DOCUMENTS = """
with headers as (
  select 'O' || cast(e.o_orderkey as string) as code, e.event_ts, e.o_orderkey, e.o_orderdate,
         e.o_orderstatus, e.o_totalprice, e.o_orderpriority, c.c_custkey, c.c_name, c.c_acctbal,
         c.c_mktsegment, n.n_nationkey, n.n_name, lower(r.r_name) as region,
         'c' || cast(c.c_custkey as string) || '@shop.example' as email{more}
  from ({order_events}) e
  join {customer} c on c.c_custkey = e.o_custkey
  join {nation} n on n.n_nationkey = c.c_nationkey
  join {region} r on r.r_regionkey = n.n_regionkey)
select /*+ merge(h) */ h.*, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
       l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate
from {lineitem} l join headers h on h.o_orderkey = l.l_orderkey
union all
select h.*, null, null, null, null, null, null, null, null, null, null
from headers h left join (select distinct l_orderkey from {lineitem}) k on k.l_orderkey = h.o_orderkey
where k.l_orderkey is null
"""

# The order events with `once`: whether no two lines of the order share number and product. They are
# marked before customers are joined, so that headers still come to the lines from a shuffle.
ORDER_EVENTS_ONCE = """
select e.*, t.l_orderkey is null as once
from ({order_events}) e
left join (
  select l_orderkey from {lineitem} group by l_orderkey, l_linenumber, l_partkey having count(*) > 1
  union
  select l_orderkey from {lineitem} where l_returnflag = 'R' group by l_orderkey, l_linenumber, l_suppkey having count(*) > 1
) t on t.l_orderkey = e.o_orderkey
"""

# Currencies by nation; none for one region, two rates for another.
RATES = """
select 'CU' || cast(n_nationkey as string) as ref_currency,
       0.5 + 0.05 * cast(n_nationkey as double) as rate, '2024-01-05' as load_date
from {nation} where n_regionkey <> 0
union all
select 'CU' || cast(n_nationkey as string), 0.51 + 0.05 * cast(n_nationkey as double),
       '2024-01-05'
from {nation} where n_regionkey = 1
"""

# Customers in debt are missing, those of one segment have a second id.
CONSUMERS = """
select 'c' || cast(c_custkey as string) || '@shop.example' as emai_hash,
       c_custkey as customer_id
from {customer} where c_acctbal >= 0
union all
select 'c' || cast(c_custkey as string) || '@shop.example', c_custkey + 1000000
from {customer} where c_mktsegment = 'MACHINERY'
"""

# Silver-shaped lines with the 29 columns of the fact (cart promotions as text).
SILVER = """
select code as order_number,
       case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then ''
            when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P' then null
            else cast(event_ts as string) end as event_date,
       o_orderstatus as order_status_code, o_totalprice as total_price,
       o_totalprice * cast(0.1 as double) as total_discounts,
       case when c_mktsegment = 'BUILDING' then null
            else o_totalprice * cast(0.2 as double) end as total_tax,
       case when o_orderstatus = 'O' then '' else cast(o_orderdate as string) end
         as order_placed_date,
       cast(null as string) as bundle_ids, 'PAID' as payment_status,
       case o_orderpriority when '1-URGENT' then 'MP_A' when '2-HIGH' then 'WEB-MP'
            when '3-MEDIUM' then null else 'WEB' end as fs_channel_code,
       'B2C' as fs_channel_sales_channel_type_code,
       'CU' || cast(n_nationkey as string) as currency_iso_code,
       region || '-shop' as site_uid, cast(cast(l_quantity as int) as string) as entries_quantity,
       l_extendedprice as entries_total_price, l_returnflag = 'R' as entries_a_service,
       case l_linestatus when 'O' then null
            else case l_returnflag when 'N' then '' else cast(l_tax as string) end end
         as entries_total_tax,
       l_discount as entries_discount_rows, email as delivery_address_email,
       o_orderstatus as delivery_status_code, 'P' || cast(l_partkey as string)
         as entries_product_code,
       cast(null as bigint) as entries_parent_entry_entry_number,
       l_returnflag as entries_promotion_code, o_orderstatus || '|' || o_orderpriority
         as cart_level_promotions,
       region as country_code, case when l_discount > 0.05 then 'SALE' end as entries_discount_name,
       cast(l_linenumber as bigint) as entries_entry_number, c_mktsegment as fs_channel_name,
       '2024-01-05' as load_date
from ({documents}) d
"""


#: How document lines are written. They repeat their field names, so gzip stores a twentieth of their size.
#: A compressed file is read by one task, so files hold so many lines at most.
LINE_FILES = {"compression": "gzip", "maxRecordsPerFile": 200_000}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(**tables: object) -> dict[str, str]:
    """The shop's SQL texts with the table placeholders filled in."""
    order_events = ORDER_EVENTS.format(**tables)
    documents = DOCUMENTS.format(order_events=order_events, more="", **tables)
    marked = ORDER_EVENTS_ONCE.format(order_events=order_events, **tables)
    return {
        "order_events": order_events,
        "documents": documents,
        "documents_once": DOCUMENTS.format(order_events=marked, more=", e.once", **tables),
        "rates": RATES.format(**tables),
        "consumers": CONSUMERS.format(**tables),
        "silver": SILVER.format(documents=documents, **tables),
    }


def flat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the flat shop tables as a DataFrame."""
    text = texts(**{t: "{" + t + "}" for t in TABLES})[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flat(spark, sf_dir, "silver")
    return rows.withColumn("cart_level_promotions", F.split("cart_level_promotions", "\\|"))


def epoch_text(moment: str) -> Column:
    """`/Date(ms)/` text of a zone-free timestamp, whatever the session zone."""
    ms = F.timestamp_diff(
        "MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(moment)
    )
    return F.concat(F.lit("/Date("), ms.cast("string"), F.lit(")/"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _none_of(array: Column) -> Column:
    """An empty array of its type. A projection with `filter` is generated in small methods, outside of the
    stage's one, which these wide rows make larger than the JVM compiles unless a session setting forbids it.
    """
    return F.filter(array, lambda _: F.lit(False))


def _entry(service: bool) -> Column:
    number = F.col("l_linenumber").cast("bigint")
    product = F.concat(F.lit("S"), _text("l_suppkey")) if service else F.concat(F.lit("P"), _text("l_partkey"))
    tax = _text("l_tax")
    return F.struct(
        F.struct(product.alias("code")).alias("product"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        (F.col("l_extendedprice") * F.lit(0.5) if service else F.col("l_extendedprice")).alias("totalPrice"),
        (F.col("l_linestatus") == "O").alias("isFocusedPrice"),
        F.struct((number if service else F.lit(None).cast("bigint")).alias("entryNumber")).alias("parentEntry"),
        F.lit(service).alias("aService"),
        (number + 100 if service else number).alias("entryNumber"),
        F.col("l_extendedprice").alias("d2cPrice"),
        F.lit("info").alias("productInfo"),
        F.col("l_extendedprice").alias("basePrice"),
        F.struct(F.col("code")).alias("order"),
        F.when(F.col("l_discount") > 0.05, F.lit("SALE")).alias("discountName"),
        tax.alias("percentageTax"),
        F.when(F.col("l_linestatus") == "O", F.lit(None))
        .when(F.col("l_returnflag") == "N", F.lit(""))
        .otherwise(tax)
        .alias("totalTax"),
        F.col("l_discount").alias("discountRows"),
    )


def _promotion(consumed: Column | None, code: Column | None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        (none if consumed is None else consumed).alias("consumedEntries"),
        F.struct((none if code is None else code).alias("code")).alias("promotion"),
    )


def _promotions() -> Column:
    number = _text("l_linenumber")
    service = (F.col("l_linenumber") + 100).cast("string")
    by_flag = F.col("l_returnflag")
    by_status = F.col("l_linestatus")

    def code(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value)

    several = F.array(
        _promotion(F.concat(number, F.lit("|"), service), code("P", by_status)),
        _promotion(None, code("Q", by_flag)),
    )
    odd = F.array(
        _promotion(F.lit(""), code("C", by_flag)),
        _promotion(F.concat(number, F.lit("|")), None),
        _promotion(None, None),
    )
    repeated = F.array(
        _promotion(number, code("P", by_flag)),
        _promotion(number, code("P", by_status)),
        _promotion(F.lit("abc"), F.lit("X")),
        _promotion(number, None),
    )
    priority = F.col("o_orderpriority")
    return (
        F.when(priority == "2-HIGH", _none_of(several))
        .when(priority == "3-MEDIUM", several)
        .when(priority == "4-NOT SPECIFIED", odd)
        .when(priority == "5-LOW", repeated)
    )


def _consignment(position: int) -> Column:
    return F.struct(
        F.col("shipped").alias("shippingDate"),
        F.concat(F.lit("TR"), _text("l_linenumber"), F.lit(f"-{position}")).alias("trackingID"),
        F.concat(F.lit("C"), _text("l_suppkey"), F.lit(f"-{position}")).alias("code"),
        F.when(F.col("l_linestatus") == "F", F.col("shipped")).alias("deliveredDate"),
        F.col("ordered").alias("namedDeliveryDate"),
        F.lit(f"step {position}").alias("statusDisplay"),
    )


def _consignments() -> Column:
    three = F.array(_consignment(1), _consignment(2), _consignment(3))
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "R", three)
        .when(flag == "N", F.array(_consignment(1)))
        .when((flag == "A") & (F.col("l_linestatus") == "F"), _none_of(F.array(_consignment(1))))
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested order documents with the declared schema."""
    return nested(flat(spark, sf_dir, "documents"))


def nested(rows: DataFrame, *keep: str) -> DataFrame:
    """Documents of flat rows, row by row, with the columns `keep` of these."""
    line = F.col("l_linenumber").isNotNull()
    one = F.array(_entry(False))
    entries = (
        F.when(line & (F.col("l_returnflag") == "R"), F.array(_entry(False), _entry(True)))
        .when(line, one)
        .when(F.col("o_orderstatus") != "P", _none_of(one))
    )
    key = F.substring("code", 2, 20)
    values = {
        "code": F.col("code"),
        "trackingUrl": F.concat(F.lit("https://track.example/"), key),
        "salesOrderNumber": F.concat(F.lit("S"), key),
        "sapGoodsIssueDate": F.when(F.col("o_orderstatus") != "O", F.col("happened")),
        "sapPlantCode": F.col("o_orderpriority"),
        "trackingId": F.concat(F.lit("T"), key),
        "orderCreatedDateInECC": F.col("ordered"),
        "creationTime": F.col("ordered"),
        "totalPrice": F.col("o_totalprice"),
        "totalDiscounts": F.col("o_totalprice") * F.lit(0.1),
        "allPromotionResults": _promotions(),
        "totalTax": F.col("o_totalprice") * F.lit(0.2),
        "orderPlacedDate": F.col("ordered"),
        "deliveryAddress": F.struct(
            (F.col("c_mktsegment") == "BUILDING").alias("isBusinessUser"),
            F.col("n_name").alias("town"),
            F.col("email"),
            F.lit("1000").alias("postalcode"),
        ),
        "deliveryNumber": F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("D"), key)),
        "productRegistration": F.col("o_orderstatus") == "F",
        "csCode": F.col("c_name"),
        "consignments": _consignments(),
        "orderblock": F.struct(F.lit("B").alias("code"), F.lit("b").alias("codeLowerCase")),
        "fsChannel": F.struct(
            F.col("c_mktsegment").alias("name"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("MP_A")).otherwise(F.lit("WEB")).alias("code"),
            F.struct(F.lit("B2C").alias("code")).alias("salesChannelType"),
        ),
        "currency": F.struct(F.concat(F.lit("CU"), _text("n_nationkey")).alias("isoCode")),
        "servicesSubTotalWithoutDiscounts": F.col("o_totalprice") * F.lit(0.3),
        "paymentStatus": F.lit("PAID"),
        "servicesSubTotal": F.col("o_totalprice") * F.lit(0.25),
        "site": F.when(
            F.col("c_acctbal") >= 0, F.struct(F.concat(F.col("region"), F.lit("-shop")).alias("uid"))
        ),
        "entries": entries,
        "subtotal": F.col("o_totalprice"),
        "totalDiscount": F.col("o_totalprice") * F.lit(0.1),
        "user": F.struct(
            _text("c_custkey").alias("uid"),
            F.lit(None).cast("string").alias("referredByCode"),
            F.lit(None).cast("string").alias("referredByStaffName"),
            F.struct(F.lit("GUEST").alias("code")).alias("type"),
        ),
        "paymentInfo": F.struct(
            F.lit("PI").alias("code"),
            F.lit("card").alias("adyenPaymentMethodName"),
            F.lit("visa").alias("adyenPaymentMethod"),
        ),
        "deliveryStatus": F.struct(F.col("o_orderstatus").alias("code")),
        "eventDate": F.col("happened"),
        "status": F.struct(F.col("o_orderstatus").alias("code")),
        "deliveryCost": F.col("c_acctbal"),
    }
    rows = rows.withColumns(
        {
            "ordered": epoch_text("o_orderdate"),
            "happened": epoch_text("event_ts"),
            "shipped": epoch_text("l_shipdate"),
        }
    )
    return rows.select(
        *[
            (values[f.name] if f.name in values else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in order_schema().fields
        ],
        *keep,
    )
