"""Registered queries for the operators between source and sink."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.checks import oracle, shop
from orderlake.checks.registry import check
from orderlake.functions.dates import decode_epoch_text, parse_dates, parse_timestamp
from orderlake.functions.sales import (
    country_from_site,
    country_prefix,
    marketplace_flag,
    net_sales_entries,
    net_sales_order,
)
from orderlake.operators import columns
from orderlake.operators.aggregates import distinct_rows, distinct_values, joined_values
from orderlake.operators.counts import observed
from orderlake.operators.joins import left_join, lookup_join
from orderlake.operators.latest import latest_rows
from orderlake.operators.nested import flatten, last_element, split_to_rows
from orderlake.operators.quality import (
    both_nonempty,
    cart_level,
    nonempty_or_null,
    require_present,
)
from orderlake.plans.gold_orders import keyed_orders_fact
from orderlake.plans.silver_orders import (
    ENTRY,
    PROMOTION,
    cart_promotions,
    entry_promotions,
    keyed_silver_lines,
    land_documents,
    promotion_rows,
)
from orderlake.schemas import FACT_OUTPUT, ORDER_LINE_KEYS
from orderlake.scratch import scratch_path
from orderlake.sinks.tables import guarded, overwrite_table
from orderlake.sources.tables import read_table

# --- projections ---------------------------------------------------------------------------


@check("project_columns", "select o_orderkey, o_totalprice, o_orderstatus from orders")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.project(
        shop.table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"]
    )


@check(
    "project_rename",
    "select c_custkey as customer_id, c_name as name, c_nationkey, c_acctbal as balance, c_mktsegment"
    " from customer",
)
def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_name": "name", "c_acctbal": "balance"}
    return columns.rename(shop.table(spark, sf_dir, "customer"), names)


@check("project_drop", "select c_custkey, c_name, c_acctbal from customer")
def project_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.drop(shop.table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment", "no_such"])


@check(
    "audit_column",
    "select p_partkey, '2024-01-05' as load_date, '2024-01-05 00:00:00' as at_load_date from part",
)
def audit_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = columns.project(shop.table(spark, sf_dir, "part"), ["p_partkey"])
    part = columns.add_audit(part, "load_date", "2024-01-05")
    part = columns.add_audit(part, "at_load_date", datetime(2024, 1, 5))
    return part.withColumn("at_load_date", F.col("at_load_date").cast("string"))


@check("lower_columns", "select c_custkey as custkey, c_name as customername from customer")
def lower_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = shop.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return columns.lower_columns(customer.toDF("CustKey", "CUSTOMERNAME"))


@check(
    "clean_columns",
    "select c_custkey as c_key_n, c_name as c_name, c_acctbal as acct_bal, c_mktsegment as segment"
    " from customer",
)
def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = shop.table(spark, sf_dir, "customer")
    customer = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return columns.clean_columns(customer.toDF("c-key(n)", "c name", "acct/bal", "seg.ment"))


@check(
    "country_from_site",
    oracle.SILVER + "select order_number, site_uid, split_part(site_uid, '-', 1) as country from silver",
)
def country_of_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.silver(spark, sf_dir).select(
        "order_number", "site_uid", country_from_site("site_uid").alias("country")
    )


@check(
    "country_prefix",
    oracle.SILVER + "select order_number, substr(country_code, 1, 2) as country_code from silver",
)
def prefix_of_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.silver(spark, sf_dir).select(
        "order_number", country_prefix("country_code").alias("country_code")
    )


# --- filters -------------------------------------------------------------------------------


@check(
    "filter_not_null",
    oracle.DOCS
    + f"select code, {oracle.epoch_text('event_ts')} as event_date from docs"
    + " where l_linenumber is not null or o_orderstatus <> 'P'",
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty entry arrays pass, null ones do not."""
    rows = require_present(shop.documents(spark, sf_dir), ["entries"])
    return rows.select("code", F.col("eventDate").alias("event_date"))


@check(
    "filter_keys_not_null",
    oracle.SILVER
    + "select order_number, entries_entry_number, event_date, entries_product_code from silver"
    + " where order_number is not null and entries_entry_number is not null"
    + " and event_date is not null and entries_product_code is not null",
)
def filter_keys_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_present(shop.silver(spark, sf_dir), ORDER_LINE_KEYS).select(*ORDER_LINE_KEYS)


_PIECE_COLUMNS = f"code, {oracle.epoch_text('event_ts')} as event_date, entry_text, promotion"


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promotion_rows(require_present(shop.documents(spark, sf_dir), ["entries"]))


def _named_pieces(rows: DataFrame) -> DataFrame:
    return columns.project_renamed(
        rows, {"code": "code", "eventDate": "event_date", ENTRY: "entry_text", PROMOTION: "promotion"}
    )


@check(
    "filter_cart_level",
    oracle.PROMOTIONS
    + f"select {_PIECE_COLUMNS} from pieces"
    + " where entry_text = '' or (entry_text is null and promotion is not null)",
)
def filter_cart_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_pieces(_pieces(spark, sf_dir).filter(cart_level(ENTRY, PROMOTION)))


@check(
    "filter_nonempty_or_null",
    oracle.PROMOTIONS
    + f"select {_PIECE_COLUMNS} from pieces where entry_text <> '' or entry_text is null",
)
def filter_nonempty_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_pieces(_pieces(spark, sf_dir).filter(nonempty_or_null(ENTRY)))


@check(
    "flag_marketplace",
    oracle.SILVER
    + "select order_number, fs_channel_code, case when regexp_matches(fs_channel_code, '(MP)')"
    + " then 'True' else 'False' end as mp_flag from silver",
)
def flag_marketplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.silver(spark, sf_dir).select(
        "order_number", "fs_channel_code", marketplace_flag("fs_channel_code").alias("mp_flag")
    )


@check(
    "nonempty_gate",
    "select count(*) as orders, (select count(*) > 0 from lineitem) as with_lines,"
    " (select count(*) > 0 from orders where o_totalprice < 0) as with_negative from orders",
)
def nonempty_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.table(spark, sf_dir, "orders")
    lines = both_nonempty(orders, shop.table(spark, sf_dir, "lineitem"))
    negative = both_nonempty(orders, orders.filter(F.col("o_totalprice") < 0))
    return orders.agg(F.count(F.lit(1)).alias("orders")).withColumns(
        {
            "with_lines": F.lit(lines is not None),
            "with_negative": F.lit(negative is not None),
        }
    )


@check("count_rows", "select count(*) as orders from orders")
def count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the rows are written, without a pass of its own."""
    rows, counted = observed(shop.table(spark, sf_dir, "orders"), orders=F.count(F.lit(1)))
    rows.write.parquet(scratch_path(spark, "orders"))
    return spark.createDataFrame([(counted.get["orders"],)], "orders long")


# --- nested data ---------------------------------------------------------------------------


@check(
    "flatten_struct",
    oracle.DOCS
    + f"select code, {oracle.epoch_text('event_ts')} as event_date,"
    + " case when o_orderpriority = '1-URGENT' then 'MP_A' else 'WEB' end as channel,"
    + " 'B2C' as channel_type, email,"
    + " case when c_acctbal >= 0 then region || '-shop' end as site_uid from docs",
)
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shop.documents(spark, sf_dir).select(
        "code", "fsChannel", "deliveryAddress", "site", "eventDate"
    )
    return flatten(rows).select(
        "code",
        F.col("eventDate").alias("event_date"),
        F.col("fsChannel_code").alias("channel"),
        F.col("fsChannel_salesChannelType_code").alias("channel_type"),
        F.col("deliveryAddress_email").alias("email"),
        "site_uid",
    )


_ENTRY_COLUMNS = (
    f"code, {oracle.epoch_text('event_ts')} as event_date, entry_number, product, price, parent_number, service"
)


def _entry_columns(rows: DataFrame, prefix: str = "entries_") -> DataFrame:
    return rows.select(
        "code",
        F.col("eventDate").alias("event_date"),
        F.col(prefix + "entryNumber").alias("entry_number"),
        F.col(prefix + "product_code").alias("product"),
        F.col(prefix + "totalPrice").alias("price"),
        F.col(prefix + "parentEntry_entryNumber").alias("parent_number"),
        F.col(prefix + "aService").alias("service"),
    )


@check("flatten_array_struct", oracle.DOC_ENTRIES + f"select {_ENTRY_COLUMNS} from entries")
def flatten_array_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty arrays keep one row of nulls."""
    return _entry_columns(flatten(shop.documents(spark, sf_dir).select("code", "eventDate", "entries")))


@check("flatten_array_array", oracle.DOC_ENTRIES + f"select {_ENTRY_COLUMNS} from entries")
def flatten_array_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries nested once more, one inner array per entry."""
    nested = shop.documents(spark, sf_dir).select(
        "code", "eventDate", F.transform("entries", lambda e: F.array(e)).alias("groups")
    )
    return _entry_columns(flatten(nested), "groups_")


@check(
    "flatten_deep",
    oracle.DOC_ENTRIES
    + """, steps as (
  select *, unnest(case when l_returnflag = 'R' then [1, 2, 3] when l_returnflag = 'N' then [1]
                   else [cast(null as integer)] end) as step from entries)
select code, entry_number, product, parent_number, 'B2C' as channel_type,
       'TR' || cast(l_linenumber as varchar) || '-' || cast(step as varchar) as tracking
from steps""",
)
def flatten_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sibling arrays (entries and consignments) multiply."""
    rows = flatten(shop.documents(spark, sf_dir).drop("allPromotionResults"))
    return rows.select(
        "code",
        F.col("entries_entryNumber").alias("entry_number"),
        F.col("entries_product_code").alias("product"),
        F.col("entries_parentEntry_entryNumber").alias("parent_number"),
        F.col("fsChannel_salesChannelType_code").alias("channel_type"),
        F.col("consignments_trackingID").alias("tracking"),
    )


@check(
    "last_element",
    oracle.DOCS
    + f"""select code, {oracle.epoch_text('event_ts')} as event_date,
       case l_returnflag when 'R' then 'TR' || cast(l_linenumber as varchar) || '-3'
            when 'N' then 'TR' || cast(l_linenumber as varchar) || '-1' end as tracking
from docs""",
)
def last_consignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.documents(spark, sf_dir).select(
        "code",
        F.col("eventDate").alias("event_date"),
        last_element("consignments").getField("trackingID").alias("tracking"),
    )


@check("split_explode", oracle.PROMOTIONS + f"select {_PIECE_COLUMNS} from pieces")
def split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = require_present(shop.documents(spark, sf_dir), ["entries"])
    rows = flatten(rows.select("code", "allPromotionResults", "eventDate"))
    return _named_pieces(split_to_rows(rows, ENTRY))


# --- joins ---------------------------------------------------------------------------------


def _entries_and_promotions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Of documents that are landed first, as the silver job does: they are read several times."""
    documents = shop.documents(spark, sf_dir).select("code", "eventDate", "entries", "allPromotionResults")
    documents = land_documents(documents)
    entries = flatten(documents.select("code", "eventDate", "entries"))
    return entries, promotion_rows(documents)


@check(
    "join_left_multikey",
    oracle.KEPT_ENTRIES
    + f"select e.code, {oracle.epoch_text('e.event_ts')} as event_date, e.entry_number, e.product,"
    + " p.promotion_code from entries e left join by_entry p on p.code = e.code"
    + " and p.entry_number = e.entry_number and p.event_ts = e.event_ts",
)
def join_left_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, promotions = _entries_and_promotions(spark, sf_dir)
    joined = left_join(entries, entry_promotions(promotions), ["code", "entries_entryNumber", "eventDate"])
    return columns.project_renamed(
        joined,
        {
            "code": "code",
            "eventDate": "event_date",
            "entries_entryNumber": "entry_number",
            "entries_product_code": "product",
            PROMOTION: "promotion_code",
        },
    )


@check(
    "join_left_single",
    oracle.KEPT_ENTRIES
    + "select e.code, e.entry_number, e.product, c.cart_promotions"
    + " from entries e left join carts c on c.code = e.code",
)
def join_left_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries, promotions = _entries_and_promotions(spark, sf_dir)
    joined = left_join(entries, cart_promotions(promotions), ["code"], unique_right=True)
    return joined.select(
        "code",
        F.col("entries_entryNumber").alias("entry_number"),
        F.col("entries_product_code").alias("product"),
        F.array_join("cart_level_promotions", "|").alias("cart_promotions"),
    )


@check(
    "join_left_expr",
    oracle.FACT
    + "select s.order_number, s.entries_entry_number, s.currency_iso_code, r.ref_currency, r.rate"
    + " from silver s left join rates r on s.currency_iso_code = r.ref_currency",
)
def join_left_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shop.silver(spark, sf_dir).select("order_number", "entries_entry_number", "currency_iso_code")
    rates = shop.flat(spark, sf_dir, "rates").select("ref_currency", "rate")
    return lookup_join(lines, rates, "currency_iso_code", "ref_currency")


@check(
    "join_left_fanout",
    oracle.FACT
    + "select s.order_number, s.entries_entry_number, s.delivery_address_email as email, c.customer_id"
    + " from silver s left join consumers c on s.delivery_address_email = c.emai_hash",
)
def join_left_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shop.silver(spark, sf_dir).select(
        "order_number", "entries_entry_number", F.col("delivery_address_email").alias("email")
    )
    consumers = shop.flat(spark, sf_dir, "consumers").withColumnRenamed("emai_hash", "email")
    return left_join(lines, consumers, ["email"])


# --- aggregates, distinct, latest ----------------------------------------------------------


@check(
    "agg_collect_set",
    "select l_orderkey, array_to_string(list_sort(list(distinct l_returnflag)), '|') as flags"
    " from lineitem group by l_orderkey",
)
def agg_collect_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = distinct_values(shop.table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_returnflag", "flags")
    return rows.withColumn("flags", F.array_join("flags", "|"))


@check(
    "agg_concat_list",
    """select l_orderkey, l_linestatus,
       coalesce(array_to_string(list_sort(list(l_returnflag) filter (l_tax > 0)), '|'), '') as flags
from lineitem group by l_orderkey, l_linestatus""",
)
def agg_concat_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shop.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", F.when(F.col("l_tax") > 0, F.col("l_returnflag")).alias("flag")
    )
    return joined_values(lines, ["l_orderkey", "l_linestatus"], "flag", "flags")


@check(
    "distinct_rows",
    "select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_tax from lineitem",
)
def rows_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(
        shop.table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax"
        )
    )


@check(
    "latest_event",
    """select o_custkey, o_orderkey, cast(o_orderdate as varchar) as o_orderdate from (
  select *, rank() over (partition by o_custkey order by o_orderdate desc nulls last) as position
  from orders) where position = 1""",
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate")
    )
    return latest_rows(orders, "o_custkey", "o_orderdate")


# --- scalar functions ----------------------------------------------------------------------


@check(
    "epoch_decode",
    "select o_orderkey, "
    + oracle.moment("case when o_orderstatus <> 'P' then o_orderdate end")
    + " as order_date from orders",
)
def epoch_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", shop.epoch_text("o_orderdate")).alias("coded"),
    )
    return orders.select("o_orderkey", decode_epoch_text("coded").alias("order_date"))


_DATE_TEXT = "case o_orderstatus when 'P' then '' when 'O' then 'n/a' else cast(o_orderdate as {text}) end"


@check(
    "parse_timestamp",
    "select o_orderkey, cast(try_cast("
    + _DATE_TEXT.format(text="varchar")
    + " as timestamp) as varchar) as order_date from orders",
)
def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.table(spark, sf_dir, "orders")
    orders = orders.select("o_orderkey", F.expr(_DATE_TEXT.format(text="string")).alias("coded"))
    return orders.select("o_orderkey", parse_timestamp("coded").cast("string").alias("order_date"))


_DAY_TEXT = """case when o_orderstatus = 'P' then '' when o_orderpriority = '1-URGENT' then '31/02/2020'
else cast(day(o_orderdate) as {text}) || '/' || cast(month(o_orderdate) as {text}) || '/'
  || cast(year(o_orderdate) as {text}) end"""


@check(
    "parse_dates",
    "select o_orderkey, strftime(try_strptime("
    + _DAY_TEXT.format(text="varchar")
    + ", '%d/%m/%Y'), '%Y-%m-%d') as order_date from orders",
)
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr(_DAY_TEXT.format(text="string")).alias("order_date")
    )
    parsed = parse_dates(orders, ["order_date"], "d/M/yyyy")
    return parsed.withColumn("order_date", F.col("order_date").cast("string"))


_RATED = "from silver s left join rates r on s.currency_iso_code = r.ref_currency"
_NET_ORDER = "(s.total_price - s.total_tax) * r.rate as net_sales_order"
_NET_ENTRIES = """case when s.entries_total_tax is null then s.entries_total_price * r.rate
  else (s.entries_total_price - try_cast(s.entries_total_tax as double)) * r.rate end as net_sales_entries"""


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = shop.flat(spark, sf_dir, "rates").select("ref_currency", "rate")
    return lookup_join(shop.silver(spark, sf_dir), rates, "currency_iso_code", "ref_currency")


@check(
    "net_sales_order",
    oracle.FACT + f"select s.order_number, s.entries_entry_number, {_NET_ORDER} {_RATED}",
)
def order_net_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).select(
        "order_number",
        "entries_entry_number",
        net_sales_order("total_price", "total_tax", "rate").alias("net_sales_order"),
    )


@check(
    "net_sales_entries",
    oracle.FACT + f"select s.order_number, s.entries_entry_number, {_NET_ENTRIES} {_RATED}",
)
def entries_net_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    net = net_sales_entries("entries_total_price", "entries_total_tax", "rate")
    return _rated(spark, sf_dir).select(
        "order_number", "entries_entry_number", net.alias("net_sales_entries")
    )


# --- whole jobs ----------------------------------------------------------------------------


@check(
    "promotions_by_entry",
    oracle.PROMOTIONS
    + f"select code, {oracle.epoch_text('event_ts')} as event_date, entry_number, promotion_code"
    + " from by_entry",
)
def promotions_by_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = require_present(shop.documents(spark, sf_dir), ["entries"])
    return columns.project_renamed(
        entry_promotions(promotion_rows(documents)),
        {
            "code": "code",
            "eventDate": "event_date",
            "entries_entryNumber": "entry_number",
            PROMOTION: "promotion_code",
        },
    )


@check("cart_promotions", oracle.PROMOTIONS + "select code, cart_promotions from carts")
def promotions_by_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = require_present(shop.documents(spark, sf_dir), ["entries"])
    carts = cart_promotions(promotion_rows(documents))
    return carts.select("code", F.array_join("cart_level_promotions", "|").alias("cart_promotions"))


_STEP = "case e.l_returnflag when 'R' then '3' when 'N' then '1' end"
_SHIPPED = f"case when {_STEP} is not null then e.l_shipdate end"
_DELIVERED = f"case when {_STEP} is not null and e.l_linestatus = 'F' then e.l_shipdate end"
_NAMED = f"case when {_STEP} is not null then e.o_orderdate end"
_KEY = "substr(e.code, 2)"
_TAX = "cast(e.l_tax as varchar)"

SILVER_FROM = (
    oracle.KEPT_ENTRIES
    + f"""
select distinct e.code as order_number, e.entry_number as entries_entry_number,
  {oracle.moment('e.event_ts')} as event_date, e.o_orderstatus as order_status_code,
  'https://track.example/' || {_KEY} as tracking_url, 'S' || {_KEY} as sales_order_number,
  {oracle.moment("case when e.o_orderstatus <> 'O' then e.event_ts end")} as sap_goods_issue_date,
  e.o_orderpriority as sap_plant_code, 'T' || {_KEY} as tracking_id,
  {oracle.moment('e.o_orderdate')} as order_created_date_in_ecc,
  {oracle.moment('e.o_orderdate')} as creation_time, e.o_totalprice as total_price,
  e.o_totalprice * 0.1::double as total_discounts, e.o_totalprice * 0.2::double as total_tax,
  {oracle.moment('e.o_orderdate')} as order_placed_date,
  case when e.o_orderstatus <> 'P' then 'D' || {_KEY} end as delivery_number,
  e.o_orderstatus = 'F' as product_registration, e.c_name as cs_code,
  cast(null as varchar) as bundle_ids,
  e.o_totalprice * 0.3::double as services_sub_total_without_discounts, 'PAID' as payment_status,
  cast(null as varchar) as applied_coupons, e.o_totalprice * 0.25::double as services_sub_total,
  cast(null as varchar) as utm_details, cast(null as varchar) as news_letter_subscription,
  e.o_totalprice as order_subtotal, e.o_totalprice * 0.1::double as order_total_discount,
  e.c_acctbal as delivery_cost, e.c_mktsegment = 'BUILDING' as delivery_address_is_business_user,
  e.n_name as delivery_address_town, e.email as delivery_address_email,
  {oracle.moment(_SHIPPED)} as consigments_shipping_date,
  'TR' || cast(e.l_linenumber as varchar) || '-' || {_STEP} as consigments_tracking_id,
  'C' || cast(e.l_suppkey as varchar) || '-' || {_STEP} as consigments_code,
  {oracle.moment(_DELIVERED)} as consigments_delivered_date,
  {oracle.moment(_NAMED)} as consigments_named_delivery_date,
  'step ' || {_STEP} as consigments_status_display, e.c_mktsegment as fs_channel_name,
  case when e.o_orderpriority = '1-URGENT' then 'MP_A' else 'WEB' end as fs_channel_code,
  'B2C' as fs_channel_sales_channel_type_code,
  'CU' || cast(e.n_nationkey as varchar) as currency_iso_code,
  case when e.c_acctbal >= 0 then e.region || '-shop' end as site_uid,
  cast(cast(e.l_quantity as integer) as varchar) as entries_quantity,
  e.price as entries_total_price, e.l_linestatus = 'O' as entries_is_focused_price,
  e.service as entries_a_service, e.l_extendedprice as entries_d2c_price,
  'info' as entries_product_info, e.l_extendedprice as entries_base_price,
  case when e.l_discount > 0.05 then 'SALE' end as entries_discount_name,
  {_TAX} as entries_percentage_tax,
  case when e.l_linestatus = 'O' then null when e.l_returnflag = 'N' then '' else {_TAX} end
    as entries_total_tax,
  e.l_discount as entries_discount_rows, cast(e.c_custkey as varchar) as user_uid,
  cast(null as varchar) as user_referred_by_code, cast(null as varchar) as user_referred_by_staff_name,
  'PI' as payment_info_code, 'card' as payment_info_adyen_payment_method_name,
  'visa' as payment_info_adyen_payment_method, e.o_orderstatus as delivery_status_code,
  e.product as entries_product_code, e.parent_number as entries_parent_entry_entry_number,
  e.code as entries_order_code, 'GUEST' as user_type_code,
  p.promotion_code as entries_promotion_code, c.cart_promotions as cart_level_promotions,
  case when e.c_acctbal >= 0 then e.region end as country_code, '2024-01-05' as load_date
from entries e
left join by_entry p
  on p.code = e.code and p.entry_number = e.entry_number and p.event_ts = e.event_ts
left join carts c on c.code = e.code
where e.entry_number is not null and e.product is not null"""
)


@check("orders_silver", SILVER_FROM)
def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 68 silver columns, distinct and guarded as the upsert sink takes them.

    The documents are landed as a columnar table first, as the job does.
    """
    rows = keyed_silver_lines(land_documents(shop.documents(spark, sf_dir)), "2024-01-05")
    rows = guarded(rows, ORDER_LINE_KEYS)
    return rows.withColumn("cart_level_promotions", F.array_join("cart_level_promotions", "|"))


_FACT_TEXT = {
    "event_date": "cast(try_cast(event_date as timestamp) as varchar)",
    "order_placed_date": "cast(try_cast(order_placed_date as timestamp) as varchar)",
    "load_date": "cast(try_cast(load_date as timestamp) as varchar)",
    "country_code": "substr(country_code, 1, 2)",
    "at_load_date": "'2024-01-06 00:00:00'",
    "mp_flag": "case when regexp_matches(fs_channel_code, '(MP)') then 'True' else 'False' end",
}

_FACT_STEPS = f""", ranked as (
  select *, rank() over (partition by order_number order by event_date desc nulls last) as position
  from silver),
netted as (
  select s.*, {_NET_ORDER}, {_NET_ENTRIES}
  from (select distinct * exclude (position) from ranked where position = 1) s
  left join rates r on s.currency_iso_code = r.ref_currency),
fact as (
  select {', '.join(f'{_FACT_TEXT[c]} as {c}' if c in _FACT_TEXT else c for c in FACT_OUTPUT)}
  from netted left join consumers on delivery_address_email = emai_hash)
select distinct * from fact
where order_number is not null and event_date is not null and entries_entry_number is not null
  and entries_product_code is not null"""

_FACT_SQL = oracle.FACT + _FACT_STEPS

#: The fact of a silver table that a query gives.
FACT_FROM = oracle.LOOKUPS + ", silver as ({silver})" + _FACT_STEPS.replace("{", "{{").replace("}", "}}")


@check("orders_fact", _FACT_SQL)
def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 33 fact columns, distinct and guarded as the fact sink writes them.

    The silver lines are a catalog table, as they are for the job, which reads them twice.
    """
    silver = f"orderlake_checks.silver_{uuid4().hex}"
    overwrite_table(shop.silver(spark, sf_dir), silver, scratch_path(spark, "silver"))
    rows = keyed_orders_fact(
        read_table(spark, silver),
        shop.flat(spark, sf_dir, "rates"),
        shop.flat(spark, sf_dir, "consumers"),
        datetime(2024, 1, 6),
    )
    rows = guarded(rows, ORDER_LINE_KEYS)
    moments = ["event_date", "order_placed_date", "load_date", "at_load_date"]
    return rows.withColumns(
        {
            **{c: F.col(c).cast("string") for c in moments},
            "cart_level_promotions": F.array_join("cart_level_promotions", "|"),
        }
    )
