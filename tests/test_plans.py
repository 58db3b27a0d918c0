import json
from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from orderlake.plans.flat_file import run_dimension, run_flat_file
from orderlake.plans.gold_orders import orders_fact, run_orders_fact
from orderlake.plans.silver_orders import orders_silver, run_orders_silver
from orderlake.schemas import FACT_INPUT, FACT_OUTPUT, ORDER_LINE_KEYS, SILVER_COLUMNS
from orderlake.sinks.tables import guarded, overwrite_table
from orderlake.sources.files import read_order_documents


@pytest.fixture(params=[("true", "UTC"), ("false", "America/New_York")], ids=["ansi", "lenient"])
def mode(spark, request):
    names = ["spark.sql.ansi.enabled", "spark.sql.session.timeZone"]
    before = [spark.conf.get(n) for n in names]
    for name, value in zip(names, request.param):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def entry(number, product, **values):
    return {
        "entryNumber": number,
        "product": {"code": product},
        "totalPrice": 10.0,
        "order": {"code": "x"},
        **values,
    }


def document(code, moment, entries, **values):
    return {
        "code": code,
        "eventDate": f"/Date({moment})/",
        "site": {"uid": "de-shop"},
        "currency": {"isoCode": "EUR"},
        "totalPrice": 100.0,
        "totalTax": 20.0,
        "deliveryAddress": {"email": "a@shop.example"},
        "entries": entries,
        **values,
    }


def promotion(consumed, code):
    return {"consumedEntries": consumed, "promotion": {"code": code}}


# 2021-03-14 02:30:00 in UTC is a moment that the clocks of New York skip
GAP = 1615689000000

DOCUMENTS = [
    document(
        "O1",
        GAP,
        [entry(0, "P0"), entry(1, "P1", totalTax="2.5")],
        allPromotionResults=[
            promotion("0|1", "SPRING"),
            promotion("0", "EXTRA"),
            promotion("1|", "LAST"),
            promotion("", "CART"),
            promotion(None, "ALL"),
            promotion("abc", "ODD"),
        ],
        consignments=[
            {"code": "C1", "shippingDate": "/Date(0)/"},
            {"code": "C2", "shippingDate": "/Date(-1500)/"},
        ],
    ),
    # a later event of the same order; its cart promotion counts for both events
    document(
        "O1",
        GAP + 1000,
        [entry(0, "P0")],
        allPromotionResults=[promotion(" 0", "SPACE"), promotion("", "LATER")],
        status={"code": "DONE"},
    ),
    document("O2", 0, [entry(0, "P9")], site=None, fsChannel={"code": "MP_A"}, consignments=[]),
    document("O3", 0, []),
    {**document("O4", 0, []), "entries": None},
]


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "bronze" / "orders" / "2024-01-05"
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(json.dumps(d) for d in DOCUMENTS))
    return str(tmp_path / "bronze" / "orders" / "*")


def by_key(df):
    return {(r.order_number, r.event_date, r.entries_product_code): r for r in df.collect()}


def test_column_lists():
    assert len(SILVER_COLUMNS) == 68 and len(set(SILVER_COLUMNS.values())) == 68
    assert len(FACT_INPUT) == 29 and len(FACT_OUTPUT) == 33
    assert set(FACT_INPUT) <= set(SILVER_COLUMNS.values())


def test_orders_silver(spark, mode, landed):
    documents = read_order_documents(spark, landed)
    lines = orders_silver(documents, "2024-01-05")
    assert lines.columns == list(SILVER_COLUMNS.values())
    found = by_key(lines)
    assert len(found) == 5

    first = found["O1", "2021-03-14 02:30:00", "P0"]
    assert first.entries_promotion_code == "EXTRA|SPRING"
    assert first.cart_level_promotions == ["ALL", "CART", "LAST", "LATER"]
    assert (first.consigments_code, first.consigments_shipping_date) == ("C2", "1969-12-31 23:59:58")
    assert (first.creation_time, first.consigments_delivered_date) == ("", "")
    assert (first.country_code, first.load_date) == ("de", "2024-01-05")
    assert found["O1", "2021-03-14 02:30:00", "P1"].entries_promotion_code == "LAST|SPRING"

    second = found["O1", "2021-03-14 02:30:01", "P0"]
    assert second.entries_promotion_code == "SPACE"
    assert second.cart_level_promotions == first.cart_level_promotions
    assert second.order_status_code == "DONE"

    other = found["O2", "1970-01-01 00:00:00", "P9"]
    assert other.cart_level_promotions is None and other.entries_promotion_code is None
    assert other.country_code is None and other.consigments_shipping_date == ""
    assert found["O3", "1970-01-01 00:00:00", None].entries_entry_number is None


def test_silver_and_gold_jobs(spark, mode, landed, tmp_path):
    db = f"jobs_{uuid4().hex}"
    silver, gold = f"{db}.orders", f"{db}.fact_of_orders"
    paths = {n: str(tmp_path / n) for n in ("silver", "gold", "rates", "consumers")}
    for land in (True, False):
        run_orders_silver(spark, landed, paths["silver"], silver, "2024-01-05", land=land)
        lines = by_key(spark.table(silver))
        assert set(lines) == {
            ("O1", "2021-03-14 02:30:00", "P0"),
            ("O1", "2021-03-14 02:30:00", "P1"),
            ("O1", "2021-03-14 02:30:01", "P0"),
            ("O2", "1970-01-01 00:00:00", "P9"),
        }

    rates = spark.createDataFrame(
        [("EUR", 2.0, "x"), ("EUR", 3.0, "y")], "ref_currency string, rate double, load_date string"
    )
    consumers = spark.createDataFrame([("a@shop.example", 7)], "emai_hash string, customer_id int")
    overwrite_table(rates, f"{db}.rates", paths["rates"])
    overwrite_table(consumers, f"{db}.consumers", paths["consumers"])
    for _ in range(2):
        run_orders_fact(
            spark, silver, f"{db}.rates", f"{db}.consumers", paths["gold"], gold, "2024-01-06T00:00:00"
        )
        fact = spark.table(gold)
        assert set(fact.columns) == set(FACT_OUTPUT)
        found = fact.select(
            "order_number", F.col("at_load_date").cast("string").alias("at"), "mp_flag", "country_code",
            "customer_id", "net_sales_order", "net_sales_entries",
        )
        assert sorted([tuple(r) for r in found.collect()], key=repr) == sorted(
            [
                ("O1", "2024-01-06 00:00:00", "False", "de", 7, 160.0, 20.0),
                ("O1", "2024-01-06 00:00:00", "False", "de", 7, 240.0, 30.0),
                ("O2", "2024-01-06 00:00:00", "True", None, 7, 160.0, 20.0),
                ("O2", "2024-01-06 00:00:00", "True", None, 7, 240.0, 30.0),
            ],
            key=repr,
        )


def test_fact_edges(spark, mode):
    base = {
        **dict.fromkeys(FACT_INPUT),
        "order_number": "O1",
        "event_date": "2024-01-05 00:00:00",
        "entries_entry_number": 0,
        "entries_product_code": "P",
        "total_price": 100.0,
        "total_tax": 20.0,
        "entries_total_price": 10.0,
        "currency_iso_code": "EUR",
        "country_code": "germany",
        "delivery_address_email": "a@shop.example",
    }
    lines = [
        base,
        base,  # exact copy
        {**base, "event_date": "2024-01-04 00:00:00"},  # older event
        {**base, "entries_product_code": "Q", "entries_total_tax": ""},
        {**base, "order_number": "O2", "currency_iso_code": "XXX"},  # no rate
        {**base, "order_number": "O3", "delivery_address_email": None},  # no customer
        {**base, "order_number": "O4", "event_date": ""},  # no date
        {**base, "order_number": "O5", "entries_entry_number": None},  # no entry
        {**base, "order_number": None},
        {**base, "order_number": "O6", "event_date": "2024-01-06 00:00:00", "entries_entry_number": None},
        {**base, "order_number": "O6"},  # hidden by the later event, which has no entry
    ]
    types = {
        **dict.fromkeys(FACT_INPUT, "string"),
        **dict.fromkeys(["total_price", "total_tax", "entries_total_price"], "double"),
        "entries_entry_number": "bigint",
        "cart_level_promotions": "array<string>",
    }
    silver = spark.createDataFrame(
        [tuple(row[c] for c in FACT_INPUT) for row in lines],
        ", ".join(f"{c} {types[c]}" for c in FACT_INPUT),
    )
    rates = spark.createDataFrame([("EUR", 2.0)], "ref_currency string, rate double")
    consumers = spark.createDataFrame(
        [("a@shop.example", 1), ("a@shop.example", 2)], "emai_hash string, customer_id int"
    )
    fact = guarded(orders_fact(silver, rates, consumers, datetime(2024, 1, 6)), ORDER_LINE_KEYS)
    assert fact.columns == FACT_OUTPUT
    found = sorted(
        (r.order_number, r.entries_product_code, r.customer_id, r.net_sales_order, r.net_sales_entries, r.country_code)
        for r in fact.fillna(-1, ["customer_id", "net_sales_order", "net_sales_entries"]).collect()
    )
    assert found == [
        ("O1", "P", 1, 160.0, 20.0, "ge"),
        ("O1", "P", 2, 160.0, 20.0, "ge"),
        ("O1", "Q", 1, 160.0, -1.0, "ge"),
        ("O1", "Q", 2, 160.0, -1.0, "ge"),
        ("O2", "P", 1, -1.0, -1.0, "ge"),
        ("O2", "P", 2, -1.0, -1.0, "ge"),
        ("O3", "P", -1, 160.0, 20.0, "ge"),
    ]


def test_flat_file_jobs(spark, tmp_path):
    db = f"jobs_{uuid4().hex}"
    for day, text in (("2024-01-05", "k,v\n1,old\n"), ("2024-01-06", "k,v\n1,new\n2,more\n")):
        folder = tmp_path / "bronze" / "shops" / day
        folder.mkdir(parents=True)
        (folder / "shops.csv").write_text(text)
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    for day in ("2024-01-05", "2024-01-06"):
        run_flat_file(spark, str(tmp_path / "bronze"), "shops", day, silver_path, f"{db}.shops")
    assert [tuple(r) for r in spark.table(f"{db}.shops").orderBy("k").collect()] == [
        (1, "new", "2024-01-06"),
        (2, "more", "2024-01-06"),
    ]
    run_dimension(spark, silver_path, gold_path, f"{db}.dim_shops", "2024-01-07")
    dimension = spark.table(f"{db}.dim_shops")
    assert dimension.columns == ["k", "v", "at_load_date"]
    assert {r.at_load_date for r in dimension.collect()} == {"2024-01-07"}
