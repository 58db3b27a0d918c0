"""Document schema, silver column mapping and gold column lists."""

from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# The order document, the silver names and the gold columns are
# the data contract of the tables, spelling included.
# ---------------------------------------------------------------------------

ORDER_DDL = """
code string, sapRejectionReason string, trackingUrl string, salesOrderNumber string,
sapGoodsIssueDate string, versionID string, sapPlantCode string, trackingId string,
orderCreatedDateInECC string, creationTime string, totalPrice double, totalDiscounts double,
allPromotionResults array<struct<consumedEntries: string, promotion: struct<code: string>>>,
totalTax double, orderPlacedDate string,
deliveryAddress struct<isBusinessUser: boolean, town: string, email: string, postalcode: string>,
deliveryNumber string, productRegistration boolean, csCode string, bundleIds string,
consignments array<struct<shippingDate: string, trackingID: string, code: string,
    deliveredDate: string, namedDeliveryDate: string, statusDisplay: string>>,
orderblock struct<code: string, codeLowerCase: string>,
fsChannel struct<name: string, code: string, salesChannelType: struct<code: string>>,
currency struct<isoCode: string>, servicesSubTotalWithoutDiscounts double, paymentStatus string,
appliedCoupons string, servicesSubTotal double, utmDetails string, newsLetterSubscription string,
site struct<uid: string>,
entries array<struct<product: struct<code: string>, quantity: string, totalPrice: double,
    isFocusedPrice: boolean, parentEntry: struct<entryNumber: bigint>, aService: boolean,
    entryNumber: bigint, d2cPrice: double, productInfo: string, basePrice: double,
    `order`: struct<code: string>, discountName: string, percentageTax: string,
    totalTax: string, discountRows: double>>,
subtotal double, totalDiscount double,
user struct<uid: string, referredByCode: string, referredByStaffName: string,
    type: struct<code: string>>,
paymentInfo struct<code: string, adyenPaymentMethodName: string, adyenPaymentMethod: string>,
deliveryStatus struct<code: string>, eventDate string, status struct<code: string>,
deliveryCost double
"""

SILVER_COLUMNS = {
    "code": "order_number",
    "entries_entryNumber": "entries_entry_number",
    "eventDate": "event_date",
    "status_code": "order_status_code",
    "trackingUrl": "tracking_url",
    "salesOrderNumber": "sales_order_number",
    "sapGoodsIssueDate": "sap_goods_issue_date",
    "sapPlantCode": "sap_plant_code",
    "trackingId": "tracking_id",
    "orderCreatedDateInECC": "order_created_date_in_ecc",
    "creationTime": "creation_time",
    "totalPrice": "total_price",
    "totalDiscounts": "total_discounts",
    "totalTax": "total_tax",
    "orderPlacedDate": "order_placed_date",
    "deliveryNumber": "delivery_number",
    "productRegistration": "product_registration",
    "csCode": "cs_code",
    "bundleIds": "bundle_ids",
    "servicesSubTotalWithoutDiscounts": "services_sub_total_without_discounts",
    "paymentStatus": "payment_status",
    "appliedCoupons": "applied_coupons",
    "servicesSubTotal": "services_sub_total",
    "utmDetails": "utm_details",
    "newsLetterSubscription": "news_letter_subscription",
    "subtotal": "order_subtotal",
    "totalDiscount": "order_total_discount",
    "deliveryCost": "delivery_cost",
    "deliveryAddress_isBusinessUser": "delivery_address_is_business_user",
    "deliveryAddress_town": "delivery_address_town",
    "deliveryAddress_email": "delivery_address_email",
    "consignments_shippingDate": "consigments_shipping_date",
    "consignments_trackingID": "consigments_tracking_id",
    "consignments_code": "consigments_code",
    "consignments_deliveredDate": "consigments_delivered_date",
    "consignments_namedDeliveryDate": "consigments_named_delivery_date",
    "consignments_statusDisplay": "consigments_status_display",
    "fsChannel_name": "fs_channel_name",
    "fsChannel_code": "fs_channel_code",
    "fsChannel_salesChannelType_code": "fs_channel_sales_channel_type_code",
    "currency_isoCode": "currency_iso_code",
    "site_uid": "site_uid",
    "entries_quantity": "entries_quantity",
    "entries_totalPrice": "entries_total_price",
    "entries_isFocusedPrice": "entries_is_focused_price",
    "entries_aService": "entries_a_service",
    "entries_d2cPrice": "entries_d2c_price",
    "entries_productInfo": "entries_product_info",
    "entries_basePrice": "entries_base_price",
    "entries_discountName": "entries_discount_name",
    "entries_percentageTax": "entries_percentage_tax",
    "entries_totalTax": "entries_total_tax",
    "entries_discountRows": "entries_discount_rows",
    "user_uid": "user_uid",
    "user_referredByCode": "user_referred_by_code",
    "user_referredByStaffName": "user_referred_by_staff_name",
    "paymentInfo_code": "payment_info_code",
    "paymentInfo_adyenPaymentMethodName": "payment_info_adyen_payment_method_name",
    "paymentInfo_adyenPaymentMethod": "payment_info_adyen_payment_method",
    "deliveryStatus_code": "delivery_status_code",
    "entries_product_code": "entries_product_code",
    "entries_parentEntry_entryNumber": "entries_parent_entry_entry_number",
    "entries_order_code": "entries_order_code",
    "user_type_code": "user_type_code",
    "allPromotionResults_promotion_code": "entries_promotion_code",
    "cart_level_promotions": "cart_level_promotions",
    "country": "country_code",
    "load_date": "load_date",
}

# Flattened columns that hold `/Date(ms)/` text.
DATE_COLUMNS = [
    "creationTime", "orderPlacedDate", "orderCreatedDateInECC", "consignments_deliveredDate",
    "consignments_namedDeliveryDate", "consignments_shippingDate", "eventDate",
    "sapGoodsIssueDate",
]

# Grain of the silver table and of the gold fact.
ORDER_LINE_KEYS = ["order_number", "entries_entry_number", "event_date", "entries_product_code"]
ORDER_PARTITIONS = ["country_code"]

FACT_INPUT = [
    "order_number", "event_date", "order_status_code", "total_price", "total_discounts",
    "total_tax", "order_placed_date", "bundle_ids", "payment_status", "fs_channel_code",
    "fs_channel_sales_channel_type_code", "currency_iso_code", "site_uid", "entries_quantity",
    "entries_total_price", "entries_a_service", "entries_total_tax", "entries_discount_rows",
    "delivery_address_email", "delivery_status_code", "entries_product_code",
    "entries_parent_entry_entry_number", "entries_promotion_code", "cart_level_promotions",
    "country_code", "entries_discount_name", "entries_entry_number", "fs_channel_name",
    "load_date",
]

FACT_OUTPUT = [
    "customer_id" if c == "delivery_address_email" else c for c in FACT_INPUT
] + ["at_load_date", "mp_flag", "net_sales_order", "net_sales_entries"]

# Column of the consumer dimension that is compared with the delivery email.
CONSUMER_EMAIL = "emai_hash"
CONSUMER_ID = "customer_id"


def order_schema() -> StructType:
    """The order document as a `StructType` (needs an active session to parse the DDL)."""
    return StructType.fromDDL(ORDER_DDL)
