"""Column types of the e-commerce feeds (fixed values: the formats of the files)."""

ITEMS = (
    "array<struct<coupon:string,item_id:string,item_name:string,"
    "item_revenue_in_usd:double,price_in_usd:double,quantity:bigint>>"
)
GEO = "struct<city:string,state:string>"
ECOMMERCE = "struct<purchase_revenue_in_usd:double,total_item_quantity:bigint,unique_items:bigint>"

# CSV columns as they arrive. JSON and the epoch columns are text.
USERS_CSV = "email string, user_first_touch_timestamp string"
PRODUCTS_CSV = "item_id string, name string, price double"
SALES_CSV = (
    "order_id string, email string, transaction_timestamp string, "
    "purchase_revenue_in_usd double, total_item_quantity bigint, items string"
)
EVENTS_CSV = (
    "user_id string, event_name string, traffic_source string, event_timestamp string, "
    "event_previous_timestamp string, user_first_touch_timestamp string, "
    "geo string, ecommerce string, items string"
)
FEEDS = {
    "users": USERS_CSV,
    "products": PRODUCTS_CSV,
    "sales": SALES_CSV,
    "events": EVENTS_CSV,
}

PURCHASE = "finalize"
