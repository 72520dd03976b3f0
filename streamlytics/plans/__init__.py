"""The composed jobs. Each takes line or record DataFrames, batch or streaming, and returns a DataFrame."""

from streamlytics.plans.orders import order_item_join, order_item_repair
from streamlytics.plans.shopping import hourly_uv, item_pv_uv, item_uv_approx, page_views, read_behaviour
from streamlytics.plans.tables import domain_traffic_sql, tumble_purchases, tumble_purchases_sql
from streamlytics.plans.traffic import domain_traffic, heavy_access
from streamlytics.plans.users import (
    etl_rows, first_time_users, os_users, province_users, read_app_events, top_products,
    top_products_on_timer, total_users,
)
from streamlytics.plans.words import count_words, count_words_stream

__all__ = [
    "count_words", "count_words_stream", "domain_traffic", "domain_traffic_sql", "etl_rows", "first_time_users",
    "heavy_access", "hourly_uv", "item_pv_uv", "item_uv_approx", "order_item_join", "order_item_repair",
    "os_users", "page_views", "province_users", "read_app_events", "read_behaviour", "top_products",
    "top_products_on_timer", "total_users", "tumble_purchases", "tumble_purchases_sql",
]
