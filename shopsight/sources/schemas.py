"""Raw table layouts. Explicit schemas: no inference pass over the files."""

from __future__ import annotations

# Logical table names and the columns of the raw files (dates arrive as text).
RAW_SCHEMAS: dict[str, str] = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, "
    "price double, freight_value double",
    "products": "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
    "product_photos_qty int, product_weight_g double, product_length_cm double, product_height_cm double, "
    "product_width_cm double",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, "
    "customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    "reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "geolocation": "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, "
    "geolocation_state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}

# Timestamp columns by table.
DATE_COLUMNS: dict[str, list[str]] = {
    "orders": [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "reviews": ["review_creation_date", "review_answer_timestamp"],
}
