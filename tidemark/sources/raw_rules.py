"""Declared rules of the raw tables, for the quality job and for reading them from CSV."""

# Columns of each table with type, allowed share of missing values (0 if not given), allowed values, and
# uniqueness.
_TEXT, _WHOLE, _REAL = "VARCHAR", "BIGINT", "DOUBLE"


def _columns(kind: str, names: str, **rules) -> dict:
    return {name: {"dtype": kind, **rules} for name in names.split()}


RAW_RULES = {
    "validation_rules": {"allow_missing_tables": False},
    "tables": {
        "orders": {
            "num_columns": 8,
            "columns": {
                **_columns(_TEXT, "order_id", unique=True),
                **_columns(_TEXT, "customer_id"),
                **_columns(
                    _TEXT,
                    "order_status",
                    allowed_values=[
                        "created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled",
                        "unavailable",
                    ],
                ),
                **_columns(_TEXT, "order_purchase_timestamp"),
                **_columns(
                    _TEXT,
                    "order_approved_at order_delivered_carrier_date order_delivered_customer_date",
                    max_missing_percentage=0.05,
                ),
                **_columns(_TEXT, "order_estimated_delivery_date"),
            },
        },
        "customers": {
            "num_columns": 5,
            "columns": {
                **_columns(_TEXT, "customer_id", unique=True),
                **_columns(_TEXT, "customer_unique_id"),
                **_columns(_WHOLE, "customer_zip_code_prefix"),
                **_columns(_TEXT, "customer_city customer_state"),
            },
        },
        "order_items": {
            "num_columns": 7,
            "columns": {
                **_columns(_TEXT, "order_id"),
                **_columns(_WHOLE, "order_item_id"),
                **_columns(_TEXT, "product_id seller_id shipping_limit_date"),
                **_columns(_REAL, "price freight_value"),
            },
        },
        "payments": {
            "num_columns": 5,
            "columns": {
                **_columns(_TEXT, "order_id"),
                **_columns(_WHOLE, "payment_sequential"),
                **_columns(
                    _TEXT,
                    "payment_type",
                    allowed_values=["credit_card", "boleto", "voucher", "debit_card", "not_defined"],
                ),
                **_columns(_WHOLE, "payment_installments"),
                **_columns(_REAL, "payment_value"),
            },
        },
        "reviews": {
            "num_columns": 7,
            "columns": {
                **_columns(_TEXT, "review_id order_id"),
                **_columns(_WHOLE, "review_score", allowed_values=[1, 2, 3, 4, 5]),
                **_columns(_TEXT, "review_comment_title review_comment_message", max_missing_percentage=1.0),
                **_columns(_TEXT, "review_creation_date review_answer_timestamp"),
            },
        },
        "products": {
            "num_columns": 9,
            "columns": {
                **_columns(_TEXT, "product_id", unique=True),
                **_columns(_TEXT, "product_category_name", max_missing_percentage=0.1),
                **_columns(
                    _REAL,
                    "product_name_lenght product_description_lenght product_photos_qty product_weight_g "
                    "product_length_cm product_height_cm product_width_cm",
                    max_missing_percentage=0.1,
                ),
            },
        },
        "sellers": {
            "num_columns": 4,
            "columns": {
                **_columns(_TEXT, "seller_id", unique=True),
                **_columns(_WHOLE, "seller_zip_code_prefix"),
                **_columns(_TEXT, "seller_city seller_state"),
            },
        },
    },
}
