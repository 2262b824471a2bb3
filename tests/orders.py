"""Small hand-made order tables."""

from tidemark.functions.times import snapshot
from tidemark.sources.tables import typed_tables

AT = snapshot("2017-09-01")

ORDERS = (
    "order_id string, customer_id string, order_purchase_timestamp string, order_estimated_delivery_date string, "
    "order_delivered_customer_date string, order_status string"
)
CUSTOMERS = "customer_id string, customer_unique_id string, customer_state string"
PAYMENTS = "order_id string, payment_value double"


def order(order_id, customer_id, bought, due="2017-09-10", delivered="2017-09-05", status="delivered"):
    return (order_id, customer_id, bought, due, delivered, status)


def raw(spark, orders, customers, payments):
    return (
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(customers, CUSTOMERS),
        spark.createDataFrame(payments, PAYMENTS),
    )


def tables(spark, orders, customers, payments):
    return typed_tables(*raw(spark, orders, customers, payments))


def by_person(df):
    return {r["customer_unique_id"]: r for r in df.collect()}
