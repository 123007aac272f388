"""Customer and order marts over staged customers, orders and payments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalars import whole_units
from adlake.operators.quality import Check
from adlake.operators.relational import left_join_using

# Payment methods in report order, order states.
PAYMENT_METHODS = ("credit_card", "coupon", "bank_transfer", "gift_card")
ORDER_STATUSES = ("placed", "shipped", "completed", "return_pending", "returned")


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("customer_id"), "first_name", "last_name")


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"), F.col("user_id").alias("customer_id"), "order_date", "status"
    )


def stage_payments(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Cents to whole units: integer division, or with cents kept when ``exact``."""
    cents = F.col("amount")
    amount = cents.cast("decimal(20,2)") / 100 if exact else whole_units(cents)
    return raw.select(F.col("id").alias("payment_id"), "order_id", "payment_method", amount.alias("amount"))


def payments_by_method(
    payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS,
) -> DataFrame:
    """One row per order: an amount per method (0 when unused) and the total."""
    return payments.groupBy("order_id").agg(
        *[
            F.sum(F.when(F.col("payment_method") == m, F.col("amount")).otherwise(0)).alias(f"{m}_amount")
            for m in methods
        ],
        F.sum("amount").alias("amount"),
    )


def orders_mart(
    orders: DataFrame, payments: DataFrame, methods: Sequence[str] = PAYMENT_METHODS,
) -> DataFrame:
    """Orders with their payments by method; NULL amounts when there are none."""
    return left_join_using(
        orders.select("order_id", "customer_id", "order_date", "status"),
        payments_by_method(payments, methods),
        "order_id",
    )


def customers_mart(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Customers with first and latest order, number of orders and lifetime value.

    Payments shrink to one row per order before they meet the orders, so orders
    and payments can be aggregated per customer together. Payments without an
    order belong to no customer and drop out.
    """
    paid = payments.groupBy("order_id").agg(F.sum("amount").alias("paid"))
    activity = (
        left_join_using(orders, paid, "order_id")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("most_recent_order"),
            F.count("order_id").alias("number_of_orders"),
            F.sum("paid").alias("customer_lifetime_value"),
        )
    )
    return left_join_using(
        customers.select("customer_id", "first_name", "last_name"), activity, "customer_id"
    )


# The declared checks of the models.
MODEL_CHECKS = (
    Check("customers", "customer_id", "unique"),
    Check("customers", "customer_id", "not_null"),
    Check("orders", "order_id", "unique"),
    Check("orders", "order_id", "not_null"),
    Check("orders", "customer_id", "not_null"),
    Check("orders", "customer_id", "relationships", to=("customers", "customer_id")),
    Check("orders", "status", "accepted_values", values=ORDER_STATUSES),
    Check("orders", "amount", "not_null"),
    Check("orders", "credit_card_amount", "not_null"),
    Check("orders", "coupon_amount", "not_null"),
    Check("orders", "bank_transfer_amount", "not_null"),
    Check("orders", "gift_card_amount", "not_null"),
    Check("stg_customers", "customer_id", "unique"),
    Check("stg_customers", "customer_id", "not_null"),
    Check("stg_orders", "order_id", "unique"),
    Check("stg_orders", "order_id", "not_null"),
    Check("stg_orders", "status", "accepted_values", values=ORDER_STATUSES),
    Check("stg_payments", "payment_id", "unique"),
    Check("stg_payments", "payment_id", "not_null"),
    Check("stg_payments", "payment_method", "accepted_values", values=PAYMENT_METHODS),
)
