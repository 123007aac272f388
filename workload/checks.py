"""Declarative data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators import quality as Q
from adlake.plans import marts
from adlake.sources.writers import stage
from workload.bindings import Tables
from workload.registry import query
from workload.reports import MART_CTES, _staged


@query(
    "check_unique",
    """SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS occurrences FROM lineitem
       WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""",
)
def check_unique(t: Tables) -> DataFrame:
    return Q.unique(t.lineitem, "l_orderkey")


@query(
    "check_not_null",
    """SELECT o_orderkey, lines FROM orders LEFT JOIN
         (SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
       WHERE lines IS NULL""",
)
def check_not_null(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"))
    return Q.not_null(t.orders.select("o_orderkey").join(lines, "o_orderkey", "left"), "lines")


@query(
    "check_accepted_values",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')",
)
def check_accepted_values(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return Q.accepted_values(rows, "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query(
    "check_relationships",
    """SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS occurrences FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1""",
)
def check_relationships(t: Tables) -> DataFrame:
    return Q.relationships(t.orders, "o_custkey", t.customer.filter("c_acctbal > 0"), "c_custkey")


def _count_sql(check: Q.Check) -> str:
    tables = {"customers": "customers_m", "orders": "orders_m"}
    table, column = tables.get(check.model, check.model), check.column
    count = {
        "unique": f"""SELECT COUNT(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
                      GROUP BY 1 HAVING COUNT(*) > 1)""",
        "not_null": f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL",
        "accepted_values": f"SELECT COUNT(*) FROM {table} WHERE {column} NOT IN {tuple(check.values)}",
        "relationships": f"""SELECT COUNT(*) FROM {table} WHERE {column} IS NOT NULL
                             AND {column} NOT IN (SELECT customer_id FROM customers_m)""",
    }[check.kind]
    return (
        f"SELECT '{check.model}' AS model, '{column}' AS column_name, '{check.kind}' AS test, "
        f"CAST(({count}) AS BIGINT) AS failures"
    )


@query("quality_report", MART_CTES + " UNION ALL ".join(_count_sql(c) for c in marts.MODEL_CHECKS))
def quality_report(t: Tables) -> DataFrame:
    customers, orders, payments = _staged(t)
    # The marts are tables, computed once and then checked column by column.
    models = {
        "stg_customers": customers,
        "stg_orders": orders,
        "stg_payments": payments,
        "orders": stage(marts.orders_mart(orders, payments), "orders-mart"),
        "customers": stage(marts.customers_mart(customers, orders, payments), "customers-mart"),
    }
    return Q.quality_report(models, marts.MODEL_CHECKS)
