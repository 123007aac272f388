"""Advertising tables derived from the given star-schema and event tables.

Each definition is SQL that Spark and the SQL oracle both read, so the two sides
start from the same rows. ``{name}`` stands for another table or definition.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The given tables. Stating their columns spares a footer-reading job per table.
BASE = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING""",
}

VIEWS = {
    # Facts of the daily statistics and the conversion rollups.
    "clicks_v": """
        SELECT ts AS partition_time, event_id AS transaction_id, user_id % 20 AS offer_id,
               user_id % 5 AS advertiser_id, user_id % 7 AS affiliate_id, user_id % 3 AS tsp,
               CONCAT('C', user_id % 4) AS country_code
        FROM {events} WHERE event_type IN ('click', 'view')""",
    "conversions_v": """
        SELECT ts AS partition_time, ts AS date, event_id AS conversion_id,
               CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'signup' THEN 'pending'
                    ELSE 'rejected' END AS conversion_status,
               user_id % 20 AS network_offer_id, user_id % 5 AS network_advertiser_id,
               user_id % 7 AS network_affiliate_id, user_id % 3 AS tsp,
               CONCAT('C', user_id % 4) AS country,
               value * 3 AS revenue, CASE WHEN event_type <> 'error' THEN value * 2 ELSE 0 END AS payout
        FROM {events} WHERE event_type IN ('purchase', 'signup', 'error')""",
    # Conversions with the columns of the export.
    "export_v": """
        SELECT CAST(ts AS DATE) AS date, ts AS partition_time, user_id % 7 AS network_affiliate_id,
               user_id % 11 AS source_id, CONCAT('app', user_id % 6) AS app_id,
               user_id % 25 AS network_offer_id, event_id % 2 AS cpa_enabled, event_type,
               CASE user_id % 2 WHEN 0 THEN 'JP' ELSE 'DE' END AS country,
               ts - INTERVAL '1' HOUR AS click_date, CONCAT('10.0.0.', user_id) AS session_user_ip,
               CASE user_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' END AS platform,
               CONCAT('idfa', user_id) AS idfa, CONCAT('gaid', user_id) AS google_ad_id,
               props AS click_ua, 'isp' AS isp, CAST(NULL AS VARCHAR(10)) AS referer,
               CONCAT('h', user_id % 8) AS handset, CONCAT('v', user_id % 9) AS os_version,
               'ja' AS language, event_id % 3 AS is_wireless_device, event_id AS transaction_id
        FROM {events}""",
    "event_types_v": """
        SELECT DISTINCT event_type, CONCAT('name of ', event_type) AS event_name
        FROM {events} WHERE event_type <> 'view'""",
    "offers_v": "SELECT n_nationkey AS offer_id, n_name AS offer_name FROM {nation}",
    # Partner revenue facts of three instances.
    "fact": """
        SELECT ts AS timestamp,
               CASE event_type WHEN 'purchase' THEN 'performance' WHEN 'signup' THEN 'portal'
                    ELSE 'core' END AS instance,
               CASE user_id % 3 WHEN 0 THEN 'GB' WHEN 1 THEN 'DE' ELSE 'JP' END AS country,
               CASE user_id % 14 WHEN 0 THEN NULL WHEN 1 THEN 2509 WHEN 2 THEN 3052
                    WHEN 3 THEN 2885 WHEN 4 THEN 2952 WHEN 5 THEN 2825 WHEN 6 THEN 3156
                    WHEN 7 THEN 3251 WHEN 8 THEN 3312 ELSE user_id + 100 END AS pid,
               user_id + 100 AS partner_id,
               CASE WHEN event_id % 10 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS net_amount_eur,
               CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(18,2)) * 2 END
                   AS raw_revenue_amount_eur,
               CASE WHEN event_id % 11 = 0 THEN CAST(value AS DECIMAL(18,2)) END AS gec_eur,
               CASE WHEN event_id % 3 <> 0
                    THEN CAST(CAST(value AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,3))
                    END AS publisher_cost_eur
        FROM {events}""",
    "videos": """
        SELECT CAST(ts AS DATE) AS date,
               CASE user_id % 5 WHEN 0 THEN 'DIYrC9g4HIz_T7EJuEZ7YA' WHEN 1 THEN 'T6YRWhYberPdRbf3Z5rbQ'
                    WHEN 2 THEN 'YO9H9-o4YqlpjXtmY4dUZA' WHEN 3 THEN 'FQX78HL5L6oCjJd3ejmFYw'
                    ELSE 'another-owner' END AS content_owner_id,
               value AS estimated_youtube_ad_revenue, value * 0.6E0 AS estimated_partner_revenue
        FROM {events}""",
    # Marts.
    "raw_customers": "SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name FROM {customer}",
    "raw_orders": """
        SELECT o_orderkey AS id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'O' THEN 'placed' WHEN 'F' THEN 'completed' ELSE 'shipped' END AS status
        FROM {orders}""",
    "raw_payments": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
               CASE l_linenumber % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'coupon'
                    WHEN 2 THEN 'bank_transfer' ELSE 'gift_card' END AS payment_method,
               CAST(floor(l_extendedprice * 100 + 0.5E0) AS BIGINT) AS amount
        FROM {lineitem}""",
    # Invoices.
    "invoices": """
        SELECT o_orderkey AS id, CAST(floor(o_totalprice * 100 + 0.5E0) AS BIGINT) AS total,
               o_orderdate AS created_at,
               CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate
                    WHEN 2 THEN o_orderdate + INTERVAL '1' MONTH
                    ELSE o_orderdate - INTERVAL '1' MONTH END AS period_start,
               CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate
                    WHEN 2 THEN o_orderdate + INTERVAL '1' MONTH
                    WHEN 3 THEN o_orderdate + INTERVAL '3' MONTH
                    WHEN 4 THEN o_orderdate + INTERVAL '11' MONTH
                    ELSE o_orderdate - INTERVAL '10' DAY END AS period_end,
               CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate + INTERVAL '40' DAY END AS canceled_at,
               CASE WHEN o_orderkey % 13 <> 0 THEN CONCAT('invoice-', o_orderkey) END AS fastbill_invoice_url
        FROM {orders}""",
    "invoice_items": """
        SELECT l_orderkey AS invoice_id,
               CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey % 500 END AS campaign_id,
               CAST(floor(l_extendedprice * 100 + 0.5E0) AS BIGINT) AS price
        FROM {lineitem}""",
    "campaign_features": "SELECT p_partkey AS campaign_id, p_partkey + 7 AS recipe_id FROM {part}",
    "campaign_recipe": """
        SELECT p_partkey + 7 AS id, CASE WHEN p_type = 'ECONOMY' THEN 'giveaway' ELSE p_type END AS name
        FROM {part}""",
    "campaign_provision": "SELECT p_partkey AS campaign_id, p_size AS influencer_provision FROM {part}",
    "invoicing": """
        SELECT o_orderkey AS id, o_totalprice AS total_cost, o_orderdate AS created_at,
               o_orderdate + INTERVAL '3' DAY AS fastbill_invoice_created_at,
               CASE WHEN o_orderkey % 13 <> 0 THEN CONCAT('no-', o_orderkey) END AS fastbill_invoice_number,
               CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate
                    WHEN 2 THEN o_orderdate + INTERVAL '1' MONTH
                    ELSE o_orderdate - INTERVAL '1' MONTH END AS start_at,
               CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN o_orderdate
                    WHEN 2 THEN o_orderdate + INTERVAL '1' MONTH
                    WHEN 3 THEN o_orderdate + INTERVAL '3' MONTH
                    WHEN 4 THEN o_orderdate + INTERVAL '11' MONTH
                    ELSE o_orderdate + INTERVAL '25' DAY END AS end_at
        FROM {orders}""",
    "cancellations": """
        SELECT o_orderkey AS individual_campaign_id, o_orderdate + INTERVAL '20' DAY AS cancelled_at
        FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "invoicing_influencer": """
        SELECT l_orderkey AS item_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS service_fee_enabled,
               l_linenumber * 5 AS management_fee
        FROM {lineitem}""",
    # Monthly bookings.
    "booking_rows": """
        SELECT CASE c_custkey % 100 WHEN 6 THEN '0406 - Third Party Supply'
                    WHEN 7 THEN '0407 - Portal - Performance'
                    ELSE CONCAT('04', LPAD(CAST(c_custkey % 100 AS VARCHAR(4)), 2, '0'), ' - ',
                                c_mktsegment, '  Sales - Unit') END AS product_name,
               o_orderdate AS booking_period_date, o_orderstatus AS state,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "bookings_revenue": """
        SELECT product_name, booking_period_date, amount AS revenue
        FROM {booking_rows} WHERE state <> 'P'""",
    "bookings_cost": """
        SELECT product_name, booking_period_date, amount AS cost
        FROM {booking_rows} WHERE state <> 'O'""",
    # Company report.
    "report_products": """
        SELECT CASE p_partkey WHEN 1 THEN 'MED-revshare' WHEN 2 THEN 'MED-core-DE'
                    ELSE CONCAT('EST-', p_partkey) END AS id,
               CASE WHEN p_size > 25 OR p_partkey < 3 THEN p_retailprice END
                   AS avg_estimated_daily_revenues,
               CASE WHEN p_size > 40 THEN 1.5E0 END AS avg_estimated_daily_direct_costs
        FROM {part}""",
    # Approved actions: source rows and tasks known from earlier runs.
    "actions": """
        SELECT o_orderkey AS id, o_custkey % 5 AS advertiser_id, o_custkey AS publisher_id,
               o_orderkey % 20 AS offer_id, o_orderkey % 3 AS tsp,
               CONCAT('offer ', o_orderkey % 20) AS offer_name,
               CONCAT('publisher ', o_custkey) AS publisher_name,
               CONCAT('src', o_orderkey % 17) AS source,
               'manager' AS publisher_account_manager_name, o_orderpriority AS reasons,
               CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 6 ELSE 9 END AS change_type,
               o_orderkey % 4 * 6 AS delay_hours,
               CASE o_orderkey % 8 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN NULL WHEN 3 THEN 3
                    WHEN 4 THEN 12 ELSE 0 END AS process_status,
               CASE WHEN o_custkey % 9 = 0 THEN '' ELSE CONCAT('a', o_custkey, '@x.org,b@x.org') END AS email_to,
               CONCAT('c', o_custkey % 3, '@x.org') AS email_cc,
               CASE WHEN o_custkey % 2 = 0 THEN 'd@x.org' END AS email_bcc,
               'user' AS updated_by, o_orderdate AS created_on, o_orderdate AS updated_on
        FROM {orders}""",
    "tasks": """
        SELECT o_orderkey AS id, o_custkey AS publisher_id, o_orderkey % 20 AS offer_id,
               CONCAT('offer ', o_orderkey % 20) AS offer_name,
               CONCAT('src', o_orderkey % 17) AS affpubid, o_orderpriority AS reason,
               CASE o_orderkey % 3 WHEN 0 THEN 'block_tsp' WHEN 1 THEN 'block_affpubid' END AS change_type,
               o_orderkey % 4 * 6 AS delay_hours,
               CASE o_orderstatus WHEN 'F' THEN 'success' ELSE 'registered' END AS status,
               CONCAT('a', o_orderkey, '@x.org') AS email_to,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS email_sent_on,
               o_orderdate AS updated_on
        FROM {orders}""",
    # The two sides of the merges: clicks per user and day, and later figures.
    "live_v": """
        SELECT CAST(ts AS DATE) AS date, CASE WHEN user_id = 0 THEN NULL ELSE user_id END AS account_id,
               COUNT(*) AS clicks, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS cost, 'live' AS origin
        FROM {events} WHERE event_type IN ('click', 'view') GROUP BY 1, 2""",
    "staged_v": """
        SELECT CAST(ts AS DATE) AS date, CASE WHEN user_id = 0 THEN NULL ELSE user_id END AS account_id,
               COUNT(*) AS click, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_cost
        FROM {events} WHERE event_type IN ('purchase', 'signup') GROUP BY 1, 2""",
}

_REFERENCE = re.compile(r"\{(\w+)\}")


class Tables:
    """Base tables and derived views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEWS:
            text = VIEWS[name]
            inputs = {ref: getattr(self, ref) for ref in set(_REFERENCE.findall(text))}
            frame = self.spark.sql(text, **inputs)
        elif name in BASE:
            frame = self.spark.read.schema(BASE[name]).parquet(f"{self.folder}/{name}.parquet")
        else:
            raise AttributeError(name)
        self.__dict__[name] = frame
        return frame


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH`` clause defining the named views and those they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for ref in _REFERENCE.findall(VIEWS[name]):
            if ref in VIEWS:
                add(ref)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({_REFERENCE.sub(lambda m: m.group(1), VIEWS[n]).strip()})" for n in ordered]
    return "WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(parts)
