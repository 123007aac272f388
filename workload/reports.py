"""End-to-end reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_keys
from adlake.functions.schema import conform
from adlake.operators.merge import merge
from adlake.plans import bookings, daily_stats as DS, exports, invoices, marts, report, rollups
from adlake.plans.contracts import CONTRACTS
from adlake.sources.writers import stage
from workload.bindings import Tables, with_views
from workload.registry import query

STATS_RUN = dt.date(2024, 1, 30)
FACT_RUN = dt.date(2024, 1, 15)
INVOICE_RUN = dt.date(1998, 7, 15)

CLICK_GROUPS = """
    SELECT CAST(partition_time AS DATE) AS date, offer_id, advertiser_id, affiliate_id, tsp, country_code,
           'DASH' AS tracker, CAST(COUNT(transaction_id) AS BIGINT) AS clicks, CAST(0 AS BIGINT) AS events,
           CAST(0 AS BIGINT) AS approved_events, CAST(0 AS BIGINT) AS rejected_events,
           CAST(0 AS BIGINT) AS pending_events, CAST(0 AS DOUBLE) AS revenue, CAST(0 AS DOUBLE) AS payout,
           CAST(0 AS DOUBLE) AS profit
    FROM clicks_v WHERE CAST(partition_time AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
    GROUP BY ALL"""
EVENT_GROUPS = """
    SELECT CAST(partition_time AS DATE) AS date, network_offer_id AS offer_id,
           network_advertiser_id AS advertiser_id, network_affiliate_id AS affiliate_id, tsp,
           country AS country_code, 'DASH' AS tracker, CAST(0 AS BIGINT) AS clicks,
           CAST(COUNT(conversion_id) AS BIGINT) AS events,
           CAST(COUNT(*) FILTER (conversion_status = 'approved') AS BIGINT) AS approved_events,
           CAST(COUNT(*) FILTER (conversion_status = 'rejected') AS BIGINT) AS rejected_events,
           CAST(COUNT(*) FILTER (conversion_status = 'pending') AS BIGINT) AS pending_events,
           CAST(round(SUM(revenue), 2) AS DOUBLE) AS revenue, CAST(round(SUM(payout), 2) AS DOUBLE) AS payout,
           CAST(round(SUM(revenue) - SUM(payout), 2) AS DOUBLE) AS profit
    FROM conversions_v WHERE CAST(partition_time AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'
    GROUP BY ALL"""
KEYS_SQL = ", ".join(DS.KEYS)
COMBINED = f"""
    SELECT {KEYS_SQL}, 'DASH' AS tracker,
           {', '.join(f'CAST(SUM({c}) AS BIGINT) AS {c}' for c in DS.COUNTS)},
           {', '.join(f'SUM({c}) AS {c}' for c in DS.MONEY)}
    FROM ({CLICK_GROUPS} UNION ALL {EVENT_GROUPS}) GROUP BY {KEYS_SQL}"""


@query("daily_stats", f"{with_views('clicks_v', 'conversions_v')} {CLICK_GROUPS} UNION ALL {EVENT_GROUPS}")
def daily_stats(t: Tables) -> DataFrame:
    return DS.daily_stats(t.clicks_v, t.conversions_v, STATS_RUN)


@query("daily_stats_combined", f"{with_views('clicks_v', 'conversions_v')} {COMBINED}")
def daily_stats_combined(t: Tables) -> DataFrame:
    return DS.daily_stats(t.clicks_v, t.conversions_v, STATS_RUN, combine=True)


@query(
    "daily_stats_merged",
    f"""{with_views('clicks_v', 'conversions_v')},
        fresh AS ({COMBINED}),
        live AS (SELECT CAST(partition_time AS DATE) AS date, offer_id, advertiser_id, affiliate_id, tsp,
                        country_code, 'OLD' AS tracker, CAST(COUNT(*) AS BIGINT) AS clicks
                 FROM clicks_v GROUP BY ALL)
        SELECT l.date, l.offer_id, l.advertiser_id, l.affiliate_id, l.tsp, l.country_code, l.tracker,
               COALESCE(f.clicks, l.clicks) AS clicks, f.events, f.approved_events, f.rejected_events,
               f.pending_events, f.revenue, f.payout, f.profit
        FROM live l LEFT JOIN fresh f USING ({KEYS_SQL})
        UNION ALL
        SELECT {KEYS_SQL}, tracker, clicks, NULL, approved_events, rejected_events, pending_events,
               revenue, payout, profit
        FROM fresh f ANTI JOIN live l USING ({KEYS_SQL})""",
)
def daily_stats_merged(t: Tables) -> DataFrame:
    """The statistics merged into a live table by its contract (no event count on new rows)."""
    contract = CONTRACTS["daily_stats"]
    keys = [F.to_date("partition_time").alias("date"), *DS.KEYS[1:]]
    clicks = t.clicks_v.groupBy(*keys).agg(F.count(F.lit(1)).alias("clicks"))
    live = conform(clicks.withColumn("tracker", F.lit("OLD")), contract.table_schema())
    fresh = DS.daily_stats(t.clicks_v, t.conversions_v, STATS_RUN, combine=True)
    return merge(live, fresh, contract.spec())


REPORT_COLUMNS_SQL = """CAST(strftime({d}, '%Y') AS BIGINT) AS year, CAST(strftime({d}, '%Y%m') AS BIGINT) AS month,
    CAST(strftime({d}, '%Y%m%d') AS BIGINT) AS day, CAST({d} AS DATE) AS value_at"""

OWNER_SHARE = f"""
    SELECT {REPORT_COLUMNS_SQL.format(d='date')}, CONCAT('MK-yt-', content_owner_id) AS product_key,
           round(SUM(CASE WHEN content_owner_id = 'DIYrC9g4HIz_T7EJuEZ7YA' THEN estimated_partner_revenue
                ELSE estimated_youtube_ad_revenue END) * 0.8411490095470413, 2) AS revenues,
           round(SUM(CASE
                WHEN content_owner_id IN ('T6YRWhYberPdRbf3Z5rbQ', 'YO9H9-o4YqlpjXtmY4dUZA', 'FQX78HL5L6oCjJd3ejmFYw')
                    THEN estimated_youtube_ad_revenue - estimated_partner_revenue
                WHEN content_owner_id = 'DIYrC9g4HIz_T7EJuEZ7YA' THEN estimated_partner_revenue * 0.18
                ELSE estimated_youtube_ad_revenue * 0.9 END) * 0.8411490095470413, 2) AS direct_costs
    FROM videos WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-16' GROUP BY content_owner_id, date"""


@query("owner_revenue_share", f"{with_views('videos')} {OWNER_SHARE}")
def owner_revenue_share(t: Tables) -> DataFrame:
    return rollups.owner_revenue_share(t.videos, FACT_RUN)


FX_TOTAL = f"""
    SELECT {REPORT_COLUMNS_SQL.format(d='CAST(date AS DATE)')}, 'AL-total' AS product_key,
           CAST(round(SUM(revenue * 0.85 * 0.92), 2) AS DOUBLE) AS revenues,
           CAST(round(SUM(payout * 0.85 * 0.92), 2) AS DOUBLE) AS direct_costs
    FROM conversions_v WHERE CAST(partition_time AS DATE) = DATE '2024-01-15' GROUP BY CAST(date AS DATE)"""


@query("fx_discount_total", f"{with_views('conversions_v')} {FX_TOTAL}")
def fx_discount_total(t: Tables) -> DataFrame:
    return rollups.fx_discount_total(t.conversions_v, FACT_RUN)


def _local_sql(key: str, revenues: str, costs: str, where: str, day: str = "2024-01-15") -> str:
    """A local-day rollup; the day number takes its month from UTC."""
    return f"""
    SELECT CAST(year(d) AS BIGINT) AS year, CAST(year(d) * 100 + month(d) AS BIGINT) AS month,
           CAST(year(d) * 10000 + month(timestamp) * 100 + day(d) AS BIGINT) AS day, d AS value_at,
           {key} AS product_key, CAST({revenues} AS DOUBLE) AS revenues, CAST({costs} AS DOUBLE) AS direct_costs
    FROM (SELECT *, CAST(timestamp AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin' AS DATE) AS d FROM fact)
    WHERE d = DATE '{day}' AND {where} GROUP BY 1, 2, 3, 4, 5"""


REVSHARE = "(2509, 3052, 2885, 2952, 2825, 3156, 3251, 3312)"
ANY_AMOUNT = """(raw_revenue_amount_eur IS NOT NULL OR gec_eur IS NOT NULL OR net_amount_eur IS NOT NULL
     OR publisher_cost_eur IS NOT NULL)"""
ANY_RAW = "(raw_revenue_amount_eur IS NOT NULL OR publisher_cost_eur IS NOT NULL)"
CORE = _local_sql(
    "CONCAT('MED-core-', replace(country, 'GB', 'UK'))",
    "SUM(COALESCE(net_amount_eur, 0))", "SUM(COALESCE(publisher_cost_eur, 0))",
    f"instance = 'core' AND {ANY_AMOUNT} AND COALESCE(pid, -1) NOT IN {REVSHARE}",
)
SHARED = _local_sql(
    "'MED-revshare'", "SUM(COALESCE(net_amount_eur, 0))",
    """SUM(COALESCE(net_amount_eur, 0) * CASE COALESCE(pid, -1) WHEN 2509 THEN 0.85 WHEN 3052 THEN 0.85
        WHEN 2885 THEN 0.75 WHEN 2952 THEN 0.88 WHEN 2825 THEN 0.85 WHEN 3156 THEN 0.70 WHEN 3251 THEN 0.75
        WHEN 3312 THEN 0.80 ELSE 1 END) + COALESCE(SUM(publisher_cost_eur), 0)""",
    f"instance = 'core' AND {ANY_AMOUNT} AND COALESCE(pid, -1) IN {REVSHARE}",
)
PERFORMANCE = _local_sql(
    "'MED-perfmkt'", "SUM(raw_revenue_amount_eur)", "SUM(publisher_cost_eur)",
    f"instance = 'performance' AND {ANY_RAW}",
)
PORTAL = _local_sql(
    f"""CASE WHEN COALESCE(pid, partner_id) NOT IN {rollups.OWN_SUPPLY_PARTNERS}
        THEN 'SY-as-third-party-supply' ELSE 'AS-others' END""",
    "SUM(COALESCE(raw_revenue_amount_eur, 0))", "SUM(COALESCE(publisher_cost_eur, 0))",
    f"instance = 'portal' AND {ANY_RAW}",
)


@query("local_day_core", f"{with_views('fact')} {CORE}")
def local_day_core(t: Tables) -> DataFrame:
    return rollups.local_day_core(t.fact, FACT_RUN)


@query("revshare_cost", f"{with_views('fact')} {SHARED}")
def revshare_cost(t: Tables) -> DataFrame:
    return rollups.revshare_cost(t.fact, FACT_RUN)


@query("instance_rollup", f"{with_views('fact')} {PERFORMANCE}")
def instance_rollup(t: Tables) -> DataFrame:
    return rollups.instance_rollup(t.fact, FACT_RUN, "performance", "MED-perfmkt")


@query("classify_partner", f"{with_views('fact')} {PORTAL}")
def classify_partner(t: Tables) -> DataFrame:
    return rollups.classify_partner(t.fact, FACT_RUN, "portal")


def _shares_sql(key: str, shares: str, day: str) -> str:
    return f"""
    SELECT {REPORT_COLUMNS_SQL.format(d=f"DATE '{day}'")}, '{key}' AS product_key,
           CAST(round(SUM(CAST(revenue / allocation AS DECIMAL(24,8))), 2) AS DOUBLE) AS revenues,
           CAST(round(SUM(CAST(revenue * 0.7 / allocation AS DECIMAL(24,8))), 2) AS DOUBLE) AS direct_costs
    FROM ({shares}) HAVING COUNT(*) > 0"""


def _months(created: str, start: str, end: str) -> str:
    s = f"greatest(coalesce({start}, {created}), {created})"
    e = f"greatest(coalesce({end}, {created}), {created})"
    return f"(12 * (year({e}) - year({s})) + month({e}) - month({s}) + 1)"


def _marketplace_sql(day: str, first: str, last: str) -> str:
    months = _months("created_at", "period_start", "period_end")
    live = f"fastbill_invoice_url IS NOT NULL AND (canceled_at IS NULL OR canceled_at > DATE '{last}')"
    return _shares_sql("RH-marketplace-total", f"""
        SELECT CAST(total AS DECIMAL(18,2)) / 100 AS revenue,
               CASE WHEN period_end > last_day(created_at) THEN {months} ELSE 1 END AS allocation
        FROM invoices WHERE {live} AND created_at >= DATE '{day}'
          AND created_at < DATE '{day}' + INTERVAL 1 DAY
          AND (period_start < last_day(created_at) OR period_start IS NULL)
        UNION ALL
        SELECT CAST(total AS DECIMAL(18,2)) / 100, {months} * day(DATE '{last}')
        FROM invoices WHERE {live} AND created_at < DATE '{first}' AND period_start <= DATE '{last}'
          AND period_end >= DATE '{first}'""", day)


def _agency_sql(day: str, first: str, last: str) -> str:
    months = f"""CASE WHEN end_at > last_day(created_at)
        THEN {_months('created_at', 'start_at', 'end_at')} ELSE 1 END"""
    kept = f"""fastbill_invoice_number IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM cancellations c WHERE c.individual_campaign_id = i.id
        AND c.cancelled_at BETWEEN DATE '{first}' AND DATE '{last}')"""
    issued = "fastbill_invoice_created_at"
    return _shares_sql("RH-agency-total", f"""
        SELECT CAST(total_cost AS DECIMAL(12,2)) AS revenue, {months} AS allocation
        FROM invoicing i WHERE {kept} AND {issued} >= DATE '{day}' AND {issued} < DATE '{day}' + INTERVAL 1 DAY
          AND (start_at < last_day({issued}) OR start_at IS NULL)
        UNION ALL
        SELECT CAST(total_cost AS DECIMAL(12,2)), {months} * day(DATE '{last}')
        FROM invoicing i WHERE {kept} AND {issued} < DATE '{first}' AND start_at <= DATE '{last}'
          AND end_at >= DATE '{first}'""", day)


MARKETPLACE = _marketplace_sql("1998-07-15", "1998-07-01", "1998-07-31")
AGENCY = _agency_sql("1998-07-15", "1998-07-01", "1998-07-31")


@query("invoice_allocation_marketplace", f"{with_views('invoices')} {MARKETPLACE}")
def invoice_allocation_marketplace(t: Tables) -> DataFrame:
    return invoices.allocate_marketplace(t.invoices, INVOICE_RUN)


@query("invoice_allocation_agency", f"{with_views('invoicing', 'cancellations')} {AGENCY}")
def invoice_allocation_agency(t: Tables) -> DataFrame:
    return invoices.allocate_agency(t.invoicing, t.cancellations, INVOICE_RUN)


@query(
    "influencer_payout",
    with_views("invoices", "invoice_items", "campaign_features", "campaign_recipe", "campaign_provision")
    + """SELECT id, CAST(CASE WHEN campaign IS NOT NULL AND recipe <> 'giveaway'
                THEN CAST(items / 100 AS DECIMAL(12,2))
                     - CAST(round(CAST(items * provision AS DECIMAL(18,0)) * 0.0001, 2) AS DECIMAL(12,2))
                ELSE 0 END AS DOUBLE) AS payout
         FROM (SELECT i.id, x.items, x.campaign, r.name AS recipe, p.influencer_provision AS provision
               FROM invoices i
               LEFT JOIN (SELECT invoice_id, SUM(price) AS items, MAX(campaign_id) AS campaign
                          FROM invoice_items GROUP BY 1) x ON x.invoice_id = i.id
               LEFT JOIN campaign_features f ON f.campaign_id = x.campaign
               LEFT JOIN campaign_recipe r ON r.id = f.recipe_id
               LEFT JOIN campaign_provision p ON p.campaign_id = x.campaign)""",
)
def influencer_payout(t: Tables) -> DataFrame:
    return invoices.marketplace_payout(
        t.invoices, t.invoice_items, t.campaign_features, t.campaign_recipe, t.campaign_provision
    )


@query(
    "agency_payout",
    with_views("invoicing", "invoicing_influencer")
    + """SELECT id, CAST(influencer AS DOUBLE) AS influencer_payout, CAST(talent AS DOUBLE) AS talent_payout,
                CAST(influencer + talent AS DOUBLE) AS payout
         FROM (SELECT id, CAST(COALESCE(fee, 0) - COALESCE(fee15, 0) AS DECIMAL(12,2)) AS influencer,
                      CAST(COALESCE(price, 0) - COALESCE(fee, 0) - COALESCE(mgmt, 0) AS DECIMAL(12,2)) AS talent
               FROM invoicing LEFT JOIN (
                 SELECT item_id, SUM(price) AS price, SUM(price * service_fee_enabled) AS fee,
                        SUM(price * service_fee_enabled * 0.15) AS fee15, SUM(price * management_fee * 0.01) AS mgmt
                 FROM invoicing_influencer GROUP BY 1) ON item_id = id)""",
)
def agency_payout(t: Tables) -> DataFrame:
    return invoices.agency_payout(t.invoicing, t.invoicing_influencer)


SLUG_SQL = r"regexp_replace(concat('AS', replace(substr(lower(product_name), 5), '-', ' ')), '\s+', '-', 'g')"
EXCLUDED = "product_name NOT IN ('0406 - Third Party Supply', '0407 - Portal - Performance')"


def _spread_part(amount: str, alias: str) -> str:
    """One measure of a calendar row, from its monthly total."""
    return f"""CASE WHEN d >= DATE '1998-07-01' THEN
            CASE WHEN COALESCE({amount}, 0) = 0
                 THEN CAST((SELECT SUM({amount}) FROM monthly WHERE month = 199806) AS DOUBLE) / 30
                      / (SELECT COUNT(*) FROM products)
                 ELSE CAST(round(CAST({amount} / 15 AS DECIMAL(24,8)), 2) AS DOUBLE) END
        ELSE CAST(round(CAST({amount} / day(last_day(d)) AS DECIMAL(24,8)), 2) AS DOUBLE) END AS {alias}"""


SPREAD_CTES = f""",
    products AS (SELECT DISTINCT {SLUG_SQL} AS product_key FROM bookings_revenue WHERE {EXCLUDED}),
    data AS (SELECT CAST(strftime(booking_period_date, '%Y%m') AS BIGINT) AS month, {SLUG_SQL} AS product_key,
                    SUM(revenue) AS revenues, 0 AS costs FROM bookings_revenue WHERE {EXCLUDED} GROUP BY 1, 2
             UNION ALL
             SELECT CAST(strftime(booking_period_date, '%Y%m') AS BIGINT), {SLUG_SQL}, 0, SUM(cost)
             FROM bookings_cost WHERE {EXCLUDED} GROUP BY 1, 2),
    monthly AS (SELECT month, product_key, SUM(revenues) AS revenues, SUM(costs) AS costs FROM data GROUP BY 1, 2),
    calendar AS (SELECT CAST(x AS DATE) AS d
                 FROM generate_series(DATE '1998-01-01', DATE '1998-07-15', INTERVAL 1 DAY) AS s(x))"""
SPREAD = f"""
    SELECT {REPORT_COLUMNS_SQL.format(d='d')}, p.product_key, {_spread_part('revenues', 'revenues')},
           {_spread_part('costs', 'direct_costs')}
    FROM calendar CROSS JOIN products p
    LEFT JOIN monthly m ON m.month = CAST(strftime(d, '%Y%m') AS BIGINT) AND m.product_key = p.product_key"""
SPREAD_VIEWS = with_views("bookings_revenue", "bookings_cost")


@query("calendar_allocation", f"{SPREAD_VIEWS} {SPREAD_CTES} {SPREAD}")
def calendar_allocation(t: Tables) -> DataFrame:
    return bookings.spread_monthly(t.bookings_revenue, t.bookings_cost, INVOICE_RUN)


@query(
    "calendar_allocation_per_product",
    f"{SPREAD_VIEWS} {SPREAD_CTES} "
    + SPREAD.replace("FROM monthly WHERE month = 199806",
                     "FROM monthly b WHERE month = 199806 AND b.product_key = p.product_key")
    .replace("/ (SELECT COUNT(*) FROM products)", "/ 1"),
)
def calendar_allocation_per_product(t: Tables) -> DataFrame:
    return bookings.spread_monthly(t.bookings_revenue, t.bookings_cost, INVOICE_RUN, per_product=True)


_REPORT_ROLLUPS = " UNION ALL ".join(
    [OWNER_SHARE, FX_TOTAL, CORE, SHARED, PERFORMANCE, PORTAL,
     _marketplace_sql("2024-01-15", "2024-01-01", "2024-01-31"),
     _agency_sql("2024-01-15", "2024-01-01", "2024-01-31"), SPREAD]
)
_REPORT_KEYS_SQL = "year, month, day, value_at, product_key"


@query(
    "daily_report",
    with_views("videos", "conversions_v", "fact", "invoices", "invoicing", "cancellations",
               "bookings_revenue", "bookings_cost", "report_products")
    + SPREAD_CTES
    + f""",
    rolled AS (SELECT {_REPORT_KEYS_SQL}, revenues, direct_costs FROM ({_REPORT_ROLLUPS})),
    estimated AS (SELECT CAST(2024 AS BIGINT) AS year, CAST(202401 AS BIGINT) AS month,
                         CAST(20240115 AS BIGINT) AS day, DATE '2024-01-15' AS value_at, id AS product_key,
                         avg_estimated_daily_revenues AS revenues, avg_estimated_daily_direct_costs AS direct_costs
                  FROM report_products WHERE avg_estimated_daily_revenues IS NOT NULL),
    staged AS (SELECT * FROM rolled UNION ALL
               SELECT * FROM estimated e ANTI JOIN rolled r USING ({_REPORT_KEYS_SQL})),
    existing AS (SELECT DISTINCT {REPORT_COLUMNS_SQL.format(d='date')},
                        CONCAT('MK-yt-', content_owner_id) AS product_key, CAST(-1 AS DOUBLE) AS revenues,
                        CAST(NULL AS DOUBLE) AS direct_costs FROM videos)
    SELECT e.year, e.month, e.day, e.value_at, e.product_key,
           CASE WHEN s.year IS NOT NULL THEN s.revenues ELSE e.revenues END AS revenues,
           CASE WHEN s.year IS NOT NULL THEN s.direct_costs ELSE e.direct_costs END AS direct_costs
    FROM existing e LEFT JOIN staged s ON e.year = s.year AND e.month = s.month AND e.day = s.day
         AND e.value_at = s.value_at AND e.product_key = s.product_key
    UNION ALL
    SELECT {_REPORT_KEYS_SQL}, revenues, direct_costs FROM staged s ANTI JOIN existing e USING ({_REPORT_KEYS_SQL})""",
)
def daily_report(t: Tables) -> DataFrame:
    """All rollups of one run date, estimates for missing products, merged into the report."""
    parts = [
        rollups.owner_revenue_share(t.videos, FACT_RUN),
        rollups.fx_discount_total(t.conversions_v, FACT_RUN),
        rollups.local_day_rollup(t.fact, FACT_RUN, [
            rollups.core_rule(), rollups.revshare_rule(),
            rollups.instance_rule("performance", "MED-perfmkt"), rollups.partner_rule("portal"),
        ]),
        invoices.allocate_marketplace(t.invoices, FACT_RUN),
        invoices.allocate_agency(t.invoicing, t.cancellations, FACT_RUN),
        bookings.spread_monthly(t.bookings_revenue, t.bookings_cost, INVOICE_RUN),
    ]
    existing = t.videos.select(
        *date_keys(F.col("date")),
        F.concat(F.lit(rollups.VIDEO_KEY_PREFIX), "content_owner_id").alias("product_key"),
    ).distinct()
    existing = existing.withColumns({"revenues": F.lit(-1.0), "direct_costs": F.lit(None).cast("double")})
    return report.daily_report(parts, t.report_products, stage(existing, "report"), FACT_RUN)


@query(
    "conversion_export",
    with_views("export_v", "event_types_v", "offers_v")
    + """SELECT date AS time, network_affiliate_id AS external_publisher_id, source_id AS external_media_id,
                app_id AS external_site_id, network_offer_id AS external_sub_site_id, network_offer_id AS campaign_id,
                CASE WHEN cpa_enabled = 1 THEN 'cpa' ELSE 'cpi' END AS campaign_type, e.event_name AS conversion_type,
                'clicks' AS attribution_type, click_date AS attribution_time, session_user_ip AS ip,
                CASE WHEN platform = 'iOS' THEN idfa ELSE google_ad_id END AS device_id, click_ua AS user_agent,
                isp AS carrier, referer, platform, handset AS device_type, os_version, language,
                is_wireless_device AS wifi, transaction_id AS session_id
         FROM export_v c LEFT JOIN event_types_v e USING (event_type)
         LEFT JOIN offers_v o ON c.network_offer_id = o.offer_id
         WHERE CAST(partition_time AS DATE) = DATE '2024-01-15' AND country = 'JP'
           AND c.event_type NOT IN ('error')""",
)
def conversion_export(t: Tables) -> DataFrame:
    return exports.conversion_export(
        t.export_v, t.event_types_v, t.offers_v, FACT_RUN, exclude=("error",)
    )


MART_VIEWS = with_views("raw_customers", "raw_orders", "raw_payments")
MART_CTES = MART_VIEWS + """,
    stg_orders AS (SELECT id AS order_id, user_id AS customer_id, order_date, status FROM raw_orders),
    stg_payments AS (SELECT id AS payment_id, order_id, payment_method, amount // 100 AS amount FROM raw_payments),
    stg_customers AS (SELECT id AS customer_id, first_name, last_name FROM raw_customers),
    order_payments AS (SELECT order_id,
        CAST(SUM(CASE WHEN payment_method = 'credit_card' THEN amount ELSE 0 END) AS BIGINT) AS credit_card_amount,
        CAST(SUM(CASE WHEN payment_method = 'coupon' THEN amount ELSE 0 END) AS BIGINT) AS coupon_amount,
        CAST(SUM(CASE WHEN payment_method = 'bank_transfer' THEN amount ELSE 0 END) AS BIGINT) AS bank_transfer_amount,
        CAST(SUM(CASE WHEN payment_method = 'gift_card' THEN amount ELSE 0 END) AS BIGINT) AS gift_card_amount,
        CAST(SUM(amount) AS BIGINT) AS amount FROM stg_payments GROUP BY 1),
    orders_m AS (SELECT * FROM stg_orders LEFT JOIN order_payments USING (order_id)),
    customers_m AS (SELECT customer_id, first_name, last_name, first_order, most_recent_order, number_of_orders,
                           customer_lifetime_value
        FROM stg_customers
        LEFT JOIN (SELECT customer_id, MIN(order_date) AS first_order, MAX(order_date) AS most_recent_order,
                          CAST(COUNT(order_id) AS BIGINT) AS number_of_orders FROM stg_orders GROUP BY 1) USING (customer_id)
        LEFT JOIN (SELECT customer_id, CAST(SUM(amount) AS BIGINT) AS customer_lifetime_value
                   FROM stg_payments LEFT JOIN stg_orders USING (order_id) GROUP BY 1) USING (customer_id))
"""


def _staged(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        marts.stage_customers(t.raw_customers), marts.stage_orders(t.raw_orders),
        marts.stage_payments(t.raw_payments),
    )


@query("orders_mart", MART_CTES + "SELECT * FROM orders_m")
def orders_mart(t: Tables) -> DataFrame:
    _, orders, payments = _staged(t)
    return marts.orders_mart(orders, payments)


@query("customers_mart", MART_CTES + "SELECT * FROM customers_m")
def customers_mart(t: Tables) -> DataFrame:
    return marts.customers_mart(*_staged(t))
