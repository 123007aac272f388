"""Projections, predicates and scalar functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions import dates as D
from adlake.functions import scalars as S
from adlake.operators import relational as R
from adlake.plans import actions, bookings, marts
from adlake.plans.invoices import service_months
from adlake.plans.rollups import REVSHARE_RATES
from workload.bindings import Tables, with_views
from workload.registry import query

RUN = dt.date(1998, 7, 15)


@query(
    "stg_rename",
    with_views("raw_orders")
    + "SELECT id AS order_id, user_id AS customer_id, order_date, status FROM raw_orders",
)
def stg_rename(t: Tables) -> DataFrame:
    return marts.stage_orders(t.raw_orders)


@query(
    "stg_cents",
    with_views("raw_payments")
    + """SELECT id AS payment_id, order_id, payment_method, CAST(amount // 100 AS BIGINT) AS amount,
                CAST(amount / 100.0 AS DOUBLE) AS exact_amount FROM raw_payments""",
)
def stg_cents(t: Tables) -> DataFrame:
    # Both readings of the division by 100, computed over the same rows.
    raw = t.raw_payments.withColumn("id", F.struct("id", "amount"))
    exact = marts.stage_payments(raw, exact=True).select(
        F.struct("payment_id.id", "amount").alias("id"), "order_id", "payment_method", F.col("payment_id.amount").alias("amount")
    )
    whole = marts.stage_payments(exact)
    return whole.select(
        F.col("payment_id.id").alias("payment_id"), "order_id", "payment_method", "amount",
        F.col("payment_id.amount").cast("double").alias("exact_amount"),
    )


@query(
    "date_window_filter",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
              CAST(o_orderdate AS DATE) >= DATE '1998-07-15' AND CAST(o_orderdate AS DATE) < DATE '1998-07-16'
                  AS issued_today
       FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-07-08' AND DATE '1998-07-16'""",
)
def date_window_filter(t: Tables) -> DataFrame:
    week, day = dt.timedelta(days=7), dt.timedelta(days=1)
    ordered = F.col("o_orderdate")
    return t.orders.filter(D.date_range(ordered, RUN - week, RUN + day)).select(
        "o_orderkey", F.to_date(ordered).alias("o_orderdate"),
        D.date_range(ordered, RUN, RUN + day, inclusive=False).alias("issued_today"),
    )


@query(
    "in_not_in_filter",
    with_views("fact")
    + """SELECT instance, pid, CAST(COUNT(*) AS BIGINT) AS n,
                CAST(SUM(CASE WHEN country NOT IN ('GB', 'FR') THEN 1 ELSE 0 END) AS BIGINT) AS abroad
         FROM fact WHERE instance IN ('core', 'portal') AND pid NOT IN (2509, 3052) GROUP BY 1, 2""",
)
def in_not_in_filter(t: Tables) -> DataFrame:
    rows = t.fact.filter(F.col("instance").isin("core", "portal") & ~F.col("pid").isin(2509, 3052))
    return rows.groupBy("instance", "pid").agg(
        F.count(F.lit(1)).alias("n"), S.count_if(~F.col("country").isin("GB", "FR")).alias("abroad")
    )


@query(
    "null_default_membership",
    with_views("fact")
    + """SELECT timestamp, instance, pid, partner_id, COALESCE(pid, partner_id) AS partner FROM fact
         WHERE COALESCE(pid, -1) NOT IN (2509, 3052, 2885) AND COALESCE(pid, partner_id) NOT IN (121, 193)""",
)
def null_default_membership(t: Tables) -> DataFrame:
    partner = F.coalesce("pid", "partner_id")
    rows = t.fact.filter(~F.coalesce(F.col("pid"), F.lit(-1)).isin(2509, 3052, 2885))
    return rows.filter(~partner.isin(121, 193)).select(
        "timestamp", "instance", "pid", "partner_id", partner.alias("partner")
    )


@query(
    "any_not_null_filter",
    with_views("fact")
    + """SELECT instance, country, CAST(COUNT(*) AS BIGINT) AS n FROM fact
         WHERE gec_eur IS NOT NULL OR publisher_cost_eur IS NOT NULL GROUP BY 1, 2""",
)
def any_not_null_filter(t: Tables) -> DataFrame:
    rows = t.fact.filter(F.coalesce("gec_eur", "publisher_cost_eur").isNotNull())
    return rows.groupBy("instance", "country").agg(F.count(F.lit(1)).alias("n"))


@query(
    "period_overlap_filter",
    with_views("invoices")
    + """SELECT id, CAST(period_start AS DATE) AS period_start, CAST(period_end AS DATE) AS period_end,
                CAST(LAST_DAY(created_at) AS DATE) AS month_end,
                COALESCE(period_end > LAST_DAY(created_at), FALSE) AS runs_on
         FROM invoices WHERE period_start <= DATE '1998-07-31' AND period_end >= DATE '1998-07-01'""",
)
def period_overlap_filter(t: Tables) -> DataFrame:
    start, end = F.col("period_start"), F.col("period_end")
    overlap = (start <= F.lit(D.month_end(RUN))) & (end >= F.lit(D.month_start(RUN)))
    last = F.last_day("created_at")
    return t.invoices.filter(overlap).select(
        "id", start.cast("date").alias("period_start"), end.cast("date").alias("period_end"),
        last.alias("month_end"), F.coalesce(end > last, F.lit(False)).alias("runs_on"),
    )


@query(
    "date_keys",
    """SELECT event_id, CAST(strftime(ts, '%Y') AS BIGINT) AS year, CAST(strftime(ts, '%Y%m') AS BIGINT) AS month,
              CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day, CAST(ts AS DATE) AS value_at FROM events""",
)
def date_keys(t: Tables) -> DataFrame:
    return t.events.select("event_id", *D.date_keys(F.col("ts")))


@query(
    "local_date",
    """SELECT event_id, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin' AS DATE) AS local_day,
              CAST(ts AS DATE) AS utc_day FROM events""",
)
def local_date(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", D.local_date(F.col("ts"), "Europe/Berlin").alias("local_day"),
        F.to_date("ts").alias("utc_day"),
    )


@query(
    "parse_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_number,
              o_orderdate - INTERVAL '1' HOUR AS from_offset, o_orderdate AS from_plain_offset FROM orders""",
)
def parse_dates(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    text = F.date_format(day, "yyyy-MM-dd HH:mm:ss")
    return t.orders.select(
        "o_orderkey",
        D.compact_date(D.day_key(day)).alias("from_number"),
        D.offset_timestamp(F.concat(text, F.lit(" +01:00"))).cast("timestamp_ntz").alias("from_offset"),
        D.offset_timestamp(F.concat(text, F.lit(" +0000")), colon=False)
        .cast("timestamp_ntz").alias("from_plain_offset"),
    )


@query(
    "month_arith",
    with_views("invoices")
    + """SELECT id, CAST(12 * (year(e) - year(s)) + month(e) - month(s) + 1 AS BIGINT) AS months,
                CAST(last_day(created_at) AS DATE) AS month_end, CAST(day(last_day(created_at)) AS BIGINT) AS days,
                CAST(date_trunc('month', created_at) AS DATE) AS month_start,
                CAST(date_trunc('year', created_at) AS DATE) AS year_start,
                CAST(created_at - INTERVAL '1' MONTH AS DATE) AS month_before,
                CAST(created_at + INTERVAL '1' DAY AS DATE) AS day_after
         FROM (SELECT id, created_at, greatest(coalesce(period_start, created_at), created_at) AS s,
                      greatest(coalesce(period_end, created_at), created_at) AS e FROM invoices)""",
)
def month_arith(t: Tables) -> DataFrame:
    created = F.col("created_at")
    return t.invoices.select(
        "id",
        service_months(created, F.col("period_start"), F.col("period_end")).cast("long").alias("months"),
        F.last_day(created).alias("month_end"),
        F.dayofmonth(F.last_day(created)).cast("long").alias("days"),
        F.trunc(created, "month").alias("month_start"),
        F.trunc(created, "year").alias("year_start"),
        F.add_months(created, -1).alias("month_before"),
        F.date_add(created, 1).alias("day_after"),
    )


@query(
    "calendar_spine",
    """SELECT CAST(d AS DATE) AS value_date, CAST(COUNT(o_orderkey) AS BIGINT) AS n_orders
       FROM generate_series(DATE '1998-01-01', DATE '1998-07-15', INTERVAL 1 DAY) AS s(d)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1""",
)
def calendar_spine(t: Tables) -> DataFrame:
    days = D.with_days(t.spark.range(1), dt.date(1998, 1, 1), RUN).drop("id")
    window = D.date_range(F.col("o_orderdate"), dt.date(1998, 1, 1), RUN)
    counts = (
        t.orders.filter(window).groupBy(F.to_date("o_orderdate").alias("value_date"))
        .agg(F.count("o_orderkey").alias("n"))
    )
    return days.join(counts, "value_date", "left").select(
        "value_date", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders")
    )


@query(
    "slug_key",
    with_views("booking_rows")
    + r"""SELECT product_name, regexp_replace(concat('AS', replace(substr(lower(product_name), 5), '-', ' ')),
                                              '\s+', '-', 'g') AS product_key,
                 CAST(COUNT(*) AS BIGINT) AS n FROM booking_rows GROUP BY 1, 2""",
)
def slug_key(t: Tables) -> DataFrame:
    named = t.booking_rows.groupBy("product_name").agg(F.count(F.lit(1)).alias("n"))
    return named.withColumn("product_key", S.slug(F.col("product_name"), bookings.KEY_PREFIX))


@query(
    "split_list",
    with_views("actions")
    + """SELECT id, CAST(CASE WHEN email_to = '' THEN 0 ELSE len(string_split(email_to, ',')) END AS BIGINT) AS n_to,
                CASE WHEN email_to <> '' THEN string_split(email_to, ',')[1] END AS first_to,
                CAST(len(string_split(email_bcc, ',')) AS BIGINT) AS n_bcc FROM actions""",
)
def split_list(t: Tables) -> DataFrame:
    to, bcc = S.split_list(F.col("email_to")), S.split_list(F.col("email_bcc"))
    return t.actions.select(
        "id", F.size(to).cast("long").alias("n_to"), F.get(to, F.lit(0)).alias("first_to"),
        F.array_size(bcc).cast("long").alias("n_bcc"),
    )


@query(
    "case_decode",
    with_views("actions")
    + """SELECT id, CASE WHEN change_type = 3 THEN 'block_tsp' WHEN change_type = 6 THEN 'block_affpubid' END AS change_type,
                CASE WHEN process_status IN (0, 1) OR process_status IS NULL THEN 'registered'
                     WHEN process_status = 2 THEN 'success' WHEN process_status = 3 THEN 'failed'
                     WHEN process_status = 12 THEN 'email_success' WHEN process_status = 13 THEN 'email_failed'
                     WHEN process_status = 22 THEN 'cancelled' END AS status,
                CASE delay_hours WHEN 0 THEN 'now' ELSE 'later' END AS urgency
         FROM actions""",
)
def case_decode(t: Tables) -> DataFrame:
    return actions.decode_actions(t.actions).select(
        "id", "change_type", "status", S.decode(F.col("delay_hours"), {0: "now"}, "later").alias("urgency")
    )


@query(
    "decimal_cast",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CAST(CAST(l_extendedprice * l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS amount,
              CAST(CAST(CAST(l_tax AS DECIMAL(9,4)) / 8 AS DECIMAL(12,2)) AS DOUBLE) AS small
       FROM lineitem""",
)
def decimal_cast(t: Tables) -> DataFrame:
    tax = F.col("l_tax").cast("decimal(9,4)")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.to_money(F.col("l_extendedprice") * F.col("l_quantity")).cast("double").alias("amount"),
        S.to_money(tax / 8).cast("double").alias("small"),
    )


@query(
    "round_half_up",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.125 AS DECIMAL(4,3)), 2) AS DOUBLE) AS rounded,
              CAST(round(-CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.5 AS DECIMAL(2,1)), 2) AS DOUBLE) AS negative
       FROM lineitem""",
)
def round_half_up(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        S.rounded(price * S.rate("0.125")).alias("rounded"),
        S.rounded(-price * S.rate("0.5")).alias("negative"),
    )


@query(
    "ordered_export",
    """SELECT CAST(o_orderdate AS DATE) AS order_day, o_orderkey, o_totalprice FROM orders
       ORDER BY 1 DESC, 2""",
)
def ordered_export(t: Tables) -> DataFrame:
    rows = t.orders.select(F.to_date("o_orderdate").alias("order_day"), "o_orderkey", "o_totalprice")
    return rows.orderBy(F.col("order_day").desc(), "o_orderkey")


@query(
    "cross_join_spine",
    """SELECT c_custkey, CAST(d AS DATE) AS value_date FROM customer,
              generate_series(DATE '1998-07-09', DATE '1998-07-15', INTERVAL 1 DAY) AS s(d)""",
)
def cross_join_spine(t: Tables) -> DataFrame:
    """Every row with every day of a week, without a join."""
    return D.with_days(t.customer.select("c_custkey"), RUN - dt.timedelta(days=6), RUN)


@query(
    "join_left_using",
    """SELECT o_orderkey, o_totalprice, lines FROM orders
       LEFT JOIN (SELECT l_orderkey AS o_orderkey, CAST(COUNT(*) AS BIGINT) AS lines FROM lineitem
                  WHERE l_returnflag = 'R' GROUP BY 1) USING (o_orderkey)""",
)
def join_left_using(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lines = returned.agg(F.count(F.lit(1)).alias("lines"))
    return R.left_join_using(t.orders.select("o_orderkey", "o_totalprice"), lines, "o_orderkey")


@query(
    "anti_join_not_exists",
    with_views("invoicing", "cancellations")
    + """SELECT id, total_cost FROM invoicing i
         WHERE NOT EXISTS (SELECT 1 FROM cancellations c WHERE c.individual_campaign_id = i.id
                           AND c.cancelled_at BETWEEN DATE '1998-07-01' AND DATE '1998-07-31')""",
)
def anti_join_not_exists(t: Tables) -> DataFrame:
    month = F.col("cancelled_at").between(F.lit(D.month_start(RUN)), F.lit(D.month_end(RUN)))
    invoices = t.invoicing.select("id", "total_cost")
    return R.without(invoices, t.cancellations.filter(month), "id", "individual_campaign_id")


@query(
    "correlated_sum",
    with_views("invoicing", "invoicing_influencer")
    + """SELECT id,
                CAST(COALESCE((SELECT SUM(ii.price) FROM invoicing_influencer ii WHERE ii.item_id = i.id), 0) AS DOUBLE) AS price,
                CAST(COALESCE((SELECT SUM(ii.price * ii.service_fee_enabled) FROM invoicing_influencer ii
                               WHERE ii.item_id = i.id), 0) AS DOUBLE) AS with_fee
         FROM invoicing i""",
)
def correlated_sum(t: Tables) -> DataFrame:
    sums = {"price": F.col("price"), "with_fee": F.col("price") * F.col("service_fee_enabled")}
    rows = R.child_sums(t.invoicing.select("id"), t.invoicing_influencer, "id", "item_id", sums, F.lit(0))
    return rows.select("id", *[F.col(c).cast("double").alias(c) for c in sums])


@query(
    "chained_scalar_lookup",
    with_views("invoices", "invoice_items", "campaign_features", "campaign_recipe")
    + """SELECT i.id, (SELECT DISTINCT campaign_id FROM invoice_items t WHERE t.invoice_id = i.id) AS campaign_id,
                (SELECT r.name FROM campaign_recipe r WHERE r.id =
                  (SELECT f.recipe_id FROM campaign_features f WHERE f.campaign_id =
                    (SELECT DISTINCT campaign_id FROM invoice_items t WHERE t.invoice_id = i.id))) AS recipe
         FROM invoices i""",
)
def chained_scalar_lookup(t: Tables) -> DataFrame:
    rows = R.attach_single(t.invoices.select("id"), t.invoice_items, "id", "invoice_id", "campaign_id", "campaign_id")
    rows = R.attach_single(rows, t.campaign_features, "campaign_id", "campaign_id", "recipe_id", "recipe_id")
    return R.attach_single(rows, t.campaign_recipe, "recipe_id", "id", "name", "recipe").drop("recipe_id")


@query(
    "customer_rollup",
    """SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS first_order, CAST(MAX(o_orderdate) AS DATE) AS last_order,
              CAST(COUNT(o_orderkey) AS BIGINT) AS n_orders,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders GROUP BY 1""",
)
def customer_rollup(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("first_order"),
        F.to_date(F.max("o_orderdate")).alias("last_order"),
        F.count("o_orderkey").alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "distinct_keys",
    """SELECT c_mktsegment, CAST(COUNT(DISTINCT o_custkey) AS BIGINT) AS buyers,
              CAST(COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS days
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def distinct_keys(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy("c_mktsegment").agg(
        F.count_distinct("o_custkey").alias("buyers"),
        F.count_distinct(F.to_date("o_orderdate")).alias("days"),
    )


@query(
    "conditional_counts",
    with_views("conversions_v")
    + """SELECT network_offer_id, CAST(COUNT(conversion_id) AS BIGINT) AS events,
                CAST(SUM(CASE WHEN conversion_status = 'approved' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
                CAST(SUM(CASE WHEN conversion_status = 'rejected' THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
                CAST(SUM(CASE WHEN conversion_status = 'pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending
         FROM conversions_v GROUP BY 1""",
)
def conditional_counts(t: Tables) -> DataFrame:
    status = F.col("conversion_status")
    return t.conversions_v.groupBy("network_offer_id").agg(
        F.count("conversion_id").alias("events"),
        *[S.count_if(status == s).alias(s) for s in ("approved", "rejected", "pending")],
    )


@query(
    "pivot_payment_methods",
    with_views("raw_payments")
    + "SELECT order_id, "
    + "".join(
        f"CAST(SUM(CASE WHEN payment_method = '{m}' THEN amount ELSE 0 END) AS BIGINT) AS {m}_amount, "
        for m in ("credit_card", "coupon", "bank_transfer", "gift_card")
    )
    + "CAST(SUM(amount) AS BIGINT) AS amount FROM raw_payments GROUP BY 1",
)
def pivot_payment_methods(t: Tables) -> DataFrame:
    return marts.payments_by_method(t.raw_payments)


@query(
    "sum_null_forms",
    with_views("fact")
    + """SELECT country, pid, CAST(SUM(COALESCE(gec_eur, 0)) AS DOUBLE) AS filled,
                CAST(COALESCE(SUM(gec_eur), 0) AS DOUBLE) AS or_zero, CAST(SUM(gec_eur) AS DOUBLE) AS bare
         FROM fact GROUP BY 1, 2""",
)
def sum_null_forms(t: Tables) -> DataFrame:
    amount = F.col("gec_eur")
    return t.fact.groupBy("country", "pid").agg(
        S.sum_filled(amount).cast("double").alias("filled"),
        S.sum_or_zero(amount).cast("double").alias("or_zero"),
        F.sum(amount).cast("double").alias("bare"),
    )


@query(
    "weighted_sum_case",
    with_views("fact")
    + """SELECT country, CAST(SUM(COALESCE(net_amount_eur, 0) * CASE COALESCE(pid, -1)
                    WHEN 2509 THEN 0.85 WHEN 3052 THEN 0.85 WHEN 2885 THEN 0.75 WHEN 2952 THEN 0.88
                    WHEN 2825 THEN 0.85 WHEN 3156 THEN 0.70 WHEN 3251 THEN 0.75 WHEN 3312 THEN 0.80
                    ELSE 1 END) AS DOUBLE) AS weighted FROM fact GROUP BY 1""",
)
def weighted_sum_case(t: Tables) -> DataFrame:
    share = S.decode(F.coalesce(F.col("pid"), F.lit(-1)), REVSHARE_RATES, Decimal("1"))
    net = F.coalesce(F.col("net_amount_eur"), F.lit(0))
    return t.fact.groupBy("country").agg(F.sum(net * share).cast("double").alias("weighted"))


@query(
    "group_by_constant",
    """SELECT DATE '1998-07-15' AS run_date, CAST(COUNT(*) AS BIGINT) AS n,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders WHERE o_orderdate < DATE '1998-07-15' GROUP BY 1""",
)
def group_by_constant(t: Tables) -> DataFrame:
    rows = t.orders.filter(F.col("o_orderdate") < F.lit(RUN)).groupBy(F.lit(RUN).alias("run_date"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(
    "union_all_padded",
    with_views("clicks_v", "conversions_v")
    + """SELECT offer_id, 'DASH' AS tracker, CAST(COUNT(transaction_id) AS BIGINT) AS clicks,
                CAST(0 AS BIGINT) AS events, CAST(0 AS DOUBLE) AS revenue FROM clicks_v GROUP BY 1
         UNION ALL
         SELECT network_offer_id, 'DASH', 0, COUNT(conversion_id), CAST(SUM(revenue) AS DOUBLE)
         FROM conversions_v GROUP BY 1""",
)
def union_all_padded(t: Tables) -> DataFrame:
    zero = F.lit(0).cast("long")
    clicks = t.clicks_v.groupBy("offer_id").agg(
        F.count("transaction_id").alias("clicks"), F.max(zero).alias("events"), F.max(F.lit(0.0)).alias("revenue")
    )
    events = t.conversions_v.groupBy(F.col("network_offer_id").alias("offer_id")).agg(
        F.max(zero).alias("clicks"), F.count("conversion_id").alias("events"),
        F.sum("revenue").cast("double").alias("revenue"),
    )
    return R.union_all(clicks, events).withColumn("tracker", F.lit("DASH"))
