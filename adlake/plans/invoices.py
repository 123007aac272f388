"""Spreading invoices over their service period, and influencer payouts."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_keys, month_end, month_start, months_spanned
from adlake.functions.scalars import rate, rounded, to_money
from adlake.operators.relational import child_sums, join_reduced, several, single_stats, without

# Cost share of revenue, report keys, fee shares.
COST_RATIO = Decimal("0.7")
MARKETPLACE_KEY = "RH-marketplace-total"
AGENCY_KEY = "RH-agency-total"
SERVICE_FEE = Decimal("0.15")
UNPAID_RECIPE = "giveaway"


def service_months(created: Column, start: Column, end: Column) -> Column:
    """Months from the later of creation and service start to the later of creation and end."""
    first = F.greatest(F.coalesce(start, created), created)
    last = F.greatest(F.coalesce(end, created), created)
    return months_spanned(first, last)


def months_if_running_on(created: Column, start: Column, end: Column) -> Column:
    """``service_months`` when the service outlasts the month of creation, else 1.

    The end is compared with midnight of the month's last day, so a service
    ending later on that day already counts as running on.
    """
    return F.when(end > F.last_day(created), service_months(created, start, end)).otherwise(1)


def _total(shares: DataFrame, run_date: dt.date, product_key: str, cost_ratio: Decimal) -> DataFrame:
    """Sum (revenue / allocation) to one report row; no invoices give no row.

    Shares keep 8 decimals. Grouping by the constant run date (not a global
    aggregate) is what makes an empty input empty.
    """
    def share(amount: Column) -> Column:
        return F.sum((amount / F.col("allocation").cast("decimal(10,0)")).cast("decimal(24,8)"))

    revenue = F.col("revenue").cast("decimal(18,4)")
    return (
        shares.groupBy(F.lit(run_date).alias("__run"))
        .agg(
            rounded(share(revenue)).alias("revenues"),
            rounded(share(revenue * rate(cost_ratio))).alias("direct_costs"),
        )
        .select(
            *date_keys(F.col("__run")),
            F.lit(product_key).alias("product_key"),
            "revenues",
            "direct_costs",
        )
    )


def _issued_on(column: Column, day: dt.date) -> Column:
    return (column >= F.lit(day)) & (column < F.lit(day + dt.timedelta(days=1)))


def _overlaps_month(start: Column, end: Column, day: dt.date) -> Column:
    return (start <= F.lit(month_end(day))) & (end >= F.lit(month_start(day)))


def allocate_marketplace(
    invoices: DataFrame, run_date: dt.date, cost_ratio: Decimal = COST_RATIO,
    product_key: str = MARKETPLACE_KEY,
) -> DataFrame:
    """Daily share of marketplace invoices.

    New money: issued on the run date, counted with 1/months when the service
    runs past the month. Old money: issued before this month with a service
    overlapping it, counted with 1/(months x days of this month). A row is never
    both, so one scan tags each invoice with its allocation.
    """
    created, start, end = F.col("created_at"), F.col("period_start"), F.col("period_end")
    canceled = F.col("canceled_at")
    live = F.col("fastbill_invoice_url").isNotNull() & (
        canceled.isNull() | (canceled > F.lit(month_end(run_date)))
    )
    new = _issued_on(created, run_date) & (start.isNull() | (start < F.last_day(created)))
    old = (created < F.lit(month_start(run_date))) & _overlaps_month(start, end, run_date)
    days = month_end(run_date).day
    shares = (
        invoices.filter(live & (new | old))
        .withColumn(
            "allocation",
            F.when(new, months_if_running_on(created, start, end))
            .otherwise(service_months(created, start, end) * days),
        )
        .select((F.col("total").cast("decimal(18,2)") / 100).alias("revenue"), "allocation")
    )
    return _total(shares, run_date, product_key, cost_ratio)


def allocate_agency(
    invoices: DataFrame, cancellations: DataFrame, run_date: dt.date,
    cost_ratio: Decimal = COST_RATIO, product_key: str = AGENCY_KEY,
) -> DataFrame:
    """Daily share of agency invoices.

    Selected by the date the invoice was issued, while months are counted from
    its creation. Old money uses 1 month when the service ends within the month
    of creation. Invoices cancelled in the run date's month are out; a
    cancellation counts up to midnight of the month's last day.
    """
    issued, created = F.col("fastbill_invoice_created_at"), F.col("created_at")
    start, end = F.col("start_at"), F.col("end_at")
    new = _issued_on(issued, run_date) & (start.isNull() | (start < F.last_day(issued)))
    old = (issued < F.lit(month_start(run_date))) & _overlaps_month(start, end, run_date)
    cancelled = cancellations.filter(
        F.col("cancelled_at").between(F.lit(month_start(run_date)), F.lit(month_end(run_date)))
    )
    months = months_if_running_on(created, start, end)
    days = month_end(run_date).day
    shares = invoices.filter(F.col("fastbill_invoice_number").isNotNull() & (new | old)).select(
        "id",
        to_money(F.col("total_cost")).alias("revenue"),
        F.when(new, months).otherwise(months * days).alias("allocation"),
    )
    shares = without(shares, cancelled, "id", "individual_campaign_id")
    return _total(shares, run_date, product_key, cost_ratio)


def marketplace_payout(
    invoices: DataFrame, items: DataFrame, features: DataFrame, recipes: DataFrame,
    provisions: DataFrame,
) -> DataFrame:
    """Influencer payout per marketplace invoice.

    Item prices minus the provision of the invoice's campaign, 0 for giveaways
    and invoices without a campaign. An invoice, campaign or recipe leading to
    two different values is an error.
    """
    # The chain from a campaign to its recipe and provision is resolved per campaign, so that
    # items are read once and invoices are joined twice, however many lookups there are.
    facts = features.select(
        F.col("campaign_id").alias("__campaign"), "recipe_id", F.lit(True).alias("is_feature")
    ).unionByName(
        provisions.select(
            F.col("campaign_id").alias("__campaign"), "influencer_provision", F.lit(False).alias("is_feature")
        ),
        allowMissingColumns=True,
    )
    campaigns = facts.groupBy("__campaign").agg(
        *single_stats(F.col("recipe_id"), "recipe_id", F.col("is_feature")),
        *single_stats(F.col("influencer_provision"), "provision", ~F.col("is_feature")),
    )
    names = recipes.groupBy(F.col("id").alias("__recipe")).agg(*single_stats(F.col("name"), "recipe"))
    campaigns = join_reduced(campaigns, names, {"__low_recipe_id": "__recipe"}, "left")
    # Cents are summed as whole numbers and become units once per invoice.
    totals = items.groupBy(F.col("invoice_id").alias("__invoice")).agg(
        F.sum("price").alias("cents"), *single_stats(F.col("campaign_id"), "campaign_id")
    )
    rows = join_reduced(invoices.select("id"), totals, {"id": "__invoice"}, "left")
    rows = join_reduced(rows, campaigns, {"__low_campaign_id": "__campaign"}, "left")
    cents = F.col("cents").cast("decimal(20,0)")
    provision = cents * F.col("__low_provision").cast("decimal(9,4)") / 10000
    paid = F.col("__low_campaign_id").isNotNull() & (F.col("__low_recipe") != UNPAID_RECIPE)
    payout = F.when(paid, F.round(cents / 100, 2) - F.round(provision, 2)).otherwise(F.lit(0)).cast("double")
    steps = {"campaign_id": "id", "recipe_id": "campaign_id", "recipe": "recipe_id", "provision": "campaign_id"}
    for name, key in steps.items():
        problem = F.raise_error(F.lit(f"more than one {name} for one {key}")).cast("double")
        payout = F.when(several(name), problem).otherwise(payout)
    return rows.select("id", payout.alias("payout"))


def agency_payout(invoices: DataFrame, influencers: DataFrame) -> DataFrame:
    """Influencer and talent payout per agency invoice, from its influencer lines."""
    # Shares and percentages are linear, so they are applied to the sums. Sums are rounded
    # to cents but not narrowed: one invoice may have very many lines.
    price = F.col("price").cast("decimal(12,2)")
    flag = F.col("service_fee_enabled")
    rows = child_sums(
        invoices.select("id"), influencers, "id", "item_id",
        {
            "price": price,
            "with_fee": F.when(flag == 1, price).when(flag == 0, F.lit(0)),
            "percents": price * F.col("management_fee").cast("decimal(5,2)"),
        },
        default=F.lit(0),
    )
    with_fee = F.col("with_fee")
    influencer = F.round(with_fee - with_fee * rate(SERVICE_FEE), 2)
    talent = F.round(F.col("price") - with_fee - F.col("percents") / 100, 2)
    return rows.select(
        "id",
        influencer.cast("double").alias("influencer_payout"),
        talent.cast("double").alias("talent_payout"),
        (influencer + talent).cast("double").alias("payout"),
    )

