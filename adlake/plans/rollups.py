"""Daily revenue/cost rollups in the common report shape.

Every rollup returns year, month, day, value_at, product_key, revenues,
direct_costs. Amounts may be decimals (exact) or doubles; results are doubles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import (
    date_keys, date_range, day_key, local_date, local_day_filter, month_key,
)
from adlake.functions.scalars import decode, rate, rounded

REPORT_KEYS = ["year", "month", "day", "value_at", "product_key"]
REPORT_COLUMNS = [*REPORT_KEYS, "revenues", "direct_costs"]

# Rates, partner lists and key prefixes of the company report.
USD_TO_EUR = Decimal("0.8411490095470413")
VIDEO_KEY_PREFIX = "MK-yt-"
PARTNER_REVENUE_OWNERS = ("DIYrC9g4HIz_T7EJuEZ7YA",)
MARGIN_OWNERS = ("T6YRWhYberPdRbf3Z5rbQ", "YO9H9-o4YqlpjXtmY4dUZA", "FQX78HL5L6oCjJd3ejmFYw")
PARTNER_COST_RATE = Decimal("0.18")
DEFAULT_COST_RATE = Decimal("0.9")
CONVERSION_FX = Decimal("0.85")
CONVERSION_DISCOUNT = Decimal("0.92")
CONVERSION_KEY = "AL-total"
REVSHARE_RATES = {
    2509: Decimal("0.85"),
    3052: Decimal("0.85"),
    2885: Decimal("0.75"),
    2952: Decimal("0.88"),
    2825: Decimal("0.85"),
    3156: Decimal("0.70"),
    3251: Decimal("0.75"),
    3312: Decimal("0.80"),
}
CORE_KEY_PREFIX = "MED-core-"
REVSHARE_KEY = "MED-revshare"
OWN_SUPPLY_PARTNERS = (
    121, 193, 198, 339, 120, 122, 123, 261, 262, 263, 264, 265, 266, 267, 268, 269, 270, 278,
    279, 280, 281, 282, 299, 300, 305, 307, 322, 323, 324, 325, 326, 327,
)
OWN_SUPPLY_KEY = "AS-others"
THIRD_PARTY_SUPPLY_KEY = "SY-as-third-party-supply"


@dataclass(frozen=True)
class OwnerRules:
    """Which revenue measure and cost rule each video content owner has."""

    partner_owners: Sequence[str] = PARTNER_REVENUE_OWNERS
    margin_owners: Sequence[str] = MARGIN_OWNERS
    partner_cost_rate: Decimal = PARTNER_COST_RATE
    default_cost_rate: Decimal = DEFAULT_COST_RATE


def owner_revenue_share(
    videos: DataFrame, run_date: dt.date, rules: OwnerRules = OwnerRules(),
    fx: Decimal = USD_TO_EUR, prefix: str = VIDEO_KEY_PREFIX, back: int = 7, ahead: int = 1,
) -> DataFrame:
    """Video revenue and partner cost per content owner and day, in the target currency."""
    owner = F.col("content_owner_id")
    ads, partner = F.col("estimated_youtube_ad_revenue"), F.col("estimated_partner_revenue")
    by_partner = owner.isin(list(rules.partner_owners))
    revenue = F.when(by_partner, partner).otherwise(ads)
    cost = (
        F.when(owner.isin(list(rules.margin_owners)), ads - partner)
        .when(by_partner, partner * rate(rules.partner_cost_rate))
        .otherwise(ads * rate(rules.default_cost_rate))
    )
    window = date_range(
        F.col("date"), run_date - dt.timedelta(days=back), run_date + dt.timedelta(days=ahead)
    )
    totals = videos.filter(window).groupBy("content_owner_id", "date").agg(
        rounded(F.sum(revenue) * rate(fx)).alias("revenues"),
        rounded(F.sum(cost) * rate(fx)).alias("direct_costs"),
    )
    return totals.select(
        *date_keys(F.col("date")),
        F.concat(F.lit(prefix), owner).alias("product_key"),
        "revenues",
        "direct_costs",
    )


def fx_discount_total(
    conversions: DataFrame, run_date: dt.date, fx: Decimal = CONVERSION_FX,
    discount: Decimal = CONVERSION_DISCOUNT, product_key: str = CONVERSION_KEY,
) -> DataFrame:
    """Converted and discounted revenue and payout of one partition day, per event date."""
    factor = rate(fx * discount)
    totals = (
        conversions.filter(date_range(F.col("partition_time"), run_date, run_date))
        .groupBy(F.to_date("date").alias("date"))
        .agg(
            rounded(F.sum(F.col("revenue") * factor)).alias("revenues"),
            rounded(F.sum(F.col("payout") * factor)).alias("direct_costs"),
        )
    )
    return totals.select(
        *date_keys(F.col("date")), F.lit(product_key).alias("product_key"), "revenues", "direct_costs"
    )


def _local_keys(tz: str, utc_month_in_day: bool) -> list[Column]:
    """Report calendar columns of the local day.

    With ``utc_month_in_day`` the day number takes its month from the UTC
    timestamp, as the company report does: around a month's first midnight it
    mixes the local day with the UTC month.
    """
    local = local_date(F.col("timestamp"), tz)
    month = F.month("timestamp") if utc_month_in_day else F.month(local)
    day = (F.year(local) * 10000 + month * 100 + F.dayofmonth(local)).cast("long")
    return [
        F.year(local).cast("long").alias("year"),
        month_key(local).alias("month"),
        (day if utc_month_in_day else day_key(local)).alias("day"),
        local.alias("value_at"),
    ]


@dataclass(frozen=True)
class LocalRule:
    """What one local-day rollup takes from a fact row.

    ``where`` picks the rows, ``any_of`` names the measures of which one must be
    present, ``revenue`` and ``cost`` are per-row amounts that are summed. A
    NULL amount is skipped; fill it to make an all-NULL group 0.
    """

    where: Column
    product_key: Column
    revenue: Column
    cost: Column
    any_of: Sequence[str]

    def applies(self) -> Column:
        return self.where & reduce(or_, [F.col(c).isNotNull() for c in self.any_of])


def local_day_rollup(
    fact: DataFrame, run_date: dt.date, rules: Sequence[LocalRule], tz: str = "Europe/Berlin",
    utc_month_in_day: bool = True,
) -> DataFrame:
    """Revenue and cost per product key of one local day.

    Several rules share one scan and one shuffle; a row counts for the first
    rule that applies to it.
    """
    def chosen(pick: Callable[[LocalRule], Column]) -> Column:
        branches = F  # F.when(..), then .when(..) on the result
        for rule in rules:
            branches = branches.when(rule.applies(), pick(rule))
        return branches

    rows = fact.filter(
        local_day_filter(F.col("timestamp"), tz, run_date)
        & reduce(or_, [rule.applies() for rule in rules])
    )
    return (
        rows.groupBy(
            *_local_keys(tz, utc_month_in_day),
            chosen(lambda r: r.product_key).alias("product_key"),
        )
        .agg(
            F.sum(chosen(lambda r: r.revenue)).cast("double").alias("revenues"),
            F.sum(chosen(lambda r: r.cost)).cast("double").alias("direct_costs"),
        )
        .select(REPORT_COLUMNS)
    )


ANY_AMOUNT = ("raw_revenue_amount_eur", "gec_eur", "net_amount_eur", "publisher_cost_eur")
ANY_RAW = ("raw_revenue_amount_eur", "publisher_cost_eur")


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def core_rule(
    instance: str = "core", excluded: Sequence[int] = tuple(REVSHARE_RATES),
    prefix: str = CORE_KEY_PREFIX,
) -> LocalRule:
    """Net revenue and publisher cost per country, without revenue-share partners."""
    return LocalRule(
        where=(F.col("instance") == instance)
        & ~F.coalesce(F.col("pid"), F.lit(-1)).isin(list(excluded)),
        product_key=F.concat(F.lit(prefix), F.replace(F.col("country"), F.lit("GB"), F.lit("UK"))),
        revenue=_filled("net_amount_eur"),
        cost=_filled("publisher_cost_eur"),
        any_of=ANY_AMOUNT,
    )


def revshare_rule(
    rates: Mapping[int, Decimal] = REVSHARE_RATES, instance: str = "core",
    product_key: str = REVSHARE_KEY,
) -> LocalRule:
    """Revenue-share partners: cost is their share of the revenue plus booked publisher cost."""
    partner = F.coalesce(F.col("pid"), F.lit(-1))
    share = decode(partner, {p: Decimal(r) for p, r in rates.items()}, Decimal("1"))
    return LocalRule(
        where=(F.col("instance") == instance) & partner.isin(list(rates)),
        product_key=F.lit(product_key),
        revenue=_filled("net_amount_eur"),
        cost=_filled("net_amount_eur") * share + _filled("publisher_cost_eur"),
        any_of=ANY_AMOUNT,
    )


def instance_rule(instance: str, product_key: str) -> LocalRule:
    """One instance in total; an all-NULL measure stays NULL."""
    return LocalRule(
        where=F.col("instance") == instance,
        product_key=F.lit(product_key),
        revenue=F.col("raw_revenue_amount_eur"),
        cost=F.col("publisher_cost_eur"),
        any_of=ANY_RAW,
    )


def partner_rule(
    instance: str, listed: Sequence[int] = OWN_SUPPLY_PARTNERS, listed_key: str = OWN_SUPPLY_KEY,
    other_key: str = THIRD_PARTY_SUPPLY_KEY,
) -> LocalRule:
    """One instance split in two product keys by a partner list (NULL partner: listed key)."""
    partner = F.coalesce(F.col("pid"), F.col("partner_id"))
    return LocalRule(
        where=F.col("instance") == instance,
        product_key=F.when(~partner.isin(list(listed)), other_key).otherwise(listed_key),
        revenue=_filled("raw_revenue_amount_eur"),
        cost=_filled("publisher_cost_eur"),
        any_of=ANY_RAW,
    )


def local_day_core(fact: DataFrame, run_date: dt.date, **options) -> DataFrame:
    """``core_rule`` alone."""
    return local_day_rollup(fact, run_date, [core_rule(**options)])


def revshare_cost(fact: DataFrame, run_date: dt.date, **options) -> DataFrame:
    """``revshare_rule`` alone."""
    return local_day_rollup(fact, run_date, [revshare_rule(**options)])


def instance_rollup(fact: DataFrame, run_date: dt.date, instance: str, product_key: str) -> DataFrame:
    """``instance_rule`` alone."""
    return local_day_rollup(fact, run_date, [instance_rule(instance, product_key)])


def classify_partner(fact: DataFrame, run_date: dt.date, instance: str, **options) -> DataFrame:
    """``partner_rule`` alone."""
    return local_day_rollup(fact, run_date, [partner_rule(instance, **options)])
