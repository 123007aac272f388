"""Reports: empty inputs, NULL groups, month ends, quirks and their switches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import quality as Q
from adlake.plans import actions as A
from adlake.plans import bookings, daily_stats, exports, invoices, marts, report, rollups
from adlake.operators.merge import merge
from adlake.plans.contracts import CONTRACTS

RUN = dt.date(2024, 1, 30)
CLICKS = "partition_time timestamp, transaction_id int, offer_id int, advertiser_id int, affiliate_id int, tsp int, country_code string"
EVENTS = """partition_time timestamp, conversion_id int, conversion_status string, network_offer_id int,
    network_advertiser_id int, network_affiliate_id int, tsp int, country string, revenue double, payout double"""


def stats_inputs(spark):
    ts = dt.datetime(2024, 1, 30, 23, 59)
    old = dt.datetime(2024, 1, 22, 23, 59)
    clicks = spark.createDataFrame([(ts, 1, 1, 1, 1, 1, "DE"), (ts, None, 1, 1, 1, 1, "DE"), (old, 2, 1, 1, 1, 1, "DE")], CLICKS)
    events = spark.createDataFrame([(ts, 1, "approved", 1, 1, 1, 1, "DE", 10.0, 4.0), (ts, 2, "other", 2, 1, 1, 1, "DE", None, None)], EVENTS)
    return clicks, events


def test_daily_stats_rows_per_key(spark):
    clicks, events = stats_inputs(spark)
    split = daily_stats.daily_stats(clicks, events, RUN)
    assert split.filter("offer_id = 1").count() == 2
    nulls = split.filter("offer_id = 2").first()
    assert nulls["events"] == 1 and nulls["revenue"] is None and nulls["approved_events"] == 0
    both = daily_stats.daily_stats(clicks, events, RUN, combine=True)
    row = both.filter("offer_id = 1").first()
    assert both.count() == 2 and (row["clicks"], row["events"], row["profit"]) == (1, 1, 6.0)


def test_split_stats_cannot_be_merged_twice(spark):
    clicks, events = stats_inputs(spark)
    contract = CONTRACTS["daily_stats"]
    split = daily_stats.daily_stats(clicks, events, RUN)
    live = merge(spark.createDataFrame([], contract.table_schema()), split, contract.spec())
    assert live.filter("offer_id = 1").count() == 2 and live.filter("events IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="several source rows"):
        merge(live, split, contract.spec()).collect()


FACT = """timestamp timestamp_ntz, instance string, country string, pid int, partner_id int, net_amount_eur double,
    raw_revenue_amount_eur double, gec_eur double, publisher_cost_eur double"""


def fact(spark, *facts):
    return spark.createDataFrame(list(facts), FACT)


def test_day_number_takes_its_month_from_utc(spark):
    f = fact(spark, (dt.datetime(2024, 1, 31, 23, 30), "core", "GB", None, 1, 5.0, None, None, None))
    day = dt.date(2024, 2, 1)
    quirk = rollups.local_day_rollup(f, day, [rollups.core_rule()]).first()
    plain = rollups.local_day_rollup(f, day, [rollups.core_rule()], utc_month_in_day=False).first()
    assert (quirk["month"], quirk["day"], quirk["product_key"]) == (202402, 20240101, "MED-core-UK")
    assert (plain["day"], plain["revenues"], plain["direct_costs"]) == (20240201, 5.0, 0.0)


def test_rules_share_a_scan_and_keep_their_null_forms(spark, plan):
    noon = dt.datetime(2024, 1, 15, 12)
    f = fact(
        spark,
        (noon, "core", "DE", 2509, 1, 100.0, None, None, None),
        (noon, "core", "DE", None, 1, 7.0, None, None, 1.0),
        (noon, "perf", "DE", 1, 1, None, 3.0, None, None),
        (noon, "portal", "DE", None, None, None, 4.0, None, None),
        (noon, "portal", "DE", 5, 121, None, 6.0, None, 2.0),
        (noon, "perf", "DE", 1, 1, 9.0, None, None, None),
    )
    rules = [rollups.core_rule(), rollups.revshare_rule(), rollups.instance_rule("perf", "P"), rollups.partner_rule("portal")]
    together = rollups.local_day_rollup(f, dt.date(2024, 1, 15), rules)
    got = {r["product_key"]: (r["revenues"], r["direct_costs"]) for r in together.collect()}
    assert got == {"MED-core-DE": (7.0, 1.0), "MED-revshare": (100.0, 85.0), "P": (3.0, None),
                   "AS-others": (4.0, 0.0), "SY-as-third-party-supply": (6.0, 2.0)}
    fresh = rollups.local_day_rollup(f, dt.date(2024, 1, 15), rules)
    assert plan(fresh).count("Exchange hashpartitioning") == 1


INVOICES = """total bigint, created_at timestamp_ntz, period_start timestamp_ntz, period_end timestamp_ntz,
    canceled_at timestamp_ntz, fastbill_invoice_url string"""


def shares(spark, *found):
    frame = spark.createDataFrame(list(found), INVOICES)
    return invoices.allocate_marketplace(frame, dt.date(2024, 1, 15)).collect()


def test_marketplace_without_invoices_has_no_row(spark):
    assert shares(spark) == []


def test_marketplace_new_money(spark):
    day = dt.datetime(2024, 1, 15, 10)
    one = lambda end, start=None: shares(spark, (12000, day, start, end, None, "u"))
    assert one(None)[0]["revenues"] == 120.0
    assert one(dt.datetime(2024, 1, 31))[0]["revenues"] == 120.0
    assert one(dt.datetime(2024, 3, 1))[0]["revenues"] == 40.0
    assert one(dt.datetime(2024, 3, 1))[0]["direct_costs"] == 28.0
    assert one(dt.datetime(2024, 1, 31, 12))[0]["revenues"] == 120.0  # runs on, within one month
    assert one(dt.datetime(2024, 3, 1), dt.datetime(2024, 2, 1)) == []  # future money


def test_marketplace_old_money_and_cancellation(spark):
    old = (31000, dt.datetime(2023, 12, 5), dt.datetime(2023, 12, 5), dt.datetime(2024, 1, 20), None, "u")
    assert shares(spark, old)[0]["revenues"] == 5.0  # 310 / (2 months * 31 days)
    assert shares(spark, (*old[:4], dt.datetime(2024, 1, 31), "u")) == []
    assert shares(spark, (*old[:4], dt.datetime(2024, 1, 31, 1), "u"))[0]["revenues"] == 5.0
    assert shares(spark, (*old[:5], None)) == []
    open_end = (*old[:3], None, None, "u")
    assert shares(spark, open_end) == []


def test_agency_counts_one_month_and_honours_cancellations(spark):
    schema = """id int, total_cost double, created_at timestamp_ntz, start_at timestamp_ntz, end_at timestamp_ntz,
        fastbill_invoice_number string, fastbill_invoice_created_at timestamp_ntz"""
    created = dt.datetime(2024, 1, 2)
    rows = [(1, 310.0, created, created, dt.datetime(2024, 1, 20), "n", dt.datetime(2023, 12, 1)),
            (2, 99.0, created, created, dt.datetime(2024, 1, 20), "n", dt.datetime(2023, 12, 1))]
    frame = spark.createDataFrame(rows, schema)
    cancelled = spark.createDataFrame([(2, dt.datetime(2024, 1, 31))], "individual_campaign_id int, cancelled_at timestamp_ntz")
    got = invoices.allocate_agency(frame, cancelled, dt.date(2024, 1, 15)).collect()
    assert [r["revenues"] for r in got] == [10.0]
    late = spark.createDataFrame([(2, dt.datetime(2024, 1, 31, 1))], "individual_campaign_id int, cancelled_at timestamp_ntz")
    assert invoices.allocate_agency(frame, late, dt.date(2024, 1, 15)).first()["revenues"] == 13.19


def test_marketplace_payout_giveaway_and_campaign_conflict(spark, rows):
    inv = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    items = spark.createDataFrame([(1, 10, 1999), (1, 10, 1), (2, 20, 500)], "invoice_id int, campaign_id int, price int")
    features = spark.createDataFrame([(10, 1), (20, 2)], "campaign_id int, recipe_id int")
    recipes = spark.createDataFrame([(1, "post"), (2, "giveaway")], "id int, name string")
    prov = spark.createDataFrame([(10, 15), (20, 15)], "campaign_id int, influencer_provision int")
    assert rows(invoices.marketplace_payout(inv, items, features, recipes, prov)) == [(1, 17.0), (2, 0.0), (3, 0.0)]
    torn = items.unionByName(spark.createDataFrame([(1, 11, 5)], items.schema))
    with pytest.raises(Exception, match="more than one campaign_id"):
        invoices.marketplace_payout(inv, torn, features, recipes, prov).collect()
    for frame, row, problem in ((features, (20, 3), "recipe_id"), (recipes, (2, "post"), "recipe"), (prov, (20, None), "provision")):
        doubled = [f.unionByName(spark.createDataFrame([row], f.schema)) if f is frame else f for f in (features, recipes, prov)]
        with pytest.raises(Exception, match=f"more than one {problem} for"):
            invoices.marketplace_payout(inv, items, *doubled).collect()
        # What no invoice leads to is no error.
        assert rows(invoices.marketplace_payout(inv, items.filter("campaign_id = 10"), *doubled))[0] == (1, 17.0)


def test_bookings_fallback_and_null_months(spark):
    schema = "product_name string, booking_period_date timestamp_ntz, {} double"
    revenue = spark.createDataFrame([("0401 - A", dt.datetime(2024, 2, 1), 290.0), ("0402 - B", dt.datetime(2024, 3, 1), 50.0),
                                     ("0406 - Third Party Supply", dt.datetime(2024, 2, 1), 1.0)], schema.format("revenue"))
    cost = spark.createDataFrame([("0401 - A", dt.datetime(2024, 3, 1), 20.0), ("0409 - Z", dt.datetime(2024, 2, 1), 29.0)], schema.format("cost"))
    run = dt.date(2024, 3, 10)
    got = {(r["product_key"], r["day"]): (r["revenues"], r["direct_costs"])
           for r in bookings.spread_monthly(revenue, cost, run).collect()}
    assert len(got) == 2 * 70
    assert got["AS-a", 20240115] == (None, None)
    assert got["AS-a", 20240229] == (10.0, 0.0)
    assert got["AS-a", 20240310] == (290 / 29 / 2, 2.0)  # missing: all products' February, shared by two
    assert got["AS-b", 20240310] == (5.0, 29 / 29 / 2)
    own = {(r["product_key"], r["day"]): r["revenues"]
           for r in bookings.spread_monthly(revenue, cost, run, per_product=True).collect()}
    assert own["AS-a", 20240310] == 10.0


def test_report_prefers_rollups_over_estimates(spark):
    schema = CONTRACTS["daily_report"].table_schema()
    day = dt.date(2024, 1, 15)
    key = (2024, 202401, 20240115, day)
    rolled = spark.createDataFrame([(*key, "a", 5.0, None)], schema)
    products = spark.createDataFrame([("a", 9.0, 9.0), ("b", 7.0, None), ("c", None, 3.0)],
                                     "id string, avg_estimated_daily_revenues double, avg_estimated_daily_direct_costs double")
    existing = spark.createDataFrame([(*key, "a", 1.0, 1.0), (*key, "z", 2.0, 2.0)], schema)
    got = {r["product_key"]: (r["revenues"], r["direct_costs"])
           for r in report.daily_report([rolled], products, existing, day).collect()}
    assert got == {"a": (5.0, None), "z": (2.0, 2.0), "b": (7.0, None)}


def test_customers_mart_ignores_orphan_payments(spark, rows):
    c = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "customer_id int, first_name string, last_name string")
    o = spark.createDataFrame([(10, 1, dt.date(2024, 2, 29), "placed"), (11, None, dt.date(2024, 1, 1), "placed")],
                              "order_id int, customer_id int, order_date date, status string")
    p = spark.createDataFrame([(1, 10, "coupon", 5), (2, 99, "coupon", 7), (3, 10, "cash", 1)],
                              "payment_id int, order_id int, payment_method string, amount int")
    got = marts.customers_mart(c, o, p)
    assert rows(got, "customer_id", "number_of_orders", "customer_lifetime_value") == [(1, 1, 6), (2, None, None)]
    assert rows(marts.orders_mart(o, p), "order_id", "coupon_amount", "amount") == [(10, 5, 6), (11, None, None)]


def test_quality_null_semantics(spark):
    df = spark.createDataFrame([(None, "x"), (None, None), (1, "y"), (1, "x")], "k int, v string")
    parent = spark.createDataFrame([(2,)], "k int")
    models = {"m": df, "p": parent}
    checks = [Q.Check("m", "k", "unique"), Q.Check("m", "k", "not_null"),
              Q.Check("m", "v", "accepted_values", values=("x",)), Q.Check("m", "k", "relationships", to=("p", "k"))]
    got = {(r["column_name"], r["test"]): r["failures"] for r in Q.quality_report(models, checks).collect()}
    assert got == {("k", "unique"): 1, ("k", "not_null"): 2, ("v", "accepted_values"): 1, ("k", "relationships"): 2}
    assert len(marts.MODEL_CHECKS) == 20


def test_export_drops_null_event_types_and_orders(spark):
    names = ("date network_affiliate_id source_id app_id network_offer_id cpa_enabled event_type country click_date "
             "session_user_ip platform idfa google_ad_id click_ua isp referer handset os_version language "
             "is_wireless_device transaction_id").split()
    def row(kind, session):
        return spark.range(1).select(
            F.lit(dt.datetime(2024, 1, 15, 9)).alias("partition_time"),
            *[F.lit({"country": "JP", "event_type": kind, "transaction_id": session, "cpa_enabled": 1, "platform": "iOS",
                     "idfa": "i"}.get(n)).cast("string").alias(n) for n in names])
    conv = row("buy", "2").unionByName(row(None, "3")).unionByName(row("alltac", "4")).unionByName(row("new", "1"))
    kinds = spark.createDataFrame([("buy", "Buy")], "event_type string, event_name string")
    offers = spark.createDataFrame([], "offer_id string")
    got = exports.conversion_export(conv, kinds, offers, dt.date(2024, 1, 15)).collect()
    assert [(r["session_id"], r["conversion_type"], r["campaign_type"], r["device_id"]) for r in got] == [
        ("1", None, "cpa", "i"), ("2", "Buy", "cpa", "i")]


def test_action_run(spark):
    now = dt.datetime(2024, 1, 15, 12)
    source = spark.createDataFrame(
        [(1, 3, 0, 0, ""), (2, 6, 6, 0, "a@x,b@x"), (3, 9, 0, 0, "a@x"), (4, 3, 0, 2, "a@x"), (5, 6, 6, 0, "a@x")],
        "id bigint, change_type int, delay_hours int, process_status int, email_to string",
    ).withColumns({c: F.lit(7) for c in ("advertiser_id", "publisher_id", "offer_id", "tsp")})
    source = source.withColumns({c: F.lit("s") for c in (
        "offer_name", "publisher_name", "source", "publisher_account_manager_name", "reasons", "email_cc",
        "email_bcc", "updated_by")})
    source = source.withColumns({c: F.lit(dt.datetime(2024, 1, 15, 8)) for c in ("created_on", "updated_on")})
    tasks = spark.createDataFrame([], A.task_schema())
    state, log = A.run_actions(source, tasks, dt.date(2024, 1, 15), now)
    got = {r["id"]: (r["status"], r["email_sent_on"], len(r["email_to"])) for r in state.collect()}
    assert got == {1: ("success", None, 0), 2: ("registered", now, 2), 3: ("registered", None, 1), 5: ("registered", now, 1)}
    events = sorted((r["task_id"], r["event_type"]) for r in log.collect())
    assert events == [(1, "blocked_tsp"), (2, "email_sent"), (5, "email_sent")]
    later = now + dt.timedelta(hours=6)
    assert A.due(state, later).count() == 0  # the delay must be over, not just reached
    state2, log2 = A.apply_due(state, later + dt.timedelta(seconds=1))
    assert {r["task_id"] for r in log2.collect()} == {2, 5}
    assert state2.filter("status = 'success'").count() == 3
    again, _ = A.run_actions(source, state2, dt.date(2024, 1, 15), later)
    assert again.count() == 4


def test_digest_lines_and_header(spark):
    now = dt.datetime(2024, 1, 15, 12)
    base = spark.createDataFrame(
        [(2, "block_tsp", 1, 12, ["two"]), (1, "block_tsp", 1, 6, ["one"]), (3, None, None, 6, ["x"])],
        "id bigint, change_type string, publisher_id int, delay_hours int, email_to array<string>")
    tasks = base.selectExpr("*", "'registered' status", "cast(null as timestamp) email_sent_on", "email_to email_cc",
                            "email_to email_bcc", "'r' reason", "'a' affpubid", "'o' offer_name", "1 offer_id")
    got = {r["task_id"]: r for r in A.digest(tasks, now).collect()}
    assert got[2]["email_to"] == ["one"] and got[2]["deadline"] == "Jan 15, 2024 7:00 PM CET" and got[2]["mail_lines"] == 2
    assert got[3]["has_content"] is False and len(got) == 3
