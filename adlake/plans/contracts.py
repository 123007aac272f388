"""Keys, refreshed columns and schemas of the live tables, as data over ``merge``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

from adlake.operators.merge import MergeSpec


@dataclass(frozen=True)
class Contract:
    """How one live table takes in its staging table.

    ``schema``        the live table's columns (DDL).
    ``on``            merge key.
    ``update``        columns refreshed on a match; None leaves known rows alone.
    ``source``        source expression of columns that are not copied by name.
    ``update_source`` the same, where an update differs from an insert.
    ``not_inserted``  columns left NULL on new rows.
    """

    schema: str
    on: Sequence[str]
    update: Sequence[str] | None = None
    source: Mapping[str, str] = field(default_factory=dict)
    update_source: Mapping[str, str] = field(default_factory=dict)
    not_inserted: Sequence[str] = ()

    def table_schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def spec(self, **overrides) -> MergeSpec:
        columns = self.table_schema().names
        update = None
        if self.update is not None:
            update = {c: self.update_source.get(c, self.source.get(c, c)) for c in self.update}
        settings = {
            "on": list(self.on),
            "update": update,
            "insert": {c: self.source.get(c, c) for c in columns if c not in self.not_inserted},
            "keys": {k: self.source[k] for k in self.on if k in self.source},
        }
        return MergeSpec(**{**settings, **overrides})


COMPACT_DATE = "to_date(cast(`date` as string), 'yyyyMMdd')"

# Columns, keys and refreshed columns of the live tables.
CONTRACTS = {
    "admanager": Contract(
        schema="""date DATE, domain STRING, total_line_item_level_impressions BIGINT,
            total_line_item_level_clicks BIGINT, total_line_item_level_cpm_and_cpc_revenue BIGINT,
            ad_server_impressions BIGINT, ad_server_clicks BIGINT,
            ad_server_cpm_and_cpc_revenue BIGINT,
            ad_server_line_item_level_percent_impressions DOUBLE,
            adsense_line_item_level_impressions BIGINT, adsense_line_item_level_clicks BIGINT,
            adsense_line_item_level_revenue BIGINT, adsense_line_item_level_average_ecpm BIGINT""",
        on=("date", "domain"),
    ),
    "admanager_adx": Contract(
        schema="""ad_exchange_site_name STRING, ad_exchange_date DATE,
            ad_exchange_impressions BIGINT, ad_exchange_clicks BIGINT,
            ad_exchange_estimated_revenue BIGINT, ad_exchange_ad_ecpm BIGINT""",
        on=("ad_exchange_date", "ad_exchange_site_name"),
    ),
    "adsense": Contract(
        schema="""date DATE, domain_name STRING, page_views BIGINT, ad_requests BIGINT,
            ad_requests_coverage DOUBLE, clicks BIGINT, estimated_earnings DOUBLE""",
        on=("date", "domain_name"),
        update=("page_views", "ad_requests", "ad_requests_coverage", "clicks", "estimated_earnings"),
    ),
    "network_analytics": Contract(
        schema="""date DATE, offer_id BIGINT, tsp BIGINT, offer_name STRING, advertiser_id BIGINT,
            advertiser_name STRING, partner_id BIGINT, partner_name STRING, clicks BIGINT,
            conversions BIGINT, cost_approved DOUBLE, cost_pending DOUBLE, cost_rejected DOUBLE,
            revenue_approved DOUBLE, revenue_pending DOUBLE, revenue_rejected DOUBLE,
            profit DOUBLE, epc DOUBLE, fired_conversions BIGINT, margin DOUBLE,
            total_cost DOUBLE, total_revenue DOUBLE""",
        on=("offer_id", "advertiser_id", "partner_id", "tsp", "date"),
        update=(
            "offer_name", "advertiser_name", "partner_name", "clicks", "conversions",
            "cost_approved", "cost_pending", "cost_rejected", "revenue_approved",
            "revenue_pending", "revenue_rejected", "profit", "epc", "fired_conversions",
            "margin", "total_cost", "total_revenue",
        ),
        source={
            "clicks": "click", "conversions": "conversion",
            "fired_conversions": "fired_conversion", "total_revenue": "total_rev",
        },
    ),
    "googleads": Contract(
        schema="""date DATE, account_id BIGINT, account_name STRING, campaign_id BIGINT,
            campaign_name STRING, adgroup_id BIGINT, adgroup_name STRING, final_url STRING,
            impressions BIGINT, clicks BIGINT, cost_micros BIGINT""",
        on=("date", "account_id", "campaign_id", "adgroup_id", "final_url"),
        update=(
            "campaign_name", "adgroup_name", "account_name", "impressions", "clicks", "cost_micros",
        ),
    ),
    "googleanalytics": Contract(
        schema="""view_id BIGINT, date DATE, users BIGINT, new_users BIGINT, sessions BIGINT,
            bounces BIGINT, entrances BIGINT, page_views BIGINT, unique_page_views BIGINT,
            page_load_time DOUBLE""",
        on=("view_id", "date"),
        update=(
            "users", "new_users", "sessions", "bounces", "entrances", "page_views",
            "unique_page_views", "page_load_time",
        ),
        source={
            "date": COMPACT_DATE, "new_users": "newUsers", "page_views": "pageviews",
            "unique_page_views": "uniquePageviews", "page_load_time": "pageLoadTime",
        },
    ),
    # The key is coarser than the rows: later ads of a known account and day are not taken in.
    "microsoftads": Contract(
        schema="""account_name STRING, account_number STRING, account_id BIGINT, time_period DATE,
            campaign_name STRING, campaign_id BIGINT, ad_group_name STRING, ad_group_id BIGINT,
            ad_id BIGINT, currency_code STRING, ad_distribution STRING, destination_url STRING,
            impressions BIGINT, clicks BIGINT, ctr DOUBLE, average_cpc DOUBLE, spend DOUBLE,
            average_position STRING, conversions BIGINT, conversion_rate DOUBLE,
            cost_per_conversion DOUBLE, device_type STRING, language STRING,
            bid_match_type STRING, delivered_match_type STRING, network STRING,
            top_vs_other STRING, device_o_s STRING, assists BIGINT, revenue DOUBLE,
            return_on_ad_spend STRING, cost_per_assist DOUBLE, revenue_per_conversion DOUBLE,
            revenue_per_assist DOUBLE, tracking_template STRING, custom_parameters STRING,
            final_url STRING, final_mobile_url STRING, final_app_url STRING,
            account_status STRING, campaign_status STRING, ad_group_status STRING,
            ad_status STRING, customer_id BIGINT, customer_name STRING, final_url_suffix STRING,
            all_conversions BIGINT, all_revenue DOUBLE, all_conversion_rate DOUBLE,
            all_cost_per_conversion DOUBLE, all_return_on_ad_spend DOUBLE,
            all_revenue_per_conversion DOUBLE, view_through_conversions BIGINT, goal STRING,
            goal_type STRING, absolute_top_impression_rate_percent DOUBLE,
            top_impression_rate_percent DOUBLE, average_cpm DOUBLE""",
        on=("account_id", "time_period"),
    ),
    # An update fills viewable_impressions from impressions, an insert from its own column.
    "revcontent": Contract(
        schema="""bid_type STRING, id BIGINT, date DATE, impressions BIGINT,
            viewable_impressions BIGINT, clicks BIGINT, conversions BIGINT, ctr DOUBLE,
            vctr DOUBLE, avg_cpc DOUBLE, avg_cpv DOUBLE, cost DOUBLE, `return` DOUBLE,
            profit DOUBLE, target_url STRING""",
        on=("id", "date", "target_url", "bid_type"),
        update=(
            "impressions", "viewable_impressions", "clicks", "conversions", "ctr", "vctr",
            "avg_cpc", "avg_cpv", "cost", "return", "profit",
        ),
        source={"avg_cpv": "avg_vcpm"},
        update_source={"viewable_impressions": "impressions"},
    ),
    "taboola_cost": Contract(
        schema="""date DATE, date_end_period DATE, clicks BIGINT, impressions BIGINT,
            visible_impressions BIGINT, spent DOUBLE, conversions_value DOUBLE, roas DOUBLE,
            ctr DOUBLE, vctr DOUBLE, cpm DOUBLE, vcpm DOUBLE, cpc DOUBLE, campaigns_num BIGINT,
            cpa DOUBLE, cpa_clicks DOUBLE, cpa_views DOUBLE, cpa_conversion_rate DOUBLE,
            cpa_conversion_rate_clicks DOUBLE, cpa_conversion_rate_views DOUBLE,
            cpa_actions_num BIGINT, cpa_actions_num_from_clicks BIGINT,
            cpa_actions_num_from_views BIGINT, currency STRING""",
        on=("date", "date_end_period"),
        source={"date": "to_date(`date`)", "date_end_period": "to_date(date_end_period)"},
    ),
    "taboola_revenue": Contract(
        schema="""date DATE, page_views BIGINT, page_views_with_ads BIGINT,
            page_views_with_ads_pct DOUBLE, clicks BIGINT, ctr DOUBLE, ad_cpc DOUBLE,
            ad_rpm DOUBLE, ad_revenue DOUBLE, currency STRING, account_id STRING""",
        on=("date", "account_id"),
        source={"date": "to_date(`date`)"},
    ),
    # The ad group's name is not refreshed.
    "zemanta": Contract(
        schema="""day DATE, account_id BIGINT, account STRING, campaign_id BIGINT,
            campaign STRING, ad_group_id BIGINT, ad_group STRING, content_ad_id BIGINT,
            content_ad STRING, impressions BIGINT, clicks BIGINT, ctr DOUBLE, avg_cpc DOUBLE,
            avg_cpm DOUBLE, media_spend DOUBLE, license_fee DOUBLE, total_spend DOUBLE,
            margin DOUBLE, visits BIGINT, unique_users BIGINT, new_users BIGINT,
            returning_users BIGINT, new_users_pct DOUBLE, pageviews BIGINT,
            pageviews_per_visit BIGINT, bounced_visits BIGINT, non_bounced_visits BIGINT,
            bounce_rate DOUBLE""",
        on=("day", "account_id", "campaign_id", "ad_group_id", "content_ad_id"),
        update=(
            "account", "campaign", "content_ad", "impressions", "clicks", "ctr", "avg_cpc",
            "avg_cpm", "media_spend", "license_fee", "total_spend", "margin", "visits",
            "unique_users", "new_users", "returning_users", "new_users_pct", "pageviews",
            "pageviews_per_visit", "bounced_visits", "non_bounced_visits", "bounce_rate",
        ),
    ),
    # New rows get no event count.
    "daily_stats": Contract(
        schema="""date DATE, offer_id BIGINT, advertiser_id BIGINT, affiliate_id BIGINT,
            tsp BIGINT, country_code STRING, tracker STRING, clicks BIGINT, events BIGINT,
            approved_events BIGINT, rejected_events BIGINT, pending_events BIGINT,
            revenue DOUBLE, payout DOUBLE, profit DOUBLE""",
        on=("date", "offer_id", "advertiser_id", "affiliate_id", "tsp", "country_code"),
        update=(
            "clicks", "events", "approved_events", "rejected_events", "pending_events",
            "revenue", "payout", "profit",
        ),
        not_inserted=("events",),
    ),
    "offers": Contract(
        schema="offer_id BIGINT, offer_name STRING, advertiser_id BIGINT, advertiser_name STRING",
        on=("offer_id",),
        update=("offer_name", "advertiser_id", "advertiser_name"),
        source={"offer_id": "id", "offer_name": "name", "advertiser_name": "advertiser_short"},
    ),
    "content_owner_revenue": Contract(
        schema="""content_owner STRING, content_owner_id STRING, report_id BIGINT, date DATE,
            channel_id STRING, video_id STRING, claimed_status STRING, uploader_type STRING,
            country_code STRING, estimated_partner_revenue DOUBLE,
            estimated_partner_ad_revenue DOUBLE, estimated_partner_ad_auction_revenue DOUBLE,
            estimated_partner_ad_reserved_revenue DOUBLE, estimated_youtube_ad_revenue DOUBLE,
            estimated_monetized_playbacks BIGINT, estimated_playback_based_cpm DOUBLE,
            ad_impressions BIGINT, estimated_cpm DOUBLE, estimated_partner_red_revenue DOUBLE,
            estimated_partner_transaction_revenue DOUBLE""",
        on=(
            "content_owner_id", "content_owner", "report_id", "channel_id", "video_id",
            "claimed_status", "uploader_type", "country_code", "date",
        ),
        source={"date": COMPACT_DATE},
    ),
    "fraud_reports": Contract(
        schema="""external_media_id STRING, external_publisher_id BIGINT, external_site_id STRING,
            external_sub_site_id STRING, impression_data STRING, inserted_at TIMESTAMP,
            name STRING, report_id BIGINT, score BIGINT, site_id BIGINT,
            click_data_base_count BIGINT, click_data_count BIGINT, click_data_givt_count BIGINT,
            click_data_givt_invalid_count BIGINT, click_data_givt_score DOUBLE,
            conversion_data_base_count BIGINT, conversion_data_browser_score DOUBLE,
            conversion_data_count BIGINT, conversion_data_device_model_score DOUBLE,
            conversion_data_flooding_score DOUBLE, conversion_data_givt_count BIGINT,
            conversion_data_givt_invalid_count BIGINT, conversion_data_givt_score DOUBLE,
            conversion_data_hours_score DOUBLE, conversion_data_isp_score DOUBLE,
            conversion_data_language_score DOUBLE, conversion_data_minutes_score DOUBLE,
            conversion_data_platform_platforms STRING, conversion_data_platform_score DOUBLE,
            conversion_data_seconds_score DOUBLE,
            conversion_data_time_to_install_farm_score DOUBLE,
            conversion_data_time_to_install_flooding_ct_score DOUBLE,
            conversion_data_time_to_install_flooding_score DOUBLE,
            conversion_data_time_to_install_flooding_vt_score DOUBLE,
            conversion_data_time_to_install_hijack_score DOUBLE, feedback_classification STRING,
            feedback_inserted_at TIMESTAMP, feedback_memo STRING, feedback_report_id BIGINT,
            feedback_user_name STRING, conversion_data_ip_score DOUBLE,
            conversion_data_new_device_score DOUBLE, conversion_data_carrier_score DOUBLE,
            conversion_data_timezone_score DOUBLE, conversion_data_uid_score DOUBLE""",
        on=("report_id", "site_id", "inserted_at"),
        source={
            "feedback_inserted_at": "to_timestamp(feedback_inserted_at, 'yyyy-MM-dd HH:mm:ss XXX')",
            "feedback_report_id": "cast(feedback_report_id as double)",
        },
    ),
    "daily_report": Contract(
        schema="""year BIGINT, month BIGINT, day BIGINT, value_at DATE, product_key STRING,
            revenues DOUBLE, direct_costs DOUBLE""",
        on=("year", "month", "day", "value_at", "product_key"),
        update=("revenues", "direct_costs"),
    ),
    "report_estimates": Contract(
        schema="""year BIGINT, month BIGINT, day BIGINT, value_at DATE, product_key STRING,
            revenues DOUBLE, direct_costs DOUBLE""",
        on=("year", "month", "day", "value_at", "product_key"),
    ),
}
