"""Live tables of single networks: the merges whose contracts have quirks.

Both sides of each merge come from the orders: the live table has those up to a day,
the staged one those from an earlier day on, with other figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.merge import merge
from adlake.plans.contracts import CONTRACTS
from workload.bindings import VIEWS, Tables, with_views
from workload.registry import query

LIVE_UNTIL, STAGED_FROM = "DATE '1997-06-01'", "DATE '1996-01-01'"
DAY = "CAST(o_orderdate AS DATE)"


def _figure(dtype: str, number: int) -> str:
    """A column's value by its type; ``number`` makes columns differ."""
    figure = f"(o_orderkey * {number} + o_custkey) % 9973"
    return {
        "STRING": f"CONCAT('text ', {figure})", "DOUBLE": f"CAST({figure} AS DOUBLE) / 8", "DATE": DAY,
        "TIMESTAMP": "o_orderdate", "BIGINT": f"CAST({figure} AS BIGINT)",
    }[dtype]


def _side(name: str, given: dict[str, str], named: dict[str, str], where: str, number: int) -> str:
    """SELECT of a table shaped like the contract's; ``given`` states columns, ``named`` other names for them."""
    fields = [column.replace("`", "").split() for column in CONTRACTS[name].schema.split(",")]
    columns = [
        f"{given.get(column) or _figure(dtype, number + i)} AS {named.get(column, column)}"
        for i, (column, dtype) in enumerate(fields)
    ]
    return f"SELECT {', '.join(columns)} FROM {{orders}} WHERE {where}"


def sides(name: str, given: dict[str, str], named: dict[str, str] | None = None, staged: dict[str, str] | None = None) -> str:
    """Define ``live_<name>`` and ``staged_<name>``; the staged side may state columns of its own."""
    VIEWS[f"live_{name}"] = _side(name, given, {}, f"o_orderdate < {LIVE_UNTIL}", 3)
    VIEWS[f"staged_{name}"] = _side(name, {**given, **(staged or {})}, named or {}, f"o_orderdate >= {STAGED_FROM}", 5)
    return with_views(f"live_{name}", f"staged_{name}")


def merged(t: Tables, name: str) -> DataFrame:
    """The live table after the merge its contract says, timestamps without a zone."""
    contract = CONTRACTS[name]
    live = getattr(t, f"live_{name}").to(contract.table_schema())
    table = merge(live, getattr(t, f"staged_{name}"), contract.spec())
    zoned = [f.name for f in contract.table_schema().fields if isinstance(f.dataType, T.TimestampType)]
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _upsert_sql(name: str, keys: str, staged: str, matched: str) -> str:
    """Live rows without a partner, matched rows as ``matched`` says, new rows as ``staged`` says."""
    return f"""
        SELECT l.* FROM live_{name} l ANTI JOIN staged_{name} s USING ({keys})
        UNION ALL BY NAME SELECT {matched} FROM live_{name} l JOIN staged_{name} s USING ({keys})
        UNION ALL BY NAME SELECT {staged} FROM staged_{name} s ANTI JOIN live_{name} l USING ({keys})"""


def _insert_sql(name: str, keys: str, staged: str = "s.*", side: str = "") -> str:
    side = side or f"staged_{name}"
    return f"""
        SELECT * FROM live_{name}
        UNION ALL BY NAME SELECT {staged} FROM {side} s ANTI JOIN live_{name} l USING ({keys})"""


@query(
    "merge_revcontent",
    sides("revcontent", {
        "id": "o_orderkey", "bid_type": "o_orderpriority",
        "target_url": "CASE WHEN o_orderstatus <> 'P' THEN CONCAT('https://x.org/', o_custkey) END",
    }, {"avg_cpv": "avg_vcpm"})
    + _upsert_sql(
        "revcontent", "id, date, target_url, bid_type", "s.* RENAME (avg_vcpm AS avg_cpv)",
        "s.* EXCLUDE (viewable_impressions) RENAME (avg_vcpm AS avg_cpv), s.impressions AS viewable_impressions",
    ),
)
def merge_revcontent(t: Tables) -> DataFrame:
    """An update fills viewable impressions from impressions; rows without a URL never match."""
    return merged(t, "revcontent")


@query(
    "merge_zemanta",
    sides("zemanta", {"account_id": "o_custkey", "campaign_id": "o_orderkey % 50", "ad_group_id": "o_orderkey % 500",
                      "content_ad_id": "o_orderkey"})
    + _upsert_sql(
        "zemanta", "day, account_id, campaign_id, ad_group_id, content_ad_id", "s.*",
        "s.* EXCLUDE (ad_group), l.ad_group",
    ),
)
def merge_zemanta(t: Tables) -> DataFrame:
    """Everything but the ad group's name is refreshed."""
    return merged(t, "zemanta")


_ANALYTICS_NAMES = "click AS clicks, conversion AS conversions, fired_conversion AS fired_conversions, total_rev AS total_revenue"


@query(
    "merge_network_analytics",
    sides("network_analytics", {"offer_id": "o_orderkey", "advertiser_id": "o_custkey", "partner_id": "o_custkey % 7",
                                "tsp": "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 3 END"},
          {"clicks": "click", "conversions": "conversion", "fired_conversions": "fired_conversion",
           "total_revenue": "total_rev"})
    + _upsert_sql(
        "network_analytics", "offer_id, advertiser_id, partner_id, tsp, date", f"s.* RENAME ({_ANALYTICS_NAMES})",
        f"s.* RENAME ({_ANALYTICS_NAMES})",
    ),
)
def merge_network_analytics(t: Tables) -> DataFrame:
    """Figures come under other names; a row without a TSP never matches."""
    return merged(t, "network_analytics")


@query(
    "merge_microsoftads",
    sides("microsoftads", {"account_id": "o_custkey % 40"}) + _insert_sql("microsoftads", "account_id, time_period"),
)
def merge_microsoftads(t: Tables) -> DataFrame:
    """The key is coarser than the rows: of a known account and day nothing more is taken in."""
    return merged(t, "microsoftads")


@query(
    "merge_content_owner_revenue",
    sides("content_owner_revenue", {
        "content_owner": "o_orderpriority", "content_owner_id": "CONCAT('owner ', o_custkey % 5)",
        "report_id": "o_orderkey", "channel_id": "CONCAT('channel ', o_custkey)",
        "video_id": "CASE WHEN o_orderstatus <> 'P' THEN CONCAT('video ', o_orderkey) END",
        "claimed_status": "o_orderstatus", "uploader_type": "'self'", "country_code": "'DE'",
    }, staged={"date": f"CAST(year({DAY}) * 10000 + month({DAY}) * 100 + day({DAY}) AS BIGINT)"})
    + """, dated AS (SELECT * REPLACE (CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE) AS date)
                     FROM staged_content_owner_revenue)"""
    + _insert_sql(
        "content_owner_revenue",
        """content_owner_id, content_owner, report_id, channel_id, video_id, claimed_status, uploader_type,
           country_code, date""", side="dated",
    ),
)
def merge_content_owner_revenue(t: Tables) -> DataFrame:
    """A key of nine columns, one of them a day written as a number."""
    return merged(t, "content_owner_revenue")


@query(
    "merge_fraud_reports",
    sides("fraud_reports", {"report_id": "o_orderkey", "site_id": "o_custkey"}, staged={
        "feedback_inserted_at": f"CONCAT(CAST({DAY} AS VARCHAR(10)), ' 10:00:00 +02:00')",
        "feedback_report_id": "CONCAT(CAST(o_orderkey AS VARCHAR(20)), '.7')",
    })
    + _insert_sql(
        "fraud_reports", "report_id, site_id, inserted_at",
        """s.* REPLACE (CAST(substr(s.feedback_inserted_at, 1, 19) AS TIMESTAMP) - INTERVAL 2 HOUR AS feedback_inserted_at,
                        CAST(round(CAST(s.feedback_report_id AS DOUBLE)) AS BIGINT) AS feedback_report_id)""",
    ),
)
def merge_fraud_reports(t: Tables) -> DataFrame:
    """45 columns; a time with an offset and a fraction come as text."""
    return merged(t, "fraud_reports")
