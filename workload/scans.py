"""Sources, sinks and payload normalisers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.schema import (
    add_missing, after_dot_lower, conform, rename_headers, snake_case, strip_prefix,
)
from adlake.operators import payloads as P
from adlake.operators import relational as R
from adlake.session import scratch_path
from adlake.sources import click_log, readers, writers
from workload.bindings import Tables
from workload.registry import query

CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _customer_sql(nation_type: str) -> str:
    return f"""SELECT c_custkey, c_name, CAST(c_nationkey AS {nation_type}) AS c_nationkey,
                      c_acctbal, c_mktsegment FROM customer"""


@query("scan_csv_inferred", _customer_sql("INTEGER"))
def scan_csv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.customer, path)
    return readers.read_csv(t.spark, path)


@query("scan_csv_declared", _customer_sql("INTEGER"))
def scan_csv_declared(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    # Positional: the declared names win over the file's header.
    writers.write_csv(t.customer.toDF("A", "B", "C", "D", "E"), path)
    return readers.read_csv(t.spark, path, CUSTOMER_DDL)


@query("scan_csv_headerless", _customer_sql("INTEGER"))
def scan_csv_headerless(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    t.customer.write.option("header", False).csv(path)
    return readers.read_csv(t.spark, path, CUSTOMER_DDL, header=False)


@query(
    "scan_csv_multiline",
    """SELECT p_partkey, CONCAT(p_name, chr(10), '"', p_brand, '", second line') AS note, p_retailprice
       FROM part""",
)
def scan_csv_multiline(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    note = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('", second line'))
    writers.write_csv(t.part.select("p_partkey", note.alias("note"), "p_retailprice"), path)
    return readers.read_csv(
        t.spark, path, "p_partkey BIGINT, note STRING, p_retailprice DOUBLE", multiline=True
    )


@query("scan_ndjson", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_ndjson(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ndjson")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    writers.write_ndjson(t.orders.select(columns), path)
    return readers.read_ndjson(t.spark, path).select(columns)


@query(
    "roundtrip_csv",
    """SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, s_acctbal FROM supplier""",
)
def roundtrip_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    writers.write_csv(t.supplier, path)
    return readers.read_csv(t.spark, path, t.supplier.schema)


@query("roundtrip_ndjson", _customer_sql("INTEGER"))
def roundtrip_ndjson(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "ndjson")
    writers.write_ndjson(t.customer, path)
    return readers.read_ndjson(t.spark, path, t.customer.schema)


def _reports(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Reports by balance in folders with a blank; those of the highest band have a field too many."""
    base = scratch_path(t.spark, "reports")
    balance = F.col("s_acctbal")
    group = F.when(balance < 2000, 0).when(balance < 6000, 1).otherwise(2)
    for number in range(3):
        part = t.supplier.filter(group == number).select(F.concat_ws(",", "s_suppkey", "s_acctbal", *[F.lit("x")] * (number == 2)).alias("s_suppkey,s_acctbal"))
        part.write.option("header", True).option("quote", "").csv(f"{base}/of {number}")
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(base)
    path = F.regexp_replace("path", "^file:/+", "/")
    number = F.regexp_extract("path", "of (\\d)/", 1).cast("long")
    manifest = files.select(
        path.alias("file_path"), F.concat(F.lit("owner "), number).alias("content_owner"),
        F.concat(F.lit("id-"), number).alias("content_owner_id"), (number + 100).alias("report_id"),
    )
    schema = T.StructType.fromDDL("s_suppkey BIGINT, s_acctbal DOUBLE")
    return readers.read_reports(t.spark, manifest, [f"{base}/of {n}" for n in range(3)], schema)


@query(
    "report_union_lineage",
    """SELECT s_suppkey, s_acctbal, CASE WHEN s_acctbal < 2000 THEN 'owner 0' ELSE 'owner 1' END AS content_owner,
              CASE WHEN s_acctbal < 2000 THEN 'id-0' ELSE 'id-1' END AS content_owner_id,
              CAST(CASE WHEN s_acctbal < 2000 THEN 100 ELSE 101 END AS BIGINT) AS report_id
       FROM supplier WHERE s_acctbal < 6000""",
)
def report_union_lineage(t: Tables) -> DataFrame:
    return _reports(t)[0].drop("file_path")


@query(
    "report_rejects",
    """SELECT DISTINCT '2' AS report, 'a row has too many fields' AS reason FROM supplier WHERE s_acctbal >= 6000""",
)
def report_rejects(t: Tables) -> DataFrame:
    return _reports(t)[1].select(F.regexp_extract("file_path", "of (\\d)/", 1).alias("report"), "reason").distinct()


@query(
    "recent_report_semi_join",
    """SELECT l_orderkey AS report_id, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                            WHERE o_orderdate >= TIMESTAMP '1998-07-15 00:00:00' - INTERVAL '3' DAY)""",
)
def recent_report_semi_join(t: Tables) -> DataFrame:
    sites = t.lineitem.select(F.col("l_orderkey").alias("report_id"), "l_linenumber", "l_extendedprice")
    reports = t.orders.select(F.col("o_orderkey").alias("report_id"), F.col("o_orderdate").alias("updated_at"))
    run = F.lit("1998-07-15 00:00:00").cast("timestamp_ntz")
    return R.recent_only(sites, reports, run)


@query(
    "partition_pruned_scan",
    """SELECT event_id, event_type, value FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-16'""",
)
def partition_pruned_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-by-day")
    writers.write_parquet(writers.with_day(t.events, "ts"), path, ["dt"])
    by_day = t.spark.read.parquet(path)
    days = readers.partition_window(by_day, "dt", dt.date(2024, 1, 14), dt.date(2024, 1, 16))
    return days.select("event_id", "event_type", "value")


def _table(t: Tables) -> tuple[str, str]:
    return f"t_{uuid.uuid4().hex}", scratch_path(t.spark, "table")


@query("truncate_load", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def truncate_load(t: Tables) -> DataFrame:
    name, path = _table(t)
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.replace_table(rows, name, path=path)
    writers.replace_table(rows, name, path=path)
    return t.spark.table(name)


@query(
    "append_conformed",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(round(o_totalprice) AS BIGINT) AS price,
              CAST(NULL AS VARCHAR) AS note
       FROM orders
       UNION ALL
       SELECT l_orderkey, CAST(l_shipdate AS DATE), CAST(round(l_extendedprice) AS BIGINT), NULL FROM lineitem""",
)
def append_conformed(t: Tables) -> DataFrame:
    name, path = _table(t)
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_orderdate DATE, price BIGINT, note STRING")
    writers.ensure_table(t.spark, name, schema, path=path)
    orders = t.orders.select("o_orderdate", "o_orderkey", F.col("o_totalprice").alias("price"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_shipdate").alias("o_orderdate"),
        F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("not_declared"),
    )
    writers.append_table(orders, name, schema)
    writers.append_table(lines, name, schema)
    return t.spark.table(name)


@query(
    "ensure_table",
    """SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer
       UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
)
def ensure_table(t: Tables) -> DataFrame:
    """Rows loaded before a column was added show it as NULL."""
    name, path = _table(t)
    for columns in (["c_custkey", "c_name"], ["c_custkey", "c_name", "c_acctbal"]):
        rows = t.customer.select(columns)
        writers.ensure_table(t.spark, name, rows.schema, path=path)
        writers.append_table(rows, name)
    return t.spark.table(name)


def _clicks(t: Tables) -> DataFrame:
    """Events in the nested shape of the click log."""
    text = {n: F.col(c).cast("string") for n, c in {"id": "event_id", "user": "user_id"}.items()}
    score = (F.col("event_id") % 10).cast("long")

    def strategy(name: str, points, reason) -> Column:
        return F.struct(
            F.lit(name).alias("strategy"), points.alias("score"),
            F.when(points > 5, "reject").otherwise("accept").alias("decision"), reason.alias("reason"),
        )

    pair = F.struct(F.lit("type").alias("key"), F.array("event_type", F.concat("event_type", F.lit("!"))).alias("value"))
    user = F.struct(F.lit("user").alias("key"), F.array(text["user"]).alias("value"))
    rows = t.events.select(
        text["id"].alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("ts").cast("timestamp").alias("sent_at"),
        F.col("user_id").alias("service_id"),
        F.struct(
            score.alias("score"), F.lit(None).cast("string").alias("fingerprint"),
            F.lit(None).cast("string").alias("redirect_url"), F.lit(None).cast("string").alias("token"),
            F.array(
                strategy("geo", score, F.col("event_type")),
                strategy("speed", score + 3, F.lit(None).cast("string")),
            ).alias("strategies"),
            F.lit("accept").alias("decision"), F.lit("redirect").alias("action"),
        ).alias("processing_result"),
        F.struct(
            F.concat(F.lit("/c/"), text["id"]).alias("url"),
            F.array(F.struct(F.lit("props").alias("key"), F.col("props").alias("value"))).alias("headers"),
            F.array(pair, user).alias("parameters"), F.lit(None).cast("string").alias("remote_address"),
        ).alias("request"),
        F.struct(
            F.lit(None).cast("string").alias("device_os_version"), (F.col("user_id") % 2 == 0).alias("is_mobile"),
            *[F.lit(None).cast("string").alias(c) for c in ("mobile_browser", "device_os", "model_name", "brand_name")],
        ).alias("device"),
        F.struct(F.array(user).alias("applied_whitelists"), F.lit(False).alias("is_whitelisted")).alias("whitelisting_result"),
    )
    return conform(rows, click_log.click_log_schema())


@query(
    "nested_table_roundtrip",
    """SELECT CAST(event_id AS VARCHAR) AS id, ts, CAST(ts AS DATE) AS dt, user_id AS service_id,
              event_id % 10 AS score, CONCAT('/c/', event_id) AS url, props AS first_header,
              user_id % 2 = 0 AS is_mobile, CAST(2 AS BIGINT) AS n_parameters
       FROM events""",
)
def nested_table_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "clicks")
    click_log.write_click_log(_clicks(t), path)
    return click_log.read_click_log(t.spark, path).select(
        "id", F.col("ts").cast("timestamp_ntz").alias("ts"), "dt", "service_id",
        F.col("processing_result.score").alias("score"), F.col("request.url").alias("url"),
        F.col("request.headers")[0]["value"].alias("first_header"),
        F.col("device.is_mobile").alias("is_mobile"),
        F.size("request.parameters").cast("long").alias("n_parameters"),
    )


@query(
    "nested_explode",
    """WITH s AS (
         SELECT event_id, user_id, event_type, 'geo' AS strategy, event_id % 10 AS score, event_type AS reason FROM events
         UNION ALL
         SELECT event_id, user_id, event_type, 'speed', event_id % 10 + 3, NULL FROM events)
       SELECT CAST(event_id AS VARCHAR) AS click_id, strategy, score,
              CASE WHEN score > 5 THEN 'reject' ELSE 'accept' END AS decision, reason,
              CONCAT(event_type, '!') AS second_type, CAST(user_id AS VARCHAR) AS first_user
       FROM s""",
)
def nested_explode(t: Tables) -> DataFrame:
    clicks = _clicks(t)
    maps = click_log.parameters_map(clicks).select(
        "click_id",
        F.col("parameters")["type"][1].alias("second_type"),
        F.col("parameters")["user"][0].alias("first_user"),
    )
    return click_log.strategies(clicks).join(maps, "click_id")


@query(
    "flatten_struct",
    """SELECT o_orderkey AS id, o_custkey AS customer_id, c_name AS customer_name,
              n_name AS customer_nation_name, o_orderstatus, o_orderstatus AS state
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def flatten_struct(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    nested = rows.select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("name")).alias("nation"),
        ).alias("customer"),
        F.struct(F.col("o_orderstatus").alias("orderstatus")).alias("o"),
    )
    by_path = {"id2": "id", "state": "o.orderstatus"}
    projected = P.project_paths(nested, by_path)
    return P.flatten(nested).join(projected, F.col("id") == F.col("id2")).drop("id2")


@query(
    "explode_records",
    """SELECT o_orderkey AS id, 'price' AS kind, o_totalprice AS amount, 'acc-1' AS account_id FROM orders
       UNION ALL SELECT o_orderkey, 'half', o_totalprice / 2, 'acc-1' FROM orders WHERE o_orderstatus <> 'P'""",
)
def explode_records(t: Tables) -> DataFrame:
    def record(kind: str, amount) -> Column:
        return F.struct(F.col("o_orderkey").alias("id"), F.lit(kind).alias("kind"), amount.alias("amount"))

    price, half = record("price", F.col("o_totalprice")), record("half", F.col("o_totalprice") / 2)
    results = F.when(F.col("o_orderstatus") == "P", F.array(price)).otherwise(F.array(price, half))
    payload = t.orders.select(F.struct(results.alias("results")).alias("data"))
    return P.explode_records(payload, "data.results", account_id="acc-1")


@query(
    "headers_cells_zip",
    """SELECT CAST(c_custkey AS VARCHAR) AS domain_name, c_name AS page_views, CAST(NULL AS VARCHAR) AS absent FROM customer
       UNION ALL SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR), NULL FROM customer""",
)
def headers_cells_zip(t: Tables) -> DataFrame:
    def cells(*values) -> Column:
        return F.struct(F.array(*[F.struct(v.alias("value")) for v in values]).alias("cells"))

    headers = F.array(*[F.struct(F.lit(n).alias("name")) for n in ("DOMAIN_NAME", "PAGE_VIEWS")])
    rows = F.array(
        cells(F.col("c_custkey").cast("string"), F.col("c_name")),
        cells(F.col("c_mktsegment"), F.col("c_nationkey").cast("string")),
    )
    payload = t.customer.select(headers.alias("headers"), rows.alias("rows"))
    return P.zip_headers_cells(payload, ["domain_name", "page_views", "absent"])


@query(
    "dim_metric_zip",
    """SELECT o_custkey AS view_id, strftime(o_orderdate, '%Y%m%d') AS date, o_orderkey AS users,
              o_totalprice AS "pageLoadTime", CAST(NULL AS DOUBLE) AS "timeOnPage"
       FROM orders""",
)
def dim_metric_zip(t: Tables) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(k).alias("type"))
        for n, k in (("ga:users", "INTEGER"), ("ga:timeOnPage", "TIME"), ("ga:pageLoadTime", "FLOAT"))
    ])
    values = F.array(F.col("o_orderkey").cast("string"), F.lit("00:10"), F.col("o_totalprice").cast("string"))
    row = F.struct(
        F.array(F.date_format("o_orderdate", "yyyyMMdd")).alias("dimensions"),
        F.array(F.struct(values.alias("values"))).alias("metrics"),
    )
    report = F.struct(
        F.struct(
            F.array(F.lit("ga:date")).alias("dimensions"),
            F.struct(entries.alias("metricHeaderEntries")).alias("metricHeader"),
        ).alias("columnHeader"),
        F.struct(F.array(row).alias("rows")).alias("data"),
    )
    payload = t.orders.select(F.col("o_custkey").alias("view_id"), F.array(report).alias("reports"))
    wanted = {"ga:users": "INTEGER", "ga:pageLoadTime": "FLOAT", "ga:timeOnPage": "FLOAT"}
    return rename_headers(P.dim_metric_report(payload, ["ga:date"], wanted), strip_prefix("ga:"))


@query(
    "lookup_title_or_null",
    """SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS advertiser_id,
              CASE WHEN o_orderstatus <> 'P' THEN c_name END AS advertiser_name
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def lookup_title_or_null(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    items = rows.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("AdvertiserId"),
        F.struct(F.col("c_name").alias("Title")).alias("Advertiser"),
    )
    return P.lookup_titles(items, {"advertiser": ("AdvertiserId", "Advertiser")})


@query(
    "rename_headers",
    """SELECT p_partkey AS ad_unit, p_name AS device_o_s, p_brand AS users, p_size AS new_users_pct FROM part""",
)
def rename_with_rules(t: Tables) -> DataFrame:
    df = t.part.select(
        F.col("p_partkey").alias("Dimension.AD_UNIT"), F.col("p_name").alias("DeviceOS"),
        F.col("p_brand").alias("ga:users"), F.col("p_size").alias("% New Users"),
    )
    rules = [
        lambda c: after_dot_lower(c) if "." in c else c,
        lambda c: snake_case(c) if c == "DeviceOS" else c,
        strip_prefix("ga:"),
        {"% New Users": "new_users_pct"},
    ]
    for rule in rules:
        df = rename_headers(df, rule)
    return df


@query(
    "conform_schema",
    """SELECT p_partkey, CAST(NULL AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS memo, p_name AS extra FROM part""",
)
def conform_schema(t: Tables) -> DataFrame:
    declared = T.StructType.fromDDL("p_partkey BIGINT, score DOUBLE, memo STRING")
    return add_missing(t.part.select("p_partkey", F.col("p_name").alias("extra")), declared)


@query("dedupe_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def dedupe_rows(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    return R.dedupe(rows.unionByName(rows))


@query(
    "union_by_name",
    """SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, CAST(NULL AS BIGINT) AS size FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
       UNION ALL SELECT p_partkey, p_name, NULL, p_size FROM part""",
)
def union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = t.supplier.select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("k")
    )
    parts = t.part.select(
        F.col("p_size").cast("long").alias("size"), F.col("p_partkey").alias("k"), F.col("p_name").alias("name")
    )
    return R.union_all(customers, suppliers, parts)


@query(
    "left_join_lookup",
    """SELECT DISTINCT l_partkey AS id, l_suppkey, l_returnflag, p_name AS target_url
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 30) ON l_partkey = p_partkey""",
)
def left_join_lookup(t: Tables) -> DataFrame:
    performance = t.lineitem.select(F.col("l_partkey").alias("id"), "l_suppkey", "l_returnflag")
    urls = t.part.filter("p_size < 30").select(
        F.col("p_partkey").alias("boost_id"), F.col("p_name").alias("target_url")
    )
    return R.attach_lookup(performance, urls, "id", "boost_id")
