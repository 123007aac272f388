"""Bucketed merges, keyed lookups, streams with state, ranges of run dates, digests, ledgers, variants."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators import digests, variants
from adlake.operators.bucketed import Bucketed, lay_out, merge_bucketed
from adlake.operators.merge import MergeSpec
from adlake.operators.quality import Check
from adlake.plans import backfill
from adlake.session import scratch_path
from adlake.sources import keyed, ledger, live, readers, writers
from adlake.streaming import stateful
from adlake.streaming.upserts import stream_insert_keyed
from workload.bindings import Tables, with_views
from workload.merges import LIVE
from workload.registry import ORACLES, query
from workload.reports import REPORT_COLUMNS_SQL, _months, conversion_export


def _schema(t: Tables) -> str:
    name = f"live_{uuid.uuid4().hex}"
    live.open_schema(t.spark, name, scratch_path(t.spark, "live"))
    return name


@query("merge_bucketed", ORACLES["merge_upsert"])
def merge_into_buckets(t: Tables) -> DataFrame:
    """The merge of ``merge_upsert`` into a table bucketed by its key."""
    table = Bucketed(f"{_schema(t)}.stats", ("date", "account_id"), 8)
    lay_out(t.live_v.withColumn("clicks", F.col("clicks").cast("long")), table)
    spec = MergeSpec(
        on=["date", "account_id"],
        update={"clicks": "click", "cost": "total_cost"},
        insert={"date": "date", "account_id": "account_id", "clicks": "click", "cost": "total_cost", "origin": "'staged'"},
    )
    merge_bucketed(t.staged_v, table, spec)
    return t.spark.table(table.name)


@query("merge_bucketed_twice", with_views(*LIVE) + """, s AS (SELECT * FROM staged_v WHERE account_id IS NOT NULL)
       SELECT t.date, t.account_id, CASE WHEN s.date IS NOT NULL THEN s.total_cost ELSE t.cost END AS cost
       FROM live_v t LEFT JOIN s ON t.date = s.date AND t.account_id = s.account_id
       UNION ALL
       SELECT s.date, s.account_id, s.total_cost FROM s
       WHERE NOT EXISTS (SELECT 1 FROM live_v t WHERE t.date = s.date AND t.account_id = s.account_id)""")
def merge_into_buckets_twice(t: Tables) -> DataFrame:
    """Run again, and laid out anew in between: nothing changes."""
    table = Bucketed(f"{_schema(t)}.stats", ("date", "account_id"), 5)
    lay_out(t.live_v.select("date", "account_id", "cost"), table)
    staged = t.staged_v.filter("account_id IS NOT NULL").select("date", "account_id", F.col("total_cost").alias("cost"))
    spec = MergeSpec(on=["date", "account_id"], update={"cost": "cost"})
    merge_bucketed(staged, table, spec)
    lay_out(t.spark.table(table.name), table)
    merge_bucketed(staged, table, spec, [Check("stats", "date", "not_null")])
    return t.spark.table(table.name)


@query("insert_keyed", """SELECT s_suppkey, 'known' AS state FROM supplier WHERE s_acctbal > 2000
       UNION ALL SELECT DISTINCT l_suppkey, 'new' FROM lineitem
       WHERE l_returnflag = 'R' AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000)""")
def insert_keyed(t: Tables) -> DataFrame:
    """Suppliers of returned lines join those known; the second run adds none."""
    path = f"{scratch_path(t.spark, 'keyed')}/table"
    known = t.supplier.filter("s_acctbal > 2000").select("s_suppkey", F.lit("known").alias("state"))
    keyed.write_keyed(known, path, "s_suppkey")
    batch = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"), F.lit("new").alias("state"))
    for _ in range(2):
        keyed.insert_keyed(batch, path, "s_suppkey")
    return t.spark.read.schema(known.schema).parquet(path)


def _files(t: Tables, name: str) -> DataFrame:
    """A table as a stream of the files that hold it."""
    schema = getattr(t, name).schema
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(f"{t.folder}/{name}.parquet*")


@query("stream_ingest_keyed", """SELECT c_custkey AS id, 'known' AS state FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT DISTINCT o_custkey, 'new' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def stream_ingest_keyed(t: Tables) -> DataFrame:
    base = scratch_path(t.spark, "stream")
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.lit("known").alias("state"))
    keyed.write_keyed(known, f"{base}/table", "id")
    rows = _files(t, "orders").select(F.col("o_custkey").alias("id"), F.lit("new").alias("state"))
    stream_insert_keyed(rows, f"{base}/table", "id", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.schema(known.schema).parquet(f"{base}/table")


@query("stream_first_seen", """SELECT o_orderkey AS id, 'known' AS state FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT DISTINCT l_orderkey, 'new' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def stream_first_seen(t: Tables) -> DataFrame:
    """Of an order's lines only the first reaches the table, which then decides by its keys."""
    base = scratch_path(t.spark, "stream")
    known = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("at"), F.lit("known").alias("state")
    )
    writers.write_parquet(known, f"{base}/table")
    rows = _files(t, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("timestamp").alias("at"), F.lit("new").alias("state")
    )
    stateful.stream_ingest(rows, f"{base}/table", "id", "at", "4000 days", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.schema(known.schema).parquet(f"{base}/table").select("id", "state")


@query("stream_trailing_statistics", """SELECT CAST(ts AS DATE) AS date, event_type, CAST(COUNT(*) AS BIGINT) AS events,
              CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
       FROM events WHERE ts IS NOT NULL GROUP BY 1, 2
       UNION ALL SELECT DATE '2000-01-01', 'before', 7, 7""")
def stream_trailing_statistics(t: Tables) -> DataFrame:
    """Events by day and type, kept up to date in a table that has an older day."""
    base = scratch_path(t.spark, "stream")
    old = t.spark.createDataFrame([(dt.date(2000, 1, 1), "before", 7, 7)], "date date, event_type string, events long, cents long")
    writers.write_parquet(old, f"{base}/table", ["date"])
    rows = _files(t, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    measures = {"events": F.count(F.lit(1)), "cents": F.sum(F.round(F.col("value") * 100).cast("long"))}
    statistics = stateful.trailing_statistics(rows, "ts", ["event_type"], measures, "400 days")
    for _ in range(2):  # the second start finds nothing new
        stateful.stream_statistics(statistics, f"{base}/table", ["event_type"], f"{base}/checkpoint").awaitTermination()
    return t.spark.read.schema(old.schema).parquet(f"{base}/table")


RANGE = dt.date(1998, 6, 20), dt.date(1998, 7, 25)
_DAYS = f"days AS (SELECT CAST(unnest(generate_series(DATE '{RANGE[0]}', DATE '{RANGE[1]}', INTERVAL 1 DAY)) AS DATE) AS d)"


def _range_sql(key: str, shares: str) -> str:
    return f""", {_DAYS}, shares AS ({shares})
    SELECT {REPORT_COLUMNS_SQL.format(d='d')}, '{key}' AS product_key,
           CAST(round(SUM(CAST(revenue / allocation AS DECIMAL(24,8))), 2) AS DOUBLE) AS revenues,
           CAST(round(SUM(CAST(revenue * 0.7 / allocation AS DECIMAL(24,8))), 2) AS DOUBLE) AS direct_costs
    FROM shares GROUP BY d"""


_SERVICE = _months("created_at", "period_start", "period_end")
_AGENCY_SERVICE = f"CASE WHEN end_at > last_day(created_at) THEN {_months('created_at', 'start_at', 'end_at')} ELSE 1 END"
_UNCANCELLED = """fastbill_invoice_number IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cancellations c
    WHERE c.individual_campaign_id = i.id AND c.cancelled_at BETWEEN date_trunc('month', d) AND last_day(d))"""


@query("invoice_range_marketplace", with_views("invoices") + _range_sql("RH-marketplace-total", f"""
    SELECT d, CAST(total AS DECIMAL(18,2)) / 100 AS revenue, CASE WHEN period_end > last_day(created_at) THEN {_SERVICE} ELSE 1 END AS allocation
    FROM invoices JOIN days ON CAST(created_at AS DATE) = d
    WHERE fastbill_invoice_url IS NOT NULL AND (canceled_at IS NULL OR canceled_at > last_day(d))
      AND (period_start < last_day(created_at) OR period_start IS NULL)
    UNION ALL
    SELECT d, CAST(total AS DECIMAL(18,2)) / 100, {_SERVICE} * day(last_day(d))
    FROM invoices JOIN days ON created_at < date_trunc('month', d) AND period_start <= last_day(d) AND period_end >= date_trunc('month', d)
    WHERE fastbill_invoice_url IS NOT NULL AND (canceled_at IS NULL OR canceled_at > last_day(d))"""))
def invoice_range_marketplace(t: Tables) -> DataFrame:
    return backfill.marketplace_range(t.invoices, *RANGE)


@query("invoice_range_agency", with_views("invoicing", "cancellations") + _range_sql("RH-agency-total", f"""
    SELECT d, CAST(total_cost AS DECIMAL(12,2)) AS revenue, {_AGENCY_SERVICE} AS allocation
    FROM invoicing i JOIN days ON CAST(fastbill_invoice_created_at AS DATE) = d
    WHERE {_UNCANCELLED} AND (start_at < last_day(fastbill_invoice_created_at) OR start_at IS NULL)
    UNION ALL
    SELECT d, CAST(total_cost AS DECIMAL(12,2)), {_AGENCY_SERVICE} * day(last_day(d))
    FROM invoicing i JOIN days ON fastbill_invoice_created_at < date_trunc('month', d) AND start_at <= last_day(d) AND end_at >= date_trunc('month', d)
    WHERE {_UNCANCELLED}"""))
def invoice_range_agency(t: Tables) -> DataFrame:
    return backfill.agency_range(t.invoicing, t.cancellations, *RANGE)


@query("load_checked", """SELECT o_orderkey, o_orderpriority, CAST(NULL AS BIGINT) AS refused FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       UNION ALL SELECT NULL, 'refused', CAST(COUNT(*) AS BIGINT) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""")
def load_checked(t: Tables) -> DataFrame:
    """A load whose rows hold; then one that fails leaves the table as it was and says how many rows failed."""
    name = f"{_schema(t)}.orders"
    checks = [Check("orders", "o_orderkey", "not_null"), Check("orders", "o_orderpriority", "accepted_values", ["1-URGENT", "2-HIGH"])]
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    live.publish(rows.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')"), name, checks)
    try:
        live.publish(rows, name, checks)
        refused = 0
    except live.CheckFailed as problem:
        refused = problem.failures["o_orderpriority accepted_values"]
    note = t.spark.createDataFrame([(None, "refused", refused)], "o_orderkey long, o_orderpriority string, refused long")
    return t.spark.table(name).withColumn("refused", F.lit(None).cast("long")).unionByName(note)


@query("reload_changed", """SELECT o_orderkey, year(o_orderdate) AS order_year, CASE WHEN year(o_orderdate) = 1996 AND o_orderstatus = 'P' THEN o_totalprice + 1
              ELSE o_totalprice END AS price, CAST(CASE WHEN EXISTS (SELECT 1 FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'P') THEN 1 ELSE 0 END AS BIGINT) AS rewritten
       FROM orders""")
def reload_changed(t: Tables) -> DataFrame:
    """Of three years that are loaded again, the one with other prices is rewritten."""
    path = f"{scratch_path(t.spark, 'reload')}/table"
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"), F.col("o_totalprice").alias("price"), "o_orderstatus")
    plain = rows.drop("o_orderstatus")
    writers.write_parquet(plain, path, ["order_year"])
    dearer = F.when((F.col("order_year") == 1996) & (F.col("o_orderstatus") == "P"), F.col("price") + 1).otherwise(F.col("price"))
    again = rows.filter("order_year BETWEEN 1995 AND 1997").withColumn("price", dearer).drop("o_orderstatus")
    rewritten = digests.reload_partitions(t.spark, path, again.select(plain.columns), "order_year")
    return t.spark.read.schema(plain.schema).parquet(path).withColumn("rewritten", F.lit(rewritten).cast("long"))


@query("report_ledger", """SELECT c_custkey, c_name, CAST(CASE WHEN c_nationkey < 10 THEN 1 ELSE 2 END AS INTEGER) AS run FROM customer
       UNION ALL SELECT c_custkey, c_name, 3 FROM customer WHERE FALSE""")
def report_ledger(t: Tables) -> DataFrame:
    """Three runs over a folder of reports: each reads what landed since the run before; the last finds nothing."""
    base = scratch_path(t.spark, "landed")
    schema = T.StructType.fromDDL("c_custkey BIGINT, c_name STRING")
    found = []
    for run, part in enumerate(("c_nationkey < 10", "c_nationkey >= 10", None), 1):
        if part:
            writers.write_csv(t.customer.filter(part).select("c_custkey", "c_name"), f"{base}/in/run {run}")
        new = ledger.NewFiles(t.spark, f"{base}/in", f"{base}/ledger", "*.csv")
        if new.paths:
            manifest = new.files.select("file_path", F.lit(run).alias("run"))
            found.append(readers.read_reports(t.spark, manifest, new.paths, schema)[0].drop("file_path"))
        new.done()
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows


@query("report_rejects_counted", """SELECT CASE s_nationkey % 4 WHEN 1 THEN 'x' WHEN 2 THEN 'empty' END AS kind, 'a row has too many fields' AS reason, CAST(COUNT(*) AS BIGINT) AS bad_rows
       FROM supplier WHERE s_nationkey % 4 IN (1, 2) GROUP BY 1
       UNION ALL SELECT 'kept', NULL, CAST(COUNT(*) AS BIGINT) FROM supplier WHERE s_nationkey % 4 IN (0, 3)""")
def report_rejects_counted(t: Tables) -> DataFrame:
    """Reports of many files: rows with a cell too many behind an empty one, with an empty one too many, short ones and right ones."""
    base = scratch_path(t.spark, "reports")
    tails = {"right": ",{}", "x": ",{},,x", "empty": ",{},", "short": ""}
    for number, (kind, tail) in enumerate(tails.items()):
        line = F.concat(F.col("s_suppkey").cast("string"), *([F.lit(","), F.col("s_acctbal").cast("string"), F.lit(tail[3:])] if tail else []))
        rows = t.supplier.filter(F.col("s_nationkey") % 4 == number).select(line.alias("s_suppkey,s_acctbal"))
        rows.write.option("header", True).option("quote", "").csv(f"{base}/{kind}")
    files = ledger.listed(t.spark, base, "*.csv")
    kind = F.element_at(F.split("file_path", "/"), -2)
    manifest = files.select("file_path", kind.alias("kind"))
    schema = T.StructType.fromDDL("s_suppkey BIGINT, s_acctbal DOUBLE")
    kept, out = readers.read_reports(t.spark, manifest, [f"{base}/{k}" for k in tails], schema)
    rejected = out.groupBy(kind.alias("kind"), "reason").agg(F.sum("bad_rows").alias("bad_rows"))
    count = kept.groupBy(F.lit("kept").alias("kind")).agg(F.count(F.lit(1)).alias("bad_rows"))
    return rejected.unionByName(count.withColumn("reason", F.lit(None).cast("string")))


@query("payload_variants", """SELECT o_orderkey AS id, CAST(o_orderkey % 2 + 1 AS INTEGER) AS version, o_totalprice AS total,
              CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS status FROM orders WHERE o_orderkey % 10 <> 0
       UNION ALL SELECT NULL, CAST(o_orderkey % 2 + 1 AS INTEGER), NULL, NULL FROM orders WHERE o_orderkey % 10 = 0""")
def payload_variants(t: Tables) -> DataFrame:
    """Payloads of two versions, the first with its total as text, and some that are no JSON."""
    odd = F.col("o_orderkey") % 2 == 1
    first = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("string").alias("total")))
    amount = F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("state"))
    second = F.to_json(F.struct(F.struct(F.col("o_orderkey").alias("id")).alias("order"), amount.alias("amount")))
    body = F.when(F.col("o_orderkey") % 10 == 0, "no json {").when(odd, second).otherwise(first)
    rows = t.orders.select((F.col("o_orderkey") % 2 + 1).cast("int").alias("version"), body.alias("body"))
    wanted = {"id": (["$.order.id", "$.id"], "long"), "total": (["$.amount.total", "$.total"], "double"), "status": ("$.amount.state", "string")}
    return variants.fields(variants.parsed(rows, "body"), "payload", wanted, ["version"])


@query("payload_records", """SELECT o_orderkey AS id, l_linenumber AS line, l_quantity AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'""")
def payload_records(t: Tables) -> DataFrame:
    """Arrays inside payloads, one row for each element; a payload without the array gives none."""
    line = F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.collect_list(line)).alias("lines"))  # a handful for each order
    bodies = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('{"data": {"lines": '), "lines", F.lit("}}"))).otherwise("{}").alias("body"),
    )
    records = variants.records(variants.parsed(bodies, "body"), "payload", "$.data.lines", ["id"])
    return variants.fields(records, "record", {"line": ("$.line", "int"), "quantity": ("$.quantity", "double")}, ["id"])


@query("export_table_csv", ORACLES["conversion_export"])
def export_table_csv(t: Tables) -> DataFrame:
    """The export as a replaced table, that table as CSV, the table dropped, and the CSV read back."""
    base, name = scratch_path(t.spark, "export"), f"t_{uuid.uuid4().hex}"
    rows = conversion_export(t)
    for _ in range(2):  # the second load replaces the first
        writers.replace_table(rows, name, path=f"{base}/table")
    writers.write_csv(t.spark.table(name), f"{base}/csv")
    schema = t.spark.table(name).schema
    writers.drop_table(t.spark, name)
    if t.spark.catalog.tableExists(name):
        raise ValueError(f"{name} is still there")
    return readers.read_csv(t.spark, f"{base}/csv", schema)
