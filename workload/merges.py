"""The MERGE family."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.merge import MergeSpec, insert_if_absent, merge, merge_into_partitions, upsert_by_pk
from adlake.session import scratch_path
from adlake.sources.writers import write_parquet
from workload.bindings import Tables, with_views
from workload.registry import query

LIVE = "live_v", "staged_v"


@query(
    "merge_upsert",
    with_views(*LIVE)
    + """SELECT t.date, t.account_id, CAST(COALESCE(s.click, t.clicks) AS BIGINT) AS clicks,
                CASE WHEN s.date IS NOT NULL THEN s.total_cost ELSE t.cost END AS cost, t.origin
         FROM live_v t LEFT JOIN staged_v s ON t.date = s.date AND t.account_id = s.account_id
         UNION ALL
         SELECT s.date, s.account_id, s.click, s.total_cost, 'staged' FROM staged_v s
         WHERE NOT EXISTS (SELECT 1 FROM live_v t WHERE t.date = s.date AND t.account_id = s.account_id)""",
)
def merge_upsert(t: Tables) -> DataFrame:
    """NULL accounts never match, so theirs are inserted next to the existing ones."""
    spec = MergeSpec(
        on=["date", "account_id"],
        update={"clicks": "click", "cost": "total_cost"},
        insert={"date": "date", "account_id": "account_id", "clicks": "click", "cost": "total_cost",
                "origin": "'staged'"},
    )
    return merge(t.live_v, t.staged_v, spec)


@query(
    "merge_insert_only",
    with_views(*LIVE)
    + """SELECT date, account_id, CAST(clicks AS BIGINT) AS clicks, cost, origin FROM live_v
         UNION ALL
         SELECT s.date, s.account_id, s.click, s.total_cost, NULL FROM staged_v s
         WHERE NOT EXISTS (SELECT 1 FROM live_v t WHERE t.date IS NOT DISTINCT FROM s.date
                           AND t.account_id IS NOT DISTINCT FROM s.account_id)""",
)
def merge_insert_only(t: Tables) -> DataFrame:
    """With NULL-safe keys and a column (origin) the insert does not name."""
    spec = MergeSpec(
        on=["date", "account_id"], null_safe=True,
        insert={"date": "date", "account_id": "account_id", "clicks": "click", "cost": "total_cost"},
    )
    return merge(t.live_v, t.staged_v, spec)


@query(
    "merge_derived_key",
    with_views(*LIVE)
    + """SELECT date, account_id, CAST(clicks AS BIGINT) AS clicks, cost FROM live_v
         UNION ALL
         SELECT s.date, s.account_id, s.click, s.total_cost FROM staged_v s
         WHERE NOT EXISTS (SELECT 1 FROM live_v t WHERE t.date = s.date AND t.account_id = s.account_id)""",
)
def merge_derived_key(t: Tables) -> DataFrame:
    """The source states its day as a number: 20240131."""
    source = t.staged_v.select(
        F.date_format("date", "yyyyMMdd").cast("long").alias("date"),
        "account_id", F.col("click").alias("clicks"), F.col("total_cost").alias("cost"),
    )
    spec = MergeSpec(
        on=["date", "account_id"], keys={"date": "to_date(cast(`date` as string), 'yyyyMMdd')"}
    )
    return merge(t.live_v.drop("origin"), source, spec)


@query(
    "merge_cast_insert",
    with_views(*LIVE)
    + """SELECT date, account_id, CAST(clicks AS BIGINT) AS clicks, NULL AS reported_at FROM live_v
         UNION ALL
         SELECT s.date, s.account_id, CAST(round(s.total_cost) AS BIGINT),
                CAST(s.date AS TIMESTAMP) - INTERVAL '2' HOUR FROM staged_v s
         WHERE NOT EXISTS (SELECT 1 FROM live_v t WHERE t.date = s.date AND t.account_id = s.account_id)""",
)
def merge_cast_insert(t: Tables) -> DataFrame:
    """Text and fractions are inserted into typed columns; a fraction is rounded."""
    live = t.live_v.select("date", "account_id", "clicks", F.lit(None).cast("timestamp").alias("reported_at"))
    staged = t.staged_v.select(
        F.col("date").cast("string").alias("date"), F.col("account_id").cast("string").alias("account_id"),
        "total_cost", F.concat(F.col("date").cast("string"), F.lit(" 00:00:00 +02:00")).alias("reported"),
    )
    spec = MergeSpec(
        on=["date", "account_id"],
        insert={"date": "date", "account_id": "account_id", "clicks": "total_cost",
                "reported_at": "to_timestamp(reported, 'yyyy-MM-dd HH:mm:ss XXX')"},
    )
    merged = merge(live, staged, spec)
    return merged.withColumn("reported_at", F.col("reported_at").cast("timestamp_ntz"))


# Text partitions that look like numbers, and one of NULLs; the staged side leaves three alone.
PART = "CASE WHEN account_id % 8 > 0 THEN CONCAT('00', account_id % 8) END"
TOUCHED = "part IS NULL OR part < '005'"


@query(
    "merge_partitioned",
    with_views(*LIVE)
    + f""", l AS (SELECT *, {PART} AS part FROM live_v),
          s AS (SELECT * FROM (SELECT *, {PART} AS part FROM staged_v) WHERE {TOUCHED})
        SELECT l.date, l.account_id, CASE WHEN s.date IS NOT NULL THEN s.click ELSE CAST(l.clicks AS BIGINT) END AS clicks,
               CASE WHEN s.date IS NOT NULL THEN s.total_cost ELSE l.cost END AS cost, l.origin, l.part
        FROM l LEFT JOIN s ON l.date = s.date AND l.account_id IS NOT DISTINCT FROM s.account_id
        UNION ALL
        SELECT s.date, s.account_id, s.click, s.total_cost, 'staged', s.part FROM s
        WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.date = s.date AND l.account_id IS NOT DISTINCT FROM s.account_id)""",
)
def merge_partitioned(t: Tables) -> DataFrame:
    """Merged twice into a table partitioned by a text column: the second run changes nothing."""
    path = f"{scratch_path(t.spark, 'merge-partitioned')}/table"
    live = t.live_v.withColumn("part", F.expr(PART))
    write_parquet(live, path, ["part"])
    staged = t.staged_v.withColumn("part", F.expr(PART)).filter(TOUCHED)
    spec = MergeSpec(
        on=["date", "account_id", "part"], null_safe=True,
        update={"clicks": "click", "cost": "total_cost"},
        insert={"date": "date", "account_id": "account_id", "clicks": "click", "cost": "total_cost",
                "origin": "'staged'", "part": "part"},
    )
    for _ in range(2):
        merge_into_partitions(t.spark, path, staged, spec, "part")
    return t.spark.read.schema(live.schema).parquet(path)


@query(
    "upsert_by_pk",
    """WITH last AS (SELECT o_custkey, max_by(o_orderpriority, o_orderkey) AS name FROM orders GROUP BY 1),
            known AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 0)
       SELECT COALESCE(c_custkey, o_custkey) AS id, COALESCE(name, c_name) AS name, c_mktsegment AS segment
       FROM known FULL JOIN last ON c_custkey = o_custkey""",
)
def upsert_pk(t: Tables) -> DataFrame:
    """A batch names an id repeatedly: its last row wins."""
    known = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    batch = t.orders.select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"), "o_orderkey"
    )
    return upsert_by_pk(known, batch, "id", ["name"], order="o_orderkey")


@query(
    "insert_if_absent",
    """SELECT l_orderkey AS id, 'seen' AS state FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
       UNION ALL
       SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def insert_absent(t: Tables) -> DataFrame:
    known = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id"), F.lit("seen").alias("state")
    ).distinct()
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"))
    return insert_if_absent(known, rows, "id", small_source=False)
