"""Approved-action state and the streaming forms of ingest and merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.schema import conform
from adlake.functions.scalars import split_list
from adlake.operators.merge import MergeSpec
from adlake.plans import actions as A
from adlake.session import scratch_path
from adlake.sources.writers import write_parquet
from adlake.streaming.upserts import stream_insert_if_absent, stream_merge
from workload.bindings import Tables, with_views
from workload.registry import query

RUN = dt.date(1998, 7, 15)
NOW = dt.datetime(1998, 7, 15, 6, 0)
NOW_SQL = "TIMESTAMP '1998-07-15 06:00:00'"


def _tasks(t: Tables) -> DataFrame:
    """Tasks known from earlier runs, with their mail list."""
    return t.tasks.withColumn("email_to", split_list(F.col("email_to")))


def _plain(df: DataFrame) -> DataFrame:
    """Zone-less timestamps and joined lists, as the oracle has them."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType.typeName() == "timestamp":
            column = column.cast("timestamp_ntz")
        elif field.dataType.typeName() == "array":
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(columns)


@query(
    "ingest_actions",
    with_views("actions", "tasks")
    + """SELECT id, publisher_id, affpubid, change_type, delay_hours, status, email_to, email_sent_on
         FROM tasks WHERE status = 'success'
         UNION ALL
         SELECT id, publisher_id, source, CASE change_type WHEN 3 THEN 'block_tsp' WHEN 6 THEN 'block_affpubid' END,
                delay_hours, 'registered', email_to, NULL
         FROM actions WHERE created_on >= DATE '1998-07-15' AND process_status = 0
           AND id NOT IN (SELECT id FROM tasks WHERE status = 'success')""",
)
def ingest_actions(t: Tables) -> DataFrame:
    known = conform(_tasks(t).filter("status = 'success'"), A.task_schema())
    return _plain(A.ingest_actions(t.actions, known, RUN)).select(
        "id", "publisher_id", "affpubid", "change_type", "delay_hours", "status", "email_to", "email_sent_on"
    )


PENDING = "status = 'registered' AND email_sent_on IS NULL AND delay_hours > 0"


@query("pending_notifications", with_views("tasks") + f"SELECT * FROM tasks WHERE {PENDING}")
def pending_notifications(t: Tables) -> DataFrame:
    return _plain(A.pending_notifications(_tasks(t)))


@query(
    "notification_digest",
    with_views("tasks")
    + f""", pending AS (SELECT * FROM tasks WHERE {PENDING}),
        heads AS (SELECT change_type, publisher_id, min_by(email_to, id) AS email_to,
                         min_by(delay_hours, id) AS hours, CAST(COUNT(*) AS BIGINT) AS mail_lines
                  FROM pending GROUP BY 1, 2)
        SELECT p.change_type, p.publisher_id, h.email_to,
               CASE h.hours WHEN 6 THEN 'Jul 15, 1998 2:00 PM CEST' WHEN 12 THEN 'Jul 15, 1998 8:00 PM CEST'
                            ELSE 'Jul 16, 1998 2:00 AM CEST' END AS deadline,
               p.change_type IS NOT NULL AS has_content, h.mail_lines, p.id AS task_id, p.reason, p.affpubid,
               p.offer_name, p.offer_id
        FROM pending p JOIN heads h ON p.publisher_id = h.publisher_id
             AND p.change_type IS NOT DISTINCT FROM h.change_type""",
)
def notification_digest(t: Tables) -> DataFrame:
    tasks = _tasks(t).withColumns({"email_cc": F.lit(None).cast("array<string>"),
                                   "email_bcc": F.lit(None).cast("array<string>")})
    return _plain(A.digest(tasks, NOW).drop("email_cc", "email_bcc"))


@query(
    "mark_notified",
    with_views("tasks")
    + f"""SELECT * REPLACE (CASE WHEN {PENDING} THEN {NOW_SQL} ELSE email_sent_on END AS email_sent_on,
                            CASE WHEN {PENDING} THEN {NOW_SQL} ELSE updated_on END AS updated_on) FROM tasks""",
)
def mark_notified(t: Tables) -> DataFrame:
    return _plain(A.mark_notified(_tasks(t), NOW)[0])


DUE = f"""status = 'registered' AND change_type IN ('block_affpubid', 'block_tsp')
    AND (delay_hours = 0 OR email_sent_on + to_hours(delay_hours) < {NOW_SQL})"""


@query("due_actions", with_views("tasks") + f"SELECT * FROM tasks WHERE {DUE} AND change_type = 'block_tsp'")
def due_actions(t: Tables) -> DataFrame:
    return _plain(A.due(_tasks(t), NOW, "block_tsp"))


@query(
    "apply_due_actions",
    with_views("tasks")
    + f"""SELECT * REPLACE (CASE WHEN {DUE} THEN 'success' ELSE status END AS status,
                            CASE WHEN {DUE} THEN {NOW_SQL} ELSE updated_on END AS updated_on) FROM tasks""",
)
def apply_due_actions(t: Tables) -> DataFrame:
    return _plain(A.apply_due(_tasks(t), NOW)[0])


@query(
    "action_event_log",
    with_views("tasks")
    + f"""SELECT 'email_sent' AS event_type, CAST(NULL AS VARCHAR) AS message, id AS task_id, {NOW_SQL} AS created_on
          FROM tasks WHERE {PENDING}
          UNION ALL
          SELECT CASE change_type WHEN 'block_tsp' THEN 'blocked_tsp' ELSE 'blocked_affpubid' END, NULL, id, {NOW_SQL}
          FROM tasks WHERE {DUE}""",
)
def action_event_log(t: Tables) -> DataFrame:
    tasks = _tasks(t)
    log = A.mark_notified(tasks, NOW)[1].unionByName(A.apply_due(tasks, NOW)[1])
    return _plain(log.drop("id"))


def _order_files(t: Tables) -> DataFrame:
    """The orders as a stream of the files that hold them."""
    schema = t.orders.schema
    return t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(f"{t.folder}/orders.parquet*")


@query(
    "stream_ingest_actions",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM orders WHERE o_orderstatus <> 'F'""",
)
def stream_ingest_actions(t: Tables) -> DataFrame:
    """Orders already in the table are left alone; running the stream again adds nothing.

    The table is partitioned by the year of the order, so a batch reads the years it has.
    """
    base = scratch_path(t.spark, "stream")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    year = F.trunc("o_orderdate", "year").alias("first_day")
    write_parquet(t.orders.filter("o_orderstatus = 'F'").select(*columns, year), f"{base}/table", ["first_day"])
    for run in range(2):
        rows = _order_files(t).withColumn("o_orderstatus", F.lit("new")).select(*columns, year)
        query_ = stream_insert_if_absent(
            rows, f"{base}/table", "o_orderkey", f"{base}/checkpoint-{run}", partition="first_day"
        )
        query_.awaitTermination()
    return t.spark.read.parquet(f"{base}/table").select(columns)


ACTION_KNOWN = "updated_on < TIMESTAMP '1998-07-15 00:00:00'"


@query(
    "action_run",
    with_views("actions", "tasks")
    + f""", merged AS (
            SELECT id, change_type, delay_hours, status, email_sent_on FROM tasks WHERE {ACTION_KNOWN}
            UNION ALL
            SELECT id, CASE change_type WHEN 3 THEN 'block_tsp' WHEN 6 THEN 'block_affpubid' END, delay_hours,
                   'registered', NULL
            FROM actions WHERE created_on >= DATE '1998-07-15' AND process_status = 0
              AND id NOT IN (SELECT id FROM tasks WHERE {ACTION_KNOWN})),
          mailed AS (SELECT * REPLACE (CASE WHEN {PENDING} THEN {NOW_SQL} ELSE email_sent_on END AS email_sent_on)
                     FROM merged)
          SELECT 'task' AS kind, id, change_type AS what, CASE WHEN {DUE} THEN 'success' ELSE status END AS status,
                 email_sent_on AS at FROM mailed
          UNION ALL SELECT 'log', id, 'email_sent', NULL, {NOW_SQL} FROM merged WHERE {PENDING}
          UNION ALL
          SELECT 'log', id, CASE change_type WHEN 'block_tsp' THEN 'blocked_tsp' ELSE 'blocked_affpubid' END, NULL,
                 {NOW_SQL} FROM mailed WHERE {DUE}""",
)
def action_run(t: Tables) -> DataFrame:
    """A whole run over the tasks of earlier days: the task table after it and its log rows."""
    known = conform(_tasks(t).filter(ACTION_KNOWN), A.task_schema())
    state, log = A.run_actions(t.actions, known, RUN, NOW)
    tasks = state.select(F.lit("task").alias("kind"), "id", F.col("change_type").alias("what"), "status",
                         F.col("email_sent_on").alias("at"))
    logged = log.select(F.lit("log").alias("kind"), F.col("task_id").alias("id"), F.col("event_type").alias("what"),
                        F.lit(None).cast("string").alias("status"), F.col("created_on").alias("at"))
    return _plain(tasks.unionByName(logged))


@query(
    "stream_merge_upsert",
    """SELECT o_orderkey, year(o_orderdate) AS order_year, 'seen' AS state, o_totalprice + 1 AS price
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, year(o_orderdate), o_orderstatus, o_totalprice + 1 FROM orders
       WHERE o_orderstatus <> 'F'""",
)
def stream_merge_upsert(t: Tables) -> DataFrame:
    """Known orders get the streamed price and keep their state; the rest are added."""
    base = scratch_path(t.spark, "stream")
    order_year = F.year("o_orderdate").cast("long").alias("order_year")
    live = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", order_year, F.lit("seen").alias("state"), F.col("o_totalprice").alias("price")
    )
    write_parquet(live, f"{base}/table", ["order_year"])
    rows = _order_files(t).select("o_orderkey", order_year, "o_orderstatus", "o_totalprice")
    spec = MergeSpec(
        on=["o_orderkey", "order_year"],
        update={"price": "o_totalprice + 1"},
        insert={"o_orderkey": "o_orderkey", "order_year": "order_year", "state": "o_orderstatus",
                "price": "o_totalprice + 1"},
    )
    stream_merge(rows, f"{base}/table", spec, "order_year", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/table").withColumn("order_year", F.col("order_year").cast("long"))
