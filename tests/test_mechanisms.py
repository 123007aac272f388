"""Key lookups by Bloom filters, stateful streams, ranges of run dates, digests, ledgers, variants, databases."""

import datetime as dt
import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.schema import conform
from adlake.operators import digests, variants
from adlake.operators.relational import union_all
from adlake.plans import backfill, invoices
from adlake.plans import report as R
from adlake.sources import database, keyed, ledger, readers
from adlake.streaming import stateful
from workload.bindings import Tables

FOLDER = "/root/testdata/sf0.001"


# Key lookups


@pytest.fixture
def keyed_table(spark, tmp_path):
    """Random keys, so that the least and greatest of a row group say nothing."""
    path = str(tmp_path / "keyed")
    rows = spark.range(200_000).select(F.abs(F.xxhash64("id")).alias("key"), F.col("id").alias("value")).coalesce(1)
    keyed.write_keyed(rows, path, "key", row_group_bytes=256 << 10)
    return path


def test_lookups_open_only_row_groups_that_may_hold_a_key(spark, keyed_table, scanned):
    table = spark.read.parquet(keyed_table)
    some = [r.key for r in table.limit(2).collect()]
    batch = spark.createDataFrame([(k,) for k in [*some, 17, None]], "key long")
    near = keyed.rows_of_keys(table, batch, "key")
    assert sorted(r.key for r in near.collect()) == sorted(some)
    assert 0 < scanned(near)[0]["rows"] < 60_000
    absent = spark.createDataFrame([(k,) for k in range(20, 25)], "key long")
    assert scanned(keyed.rows_of_keys(table, absent, "key"))[0]["rows"] < 60_000


@pytest.mark.parametrize("most", [1000, 3])
def test_keyed_insert_adds_each_new_key_once(spark, keyed_table, most):
    table = spark.read.parquet(keyed_table)
    known = [r.key for r in table.limit(5).collect()]
    batch = spark.createDataFrame([(k, -1) for k in [*known, 1, 2, 2, 3]], "key long, value long")
    for _ in range(2):
        keyed.insert_keyed(batch, keyed_table, "key", most=most)
        fresh = spark.read.parquet(keyed_table)
        assert fresh.count() == 200_003 and fresh.filter("value = -1").count() == 3
    with pytest.raises(Exception, match="NULL in the primary key"):
        keyed.insert_keyed(spark.createDataFrame([(None, 1)], "key long, value long"), keyed_table, "key")


def test_keyed_lookups_of_text_and_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(spark.range(50).select(F.concat(F.lit("k"), "id").alias("key"), "id"), path, "key", ["id"])
    table = spark.read.parquet(path)
    assert keyed.rows_of_keys(table, spark.createDataFrame([("k7",), ("x",)], "key string"), "key").count() == 1
    assert keyed.rows_of_keys(table, spark.createDataFrame([], "key string"), "key").count() == 0


# Streams with state


def _land(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/batch={number}")


EVENTS = "id long, at timestamp, kind string"


def _at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def _event_stream(spark, folder):
    return spark.readStream.schema(EVENTS + ", batch int").option("maxFilesPerTrigger", 1).parquet(folder).drop("batch")


def test_repeats_are_dropped_across_batches_and_a_restart(spark, tmp_path, rows):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    spark.createDataFrame([(100, _at(1), "old")], EVENTS).write.parquet(table)
    batches = [[(1, _at(2), "a"), (1, _at(2), "a"), (2, _at(2, 5), "b")], [(1, _at(2, 7), "again"), (100, _at(2), "known"), (3, _at(3), "c")],
               [(2, _at(3, 1), "again"), (4, _at(3, 2), "d"), (4, _at(3, 2), "d")]]
    asked = []
    for number, batch in enumerate(batches):  # the query is started anew for each
        _land(spark, folder, number, batch, EVENTS)
        stream = _event_stream(spark, folder)
        query = stateful.stream_ingest(stream, table, "id", "at", "2 days", checkpoint)
        query.awaitTermination()
        asked += [s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"]]
    assert rows(spark.read.parquet(table), "id", "kind") == [(1, "a"), (100, "old"), (2, "b"), (3, "c"), (4, "d")]
    assert sum(asked) == 5  # 1, 2, 100, 3 and 4: no repeat asked the table, whichever run it came in


def test_a_batch_run_again_adds_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame([], EVENTS).write.parquet(table)
    _land(spark, folder, 0, [(1, _at(2), "a"), (2, _at(2), "b")], EVENTS)
    for run in range(2):  # a lost checkpoint: all is delivered again
        stateful.stream_ingest(_event_stream(spark, folder), table, "id", "at", "2 days", str(tmp_path / f"c{run}")).awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_late_rows_correct_their_day_and_later_ones_are_counted(spark, tmp_path, rows):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    measures = {"events": F.count(F.lit(1)), "total": F.sum("id")}
    spark.createDataFrame([], "date date, kind string, events long, total long").write.partitionBy("date").parquet(table)
    batches = [[(1, _at(10), "a"), (2, _at(10, 3), "a"), (3, _at(10), "b")],
               [(4, _at(9), "a"), (5, _at(10, 4), None), (6, _at(12), "a")],  # the 9th is within three days
               [(7, _at(1), "a"), (8, _at(12, 1), "a")],  # the 1st is too late
               [(9, _at(10, 9), "a")]]
    late = 0
    for number, batch in enumerate(batches):
        _land(spark, folder, number, batch, EVENTS)
        statistics = stateful.trailing_statistics(_event_stream(spark, folder), "at", ["kind"], measures, "3 days")
        query = stateful.stream_statistics(statistics, table, ["kind"], checkpoint)
        query.awaitTermination()
        late += stateful.late_rows(query)
    found = spark.read.schema("date date, kind string, events long, total long").parquet(table)
    day = lambda n: dt.date(2024, 1, n)
    assert sorted((r.date, r.kind or "", r.events, r.total) for r in found.collect()) == [
        (day(9), "a", 1, 4), (day(10), "", 1, 5), (day(10), "a", 3, 12), (day(10), "b", 1, 3), (day(12), "a", 2, 14)]
    assert late == 1


# Ranges of run dates


@pytest.fixture
def tables(spark):
    return Tables(spark, FOLDER)


START, END = dt.date(1998, 6, 27), dt.date(1998, 8, 2)


def _each_day(plan):
    days = [START + dt.timedelta(days=n) for n in range((END - START).days + 1)]
    return union_all(*[plan(day) for day in days])


def test_marketplace_of_a_range_equals_its_days(tables, rows):
    got = rows(backfill.marketplace_range(tables.invoices, START, END))
    assert got == rows(_each_day(lambda day: invoices.allocate_marketplace(tables.invoices, day))) and len(got) == 37


def test_agency_of_a_range_equals_its_days(tables, rows):
    got = rows(backfill.agency_range(tables.invoicing, tables.cancellations, START, END))
    assert got == rows(_each_day(lambda day: invoices.allocate_agency(tables.invoicing, tables.cancellations, day))) and got


def test_odd_periods_of_a_range_equal_their_days(spark, rows):
    """Starts and ends around the last day of a month, before the invoice, missing, or turned round."""
    times = [None, *[dt.datetime(1998, m, d, h) for m, d, h in [(6, 30, 0), (6, 30, 9), (7, 1, 0), (7, 31, 0), (7, 31, 5), (8, 1, 0), (5, 2, 3)]]]
    made = [(i, 1000 + i, c, s, e, x, "url") for i, (c, s, e, x) in enumerate(
        (c, s, e, x) for c in times[1:] for s in times for e in times for x in (None, times[5], times[2]))]
    frame = spark.createDataFrame(made, "id long, total long, created_at timestamp_ntz, period_start timestamp_ntz, "
                                        "period_end timestamp_ntz, canceled_at timestamp_ntz, fastbill_invoice_url string").coalesce(2).cache()
    assert rows(backfill.marketplace_range(frame, START, END)) == rows(_each_day(lambda day: invoices.allocate_marketplace(frame, day)))
    agency = frame.select("id", F.col("total").cast("double").alias("total_cost"), "created_at", F.col("period_start").alias("start_at"),
                          F.col("period_end").alias("end_at"), F.expr("created_at + interval 1 day").alias("fastbill_invoice_created_at"),
                          F.lit("n").alias("fastbill_invoice_number"))
    agency = agency.filter("start_at IS NULL OR end_at IS NULL OR start_at <= end_at")  # others may span no month: division by zero in both
    cancelled = frame.select(F.col("id").alias("individual_campaign_id"), F.col("canceled_at").alias("cancelled_at"))
    assert rows(backfill.agency_range(agency, cancelled, START, END)) == rows(_each_day(lambda day: invoices.allocate_agency(agency, cancelled, day)))


def test_an_empty_range_of_invoices_has_no_rows(tables):
    assert backfill.marketplace_range(tables.invoices.limit(0), START, END).collect() == []


def test_the_report_of_a_range_equals_its_runs(spark, tables, rows):
    start, end = dt.date(1998, 7, 30), dt.date(1998, 8, 1)
    products = tables.report_products
    existing = spark.createDataFrame([(1998, 199807, 19980730, start, "RH-marketplace-total", -1.0, -1.0), (1997, 199701, 19970101, dt.date(1997, 1, 1), "x", 1.0, None)],
                                     R.REPORT.table_schema())
    whole = backfill.report_range([backfill.marketplace_range(tables.invoices, start, end)], products, existing, start, end)
    by_day = existing
    for n in range(3):
        day = start + dt.timedelta(days=n)
        by_day = R.daily_report([invoices.allocate_marketplace(tables.invoices, day)], products, by_day, day)
    assert rows(whole) == rows(conform(by_day, R.REPORT.table_schema()))


# Digests


def _files(path):
    return {p.relative_to(path) for p in Path(path).rglob("part-*")}


def test_only_partitions_that_differ_are_rewritten(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    days = spark.range(3000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 2).alias("value"),
                                    F.array("id").alias("list"), (F.col("id") % 30).cast("int").alias("day"))
    days.write.partitionBy("day").parquet(path)
    before = _files(path)
    again = days.filter("day between 5 and 20").repartition(7)  # the same rows in another order
    assert digests.reload_partitions(spark, path, again, "day") == 0 and _files(path) == before
    changed = again.withColumn("value", F.when((F.col("id") == 7 + 300) | F.col("id").isin(9), 1).otherwise(F.col("value")))
    changed = changed.unionByName(changed.limit(0)).filter("id <> 2711")  # 2711 is of day 11
    assert digests.reload_partitions(spark, path, changed, "day") == 3
    kept, new = before & _files(path), _files(path) - before
    assert {str(p).split("/")[0] for p in new} == {"day=7", "day=9", "day=11"}
    assert {str(p).split("/")[0] for p in before - kept} == {"day=7", "day=9", "day=11"}
    expected = days.filter("day < 5 or day > 20").unionByName(changed)
    assert rows(spark.read.schema(days.schema).parquet(path)) == rows(expected)


def test_digests_see_repeats_nulls_and_new_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.createDataFrame([(1, None, 1), (None, 1, 2), (5, 5, 3)], "a int, b int, p int")
    table.write.partitionBy("p").parquet(path)
    for other, count in [([(None, 1, 1)], 1), ([(5, 5, 3), (5, 5, 3)], 1), ([(1, 1, 9), (2, 2, None)], 2), ([], 0)]:
        assert digests.reload_partitions(spark, path, spark.createDataFrame(other, table.schema), "p") == count
    assert spark.read.parquet(path).count() == 6


def test_digests_of_maps_go_by_their_entries(spark):
    one = spark.sql("SELECT map('a', 1, 'b', NULL) AS m, named_struct('x', map('c', 2)) AS s, 1 AS p")
    two = spark.sql("SELECT map('b', NULL, 'a', 1) AS m, named_struct('x', map('c', 2)) AS s, 1 AS p")
    other = spark.sql("SELECT map('a', 1, 'b', 2) AS m, named_struct('x', map('c', 2)) AS s, 1 AS p")
    assert digests.changed_partitions(one, two, "p").collect() == [] and digests.changed_partitions(one, other, "p").count() == 1


# Ledger


def test_a_second_run_reads_only_new_and_changed_files(spark, tmp_path, rows):
    folder, book = tmp_path / "in", str(tmp_path / "ledger")
    (folder / "sub").mkdir(parents=True)
    (folder / "a b.csv").write_text("k\n1\n")
    (folder / "sub" / "c.csv").write_text("k\n2\n")
    (folder / "note.txt").write_text("no report")
    first = ledger.NewFiles(spark, str(folder), book, "*.csv")
    assert sorted(first.paths) == [f"{folder}/a b.csv", f"{folder}/sub/c.csv"]
    assert sorted(ledger.NewFiles(spark, str(folder), book, "*.csv").paths) == sorted(first.paths)  # not done yet
    (folder / "late.csv").write_text("k\n3\n")
    first.done()
    second = ledger.NewFiles(spark, str(folder), book, "*.csv")
    assert second.paths == [f"{folder}/late.csv"]
    second.done()
    assert ledger.NewFiles(spark, str(folder), book, "*.csv").paths == []
    (folder / "a b.csv").write_text("k\n1\n9\n")
    third = ledger.NewFiles(spark, str(folder), book, "*.csv")
    assert third.paths == [f"{folder}/a b.csv"]
    manifest = spark.createDataFrame([(p, "o") for p in third.paths], "file_path string, owner string")
    got, _ = readers.read_reports(spark, manifest, third.paths, T.StructType.fromDDL("k INT"))
    assert rows(got, "k") == [(1,), (9,)]


def test_rows_with_too_many_fields_whatever_they_hold(spark, tmp_path):
    texts = {"ok": '1,2\n3\n"a,b",\n"q""x,",7\n', "mark": "1,2\n3,4,,x\n", "empty": "7,8,\n9,9,,,\n1,1\n", "quoted": '"1,2","3,4","5"\n'}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text("k,v\n" + text)
    manifest = spark.createDataFrame([(f"{tmp_path}/{n}.csv", n) for n in texts], "file_path string, owner string")
    got, out = readers.read_reports(spark, manifest, str(tmp_path), T.StructType.fromDDL("k STRING, v STRING"))
    assert sorted((r.file_path.split("/")[-1], r.reason, r.bad_rows) for r in out.collect()) == [
        ("empty.csv", "a row has too many fields", 2), ("mark.csv", "a row has too many fields", 1), ("quoted.csv", "a row has too many fields", 1)]
    assert sorted((r.k, r.v or "") for r in got.collect()) == [("1", "2"), ("3", ""), ("a,b", ""), ('q"x,', "7")]


# Variants


def test_fields_of_payloads_that_changed_shape(spark):
    payloads = [(1, '{"id": 1, "total": "12.5"}'), (1, '{"id": 2}'), (2, '{"id": "3", "amount": {"total": 7, "parts": [{"x": 1}, {"x": null}]}}'), (2, "broken{"), (2, None)]
    df = variants.parsed(spark.createDataFrame(payloads, "version int, body string"), "body")
    wanted = {"id": ("$.id", "long"), "total": (["$.amount.total", "$.total"], "double")}
    assert sorted(map(tuple, variants.fields(df, "payload", wanted, ["version"]).na.fill(-1).collect())) == [
        (1, 1, 12.5), (1, 2, -1.0), (2, -1, -1.0), (2, -1, -1.0), (2, 3, 7.0)]
    parts = variants.records(df, "payload", "$.amount.parts", ["version"])
    assert [(r.version, r.x) for r in parts.select("version", variants.field("record", "$.x", "int").alias("x")).collect()] == [(2, 1), (2, None)]
    found = {r.version: (r.shape, r.payloads) for r in variants.shapes(df, "payload", ["version"]).collect()}
    assert "amount" not in found[1][0] and "amount" in found[2][0] and (found[1][1], found[2][1]) == (2, 3)
    assert variants.drifted(df, "payload", ["version"]).count() == 2
    assert variants.drifted(df.filter("version = 1"), "payload", ["version"]).count() == 0


# Databases


@pytest.fixture
def sqlite(tmp_path):
    path = str(tmp_path / "shop.db")
    with sqlite3.connect(path) as connection:
        connection.execute('CREATE TABLE orders (id INTEGER, name TEXT, price REAL, "odd ""name" INTEGER)')
        connection.executemany("INSERT INTO orders VALUES (?, ?, ?, ?)", [(i if i % 50 else None, f"n{i % 7}" if i % 11 else None, i / 4, i) for i in range(-500, 1500)])
    return path


SHOP = 'id BIGINT, name STRING, price DOUBLE, `odd "name` INT'


def test_database_ranges_give_all_rows_once(spark, sqlite, rows):
    whole = rows(database.read_database(spark, SHOP, module="sqlite3", database=sqlite, query="SELECT * FROM orders"))
    assert len(whole) == 2000
    ranged = database.read_database(spark, SHOP, module="sqlite3", database=sqlite, query="SELECT * FROM orders",
                                    partitionColumn="id", lowerBound=0, upperBound=1000, numPartitions=6)
    assert ranged.rdd.getNumPartitions() == 6 and rows(ranged) == whole


def test_database_judges_filters(spark, sqlite, plan):
    df = database.read_database(spark, SHOP, module="sqlite3", database=sqlite, query="SELECT * FROM orders",
                                partitionColumn="id", lowerBound=0, upperBound=1000, numPartitions=3)
    near = df.filter("id > 1400 AND name IN ('n1', 'n2') AND price IS NOT NULL AND upper(name) = 'N1'")
    expected = df.collect()
    assert sorted(r.id for r in near.collect()) == sorted(r.id for r in expected if r.id is not None and r.id > 1400 and r.name == "n1")
    assert df.filter("id IS NULL").count() == sum(r.id is None for r in expected)


@pytest.mark.parametrize("low, high, number, tasks", [(0, 10, 100, 10), (5, 5, 4, 1), (0, 100, 1, 1), (-7, 8, 4, 4)])
def test_ranges_cover_everything(low, high, number, tasks):
    parts = database.ranges("id", low, high, number)
    connection = sqlite3.connect(":memory:")
    connection.execute("CREATE TABLE t (id INTEGER)")
    connection.executemany("INSERT INTO t VALUES (?)", [(v,) for v in [*range(-50, 150), None]])
    found = [r for p in parts for r in connection.execute(f"SELECT id FROM t WHERE {p.test}", p.values)]
    assert len(parts) == tasks and len(found) == 201 and len(set(found)) == 201
