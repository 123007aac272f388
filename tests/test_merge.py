"""MERGE policies: NULL keys, duplicates, skew, partitions, contracts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adlake.functions.schema import conform
from adlake.operators.merge import (
    MergeSpec, insert_if_absent, last_per_key, merge, merge_into_partitions,
    merge_into_table, touched_partitions, upsert_by_pk,
)
from adlake.plans.contracts import CONTRACTS
from adlake.sources.writers import ensure_table, write_parquet
from adlake.streaming.upserts import stream_insert_if_absent

TARGET = "k int, v int, note string"
SOURCE = "k int, v int"
UPSERT = MergeSpec(on=["k"], update={"v": "v"}, insert={"k": "k", "v": "v"})


def frames(spark, target, source):
    return spark.createDataFrame(target, TARGET), spark.createDataFrame(source, SOURCE)


def test_update_and_insert(spark, rows):
    t, s = frames(spark, [(1, 10, "a"), (2, 20, "b")], [(2, 21), (3, 30)])
    assert rows(merge(t, s, UPSERT)) == [(1, 10, "a"), (2, 21, "b"), (3, 30, None)]


def test_update_to_null_is_an_update(spark, rows):
    t, s = frames(spark, [(1, 10, "a")], [(1, None)])
    assert rows(merge(t, s, UPSERT)) == [(1, None, "a")]


def test_null_keys_never_match_by_default(spark, rows):
    t, s = frames(spark, [(None, 1, "a")], [(None, 2)])
    assert rows(merge(t, s, UPSERT)) == [(None, 1, "a"), (None, 2, None)]


def test_null_safe_keys_match(spark, rows):
    t, s = frames(spark, [(None, 1, "a"), (1, 1, "b")], [(None, 2), (2, 2)])
    spec = MergeSpec(on=["k"], update={"v": "v"}, insert={"k": "k", "v": "v"}, null_safe=True)
    assert rows(merge(t, s, spec)) == [(None, 2, "a"), (1, 1, "b"), (2, 2, None)]


def test_several_source_rows_for_one_target_row_fail(spark):
    t, s = frames(spark, [(1, 10, "a")], [(1, 11), (1, 12)])
    with pytest.raises(Exception, match="several source rows"):
        merge(t, s, UPSERT).collect()


def test_several_unmatched_source_rows_are_all_inserted(spark, rows):
    t, s = frames(spark, [(1, 10, "a")], [(2, 11), (2, 12)])
    assert rows(merge(t, s, UPSERT)) == [(1, 10, "a"), (2, 11, None), (2, 12, None)]


def test_one_source_row_updates_several_target_rows(spark, rows):
    t, s = frames(spark, [(1, 10, "a"), (1, 20, "b")], [(1, 5)])
    assert rows(merge(t, s, UPSERT)) == [(1, 5, "a"), (1, 5, "b")]


def test_insert_only_never_touches_known_rows(spark, rows):
    t, s = frames(spark, [(1, 10, "a")], [(1, 99), (2, 20)])
    spec = MergeSpec(on=["k"], insert={"k": "k", "v": "v"})
    assert rows(merge(t, s, spec)) == [(1, 10, "a"), (2, 20, None)]


def test_update_only(spark, rows):
    t, s = frames(spark, [(1, 10, "a")], [(1, 11), (2, 20)])
    assert rows(merge(t, s, MergeSpec(on=["k"], update={"v": "v"}, insert=None))) == [(1, 11, "a")]


def test_empty_sides(spark, rows):
    t, s = frames(spark, [], [(1, 1)])
    assert rows(merge(t, s, UPSERT)) == [(1, 1, None)]
    t, s = frames(spark, [(1, 1, "a")], [])
    assert rows(merge(t, s, UPSERT)) == [(1, 1, "a")]


def test_merge_is_idempotent_on_non_null_keys(spark, rows):
    t, s = frames(spark, [(1, 10, "a"), (2, 20, "b")], [(2, 21), (3, 30)])
    once = merge(t, s, UPSERT)
    assert rows(merge(once, s, UPSERT)) == rows(once)


def test_source_derived_from_the_target(spark, rows):
    t = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], TARGET)
    source = t.filter("k = 1").withColumn("v", F.col("v") + 1)
    assert rows(merge(t, source, UPSERT)) == [(1, 11, "a"), (2, 20, "b")]


def test_fraction_is_rounded_into_an_integer_column(spark, rows):
    t = spark.createDataFrame([(1, 10)], "k int, v bigint")
    s = spark.createDataFrame([("2", 2.5), ("3", 3.4)], "k string, v double")
    assert rows(merge(t, s, MergeSpec(on=["k"]))) == [(1, 10), (2, 3), (3, 3)]


def test_hot_key_rows_all_survive(spark):
    """A third of the source on one new key, a third of the target on NULL keys."""
    n = 3000
    t = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit(1).alias("v"), F.lit("t").alias("note"),
    )
    s = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).cast("int").alias("k"),
        F.lit(2).alias("v"),
    )
    merged = merge(t, s, UPSERT)
    assert merged.count() == n + n // 3
    assert merged.filter("k = -1").count() == n // 3
    assert merged.filter("k IS NULL AND v = 1").count() == n // 3
    assert merged.filter("k > 0 AND v = 2 AND note = 't'").count() == n - n // 3


def test_plan_has_no_full_outer_or_cross_join(spark, plan):
    t, s = frames(spark, [(1, 10, "a")], [(1, 11)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merge(t, s, UPSERT))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftOuter" in text and "LeftAnti" in text
    for banned in ("FullOuter", "CartesianProduct", "NestedLoopJoin", "BatchEvalPython"):
        assert banned not in text


def test_insert_if_absent_takes_one_row_per_key(spark, rows):
    t = spark.createDataFrame([(1, 1)], SOURCE)
    s = spark.createDataFrame([(1, 2), (2, 3), (2, 3)], SOURCE)
    assert rows(insert_if_absent(t, s, "k")) == [(1, 1), (2, 3)]


def test_upsert_by_pk_last_wins(spark, rows):
    t = spark.createDataFrame([(1, "old", "x")], "id int, name string, other string")
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, name string, page int")
    assert rows(upsert_by_pk(t, s, "id", ["name"], order="page")) == [(1, "b", "x"), (2, "c", None)]
    assert rows(last_per_key(s, "id", "page")) == [(1, "b", 2), (2, "c", 1)]


def test_merge_into_partitions_rewrites_only_touched_days(spark, rows, tmp_path):
    path = str(tmp_path / "live")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    live = spark.createDataFrame([(d, 1, 10) for d in days], "day date, k int, v int")
    write_parquet(live, path, ["day"])
    before = {p.name for p in (tmp_path / "live" / "day=2024-01-01").glob("*.parquet")}
    source = spark.createDataFrame([(days[1], 1, 11), (days[2], 2, 12)], "day date, k int, v int")
    spec = MergeSpec(on=["day", "k"], update={"v": "v"})
    for _ in range(2):
        merge_into_partitions(spark, path, source, spec, "day")
    got = rows(spark.read.parquet(path), "day", "k", "v")
    assert got == [(days[0], 1, 10), (days[1], 1, 11), (days[2], 1, 10), (days[2], 2, 12)]
    assert before == {p.name for p in (tmp_path / "live" / "day=2024-01-01").glob("*.parquet")}


def test_merge_into_partitions_insert_only_appends(spark, rows, tmp_path):
    path = str(tmp_path / "live")
    day = dt.date(2024, 1, 1)
    write_parquet(spark.createDataFrame([(day, 1, 10)], "day date, k int, v int"), path, ["day"])
    source = spark.createDataFrame([(day, 1, 99), (day, 2, 20)], "day date, k int, v int")
    for _ in range(2):
        merge_into_partitions(spark, path, source, MergeSpec(on=["day", "k"]), "day")
    assert rows(spark.read.parquet(path), "k", "v") == [(1, 10), (2, 20)]


def test_partition_must_be_a_key(spark, tmp_path):
    with pytest.raises(ValueError):
        merge_into_partitions(spark, str(tmp_path), spark.range(1), MergeSpec(on=["id"]), "day")


def test_merge_statement_needs_a_table_format(spark):
    spark.sql("DROP TABLE IF EXISTS plain_table")
    ensure_table(spark, "plain_table", spark.createDataFrame([], TARGET).schema)
    source = spark.createDataFrame([(1, 5)], SOURCE)
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_into_table(source, "plain_table", UPSERT)


@pytest.mark.parametrize("null_safe, small_source", [(False, True), (True, True), (False, False), (True, False)])
def test_random_cases_against_brute_force(spark, null_safe, small_source):
    """Many small merges at once: the case number is part of the key."""
    rng = random.Random(7)
    target, source = [], []
    for case in range(150):
        keys = [None, 1, 2, 3, 4, 5]
        target += [(case, rng.choice(keys), rng.randint(0, 9), "t") for _ in range(rng.randint(0, 6))]
        source += [(case, k, rng.randint(10, 19)) for k in rng.sample(keys, rng.randint(0, 6))]
    spec = MergeSpec(on=["c", "k"], update={"v": "v"}, insert={"c": "c", "k": "k", "v": "v"},
                     null_safe=null_safe, small_source=small_source)
    merged = merge(
        spark.createDataFrame(target, "c int, k int, v int, note string"),
        spark.createDataFrame(source, "c int, k int, v int"), spec,
    )
    meets = lambda key: null_safe or key[1] is not None
    new = {(c, k): v for c, k, v in source if meets((c, k))}
    known = {(c, k) for c, k, _, _ in target if meets((c, k))}
    expected = [(c, k, new.get((c, k), v), n) for c, k, v, n in target]
    expected += [(c, k, v, None) for c, k, v in source if (c, k) not in known]
    assert Counter(map(tuple, merged.collect())) == Counter(expected)


# One golden case per contract: a known key, a new key, and what must (not) change.

DAY = dt.date(2024, 1, 31)
STAGED_VALUES = {
    "string": "s", "bigint": 7, "double": 0.5, "date": DAY, "timestamp": dt.datetime(2024, 1, 31, 12),
}
STAGED_COLUMNS = {
    "network_analytics": {"click": 7, "conversion": 7, "fired_conversion": 7, "total_rev": 0.5},
    "googleanalytics": {"date": 20240131, "newUsers": 7, "pageviews": 7, "uniquePageviews": 7,
                        "pageLoadTime": 0.5},
    "revcontent": {"avg_vcpm": 0.25},
    "taboola_cost": {"date": dt.datetime(2024, 1, 31, 5), "date_end_period": dt.datetime(2024, 1, 31, 6)},
    "taboola_revenue": {"date": dt.datetime(2024, 1, 31, 5), "clicks": 6.6},
    "zemanta": {"pageviews_per_visit": 6.6},
    "offers": {"id": 7, "name": "s", "advertiser_short": "s"},
    "content_owner_revenue": {"date": 20240131},
    "fraud_reports": {"feedback_inserted_at": "2024-01-31 13:00:00 +01:00", "feedback_report_id": "7.0"},
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contract(spark, name):
    contract = CONTRACTS[name]
    schema = contract.table_schema()
    defaults = {f.name: STAGED_VALUES[f.dataType.simpleString()] for f in schema.fields}
    staged = {**defaults, **STAGED_COLUMNS.get(name, {})}
    source = spark.range(1).select([F.lit(v).alias(k) for k, v in staged.items()])
    empty = spark.createDataFrame([], schema)
    inserted = merge(empty, source, contract.spec()).collect()
    assert len(inserted) == 1
    first = inserted[0].asDict()
    expected = {**defaults, **{c: None for c in contract.not_inserted}}
    if name == "revcontent":
        expected["avg_cpv"] = 0.25
    assert first == expected

    # The same key again, all measures different.
    other = {"string": "o", "bigint": 1, "double": 9.5, "date": DAY, "timestamp": dt.datetime(2020, 1, 1)}
    live = spark.range(1).select([
        F.lit(defaults[f.name] if f.name in contract.on else other[f.dataType.simpleString()])
        .cast(f.dataType).alias(f.name) for f in schema.fields
    ])
    live = conform(live, schema)
    known = live.collect()[0].asDict()
    again = merge(live, source, contract.spec()).collect()
    assert len(again) == 1
    refreshed = set(contract.update or ())
    for column, value in again[0].asDict().items():
        fresh = {**defaults, "avg_cpv": 0.25}[column] if name == "revcontent" else defaults[column]
        assert value == (fresh if column in refreshed else known[column]), column


def test_revcontent_update_copies_impressions(spark):
    contract = CONTRACTS["revcontent"]
    values = {f.name: STAGED_VALUES[f.dataType.simpleString()] for f in contract.table_schema().fields}
    source = spark.range(1).select(
        [F.lit(v).alias(k) for k, v in {**values, "impressions": 100, "viewable_impressions": 60,
                                        "avg_vcpm": 0.25}.items()]
    )
    inserted = merge(spark.createDataFrame([], contract.table_schema()), source, contract.spec())
    assert inserted.first()["viewable_impressions"] == 60
    assert merge(inserted, source, contract.spec()).first()["viewable_impressions"] == 100


def test_zemanta_keeps_the_ad_group_name():
    assert "ad_group" not in CONTRACTS["zemanta"].update
    assert len(CONTRACTS["zemanta"].update) == 22


def test_microsoftads_has_all_columns():
    assert len(CONTRACTS["microsoftads"].schema.split(",")) == 58
    assert len(CONTRACTS["fraud_reports"].schema.split(",")) == 45


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("update", [{"v": "v"}, None])
def test_null_partition_stays(spark, rows, tmp_path, null_safe, update):
    path = str(tmp_path / "t")
    schema = "k int, v string, part int"
    write_parquet(spark.createDataFrame([(1, "old-null", None), (2, "old-1", 1), (3, "far", 9)], schema), path, ["part"])
    source = spark.createDataFrame([(9, "new-null", None), (2, "new-1", 1), (1, "again", None)], schema)
    spec = MergeSpec(on=["k", "part"], update=update, null_safe=null_safe)
    merge_into_partitions(spark, path, source, spec, "part")
    once = rows(spark.read.parquet(path), "k", "v", "part")
    want = [(9, "new-null", None), (2, "new-1" if update else "old-1", 1), (3, "far", 9)]
    if null_safe:
        want += [(1, "again" if update else "old-null", None)]
    else:
        want += [(1, "old-null", None), (1, "again", None)]
    assert sorted(map(str, once)) == sorted(map(str, want))
    if null_safe:
        merge_into_partitions(spark, path, source, spec, "part")
        assert rows(spark.read.parquet(path), "k", "v", "part") == once


def test_text_partition_keeps_its_type(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v string, part string"
    write_parquet(spark.createDataFrame([(1, "old", "007"), (2, "other", "008")], schema), path, ["part"])
    source = spark.createDataFrame([(1, "new", "007")], schema)
    spec = MergeSpec(on=["k", "part"], update={"v": "v"})
    for declared in (None, source.select("k", "v", "part").schema):
        merge_into_partitions(spark, path, source, spec, "part", declared)
    assert rows(spark.read.schema(schema).parquet(path), "k", "v", "part") == [(1, "new", "007"), (2, "other", "008")]
    assert sorted(p.name for p in (tmp_path / "t").glob("part=*")) == ["part=007", "part=008"]


@pytest.mark.parametrize("parts", [3, 400])
def test_untouched_partitions_keep_their_files(spark, tmp_path, parts):
    path = str(tmp_path / "t")
    table = spark.range(parts).selectExpr("int(id) AS k", "'old' AS v", "int(id) AS part")
    write_parquet(table.coalesce(1), path, ["part"])
    before = {f.name for f in (tmp_path / "t").glob("part=*/*.parquet") if f.parent.name not in ("part=0", f"part={parts - 1}")}
    source = spark.createDataFrame([(0, "new", 0), (parts - 1, "new", parts - 1)], "k int, v string, part int")
    merge_into_partitions(spark, path, source, MergeSpec(on=["k", "part"], update={"v": "v"}), "part")
    after = spark.read.parquet(path)
    assert before <= {f.name for f in (tmp_path / "t").glob("part=*/*.parquet")}
    assert after.count() == parts and after.filter("v = 'new'").count() == 2


def test_null_primary_key_is_an_error(spark):
    target, source = frames(spark, [(1, 10, "a")], [(None, 1)])
    with pytest.raises(Exception, match="NULL in the primary key"):
        insert_if_absent(target.drop("note"), source, "k").collect()


def test_touched_partitions_bound_the_scan(spark, rows, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id AS INT)) AS day FROM range(30)").write.partitionBy("day").parquet(path)
    target = spark.read.schema("id bigint, day date").parquet(path)
    source = spark.sql("SELECT id, date_add(DATE '2024-01-01', CAST(id AS INT)) AS day FROM range(5, 9, 2)")
    near = touched_partitions(target, source, "day", "day")
    assert rows(near, "id") == [(5,), (7,)]
    filters = next(line for line in plan(near).splitlines() if "PartitionFilters" in line and path in line)
    assert "day#" in filters and ">=" in filters.split("PartitionFilters")[1]
    assert rows(touched_partitions(target, source.limit(0), "day", "day")) == []


def test_stream_with_a_partition_adds_each_key_once(spark, rows, tmp_path):
    path, landed = str(tmp_path / "t"), str(tmp_path / "in")
    schema = "id bigint, what string, day date"
    spark.sql("SELECT 1L AS id, 'known' AS what, DATE '2024-01-01' AS day").write.partitionBy("day").parquet(path)
    spark.sql(
        """SELECT * FROM VALUES (1L, 'new', DATE '2024-01-01'), (2L, 'new', DATE '2024-01-01'), (2L, 'new', DATE '2024-01-01'),
           (3L, 'new', CAST(NULL AS DATE)) AS t(id, what, day)"""
    ).write.parquet(landed)
    for run in range(2):
        stream = spark.readStream.schema(schema).parquet(landed)
        stream_insert_if_absent(stream, path, "id", str(tmp_path / f"c{run}"), partition="day").awaitTermination()
    assert rows(spark.read.schema(schema).parquet(path), "id", "what") == [(1, "known"), (2, "new"), (3, "new")]


def test_far_apart_partitions_leave_those_between_unread(spark, tmp_path, scanned):
    path = str(tmp_path / "t")
    spark.range(400).withColumn("day", F.col("id").cast("int")).write.partitionBy("day").parquet(path)
    target = spark.read.schema("id bigint, day int").parquet(path)
    source = spark.createDataFrame([(0, 0), (399, 399), (5, None)], "id long, day int")
    near = touched_partitions(target, source, "day", "day")
    assert scanned(near) == [{"partitions": 2, "rows": 2}]
