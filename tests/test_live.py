"""Versions of live tables, bucketed merges."""

import uuid

import pytest
from pyspark.sql import functions as F

from adlake.operators.bucketed import SALT, Bucketed, lay_out, merge_bucketed, merged
from adlake.operators.merge import MergeSpec, merge
from adlake.operators.quality import Check
from adlake.sources import live


@pytest.fixture
def schema(spark, tmp_path):
    name = f"live_{uuid.uuid4().hex}"
    live.open_schema(spark, name, str(tmp_path))
    return name


def test_a_load_switches_and_a_failing_one_changes_nothing(spark, schema, rows):
    name = f"{schema}.t"
    checks = [Check("t", "id", "not_null"), Check("t", "kind", "accepted_values", ["a", "b"])]
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, kind string")
    load = live.publish(first, name, checks)
    assert (load.rows, load.failures) == (2, {"id not_null": 0, "kind accepted_values": 0})
    bad = spark.createDataFrame([(None, "a"), (3, "c"), (4, "d")], "id long, kind string")
    with pytest.raises(live.CheckFailed) as problem:
        live.publish(bad, name, checks)
    assert problem.value.failures == {"id not_null": 1, "kind accepted_values": 2}
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    assert live.publish(bad, name, checks, tolerated=2).rows == 3
    assert spark.table(name).count() == 3


def test_a_load_may_read_its_own_table_and_old_versions_go(spark, schema):
    name = f"{schema}.t"
    for n in range(1, 5):
        rows = spark.range(1) if n == 1 else spark.table(name).unionByName(spark.range(n - 1, n))
        live.publish(rows, name)
        assert spark.table(name).count() == n
    versions = [t.name for t in spark.catalog.listTables(schema) if "__" in t.name]
    assert len(versions) == 2


def test_a_load_that_breaks_off_leaves_the_table(spark, schema):
    name = f"{schema}.t"
    live.publish(spark.range(5), name)
    broken = spark.range(100).select(F.when(F.col("id") == 70, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        live.publish(broken, name)
    assert spark.table(name).count() == 5
    assert len([t for t in spark.catalog.listTables(schema) if "__" in t.name]) == 1


def test_checks_over_several_rows_are_refused(spark, schema):
    with pytest.raises(ValueError):
        live.publish(spark.range(1), f"{schema}.t", [Check("t", "id", "unique")])


SPEC = MergeSpec(on=["id", "day"], update={"value": "value + 100"}, insert={"id": "id", "day": "day", "value": "value"})


def _live_rows(spark):
    """A third of all rows has one key, some have NULL keys."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") + 10).alias("id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4).cast("int").alias("day"),
        F.col("id").alias("value"), F.lit("kept").alias("note"),
    )


def _source(spark):
    rows = [(7, 1, 1), (11, 1, 2), (999_999, 3, 4), (None, 1, 5), (8, None, 6)]
    return spark.createDataFrame(rows, "id long, day int, value long")


@pytest.fixture
def unsorted_small(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_merge_equals_merge_twice_over(spark, schema, rows, unsorted_small):
    table = Bucketed(f"{schema}.t", ("id", "day"), 8)
    plain = _live_rows(spark)
    lay_out(plain, table)
    for _ in range(2):
        plain = merge(plain, _source(spark), SPEC)
        load = merge_bucketed(_source(spark), table, SPEC, [Check("t", "value", "not_null")])
        assert load.failures == {"value not_null": 0}
    assert spark.table(table.name).columns == plain.columns
    assert rows(spark.table(table.name)) == rows(plain)
    lay_out(spark.table(table.name), table)
    assert rows(spark.table(table.name)) == rows(plain)


def test_the_target_is_not_shuffled(spark, schema, plan, unsorted_small):
    table = Bucketed(f"{schema}.t", ("id", "day"), 8)
    lay_out(_live_rows(spark), table)
    text = plan(merged(_source(spark), table, SPEC))
    lines = text.split("== Initial Plan ==")[-1].splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and SALT in line]
    assert scans
    for at in scans:
        assert "Bucketed: true" in lines[at]
        depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
        for line in reversed(lines[:at]):  # upwards to the join that reads this side
            mine = len(line) - len(line.lstrip(" :+-"))
            if mine < depth:
                assert "Exchange" not in line
                depth = mine
                if "Join" in line:
                    break


def test_a_hot_key_is_split_over_buckets(spark, schema):
    table = Bucketed(f"{schema}.t", ("id", "day"), 8)
    lay_out(_live_rows(spark), table)
    per_bucket = live.present(spark, table.name).groupBy("_metadata.file_path").count().collect()
    assert max(r["count"] for r in per_bucket) <= 2 * 3000 / 8
    salts = live.present(spark, table.name).filter("id = 7").select(SALT).distinct().count()
    assert salts >= 2


def test_other_keys_and_duplicates_are_refused(spark, schema):
    table = Bucketed(f"{schema}.t", ("id", "day"), 4)
    lay_out(_live_rows(spark), table)
    with pytest.raises(ValueError):
        merged(_source(spark), table, MergeSpec(on=["id"]))
    with pytest.raises(ValueError):
        merged(_source(spark), table, MergeSpec(on=["id", "day"], null_safe=True))
    with pytest.raises(Exception, match="several source rows"):
        merge_bucketed(_source(spark).unionByName(_source(spark)), table, SPEC)
    assert spark.table(table.name).count() == 3000
