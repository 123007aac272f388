"""Schemas, dates, text, money and payload edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions import dates as D
from adlake.functions import scalars as S
from adlake.functions import schema as C
from adlake.operators import payloads as P
from adlake.operators import relational as R


def value(spark, column, data=None, schema="x string"):
    df = spark.createDataFrame([(data,)], schema) if data is not None else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


def test_struct_from_fields_with_modes():
    schema = C.struct_from_fields([
        {"name": "id", "type": "STRING", "mode": "REQUIRED"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": [
            {"name": "key", "type": "STRING", "mode": "REQUIRED"}, {"name": "n", "type": "INTEGER"}]},
        {"name": "at", "type": "TIMESTAMP"}, {"name": "ok", "type": "BOOLEAN"}, {"name": "f", "type": "FLOAT"},
    ])
    assert not schema["id"].nullable and schema["at"].nullable
    assert schema["tags"].dataType == T.ArrayType(T.StringType(), False)
    assert schema["r"].dataType.elementType.names == ["key", "n"]
    assert [schema[c].dataType.simpleString() for c in ("at", "ok", "f")] == ["timestamp", "boolean", "double"]


def test_conform_adds_orders_casts_and_drops(spark):
    df = spark.createDataFrame([(2.5, "2024-02-29", "x")], "n double, d string, extra string")
    schema = T.StructType.fromDDL("d DATE, n BIGINT, gone DOUBLE")
    got = C.conform(df, schema)
    assert got.columns == ["d", "n", "gone"] and got.first() == (dt.date(2024, 2, 29), 3, None)
    assert C.conform(df, schema, keep_extra=True).columns == ["d", "n", "gone", "extra"]
    assert C.add_missing(df, schema).columns == ["n", "d", "extra", "gone"]


def test_check_required_looks_into_structs(spark):
    schema = T.StructType([T.StructField("s", T.StructType([T.StructField("a", T.LongType(), False)]))])
    good = spark.sql("SELECT named_struct('a', 1L) AS s UNION ALL SELECT NULL")
    assert C.check_required(good, schema).count() == 2
    with pytest.raises(Exception, match="required column s.a"):
        C.check_required(spark.sql("SELECT named_struct('a', CAST(NULL AS BIGINT)) AS s"), schema).collect()


def test_header_rules(spark):
    assert C.after_dot_lower("Dimension.AD_UNIT_NAME") == "ad_unit_name"
    assert [C.snake_case(c) for c in ("DeviceOS", "AdGroupId", "Impressions")] == [
        "device_o_s", "ad_group_id", "impressions"]
    df = spark.createDataFrame([(1, 2, 3)], "`ga:newUsers` int, `% New Users` int, `a.B` int")
    assert C.rename_headers(df, C.strip_prefix("ga:")).columns[0] == "newUsers"
    assert C.rename_headers(df, {"% New Users": "new_users_pct"}).columns[1] == "new_users_pct"


@pytest.mark.parametrize("utc, day", [
    ("2024-01-14 22:59:59", 14), ("2024-01-14 23:00:00", 15), ("2024-07-14 21:59:59", 14),
    ("2024-07-14 22:00:00", 15),
])
def test_local_date_follows_the_zone(spark, utc, day):
    got = value(spark, D.local_date(F.lit(utc).cast("timestamp_ntz"), "Europe/Berlin"))
    assert got.day == day


@pytest.mark.parametrize("day, hours", [(dt.date(2024, 3, 31), 23), (dt.date(2024, 10, 27), 25), (dt.date(2024, 1, 1), 24)])
def test_local_day_filter_on_clock_changes(spark, day, hours):
    start = f"timestamp_ntz'{day - dt.timedelta(days=2)} 00:30:00'"
    stamps = spark.sql(f"SELECT explode(sequence({start}, {start} + interval 5 days, interval 1 hour)) AS ts")
    assert stamps.filter(D.local_day_filter(F.col("ts"), "Europe/Berlin", day)).count() == hours


def test_date_range_reaches_the_scan(spark, tmp_path, plan):
    spark.sql("SELECT timestamp_ntz'2024-01-15 23:59:59' AS ts").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    kept = df.filter(D.date_range(F.col("ts"), dt.date(2024, 1, 8), dt.date(2024, 1, 15)))
    assert kept.count() == 1
    assert "GreaterThanOrEqual(ts" in plan(kept) and "LessThan(ts" in plan(kept)
    assert df.filter(D.date_range(F.col("ts"), dt.date(2024, 1, 8), dt.date(2024, 1, 15), False)).count() == 0


def test_months_spanned_and_month_bounds(spark):
    months = D.months_spanned(F.lit(dt.date(2023, 11, 30)), F.lit(dt.date(2024, 2, 1)))
    assert value(spark, months) == 4
    day = dt.date(2024, 2, 10)
    assert D.month_end(day) == dt.date(2024, 2, 29) and D.previous_month_start(dt.date(2024, 1, 31)) == dt.date(2023, 12, 1)
    assert D.next_month_start(dt.date(2023, 12, 31)) == dt.date(2024, 1, 1)


def test_deadline_keeps_the_zone_of_now(spark):
    now = dt.datetime(2024, 3, 30, 14, 5)  # a day before summer time starts
    assert value(spark, D.local_deadline(now, F.lit(24), "Europe/Berlin")) == "Mar 31, 2024 3:05 PM CET"
    assert value(spark, D.local_deadline(dt.datetime(2024, 7, 1, 22, 0), F.lit(0), "Europe/Berlin")) == "Jul 2, 2024 12:00 AM CEST"


def test_text_functions(spark):
    assert value(spark, S.slug(F.col("x"), "AS"), "0401 - Digital  Marketing") == "AS-digital-marketing"
    assert value(spark, S.slug(F.col("x"), "AS"), "0402 - Pre-Sales") == "AS-pre-sales"
    assert value(spark, S.split_list(F.col("x")), "") == []
    assert value(spark, S.split_list(F.col("x")), "a,b") == ["a", "b"]
    assert value(spark, S.split_list(F.col("x"), "|"), "a|b") == ["a", "b"]
    assert value(spark, S.split_list(F.lit(None).cast("string"))) is None


def test_money_functions(spark):
    assert value(spark, S.rounded(F.lit(2.675).cast("decimal(9,3)"))) == 2.68
    assert value(spark, S.whole_units(F.lit(-199))) == -1
    assert str(value(spark, S.to_money(F.lit("1.005").cast("decimal(9,3)")))) == "1.01"
    assert value(spark, S.decode(F.lit(None).cast("int"), {None: "none", 1: "one"})) == "none"
    assert value(spark, S.decode(F.lit(5), {1: "one"})) is None


def test_sum_forms_on_an_all_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "g int, x int")
    got = df.groupBy("g").agg(S.sum_filled(F.col("x")).alias("a"), S.sum_or_zero(F.col("x")).alias("b"),
                              F.sum("x").alias("c")).orderBy("g").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, None), (2, 5, 5, 5)]


def test_flatten_keeps_arrays_and_handles_dots(spark):
    df = spark.sql("SELECT named_struct('b.c', 1, 'd', named_struct('e', 2)) AS a, array(1) AS l")
    assert P.flatten(df).columns == ["a_b.c", "a_d_e", "l"]
    assert P.flatten(df, ".").columns == ["a.b.c", "a.d.e", "l"]


def test_explode_records_of_missing_array(spark):
    df = spark.createDataFrame([(None,), ([],), ([(1,)],)], "results array<struct<x int>>")
    assert [tuple(r) for r in P.explode_records(df, "results", account="a").collect()] == [(1, "a")]


def test_dim_metric_report_drops_other_types_and_short_rows(spark):
    json = (
        '{"view_id":1,"reports":[{"columnHeader":{"dimensions":["ga:date"],"metricHeader":{"metricHeaderEntries":'
        '[{"name":"m1","type":"INTEGER"},{"name":"m2","type":"CURRENCY"},{"name":"m3","type":"FLOAT"}]}},'
        '"data":{"rows":[{"dimensions":["20240131"],"metrics":[{"values":["5","9.9","0.5"]}]},'
        '{"dimensions":["20240201"],"metrics":[{"values":["6"]}]},{"dimensions":["20240202"],"metrics":[]}]}}]}'
    )
    df = spark.read.json(spark.sparkContext.parallelize([json]))
    got = P.dim_metric_report(df, ["ga:date"], {"m1": "INTEGER", "m2": "FLOAT", "m3": "FLOAT"})
    assert sorted(map(tuple, got.collect())) == [
        (1, "20240131", 5, None, 0.5), (1, "20240201", 6, None, None), (1, "20240202", None, None, None)]


def test_headers_zip_pairs_up_to_the_shorter_list(spark):
    json = ('{"headers":[{"name":"A"},{"name":"B"},{"name":"a"}],"rows":[{"cells":[{"value":"1"},{"value":"2"},'
            '{"value":"3"}]},{"cells":[{"value":"9"}]}]}')
    df = spark.read.json(spark.sparkContext.parallelize([json]))
    got = sorted(map(tuple, P.zip_headers_cells(df, ["a", "b"]).collect()))
    assert got == [("3", "2"), ("9", None)]


def test_fractions_round_half_away_from_zero(spark):
    numbers = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, 2.4, -2.6, 1e15 + 0.5]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = [r["x"] for r in C.conform(df, T.StructType.fromDDL("x BIGINT")).collect()]
    assert got == [1, -1, 2, 3, -3, 0, 2, -3, 10**15 + 1]


def test_lookup_title_needs_the_id(spark):
    df = spark.createDataFrame([(1, 5.0, ("t",)), (2, None, ("t",))], "id int, PId double, P struct<Title string>")
    assert [tuple(r) for r in P.lookup_titles(df, {"p": ("PId", "P")}).orderBy("id").collect()] == [
        (1, 5, "t"), (2, None, None)]


def test_attach_lookup_does_not_multiply_rows(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    lookup = spark.createDataFrame([(1, "u"), (1, "u")], "boost_id int, url string")
    assert rows(R.attach_lookup(df, lookup, "id", "boost_id")) == [(1, "x", "u"), (2, "y", None)]


def test_attach_single_errors_only_for_existing_parents(spark, rows):
    child = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (2, 6), (3, None), (3, 7)], "k int, v int")
    one = spark.createDataFrame([(1,), (9,)], "id int")
    assert rows(R.attach_single(one, child, "id", "k", "v", "v1")) == [(1, 5), (9, None)]
    for bad in (2, 3):
        with pytest.raises(Exception, match="more than one v1"):
            R.attach_single(spark.createDataFrame([(bad,)], "id int"), child, "id", "k", "v", "v1").collect()


def test_recent_only_includes_the_boundary(spark, rows):
    reports = spark.sql("""SELECT 1 AS report_id, timestamp'2024-01-12 10:00:00' AS updated_at
                           UNION ALL SELECT 2, timestamp'2024-01-12 09:59:59'""")
    sites = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "report_id int, s string")
    run = F.lit("2024-01-15 10:00:00").cast("timestamp")
    assert rows(R.recent_only(sites, reports, run), "s") == [("a",), ("c",)]
