"""Files, tables, report sets, scratch space and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.merge import MergeSpec
from adlake.session import scratch_path, shuffle_partitions
from adlake.sources import click_log, readers, writers
from adlake.streaming.upserts import stream_insert_if_absent, stream_merge


def test_csv_bom_quotes_and_line_breaks(spark, tmp_path):
    file = tmp_path / "seed.csv"
    file.write_bytes(b'\xef\xbb\xbfid,name,notes,amount\n1,a,"two\nlines, ""quoted""",0.5\n2,b,,\n')
    df = readers.read_csv(spark, str(file), multiline=True)
    assert df.columns == ["id", "name", "notes", "amount"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "a", 'two\nlines, "quoted"', 0.5), (2, "b", None, None)]


def test_declared_csv_fails_on_a_bad_value(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\nbad\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path), "n INT").collect()


def test_reports_with_a_bad_row_are_skipped_whole(spark, tmp_path, rows):
    (tmp_path / "good.csv").write_text("k,v\n1,0.5\n2,1.5\n")
    (tmp_path / "bad.csv").write_text("k,v\n3,0.5\n4,oops\n")
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "report 1+.csv").write_text("k,v\n5,N/A\n6\n")
    (tmp_path / "long.csv").write_text("k,v\n7,0.5,9\n")
    names = ["good.csv", "bad.csv", "x/report 1+.csv", "long.csv"]
    manifest = spark.createDataFrame([(f"{tmp_path}/{n}", n[:4], i) for i, n in enumerate(names)], "file_path string, content_owner string, report_id int")
    schema = T.StructType.fromDDL("k INT, v DOUBLE")
    paths = [str(tmp_path), str(tmp_path / "x")]
    got, left_out = readers.read_reports(spark, manifest, paths, schema)
    assert rows(got, "k", "v", "report_id") == [(5, None, 2), (6, None, 2), (1, 0.5, 0), (2, 1.5, 0), (3, 0.5, 1), (4, None, 1)] or sorted(
        (r.k, r.v, r.report_id) for r in got.collect() if r.v is not None) == [(1, 0.5, 0), (2, 1.5, 0), (3, 0.5, 1)]
    assert [(r.file_path, r.reason) for r in left_out.collect()] == [(f"{tmp_path}/long.csv", "a row has too many fields")]
    strict, left_out = readers.read_reports(spark, manifest, paths, schema, rule="cells")
    assert rows(strict, "k", "report_id") == [(1, 0), (2, 0)] and left_out.count() == 3
    with pytest.raises(Exception, match="unreadable row"):
        readers.read_reports(spark, manifest, paths, schema, rule="fail")[0].collect()
    for wrong in (manifest.filter("report_id <> 0"), manifest.union(manifest)):
        with pytest.raises(Exception, match="not exactly one manifest row"):
            readers.read_reports(spark, wrong, paths, schema)[0].collect()


def test_ndjson_keeps_null_fields(spark, tmp_path):
    path = str(tmp_path / "j")
    writers.write_ndjson(spark.createDataFrame([(1, None)], "a int, b string"), path)
    assert readers.read_ndjson(spark, path, "a INT, b STRING").first() == (1, None)
    assert '"b":null' in "".join(f.read_text() for f in (tmp_path / "j").glob("part-*"))


def test_partition_window_prunes(spark, tmp_path, plan):
    path = str(tmp_path / "e")
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-10')) AS dt, 1 AS v")
    writers.write_parquet(days, path, ["dt"])
    df = readers.partition_window(spark.read.parquet(path), "dt", dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    assert df.count() == 2 and "PartitionFilters: [isnotnull(dt" in plan(df)


def test_tables(spark, rows):
    first = T.StructType.fromDDL("a INT")
    writers.drop_table(spark, "tbl")
    writers.ensure_table(spark, "tbl", first)
    writers.ensure_table(spark, "tbl", first)
    writers.append_table(spark.createDataFrame([("1",)], "a string"), "tbl")
    writers.ensure_table(spark, "tbl", T.StructType.fromDDL("a INT, b DATE"))
    late = spark.createDataFrame([(dt.datetime(2024, 1, 2, 5), 2)], "b timestamp, a int")
    writers.append_table(late, "tbl")
    assert rows(readers.read_query(spark, "tbl")) == [(1, None), (2, dt.date(2024, 1, 2))]
    writers.replace_table(spark.createDataFrame([(9,)], "a int"), "tbl")
    assert rows(spark.table("tbl")) == [(9,)]


def test_click_log_rejects_a_missing_required_member(spark, tmp_path):
    schema = click_log.click_log_schema()
    assert len(schema.fields) == 22
    empty = spark.range(1).select([F.lit(None).cast("string").alias("id")])
    from adlake.functions.schema import conform
    with pytest.raises(Exception, match="required column"):
        click_log.write_click_log(conform(empty, schema), str(tmp_path / "c"))


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert base is None or path.startswith(base.rstrip("/"))


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(100 * 2**40) == 100 * 2**40 // (256 * 2**20)


def test_stream_insert_if_absent_over_several_batches(spark, tmp_path, rows):
    source, table = tmp_path / "in", str(tmp_path / "table")
    schema = "id int, v string"
    spark.createDataFrame([(1, "known")], schema).write.parquet(table)
    for batch in ([(1, "new"), (2, "a")], [(2, "b"), (3, "c")]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
        stream_insert_if_absent(stream, table, "id", str(tmp_path / "ck")).awaitTermination()
    assert rows(spark.read.parquet(table)) == [(1, "known"), (2, "a"), (3, "c")]


def test_stream_merge_restates_days(spark, tmp_path, rows):
    source, table = tmp_path / "in", str(tmp_path / "table")
    schema = "day date, k int, v int"
    day = dt.date(2024, 1, 1)
    writers.write_parquet(spark.createDataFrame([(day, 1, 10)], schema), table, ["day"])
    spec = MergeSpec(on=["day", "k"], update={"v": "v"})
    for batch in ([(day, 1, 11), (day, 2, 20)], [(day, 2, 21), (dt.date(2024, 1, 2), 1, 5)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        stream_merge(stream, table, spec, "day", str(tmp_path / "ck")).awaitTermination()
    assert rows(spark.read.parquet(table), "day", "k", "v") == [(day, 1, 11), (day, 2, 21), (dt.date(2024, 1, 2), 1, 5)]
