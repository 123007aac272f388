"""MERGE into a table bucketed by its key: the table is never shuffled, and a hot key is still split.

Bucketed by the key alone, all rows of one key are in one bucket and so in one task. Here keys that
have more rows than a bucket should hold are found when the table is laid out; a second bucket
column, the salt, deals their rows over as many buckets as they would fill. There are fewer such keys
than buckets. In a merge the source, one row for each key, is repeated for each salt of a hot
key and sent to the table's buckets; the table is read bucket by bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.merge import MergeSpec, evaluated_once, known_keys, new_rows, updated_rows
from adlake.operators.quality import Check
from adlake.sources import live
from adlake.sources.writers import stage

SALT = "__salt"
HOT = "adlake.hot"


@dataclass(frozen=True)
class Bucketed:
    """A live table (``adlake.sources.live``) in ``buckets`` by its ``keys``."""

    name: str
    keys: Sequence[str]
    buckets: int

    def _write(self, rows: DataFrame, hot: str, checks: Sequence[Check]) -> live.Load:
        return live.publish(
            rows, self.name, checks, hidden=[SALT], extra={HOT: hot},
            layout=lambda writer: writer.bucketBy(self.buckets, *self.keys, SALT).sortBy(*self.keys),
        )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, [F.col(f"`{a}`").eqNullSafe(F.col(f"`{b}`")) for a, b in zip(left, right)])


def _hot_keys(spark: SparkSession, table: str, n: int) -> DataFrame:
    """The hot keys as ``__hot0`` ..., and over how many salts they are dealt: fewer rows than buckets, so they may be broadcast."""
    return F.broadcast(spark.table(table).toDF(*[f"__hot{i}" for i in range(n)], "__parts"))


def _salted(rows: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Rows with their salt: 0, or for a hot key one by a hash of the row."""
    content = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(*content), F.col("__parts"))).otherwise(0)
    joined = rows.join(hot, _same(keys, [c for c in hot.columns if c != "__parts"]), "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], salt.cast("int").alias(SALT))


def lay_out(rows: DataFrame, table: Bucketed, checks: Sequence[Check] = ()) -> live.Load:
    """Make ``rows`` the content of the table, with the hot keys it has now.

    A key is hot if it has more rows than a bucket's even share; NULL is a key like any
    other. Lay the table out anew when its hot keys have changed: until then merges stay
    right, but a key that became hot is not split. ``rows`` may read the table itself.
    """
    spark = rows.sparkSession
    rows = stage(rows, "bucketed")
    share = max(1, rows.count() // table.buckets)
    counts = rows.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > share)
    parts = F.least(F.ceil(F.col("__n") / share), F.lit(table.buckets)).cast("long").alias("__parts")
    hot = f"{table.name}__hot_{uuid.uuid4().hex}"
    counts.select(*table.keys, parts).write.format("parquet").saveAsTable(hot)
    before = live.properties(spark, table.name).get(HOT)
    salted = _salted(rows, table.keys, _hot_keys(spark, hot, len(table.keys)))
    load = table._write(salted.repartition(table.buckets, *table.keys, SALT), hot, checks)
    if before:
        spark.sql(f"DROP TABLE IF EXISTS {before}")
    return load


def merged(source: DataFrame, table: Bucketed, spec: MergeSpec) -> DataFrame:
    """The table's rows after MERGE, with their salts. ``source`` is read up to three times.

    Only rows of the source's size are shuffled. The keys must be those of the table and compare
    by ``=``, which is what buckets are made for: a NULL key never matches.
    """
    if tuple(spec.on) != tuple(table.keys):
        raise ValueError(f"the table is bucketed by {tuple(table.keys)}, not by {tuple(spec.on)}")
    if spec.null_safe or not spec.small_source:
        raise ValueError("a bucketed merge compares keys by = and takes a source smaller than the table")
    spark = source.sparkSession
    target = live.present(spark, table.name)
    hot = _hot_keys(spark, live.properties(spark, table.name)[HOT], len(table.keys))

    def by_bucket(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str, _null_safe: bool) -> DataFrame:
        right_keys = list(keys.values())
        salts = F.sequence(F.lit(0), (F.coalesce("__parts", F.lit(1)) - 1).cast("int"))
        spread = right.join(hot, _same(right_keys, [c for c in hot.columns if c != "__parts"]), "left").select(
            *right.columns, F.explode(salts).alias("__at")
        ).repartition(table.buckets, *right_keys, "__at")
        tests = [F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in keys.items()]
        return left.join(spread, reduce(and_, tests, F.col(SALT) == F.col("__at")), how).drop("__at")

    base = updated_rows(target, source, spec, by_bucket) if spec.update else target
    if spec.insert is None:
        return base
    known = known_keys(target, source, spec, by_bucket, carried=[SALT])
    fresh = _salted(new_rows(target.drop(SALT), source, spec, known), table.keys, hot)
    return base.unionByName(fresh.repartition(table.buckets, *table.keys, SALT))


def merge_bucketed(source: DataFrame, table: Bucketed, spec: MergeSpec, checks: Sequence[Check] = ()) -> live.Load:
    """MERGE the source into the table as a new version of it."""
    rows = merged(evaluated_once(source), table, spec)
    hot = live.properties(source.sparkSession, table.name)[HOT]
    return table._write(rows, hot, checks)
