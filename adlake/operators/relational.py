"""Unions, de-duplication, lookups, membership and correlated-subquery rewrites.

Join sides are never forced to broadcast: Spark broadcasts a side only when its
measured size is below the session threshold. The side that may hold a hot key
is always the left one of a left/semi/anti join, which adaptive execution can
split; the other side is reduced to one row per key, map side first, before it
is joined (``join_reduced``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Values of the extra join column of ``join_reduced``.
BUCKETS = 4096


def _bucket(columns: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))


def join_reduced(
    left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str, null_safe: bool = False,
) -> DataFrame:
    """Join ``left``, which may hold hot keys, with a side that has one row per key.

    ``keys`` maps left to right key columns; right columns must not be named
    like left ones and stay in the result of a left join. A hash of the keys is
    an additional join column on both sides. It serves two ends:

    * ``right`` usually comes out of an aggregation on its keys. The additional
      column gives the join an exchange of its own on that side, and adaptive
      execution splits a hot left partition only if both sides have one;
    * left rows with a NULL key have no partner, so theirs may be a hash of the
      whole row, which spreads them over the tasks. (Select the columns you need
      beforehand: the hash reads all that are left.)
    """
    left_keys, right_keys = [F.col(f"`{k}`") for k in keys], [F.col(f"`{k}`") for k in keys.values()]
    bucket = _bucket(left_keys)
    if not null_safe:
        whole = [F.col(f"`{f.name}`") for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
        no_partner = reduce(or_, [k.isNull() for k in left_keys])
        bucket = F.when(no_partner, _bucket(whole)).otherwise(bucket)
    a = left.withColumn("__left_bucket", bucket)
    b = right.withColumn("__right_bucket", _bucket(right_keys))
    tests = [a[f"`{x}`"].eqNullSafe(b[f"`{y}`"]) if null_safe else a[f"`{x}`"] == b[f"`{y}`"]
             for x, y in keys.items()]
    condition = reduce(and_, tests, F.col("__left_bucket") == F.col("__right_bucket"))
    return a.join(b, condition, how).drop("__left_bucket", "__right_bucket")


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column a frame lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates (copies collapse before the shuffle)."""
    return df.dropDuplicates()


def attach_lookup(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join a lookup on differently named keys, drop its key, drop copies.

    Copies in the lookup go first, so the join cannot multiply rows by them.
    """
    right = lookup.dropDuplicates().withColumnRenamed(right_key, "__lookup_key")
    joined = df.join(right, F.col(left_key) == F.col("__lookup_key"), "left")
    return joined.drop("__lookup_key").dropDuplicates()


def left_join_using(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """LEFT JOIN ... USING."""
    return left.join(right, on=keys, how="left")


def members(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``keys`` (semi join)."""
    known = keys.select(F.col(key).alias("__member")).distinct()
    return join_reduced(df, known, {key: "__member"}, "left_semi")


def recent_only(
    rows: DataFrame, reports: DataFrame, run_ts: Column, days: int = 3,
    key: str = "report_id", updated: str = "updated_at",
) -> DataFrame:
    """Rows of reports updated no earlier than ``days`` before the run."""
    fresh = reports.filter(F.col(updated) >= run_ts - F.make_dt_interval(days=F.lit(days)))
    return members(rows, fresh, key)


def without(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """NOT EXISTS on one key; restrict ``other`` by its own predicates beforehand."""
    blocked = other.select(F.col(right_key).alias("__blocked")).distinct()
    return join_reduced(df, blocked, {left_key: "__blocked"}, "left_anti")


def child_sums(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
    sums: Mapping[str, Column], default: Column | None = None,
) -> DataFrame:
    """Correlated ``(SELECT SUM(..) FROM child WHERE child.key = parent.key)`` columns."""
    totals = child.groupBy(F.col(child_key).alias("__child_key")).agg(
        *[F.sum(expr).alias(name) for name, expr in sums.items()]
    )
    joined = join_reduced(parent, totals, {parent_key: "__child_key"}, "left").drop("__child_key")
    if default is None:
        return joined
    return joined.withColumns({name: F.coalesce(F.col(name), default) for name in sums})


def attach_single(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
    value: str | Column, name: str,
) -> DataFrame:
    """Add ``(SELECT DISTINCT value FROM child WHERE child.key = parent.key)`` as a column.

    No child row gives NULL; several distinct values (NULL counts as one) are an
    error, but only for parents that exist. Per key no more than the lowest and
    highest value and a NULL mark travel, however many rows the key has.
    """
    expr = F.col(value) if isinstance(value, str) else value
    stats = child.groupBy(F.col(child_key).alias("__scalar_key")).agg(*single_stats(expr, name))
    joined = join_reduced(parent, stats, {parent_key: "__scalar_key"}, "left")
    problem = F.raise_error(F.lit(f"more than one {name} for one {parent_key}"))
    kept = [F.col(f"`{c}`") for c in parent.columns if c != name]
    return joined.select(*kept, F.when(several(name), problem).otherwise(F.col(f"__low_{name}")).alias(name))


def single_stats(value: Column, name: str, among: Column | None = None) -> list[Column]:
    """Aggregates that show whether a group has one value: the lowest, the highest and a NULL mark.

    ``among`` says which rows of the group count.
    """
    counted = F.lit(True) if among is None else among
    shown = F.when(counted, value)
    return [
        F.min(shown).alias(f"__low_{name}"),
        F.max(shown).alias(f"__high_{name}"),
        F.max(counted & value.isNull()).alias(f"__null_{name}"),
    ]


def several(name: str) -> Column:
    """Whether the group had more than one value, NULL counting as one; NULL without a group."""
    low = F.col(f"__low_{name}")
    return (low != F.col(f"__high_{name}")) | (F.col(f"__null_{name}") & low.isNotNull())
