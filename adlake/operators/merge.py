"""MERGE as a DataFrame operator, with explicit NULL-key and duplicate policies.

``merge(target, source, spec)`` returns the merged table. Two facts shape the plan:

* a full outer join cannot be split when one key is hot, left outer and left
  anti joins can. So matched rows come from ``target LEFT JOIN source`` and new
  rows from ``source LEFT ANTI target``;
* the side a join cannot split is reduced to one row per key beforehand, with
  partial aggregation on the map side, and joined so that adaptive execution
  can still split the other side (``join_reduced``).

The source is read more than once; stage one that is expensive to compute
(``adlake.sources.writers.stage``), as the daily report does.

NULL keys follow SQL: ``=`` never matches them, so a source row with a NULL key
is new on every run unless ``null_safe`` is set.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.schema import cast_to
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

Expr = str | Column


@dataclass(frozen=True)
class MergeSpec:
    """What a MERGE statement says.

    ``on``      target key columns.
    ``keys``    source expression of a key, where it is not the same-named column.
    ``update``  target column -> source expression; None for an insert-only merge.
    ``insert``  target column -> source expression, ``"row"`` for all columns by
                name, or None for an update-only merge. Columns left out are NULL.

    Expressions are SQL text over source columns, or Columns. Results are cast
    to the target's types. ``on_multi_match="error"`` raises when several source
    rows meet one target row; ``"any"`` takes one of them. ``small_source`` plans
    for a source much smaller than the target; switch it off for a full reload.
    """

    on: Sequence[str]
    update: Mapping[str, Expr] | None = None
    insert: Mapping[str, Expr] | Literal["row"] | None = "row"
    keys: Mapping[str, Expr] = field(default_factory=dict)
    null_safe: bool = False
    on_multi_match: Literal["error", "any"] = "error"
    small_source: bool = True


def _expr(source: DataFrame, value: Expr) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(f"`{value}`") if value in source.columns else F.expr(value)


def _evaluate(
    source: DataFrame, exprs: Mapping[str, Expr], types: Mapping[str, T.DataType]
) -> list[Column]:
    """Typed columns; the source types are read from the analysed projection."""
    plain = {name: _expr(source, e) for name, e in exprs.items()}
    actual = source.select([c.alias(n) for n, c in plain.items()]).schema
    return [cast_to(c, actual[n].dataType, types[n]).alias(n) for n, c in plain.items()]


def _insert_map(target: DataFrame, source: DataFrame, spec: MergeSpec) -> dict[str, Expr]:
    if spec.insert == "row":
        return {c: spec.keys.get(c, c) for c in target.columns}
    return dict(spec.insert or {})


Join = Callable[[DataFrame, DataFrame, Mapping[str, str], str, bool], DataFrame]


def _with_keys(target: DataFrame, source: DataFrame, spec: MergeSpec) -> tuple[DataFrame, list[str]]:
    """The source with its keys in the target's types, and their names."""
    types = {f.name: f.dataType for f in target.schema.fields}
    names = [f"__src{i}" for i in range(len(spec.on))]
    keys = {k: spec.keys.get(k, k) for k in spec.on}
    return source.withColumns(dict(zip(names, _evaluate(source, keys, types)))), names


def known_keys(
    target: DataFrame, source: DataFrame, spec: MergeSpec, join: Join = join_reduced, carried: Sequence[str] = (),
) -> DataFrame:
    """The target's keys (``__key0`` ...), once each; with ``small_source`` only those the source asks for.

    ``join`` finds these; it may need more columns of the target, which are ``carried`` to it.
    """
    keyed, source_keys = _with_keys(target, source, spec)
    key_names = [f"__key{i}" for i in range(len(spec.on))]
    known = target.select([F.col(f"`{k}`").alias(n) for k, n in zip(spec.on, key_names)] + list(carried))
    if not spec.null_safe:
        known = known.dropna(subset=key_names)
    if spec.small_source:
        # Keep only target keys the source asks for. A source below the broadcast
        # threshold spares the target's other keys the shuffle.
        wanted = keyed.select([F.col(k).alias(f"__w{k}") for k in source_keys])
        wanted = (wanted if spec.null_safe else wanted.dropna()).distinct()
        asked = dict(zip(key_names, wanted.columns))
        known = join(known, wanted, asked, "left_semi", spec.null_safe)
    return known.select(key_names).distinct()


def new_rows(target: DataFrame, source: DataFrame, spec: MergeSpec, known: DataFrame | None = None) -> DataFrame:
    """Source rows without a partner in the target, shaped like the target.

    ``known`` are the target's keys, if ``known_keys`` has found them already.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    keyed, source_keys = _with_keys(target, source, spec)
    known = known_keys(target, source, spec) if known is None else known
    key_names = known.columns
    fresh = join_reduced(keyed, known, dict(zip(source_keys, key_names)), "left_anti", spec.null_safe)
    inserts = _insert_map(target, source, spec)
    filled = {n: inserts[n] for n in target.columns if n in inserts}
    # Expressions refer to source columns, all of which survive the anti join.
    values = dict(zip(filled, _evaluate(source, filled, types)))
    return fresh.select(
        [values.get(n, F.lit(None).cast(types[n])).alias(n) for n in target.columns]
    )


def updated_rows(target: DataFrame, source: DataFrame, spec: MergeSpec, join: Join = join_reduced) -> DataFrame:
    """The whole target, with the update applied to rows that have a partner.

    ``join`` brings the source's rows, one for each key, to the target's.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    assignments = dict(spec.update or {})
    keys = {k: spec.keys.get(k, k) for k in spec.on}
    projected = source.select(
        [c.alias(f"__key{i}") for i, c in enumerate(_evaluate(source, keys, types))]
        + [c.alias(f"__new_{n}") for n, c in zip(assignments, _evaluate(source, assignments, types))]
    )
    key_names = [f"__key{i}" for i in range(len(spec.on))]
    if not spec.null_safe:
        projected = projected.dropna(subset=key_names)
    partner = projected.groupBy(key_names).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.first(f"__new_{n}").alias(f"__new_{n}") for n in assignments],
    )
    joined = join(target, partner, dict(zip(spec.on, key_names)), "left", spec.null_safe)
    if spec.on_multi_match == "error":
        # Duplicates without a partner are no error, so the check must stay above the
        # join; the optimizer never moves a predicate that is not deterministic.
        several = (F.col("__n") > 1) & (F.spark_partition_id() >= 0)
        message = F.lit("MERGE: several source rows match one target row")
        joined = joined.filter(F.when(several, F.raise_error(message).cast("boolean")).otherwise(True))
    return joined.select(
        [
            (
                F.when(F.col("__n").isNotNull(), F.col(f"`__new_{c}`")).otherwise(F.col(f"`{c}`"))
                if c in assignments
                else F.col(f"`{c}`")
            ).alias(c)
            for c in target.columns
        ]
    )


def evaluated_once(source: DataFrame) -> DataFrame:
    """The source computed once: a merge reads it up to three times."""
    void = {f.name for f in source.schema.fields if isinstance(f.dataType, T.NullType)}
    typed = [F.lit(None).cast("string").alias(c) if c in void else F.col(f"`{c}`") for c in source.columns]
    return stage(source.select(typed), "merge-source")


def merge(target: DataFrame, source: DataFrame, spec: MergeSpec, staged: bool = False) -> DataFrame:
    """The target after MERGE. Insert-only merges never touch existing rows.

    The source is computed once and written to the shared folder, unless ``staged``
    says that it is a plain scan.
    """
    if not staged:
        source = evaluated_once(source)
    base = updated_rows(target, source, spec) if spec.update else target
    if spec.insert is None:
        return base
    return base.unionByName(new_rows(target, source, spec))


def merge_into_table(source: DataFrame, name: str, spec: MergeSpec) -> None:
    """The same MERGE as a statement, for catalogs whose tables support row-level changes.

    There the table format finds the touched files; a plain Parquet table
    rejects the statement. Untested beyond that: no such format is at hand.
    """
    target = source.sparkSession.table(name)
    types = {f.name: f.dataType for f in target.schema.fields}
    keys = {k: spec.keys.get(k, k) for k in spec.on}
    updates, inserts = dict(spec.update or {}), _insert_map(target, source, spec)
    roles = {"__key_": keys, "__new_": updates, "__ins_": inserts}
    rows = source.select(
        [
            value.alias(prefix + column)
            for prefix, exprs in roles.items()
            for column, value in zip(exprs, _evaluate(source, exprs, types))
        ]
    )
    tests = [(F.col(f"{name}.{k}"), F.col(f"`__key_{k}`")) for k in spec.on]
    condition = reduce(and_, [a.eqNullSafe(b) if spec.null_safe else a == b for a, b in tests])
    writer = rows.mergeInto(name, condition)
    if updates:
        writer = writer.whenMatched().update({c: F.col(f"`__new_{c}`") for c in updates})
    if inserts:
        writer = writer.whenNotMatched().insert({c: F.col(f"`__ins_{c}`") for c in inserts})
    writer.merge()


def insert_if_absent(
    target: DataFrame, source: DataFrame, key: str, small_source: bool = True,
) -> DataFrame:
    """Append source rows whose key the target does not have yet, one per key."""
    return target.unionByName(absent_rows(target, source, key, small_source))


def absent_rows(
    target: DataFrame, source: DataFrame, key: str, small_source: bool = True,
) -> DataFrame:
    """The rows ``insert_if_absent`` would add; known ones drop out before the rest is deduped.

    A NULL key is an error: it never equals one in the table, so a rerun would add it again.
    """
    spec = MergeSpec(on=[key], small_source=small_source)
    problem = F.raise_error(F.lit(f"NULL in the primary key {key}")).cast(source.schema[key].dataType)
    source = source.withColumn(key, F.coalesce(F.col(f"`{key}`"), problem))
    return new_rows(target, source, spec).dropDuplicates([key])


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the highest ``order`` per key, combined before the shuffle."""
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__last"))
    return best.select(key, "__last.*").select(df.columns)


def upsert_by_pk(
    target: DataFrame, source: DataFrame, key: str, columns: Sequence[str],
    order: str | None = None,
) -> DataFrame:
    """Insert or overwrite ``columns`` by primary key.

    With ``order`` the last source row of a key wins; without it the source
    must hold a key once.
    """
    rows = last_per_key(source, key, order) if order else source
    return merge(
        target, rows,
        MergeSpec(on=[key], update={c: c for c in columns}, insert={c: c for c in (key, *columns)}),
    )


def touched_partitions(target: DataFrame, source: DataFrame, partition: str, value: Expr) -> DataFrame:
    """The target's rows in partitions that ``value`` names for some source row.

    The values are part of the scan's own filter, so no other partition is read, however far the
    touched ones lie apart. The driver holds them as it holds the list of the table's partitions and
    of those a write commits; they are no more than these. The partition of NULLs is one like any other.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    touched = source.select(*[c.alias("__touched") for c in _evaluate(source, {partition: value}, types)]).distinct()
    found = [r[0] for r in touched.collect()]
    values = [v for v in found if v is not None]
    column = F.col(f"`{partition}`")
    near = F.lit(False)
    if values:
        near = column.between(F.lit(min(values)), F.lit(max(values))) & column.isin([F.lit(v).cast(types[partition]) for v in values])
    return target.filter(near | column.isNull() if None in found else near)


def merge_into_partitions(
    spark: SparkSession, path: str, source: DataFrame, spec: MergeSpec, partition: str,
    schema: T.StructType | None = None,
) -> None:
    """MERGE into a Parquet table partitioned by one of its key columns.

    Only partitions the source touches are read (``touched_partitions``), and only those
    are rewritten. An insert-only merge rewrites nothing and appends. Hot partitions are
    split over several writers.

    ``schema`` declares the table's columns. Without it they are inferred, but a
    partition column the source has as text stays text (``007`` is not 7).
    """
    if partition not in spec.on:
        raise ValueError("the partition column must be part of the merge key")
    if spec.update and partition in spec.update:
        raise ValueError("the partition column cannot be updated")
    source = evaluated_once(source)
    if schema is None:
        schema = spark.read.parquet(path).schema
        value = _expr(source, spec.keys.get(partition, partition))
        if isinstance(source.select(value).schema[0].dataType, T.StringType):
            fields = [T.StructField(f.name, T.StringType()) if f.name == partition else f for f in schema.fields]
            schema = T.StructType(fields)
    target = spark.read.schema(schema).parquet(path)
    affected = touched_partitions(target, source, partition, spec.keys.get(partition, partition))
    if spec.update:
        rows = merge(affected, source, spec, staged=True)
        writer = rows.hint("rebalance", partition).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        rows = new_rows(affected, source, spec)
        writer = rows.hint("rebalance", partition).write.mode("append")
    writer.partitionBy(partition).parquet(path)
