"""Landed API payloads -> flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quote(path: Sequence[str]) -> str:
    return ".".join(f"`{part}`" for part in path)


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*path, field.name)
        nested = isinstance(field.dataType, T.StructType)
        found += _leaves(field.dataType, here) if nested else [here]
    return found


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to ``outer<sep>inner`` columns; arrays stay as they are."""
    return df.select([F.col(_quote(p)).alias(sep.join(p)) for p in _leaves(df.schema)])


def project_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """``{output name: dotted path}`` to positional columns."""
    return df.select([F.col(_quote(p.split("."))).alias(name) for name, p in paths.items()])


def explode_records(df: DataFrame, path: str, **constants: Any) -> DataFrame:
    """One row per element of the record array at ``path``, plus constant columns.

    A missing or empty array gives no rows.
    """
    rows = df.select(F.explode(F.col(_quote(path.split(".")))).alias("__record"))
    return rows.select("__record.*", *[F.lit(v).alias(k) for k, v in constants.items()])


def _zip_map(names: Column, values: Column) -> Column:
    """Map from two lists, paired up to the shorter one; the last of equal names wins."""
    n = F.greatest(F.least(F.size(names), F.size(values)), F.lit(0))
    return F.map_from_arrays(F.slice(names, F.lit(1), n), F.slice(values, F.lit(1), n))


def zip_headers_cells(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``{headers:[{name}], rows:[{cells:[{value}]}]}`` -> one column per header.

    Header names are compared in lower case; ``fields`` picks the columns.
    """
    names = F.transform("headers", lambda h: F.lower(h["name"])).alias("__names")
    cells = df.select(names, F.explode("rows").alias("__row"))
    values = F.transform(F.col("__row")["cells"], lambda c: c["value"])
    by_name = cells.select(_zip_map(F.col("__names"), values).alias("__cells"))
    return by_name.select([F.try_element_at("__cells", F.lit(f)).alias(f) for f in fields])


def dim_metric_report(
    df: DataFrame, dimensions: Sequence[str], metrics: Mapping[str, str],
    view_id: str = "view_id",
) -> DataFrame:
    """Dimension/metric reports to typed columns.

    ``metrics`` maps the wanted metric to INTEGER or FLOAT. Whether a metric is
    kept is decided by the type the payload declares: any other type is dropped
    and its column comes out NULL.
    """
    rows = (
        df.select(view_id, F.explode("reports").alias("__report"))
        .select(
            view_id,
            F.col("__report.columnHeader.dimensions").alias("__dims"),
            F.col("__report.columnHeader.metricHeader.metricHeaderEntries").alias("__entries"),
            F.explode("__report.data.rows").alias("__row"),
        )
    )
    # An entry is kept as (type, value) until its type is known to be wanted.
    values = F.get(F.col("__row.metrics"), F.lit(0))["values"]
    typed = F.zip_with(
        F.transform("__entries", lambda e: e["type"]), values,
        lambda kind, text: F.when(kind.isin("INTEGER", "FLOAT"), text),
    )
    maps = rows.select(
        view_id,
        _zip_map(F.col("__dims"), F.col("__row.dimensions")).alias("__d"),
        _zip_map(F.transform("__entries", lambda e: e["name"]), typed).alias("__m"),
    )

    def metric(name: str, kind: str) -> Column:
        text = F.try_element_at("__m", F.lit(name))
        return text.cast("long" if kind == "INTEGER" else "double").alias(name)

    return maps.select(
        view_id,
        *[F.try_element_at("__d", F.lit(d)).alias(d) for d in dimensions],
        *[metric(name, kind) for name, kind in metrics.items()],
    )


def lookup_titles(df: DataFrame, lookups: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``{output prefix: (id column, expanded lookup column)}`` -> ``<prefix>_id/_name``.

    The name is the lookup's title, or NULL when the id is NULL, even if the
    payload carries an expanded object.
    """
    used = {c for pair in lookups.values() for c in pair}
    plain = [F.col(f"`{c}`") for c in df.columns if c not in used]
    pairs: list[Column] = []
    for prefix, (id_column, object_column) in lookups.items():
        key = F.col(f"`{id_column}`")
        pairs.append(key.cast("long").alias(f"{prefix}_id"))
        pairs.append(F.when(key.isNotNull(), F.col(f"`{object_column}`")["Title"]).alias(f"{prefix}_name"))
    return df.select(*plain, *pairs)
