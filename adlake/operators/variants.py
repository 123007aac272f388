"""Payloads whose shape differs from file to file, kept as VARIANT and read by path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, column: str, name: str = "payload") -> DataFrame:
    """Add the JSON text of ``column`` as a VARIANT, in one pass and without a schema; text that is no JSON is NULL."""
    return df.withColumn(name, F.try_parse_json(F.col(f"`{column}`")))


def field(payload: Column | str, paths: str | Sequence[str], kind: str) -> Column:
    """The first of several paths that has a value of type ``kind``; NULL where none has.

    Paths are tried in order, so the newest spelling of a field comes first. A value that
    cannot become ``kind`` counts as missing.
    """
    column = F.col(payload) if isinstance(payload, str) else payload
    tried = [F.try_variant_get(column, p, kind) for p in ([paths] if isinstance(paths, str) else paths)]
    return F.coalesce(*tried)


def fields(df: DataFrame, payload: str, wanted: Mapping[str, tuple[str | Sequence[str], str]], keep: Sequence[str] = ()) -> DataFrame:
    """Columns by name from (paths, type); ``keep`` are columns of ``df`` to go with them."""
    return df.select(*[F.col(f"`{c}`") for c in keep], *[field(payload, p, kind).alias(n) for n, (p, kind) in wanted.items()])


def records(df: DataFrame, payload: str, path: str, keep: Sequence[str] = (), name: str = "record") -> DataFrame:
    """One row for each element of the array at ``path``, itself a VARIANT; no array gives no row."""
    elements = F.explode(F.try_variant_get(F.col(payload), path, "array<variant>")).alias(name)
    return df.select(*[F.col(f"`{c}`") for c in keep], elements)


def shapes(df: DataFrame, payload: str, by: Sequence[str]) -> DataFrame:
    """The schema that the payloads of each group share, as text, and their number: shows when a source drifts.

    Schemas are merged while they are aggregated, so no payload is shuffled.
    """
    return df.groupBy(*by).agg(F.schema_of_variant_agg(payload).alias("shape"), F.count(F.lit(1)).alias("payloads"))


def drifted(df: DataFrame, payload: str, by: Sequence[str]) -> DataFrame:
    """The groups whose shape is not the one that all groups have together."""
    whole = df.agg(F.schema_of_variant_agg(payload).alias("whole"))
    return shapes(df, payload, by).filter(F.col("shape") != whole.scalar())
