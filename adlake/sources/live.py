"""Live tables in versions: written beside the present one, checked while written, then shown.

A live table is a view over its present version, a managed table of the same schema. A load
writes a new version and switches the view only when that is complete and its checks hold, so
readers never see half a load, and one that breaks off or fails leaves the table as it was. One
writer at a time; a reader has until the next load but one to finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from adlake.operators.quality import Check, is_bad

VERSION = "adlake.version"
PREVIOUS = "adlake.previous"


class CheckFailed(ValueError):
    """A load whose rows break a check; ``failures`` counts them by check."""

    def __init__(self, name: str, failures: Mapping[str, int]) -> None:
        super().__init__(f"{name} stays as it was: {dict(failures)}")
        self.failures = dict(failures)


@dataclass(frozen=True)
class Load:
    """What a load wrote: the version, its rows, and the rows that fail each check."""

    version: str
    rows: int
    failures: Mapping[str, int]


def open_schema(spark: SparkSession, schema: str, folder: str) -> None:
    """A schema whose tables lie in ``folder``, which every executor must reach."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{folder}'")


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    """What the view of a live table says about it; empty if there is none."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def present(spark: SparkSession, name: str) -> DataFrame:
    """The present version itself, with its layout and its hidden columns."""
    return spark.table(properties(spark, name)[VERSION])


def publish(
    df: DataFrame, name: str, checks: Sequence[Check] = (), tolerated: int = 0,
    layout: Callable[[DataFrameWriter], DataFrameWriter] = lambda writer: writer,
    hidden: Sequence[str] = (), extra: Mapping[str, str] | None = None,
) -> Load:
    """Make ``df`` the content of the live table ``schema.table``; ``df`` may read the table itself.

    Row-wise ``checks`` (``not_null``, ``accepted_values``) are counted in the very job that writes, no
    second scan. If one has more than ``tolerated`` rows the new version is dropped and
    ``CheckFailed`` raised. ``layout`` may bucket or partition the version; ``hidden`` columns are stored, not
    shown; ``extra`` properties are stored with the view.
    """
    spark = df.sparkSession
    version = f"{name}__{uuid.uuid4().hex}"
    counts = {f"{c.column} {c.kind}": F.count(F.when(is_bad(c), 1)) for c in checks}
    seen = Observation()
    # On top of the plan, in the stage that writes: what is run again upstream is not counted twice.
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in counts.items()])
    try:
        layout(observed.write.format("parquet")).saveAsTable(version)
        found = seen.get
        failures = {n: found[n] for n in counts}
        if any(n > tolerated for n in failures.values()):
            raise CheckFailed(name, {k: n for k, n in failures.items() if n > tolerated})
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    before = properties(spark, name)
    stated = {VERSION: version, PREVIOUS: before.get(VERSION, ""), **(extra or {})}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in stated.items())
    shown = ", ".join(f"`{c}`" for c in df.columns if c not in hidden)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT {shown} FROM {version}")
    if before.get(PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {before[PREVIOUS]}")
    return Load(version, found["rows"], failures)
