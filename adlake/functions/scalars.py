"""Text, money and decoding expressions."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column, prefix: str, skip: int = 4) -> Column:
    """``0401 - Digital Marketing`` -> ``<prefix>-digital-marketing``.

    ``skip`` leading characters (the number) are cut, dashes become blanks and
    every run of blanks becomes one dash.
    """
    tail = F.replace(F.substr(F.lower(name), F.lit(skip + 1)), F.lit("-"), F.lit(" "))
    return F.regexp_replace(F.concat(F.lit(prefix), tail), r"\s+", "-")


def split_list(column: Column, separator: str = ",") -> Column:
    """Delimited text -> array; empty text is an empty array, NULL stays NULL."""
    return F.when(column == "", F.array().cast("array<string>")).otherwise(
        F.split(column, "\\Q" + separator + "\\E")
    )


def decode(column: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Searched CASE from a small fixed mapping; a NULL key matches NULL."""
    branches = None
    for key, value in mapping.items():
        test = column.isNull() if key is None else column == F.lit(key)
        branches = F.when(test, F.lit(value)) if branches is None else branches.when(test, F.lit(value))
    return branches if default is None else branches.otherwise(F.lit(default))


def whole_units(cents: Column, per_unit: int = 100) -> Column:
    """Integer division of an integer amount."""
    return F.call_function("div", cents, F.lit(per_unit))


def to_money(column: Column, scale: int = 2) -> Column:
    """DECIMAL(12, scale), half away from zero."""
    return column.cast(f"decimal(12,{scale})")


def rate(value: float | str | Decimal) -> Column:
    """A literal factor as an exact decimal."""
    return F.lit(value if isinstance(value, Decimal) else Decimal(str(value)))


def rounded(column: Column, digits: int = 2) -> Column:
    """Half away from zero, as a double."""
    return F.round(column, digits).cast("double")


def sum_filled(column: Column) -> Column:
    """NULLs count as 0: an all-NULL group gives 0."""
    return F.sum(F.coalesce(column, F.lit(0)))


def sum_or_zero(column: Column) -> Column:
    """NULLs are skipped, an all-NULL group gives 0."""
    return F.coalesce(F.sum(column), F.lit(0))


def count_if(condition: Column) -> Column:
    """Number of rows meeting a condition (NULL counts as not met)."""
    return F.sum(F.when(condition, 1).otherwise(0))
