"""Declared schemas, conforming frames to them, and header renaming."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names of the declared field lists.
FIELD_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct_from_fields(fields: Iterable[Mapping]) -> T.StructType:
    """``[{name, type[, mode, fields]}]`` -> ``StructType``.

    RECORD becomes a struct, REPEATED an array, REQUIRED a non-nullable field.
    """
    built = []
    for field in fields:
        mode = field.get("mode", "NULLABLE").upper()
        kind = field["type"].upper()
        dtype = struct_from_fields(field["fields"]) if kind == "RECORD" else FIELD_TYPES[kind]
        if mode == "REPEATED":
            dtype = T.ArrayType(dtype, containsNull=False)
        built.append(T.StructField(field["name"], dtype, nullable=mode != "REQUIRED"))
    return T.StructType(built)


def nullable_type(dtype: T.DataType) -> T.DataType:
    """The same type with every nested part nullable, as files give it back."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable_type(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable_type(dtype.elementType))
    return dtype


def cast_to(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast the way the warehouse does: a fraction going to an integer is rounded."""
    source, target = nullable_type(source), nullable_type(target)
    if source == target:
        return column
    if isinstance(target, T.IntegralType) and isinstance(source, (T.DoubleType, T.FloatType)):
        # Half away from zero without a detour over decimals: rint sends ties to even.
        near = F.rint(column)
        tie = F.abs(column - near) == 0.5
        return F.when(tie, column + F.signum(column) * 0.5).otherwise(near).cast(target)
    if isinstance(target, T.IntegralType) and isinstance(source, T.DecimalType):
        return F.round(column).cast(target)
    return column.cast(target)


def add_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add declared columns the frame lacks as typed NULLs; keep everything else."""
    present = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in present}
    )


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Exactly the declared columns, in order and typed; missing ones are NULL."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        (
            cast_to(F.col(f"`{f.name}`"), actual[f.name], f.dataType)
            if f.name in actual
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        declared = set(schema.names)
        columns += [F.col(f"`{c}`") for c in df.columns if c not in declared]
    return df.select(columns)


def _required(schema: T.StructType, path: str = "") -> list[str]:
    found = []
    for field in schema.fields:
        here = f"{path}`{field.name}`"
        if not field.nullable:
            found.append(here)
        if isinstance(field.dataType, T.StructType):
            found += _required(field.dataType, here + ".")
    return found


def check_required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail on a NULL in a REQUIRED column or a REQUIRED member of a struct."""
    for path in _required(schema):
        outer = path.rpartition(".")[0]
        broken = F.col(path).isNull()
        if outer:
            broken = F.col(outer).isNotNull() & broken
        message = F.lit(f"NULL in required column {path.replace('`', '')}")
        df = df.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True))
    return df


def after_dot_lower(name: str) -> str:
    """``Dimension.AD_UNIT`` -> ``ad_unit``."""
    return name.split(".")[1].lower()


def snake_case(name: str) -> str:
    """``DeviceOS`` -> ``device_o_s``: every capital but a leading one starts a word."""
    return re.sub(r"(?<!^)([A-Z])", r"_\1", re.sub(r"[-.\s]", "_", name)).lower()


def strip_prefix(prefix: str) -> Callable[[str], str]:
    """Rule removing ``prefix`` wherever it stands in a header."""
    return lambda name: name.replace(prefix, "")


def rename_headers(df: DataFrame, rule: Callable[[str], str] | Mapping[str, str]) -> DataFrame:
    """Rename columns by a rule or a fixed map; headers a map does not name stay."""
    if not callable(rule):
        mapping = rule
        rule = lambda name: mapping.get(name, name)
    return df.toDF(*[rule(c) for c in df.columns])
