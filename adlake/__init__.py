"""adlake: advertising and revenue analytics on Spark DataFrames."""

from adlake.functions.schema import conform, rename_headers, struct_from_fields
from adlake.operators.merge import (
    MergeSpec, insert_if_absent, merge, merge_into_partitions, upsert_by_pk,
)
from adlake.session import apply_defaults, build_session

__all__ = [
    "MergeSpec", "apply_defaults", "build_session", "conform", "insert_if_absent", "merge",
    "merge_into_partitions", "rename_headers", "struct_from_fields", "upsert_by_pk",
]
