"""Streams into Parquet tables. A batch that is run again changes nothing.

Sinks work per micro-batch with the batch operators: keys already present are
skipped or updated in place, so at-least-once delivery gives an exact table. A
batch is kept on its executors while a sink uses it; what is lost is read again.
The checkpoint belongs in the folder ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from adlake.operators.merge import MergeSpec, absent_rows, merge_into_partitions, touched_partitions
from adlake.sources.keyed import insert_keyed


@contextmanager
def kept(batch: DataFrame) -> Iterator[DataFrame]:
    """The batch, read from its source once although the sink uses it repeatedly."""
    rows = batch.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def stream_insert_if_absent(
    stream: DataFrame, path: str, key: str, checkpoint: str, partition: str | None = None, **trigger,
) -> StreamingQuery:
    """Append rows with a new key; rows whose key the table has are skipped.

    ``path`` must hold a Parquet table (it may be empty) of the stream's columns.
    State ``partition`` for a table partitioned by a column that a key determines,
    such as the day it was made on: a batch then looks up its keys in the partitions
    it touches. Without it every batch reads the key column of the whole table, which
    suits small tables only. A NULL key is an error. ``trigger`` is that of
    ``writeStream.trigger``, by default everything available.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        target = batch.sparkSession.read.schema(batch.schema).parquet(path)
        with kept(batch) as rows:
            if partition is None:
                absent_rows(target, rows, key).write.mode("append").parquet(path)
                return
            near = touched_partitions(target, rows, partition, partition)
            fresh = absent_rows(near, rows, key).hint("rebalance", partition)
            fresh.write.mode("append").partitionBy(partition).parquet(path)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_insert_keyed(
    stream: DataFrame, path: str, key: str, checkpoint: str, partition_by: Sequence[str] = (), **trigger,
) -> StreamingQuery:
    """``stream_insert_if_absent`` for a table of ``write_keyed``: its Bloom filters answer the batch's keys."""

    def load(batch: DataFrame, _batch_id: int) -> None:
        with kept(batch) as rows:
            insert_keyed(rows, path, key, partition_by)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_merge(
    stream: DataFrame, path: str, spec: MergeSpec, partition: str, checkpoint: str, **trigger,
) -> StreamingQuery:
    """MERGE every micro-batch into a Parquet table partitioned by a key column."""

    def load(batch: DataFrame, _batch_id: int) -> None:
        with kept(batch) as rows:
            merge_into_partitions(batch.sparkSession, path, rows, spec, partition)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
