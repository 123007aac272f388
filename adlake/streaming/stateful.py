"""Streams that remember: repeats dropped before the sink, and statistics of a trailing window.

State lives in the query's checkpoint, which belongs in the folder ``spark.checkpoint.dir`` names;
it is bounded by event time, and a query started again goes on from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlake.operators.merge import MergeSpec, merge_into_partitions
from adlake.streaming.upserts import kept, stream_insert_if_absent


def first_seen(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """The first row of each key; a repeat within ``delay`` of event time is dropped before it reaches a sink.

    Keys are forgotten when the watermark (the greatest event time less ``delay``) has passed them, so
    state holds the keys of one delay, not of all time. ``delay`` is how late a repeat may come. A
    row older than the watermark is dropped; NULL is a key like any other.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_ingest(
    stream: DataFrame, path: str, key: str, event_time: str, delay: str, checkpoint: str,
    partition: str | None = None, **trigger,
) -> StreamingQuery:
    """Append rows with a new key; of the repeats within ``delay`` only the first asks the table.

    The table still decides: a key it has from before the delay, or from a batch that is run
    again, is skipped.
    """
    return stream_insert_if_absent(first_seen(stream, key, event_time, delay), path, key, checkpoint, partition, **trigger)


def trailing_statistics(
    stream: DataFrame, event_time: str, keys: Sequence[str], measures: Mapping[str, Column],
    delay: str, period: str = "1 day", name: str = "date",
) -> DataFrame:
    """Aggregates by period of event time and ``keys``, kept open for ``delay``.

    In update mode every batch gives the groups it changed, with their whole values: a row that comes late
    but within ``delay`` corrects its group, a later one is dropped and counted (``late_rows``).
    Groups combine before the shuffle; state holds the groups of one delay.
    """
    grouped = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, period).alias("__window"), *keys)
    columns = [value.alias(n) for n, value in measures.items()]
    return grouped.agg(*columns).select(F.to_date("__window.start").alias(name), *keys, *measures)


def stream_statistics(
    statistics: DataFrame, path: str, keys: Sequence[str], checkpoint: str, name: str = "date", **trigger,
) -> StreamingQuery:
    """Merge the groups each batch changed into a Parquet table partitioned by ``name``.

    ``statistics`` come from ``trailing_statistics``. Only partitions with a changed group are
    read and rewritten; a batch that is run again writes the same values.
    """
    on = [name, *keys]
    values = [c for c in statistics.columns if c not in on]
    spec = MergeSpec(on=on, update={c: c for c in values}, null_safe=True)

    def load(batch: DataFrame, _batch_id: int) -> None:
        with kept(batch) as rows:
            if not rows.isEmpty():
                merge_into_partitions(batch.sparkSession, path, rows, spec, name, schema=batch.schema)

    return (
        statistics.writeStream.outputMode("update").foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """What a query has dropped as later than its watermark so far in this run.

    An aggregate counts after combining rows of one group in a task, so this many groups' rows at least.
    """
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])
