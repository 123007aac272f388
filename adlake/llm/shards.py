"""Shards of nearly equal bytes, by longest-processing-time scheduling of groups that stay together.

Groups (equal texts) go, largest first, to the least-loaded shard through a heap.
The heap does not see every group: groups are counted by size class, which is the
exact size up to 4096 and keeps 12 leading bits above, so there are at most 110,000
classes however many groups there are. Within a class all groups weigh the same to
a part in 2048, so it only matters how many each shard gets; a rank within the
class then says which.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import random_number, ranked, text_hash
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

LEADING_BITS = 12


def size_class(size: Column) -> Column:
    """A size without all but its LEADING_BITS leading bits."""
    shift = F.greatest(F.lit(0), F.floor(F.log2(size)).cast("int") - (LEADING_BITS - 1))
    return F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)


def level(loads: Sequence[float], weight: float, n: int) -> list[int]:
    """How many of ``n`` equal weights each shard surely gets when all go to the least loaded in turn."""
    height, below, room = 0.0, sorted(loads), n * weight
    for i in range(1, len(below) + 1):
        height = (sum(below[:i]) + room) / i
        if i == len(below) or height <= below[i]:
            break
    return [max(0, int((height - load) / weight) - 1) for load in loads]


def schedule(classes: Sequence[tuple[int, int, int]], shards: int) -> dict[int, list[int]]:
    """For (class, groups, bytes) rows: up to which rank each shard takes the groups of a class.

    A class with very many groups is levelled in one step, which leaves every shard
    what the heap would give it but for the last few.
    """
    heap = [(0.0, s) for s in range(shards)]
    out = {}
    for name, n, total in sorted(classes, reverse=True):
        weight = total / n
        given = [0] * shards
        if n > 8 * shards:
            loads = [0.0] * shards
            for load, s in heap:
                loads[s] = load
            given = level(loads, weight, n)
            heap = [(loads[s] + given[s] * weight, s) for s in range(shards)]
            heapq.heapify(heap)
        for _ in range(n - sum(given)):
            load, s = heap[0]
            given[s] += 1
            heapq.heapreplace(heap, (load + weight, s))
        ends = []
        for g in given:
            ends.append((ends[-1] if ends else 0) + g)
        out[name] = ends
    return out


def shard(
    docs: DataFrame, carried: Sequence[str], shards: int = 16, doc: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each row as ``row`` (a struct of the columns ``carried``) with ``size``, ``text_crc32``, ``shard``, ``slot``.

    ``size`` is the UTF-8 bytes of the text plus 1; NULL counts as empty. Equal texts
    share a shard (texts of equal 64-bit hash are taken for equal: they stay together
    too). Shards are as equal in bytes as whole groups allow: one group larger than a
    shard's part makes its shard the largest. ``slot`` numbers the rows of a shard
    from 0, by id within parts of it; rows equal in id and text are numbered in any order.
    An empty table gives no row.
    """
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col(f"`{doc}`").alias("doc"),
        (F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("text_crc32"), text_hash(f"`{text}`").alias("key"),
    )
    groups = stage(
        base.groupBy(F.col("key").alias("group")).agg(F.sum("size").alias("bytes"))
        .withColumn("size_class", size_class(F.col("bytes"))), "shard-groups",
    )
    found = groups.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    ends = schedule([(r.size_class, r.n, r.bytes) for r in found], shards)
    # At most one row for each size class, so of a proven size.
    plan = F.broadcast(docs.sparkSession.createDataFrame(list(ends.items()), "size_class bigint, ends array<bigint>"))
    placed = ranked(groups, ["size_class"], [F.xxhash64("group"), F.col("group")], "rank").join(plan, "size_class").select(
        "group", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")
    )
    rows = join_reduced(base, placed, {"key": "group"}, "inner").drop("group")
    assigned = stage(rows.withColumn("spread", random_number()), "sharded")
    return ranked(assigned, ["shard"], [F.col("doc"), F.col("key")], "slot", "spread").select(
        "row", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )
