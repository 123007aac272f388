"""Mix sources to target weights by fitting word budgets.

Documents are counted by source and exact length, map side first. Each source's
budget is whole repeats of all its documents plus a rest; the rest is fitted on the
counts: every length gives its share, and what is still missing is filled by a
bounded-knapsack table over a bounded number of words. Documents are then picked by
a seeded hash, as many of each length as the fit says.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import random_number, ranked
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

WORDS = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3
# Words the knapsack table spans; what exceeds them is filled with the longest documents first.
SPAN = 1 << 16
# Leading bits of a hash that documents of a length are counted by.
RANGE_BITS = 8


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (1, 2, 3)) -> dict[str | None, float]:
    """Words for each source: by weight of all words, at most MOST_REPEATS times its own, the rest shared again.

    Sources are sorted by code point, NULL last, and take the weights in turn.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, open_names = float(sum(sizes.values())), names
    while open_names:
        total = sum(weight[s] for s in open_names)
        above = [s for s in open_names if left * weight[s] / total > MOST_REPEATS * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in open_names}
        for s in above:
            out[s] = float(MOST_REPEATS * sizes[s])
        left -= sum(out[s] for s in above)
        open_names = [s for s in open_names if s not in out]
    return out


def fit(lengths: Sequence[int], counts: Sequence[int], budget: int, span: int = SPAN) -> list[int]:
    """How many documents of each length to take so that their words come nearest to ``budget``.

    Each length first gives its share; then, while more than ``span`` words are
    missing, the longest that fit; the rest is a bounded knapsack, solved exactly.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if not total or budget <= 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    taken = [c * budget // total for c in counts]
    rest = budget - sum(n * k for n, k in zip(lengths, taken, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        if n and rest > span:
            more = min(counts[i] - taken[i], rest // n, -(-(rest - span) // n))
            taken[i] += more
            rest -= more * n
    free = [(n, i, counts[i] - taken[i]) for i, n in enumerate(lengths) if n and counts[i] > taken[i]]
    if not free or rest <= 0:
        return taken
    # One more than enough: a sum above the rest may be nearer than the best below it.
    limit = min(rest, span) + min(n for n, _, _ in free)
    reached = np.zeros(limit + 1, bool)
    reached[0] = True
    by = np.full(limit + 1, -1, np.int32)
    parts: list[tuple[int, int]] = []
    for n, i, most in sorted(free, reverse=True):
        most, size = min(most, limit // n), 1
        while most > 0:  # 1, 2, 4, ... documents of one length at a time
            size = min(size, most)
            step = n * size
            new = reached[:-step] & ~reached[step:] if step <= limit else None
            if new is not None:
                by[step:][new] = len(parts)
                reached[step:] |= new
                parts.append((i, size))
            most -= size
            size *= 2
        if reached[min(rest, limit)]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, size = parts[by[at]]
        taken[i] += size
        at -= lengths[i] * size
    return taken


def _last_bits_first(number: Column) -> Column:
    """A number that sorts as the last six bits of ``number``, then as ``number`` itself: what documents are picked by."""
    last = F.call_function("shiftleft", number.bitwiseAND(63) - 32, F.lit(58))
    return last.bitwiseOR(F.call_function("shiftright", number, F.lit(6)) + F.lit(1 << 57))


def _keyed(docs: DataFrame, carried: Sequence[str], doc: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col(f"`{source}`").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`")), F.lit("")).alias("source_key"),
        words_in(F.col(f"`{text}`")).alias("size"),
        _last_bits_first(F.xxhash64(F.lit(seed), F.col(f"`{doc}`"), F.col(f"`{text}`"))).alias("order"),
    )


def last_picked(slim: DataFrame, counts: DataFrame, planned: DataFrame) -> DataFrame:
    """For each source and length that gives some: ``last``, the greatest hash among those picked, ``ties``, how many
    rows have it, and ``open``, how many of these are picked.

    The counts by leading bits of the hash say in which range the last one lies; only the
    hashes of that range are sorted, each once.
    """
    earlier = Window.partitionBy("source_key", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    reached = counts.withColumn("before", before).join(planned, ["source_key", "size"])
    ranges = stage(
        reached.filter("before < picked AND picked <= before + n").select(
            F.col("source_key").alias("__source"), F.col("size").alias("__size"), F.col("range").alias("__range"),
            (F.col("picked") - F.col("before")).alias("need"),
        ), "mix-ranges",
    )
    near = join_reduced(slim, ranges, {"source_key": "__source", "size": "__size", "range": "__range"}, "inner")
    ties = near.groupBy("source_key", "size", "need", "order").agg(F.count(F.lit(1)).alias("ties"))
    smaller = Window.partitionBy("source_key", "size").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    found = ties.withColumn("below", F.coalesce(F.sum("ties").over(smaller), F.lit(0)))
    return found.filter("below < need AND need <= below + ties").select(
        "source_key", "size", F.col("order").alias("last"), "ties", (F.col("need") - F.col("below")).alias("open")
    )


def mix(
    docs: DataFrame, carried: Sequence[str], doc: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (1, 2, 3), seed: int = 7,
) -> DataFrame:
    """Each row as ``row`` (a struct of the columns ``carried``) with ``size``, ``source_size``, ``target``, ``copies``.

    ``size`` is the number of words; NULL and empty texts have none and are not
    taken. ``copies`` is how often the mix takes the row, 0 to MOST_REPEATS. NULL is
    a source of its own. Rows of one source, id and text are picked in any order; otherwise
    reruns agree. An empty table gives
    no row. One number per source comes to the driver.

    Of each source and length those with the least hashes are picked, so a row is judged by
    comparing its hash with the last one picked, and rows are not sorted. Only where some of
    equal rows are picked and some not are these numbered.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, carried, doc, text, source, seed)
    range_of = F.call_function("shiftright", F.col("order"), F.lit(64 - RANGE_BITS)).alias("range")
    slim = stage(keyed.select("source", "source_key", "size", "order", range_of), "mix-sizes")
    counts = stage(slim.groupBy("source", "source_key", "size", "range").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sizes = {r.source: r.words or 0 for r in counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()}
    goals = targets(sizes, weights)
    key = {s: "" if s is None else "=" + s for s in sizes}
    budgets = {key[s]: (goals[s], sizes[s]) for s in sizes}

    def plan(histogram: pd.DataFrame) -> pd.DataFrame:
        goal, size = budgets[histogram.source_key.iloc[0]]
        lengths, have = histogram["size"].tolist(), histogram["n"].tolist()
        repeats = min(MOST_REPEATS, int(goal // size)) if size else 0
        rest = round(goal) - repeats * size if repeats < MOST_REPEATS else 0
        return histogram[["source_key", "size"]].assign(repeats=repeats, picked=fit(lengths, have, rest))

    histogram = counts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    planned = histogram.groupBy("source_key").applyInPandas(plan, "source_key string, size bigint, repeats bigint, picked bigint")
    goal_rows = spark.createDataFrame(
        [(k, float(g), int(n)) for k, (g, n) in budgets.items()], "source_key string, target double, source_size bigint"
    )
    planned = stage(planned.join(goal_rows, "source_key"), "mix-plan")
    ends = planned.drop("picked").join(last_picked(slim, counts, planned), ["source_key", "size"], "left")
    limits = stage(ends.withColumnsRenamed({"source_key": "__source", "size": "__size"}), "mix-limits")
    # Every row has its limit; an inner join would count the words once more, to filter by them.
    judged = join_reduced(keyed.drop("source"), limits, {"source_key": "__source", "size": "__size"}, "left")
    torn = F.coalesce((F.col("order") == F.col("last")) & (F.col("open") < F.col("ties")), F.lit(False))

    def copies(rows: DataFrame, picked: Column) -> DataFrame:
        more = F.when(F.col("size") > 0, F.col("repeats") + F.coalesce(picked, F.lit(False)).cast("long")).otherwise(0)
        return rows.select("row", "size", "source_size", "target", more.alias("copies"))

    if limits.filter("open < ties").isEmpty():
        return copies(judged, F.col("order") <= F.col("last"))
    tied = stage(judged.filter(torn).withColumn("spread", random_number()), "mix-ties")
    numbered = ranked(tied, ["source_key", "size"], [F.col("spread")], "rank")
    return copies(judged.filter(~torn), F.col("order") <= F.col("last")).unionByName(
        copies(numbered, F.col("rank") < F.col("open"))
    )


def mixed(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, with all their columns, each as often as it is taken."""
    taken = mix(docs, docs.columns, doc, text, source).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
