"""SimHash near-duplicates: fingerprints, links by bit-sliced comparison, connected components.

Equal fingerprints are merged first, so copies cost nothing further. Fingerprints
within the radius agree in at least ``BLOCKS - RADIUS`` of ``BLOCKS`` bit blocks;
for every choice of that many blocks, fingerprints that agree in them meet in a
bucket. A bucket is compared bit-sliced: its fingerprints are turned into 64 bit
planes, the planes' differences are added into carry-save counters for all pairs
at once, and rows of pairs are abandoned once all exceed the radius. A bucket
gives back no pairs, only each component's members next to its smallest one.
Buckets over ``CHUNK`` are cut into parts, and every two parts meet in a task of
their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import text_hash
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
SEED = 42
CHUNK = 8192
TILE = 512
AT_ONCE = 1 << 15


def fingerprint(text: str | None) -> int:
    """Majority of the bits of XXH64 over the 4-word shingles; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(SHINGLE, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: len(words) - k + 1], ends[k - 1 :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), AT_ONCE):
        spans = zip(first[at : at + AT_ONCE].tolist(), last[at : at + AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(first), bitorder="little")
    return int(majority.view(np.int64)[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def near(prints: np.ndarray, rows: slice, radius: int = RADIUS) -> np.ndarray:
    """Which fingerprints each of ``rows`` is near to, itself aside, as packed bits."""
    n = len(prints)
    lanes = -(-n // 64)
    planes = np.zeros((64, lanes * 64), np.uint8)
    planes[:, :n] = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
    queries = prints[rows]
    here = np.arange(len(queries))
    out = np.zeros((len(queries), lanes), np.uint64)
    full = ~np.uint64(0)
    ones = np.zeros((len(queries), lanes), np.uint64)
    twos, fours, over = ones.copy(), ones.copy(), ones.copy()
    column = np.arange(rows.start, rows.start + len(queries))
    over[here, column // 64] |= np.uint64(1) << (column % 64).astype(np.uint64)
    if n % 64:
        over[:, -1] |= full << np.uint64(n % 64)
    for bit in range(0, 64, 2):
        flip = [np.where((queries >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))[:, None] for b in (bit, bit + 1)]
        a, b = planes[bit] ^ flip[0], planes[bit + 1] ^ flip[1]
        differ = a ^ b
        carry = (a & b) | (ones & differ)
        ones ^= differ
        carry, twos = twos & carry, twos ^ carry
        over |= fours & carry
        fours |= carry
        over |= fours & (ones | twos)
        if bit % 16 == 14:
            left = ~(over == full).all(axis=1)
            if not left.any():
                return out
            if not left.all():
                queries, here = queries[left], here[left]
                ones, twos, fours, over = ones[left], twos[left], fours[left], over[left]
    out[here] = ~over
    return out


def stars(prints: np.ndarray) -> list[tuple[int, int]]:
    """(member, smallest member) for each member of each component of a bucket's links."""
    n = len(prints)
    unsigned = prints.view(np.uint64)
    links = np.concatenate([near(unsigned, slice(i, min(n, i + TILE))) for i in range(0, n, TILE)])
    linked = links.any(axis=1)
    unseen = np.zeros(links.shape[1] * 64, np.uint8)
    unseen[:n] = linked
    unseen = np.packbits(unseen, bitorder="little").view(np.uint64)
    edges = []
    for first in np.flatnonzero(linked).tolist():
        if not unseen[first // 64] >> np.uint64(first % 64) & np.uint64(1):
            continue
        frontier, members = np.array([first]), [np.array([first])]
        unseen[first // 64] &= ~(np.uint64(1) << np.uint64(first % 64))
        while len(frontier):
            reached = np.bitwise_or.reduce(links[frontier], axis=0) & unseen
            unseen &= ~reached
            frontier = np.flatnonzero(np.unpackbits(reached.view(np.uint8), bitorder="little"))
            members.append(frontier)
        found = prints[np.concatenate(members)]
        least = int(found.min())
        edges += [(int(p), least) for p in found.tolist() if p != least]
    return edges


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket to star edges.

    Small buckets are compared together: a link found between two of them is a link
    all the same. No more than one bucket and one tile are held.
    """
    prints, keys = np.empty(0, np.int64), np.empty((0, 4), np.int64)

    def edges(some: np.ndarray) -> pa.RecordBatch:
        found = np.array(stars(np.unique(some)), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

    for batch in chain(batches, [None]):
        if batch is not None:
            prints = np.concatenate([prints, batch.column("print").to_numpy()])
            more = np.stack([batch.column(c).to_numpy() for c in ("t", "key", "a", "b")], axis=1)
            keys = np.concatenate([keys, more])
        ends = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
        if batch is None:
            ends.append(len(prints))
        done = last = 0
        for end in ends:
            if end - done > TILE and last > done:
                yield edges(prints[done:last])
                done = last
            last = end
        if batch is None and last > done:
            yield edges(prints[done:last])
        prints, keys = prints[done:], keys[done:]


def links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Star edges (u, v) that connect what links of distinct fingerprints (column ``print``) connect."""
    edges, width = [], [64 // BLOCKS + (i < 64 % BLOCKS) for i in range(BLOCKS)]
    for w in width:
        edges.append(edges[-1] + w if edges else w)
    masks = [sum(1 << b for b in range(e - w, e)) for e, w in zip(edges, width, strict=True)]
    choices = [sum(c) for c in combinations(masks, BLOCKS - RADIUS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in choices]
    tables = F.array(*[
        F.struct(F.lit(i).cast("long").alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(signed)
    ])
    rows = prints.select("print", F.inline(tables))
    counts = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.filter(F.col("n") > chunk).select(
        F.col("t").alias("hot_t"), F.col("key").alias("hot_key"), F.ceil(F.col("n") / chunk).alias("parts")
    )
    parted = join_reduced(rows, hot, {"t": "hot_t", "key": "hot_key"}, "left").withColumn(
        "part", F.pmod(F.xxhash64("print"), F.coalesce("parts", F.lit(1).cast("long")))
    )
    others = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: o != F.col("part"))
    )
    paired = parted.select("t", "key", "print", "part", F.explode(others).alias("other")).select(
        "t", "key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "print"
    )
    dealt = paired.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")
    return dealt.mapInArrow(_compare, "u bigint, v bigint").distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("low"))


def components(edges: DataFrame) -> DataFrame:
    """(node, low): the smallest node of its component, for each node of an edge but the smallest.

    Large and small stars in turn: every node hands its larger, then its smaller
    neighbours to the smallest one. No neighbourhood is gathered; a node with very
    many neighbours is the left side of a join that Spark can split. Each round is
    written to the shared folder.
    """
    edges = stage(edges.filter("u != v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        both = _both(edges)
        large = join_reduced(both.filter("v > u"), _least(both), {"u": "node"}, "inner").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stage(large.filter("u != v").distinct(), "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = _least(down)
        small = join_reduced(down, low, {"u": "node"}, "inner")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select(F.col("node").alias("u"), F.col("low").alias("v"))
        )
        edges = stage(small.filter("u != v").distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("low"))
        state = now


def near_groups(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document row: its id, ``__hash`` of the text, ``print``, ``component`` and ``component_id``.

    Texts are lower-cased in A-Z and cut at ASCII white space; fewer words than a
    shingle are one shingle, no words (and NULL) give fingerprint 0. Documents are
    linked if their fingerprints differ in at most RADIUS bits; component_id is the
    smallest id that links lead to, component the smallest fingerprint (two components
    may share an id, if an id is repeated). Repeated rows each give a row; NULL ids are
    linked but never name a component unless it has no other. Other columns are not
    read. An empty table gives no row.
    """
    printed = stage(
        docs.select(F.col(doc).alias("doc"), text_hash(text).alias("text_hash"), fingerprints(F.col(text)).alias("print")),
        "simhash",
    )
    distinct = stage(printed.groupBy("print").agg(F.min("doc").alias("low_doc")), "prints")
    labels = components(links(distinct.select("print")))
    labelled = join_reduced(distinct, labels, {"print": "node"}, "left").select(
        "print", "low_doc", F.coalesce("low", "print").alias("label")
    )
    ids = labelled.groupBy(F.col("label").alias("component")).agg(F.min("low_doc").alias("component_id"))
    named = join_reduced(labelled, ids, {"label": "component"}, "inner").select(
        F.col("print").alias("own"), "component", "component_id"
    )
    return join_reduced(printed, named, {"print": "own"}, "inner").select(
        F.col("doc").alias(doc), F.col("text_hash").alias("__hash"), "print", "component", "component_id"
    )


def first_of_groups(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the smallest id, then the smallest text hash.

    The chosen rows are found by (id, text hash); of rows equal in both one is left.
    """
    pair = F.struct(F.col(doc).isNull(), F.col(doc), F.col("__hash"))
    grouped = near_groups(docs, doc, text)
    chosen = grouped.groupBy("component").agg(F.min(pair).alias("p")).select(
        F.col(f"p.`{doc}`").alias("kept_doc"), F.col("p.__hash").alias("kept_hash")
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    keyed = packed.withColumn("__doc", F.col(f"__row.`{doc}`")).withColumn("__hash", text_hash(f"__row.`{text}`"))
    kept = join_reduced(keyed, chosen, {"__doc": "kept_doc", "__hash": "kept_hash"}, "left_semi", null_safe=True)
    return kept.dropDuplicates(["__doc", "__hash"]).select("__row.*")
