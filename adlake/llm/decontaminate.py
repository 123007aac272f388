"""Benchmark decontamination by winnowing.

Texts become hashes of ``GRAM`` words; of each ``SPREAD`` consecutive hashes the
smallest is kept. Two texts that share WINDOW = GRAM + SPREAD - 1 words keep the
same hash inside the shared span, so looking for the kept hashes finds every window.
A kept hash that both have is extended to the windows it is the smallest of: only
windows that are equal as a whole are joined, so a phrase that many texts and items share
but nothing around it makes no rows. Items shorter than a window are looked up whole.

Two bit maps of a fixed size, of the benchmark's kept hashes and of its windows, are broadcast:
only windows that both may know leave the scan of the texts, as two hashes of 64 bits each, which
stand for the words. Texts and words are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import text_hash
from adlake.llm.hashing import ALNUM, gram_hashes, word_hashes, word_spans
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

WINDOW = 10
GRAM = 5
SPREAD = WINDOW - GRAM + 1
MAP_BITS = 24
CANDIDATES = "array<struct<pos:int,k:int,gram:bigint,hash:bigint,check:bigint>>"


def _words(texts: list[str | None]):
    """Folded bytes of all texts, spans, hashes and text number of all words."""
    blobs = [(t or "").encode() for t in texts]
    folded = ALNUM[np.frombuffer(b"\n".join(blobs), np.uint8)]
    starts, ends = word_spans(folded)
    begins = np.concatenate([[0], np.cumsum([len(b) + 1 for b in blobs])])
    return folded, starts, ends, word_hashes(folded, starts, ends), np.searchsorted(begins, starts, "right") - 1


def _least(grams: np.ndarray, n: int) -> np.ndarray:
    """The smallest hash of each of ``n`` windows."""
    least = grams[:n].copy()
    for j in range(1, SPREAD):
        np.minimum(least, grams[j : j + n], out=least)
    return least


def _on_map(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    slot = (found >> np.uint64(64 - MAP_BITS)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def fingerprints(texts: list[str | None], short: tuple[int, ...], known: tuple[np.ndarray, np.ndarray] | None, own: bool = False):
    """Number of words per text and, per text, its windows as (place, 0, kept hash, two hashes of the window).

    ``short``: lengths looked up whole, as (place, length, hash, both hashes). ``known``: the bit maps of
    kept hashes and of windows that others must be in. ``own``: of the benchmark itself, where a short
    text has its whole hash only.
    """
    found: list[list[tuple]] = [[] for _ in texts]
    folded, starts, ends, hashes, of = _words(texts)
    counts = np.bincount(of, minlength=len(texts)).astype(np.int64)
    n = len(hashes)
    at_start = np.concatenate([[0], np.cumsum(counts)])

    def add(where: np.ndarray, k: int, grams: np.ndarray, whole: np.ndarray, size: int) -> None:
        for p, gram, one in zip(where.tolist(), grams.view(np.int64).tolist(), whole.view(np.int64).tolist()):
            # Of the words' bytes themselves, so that no two words of one hash pass for each other.
            words = b" ".join(folded[starts[i] : ends[i]].tobytes() for i in range(p, p + size))
            check = int.from_bytes(blake2b(words, digest_size=8).digest(), "little", signed=True)
            found[of[p]].append((p - int(at_start[of[p]]), k, gram, one, check))

    if n >= WINDOW:
        m = n - WINDOW + 1
        least, windows = _least(gram_hashes(hashes, GRAM), m), gram_hashes(hashes, WINDOW)
        where = np.flatnonzero(of[:m] == of[WINDOW - 1 :])
        if known is not None:
            where = where[_on_map(known[0], least[where])]
            where = where[_on_map(known[1], windows[where])]
        add(where, 0, least[where], windows[where], WINDOW)
    for k in short:
        if n < k:
            continue
        grams = gram_hashes(hashes, k)
        whole = of[: len(grams)] == of[k - 1 : k - 1 + len(grams)]
        if own:
            whole &= counts[of[: len(grams)]] == k
        where = np.flatnonzero(whole)
        if known is not None:
            where = where[_on_map(known[1], grams[where])]
        add(where, k, grams[where], grams[where], k)
    return counts, found


def _scan(short: tuple[int, ...], known, own: bool):
    """Batches of texts to batches of word counts and fingerprints; other columns pass through."""
    fields = pa.struct([("pos", pa.int32()), ("k", pa.int32()), ("gram", pa.int64()), ("hash", pa.int64()), ("check", pa.int64())])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if known is None else tuple(np.frombuffer(b, np.uint8) for b in known.value)
        for batch in batches:
            texts = batch.column("__text").to_pylist()
            counts, found = fingerprints(texts, short, bits, own)
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            rows = [[dict(zip(names, f, strict=True)) for f in one] for one in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(counts, pa.int64()), pa.array(rows, pa.list_(fields))],
                names=[batch.schema.names[i] for i in keep] + ["n_words", "found"],
            )

    return run


def benchmark_index(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> tuple[DataFrame, tuple[int, ...]]:
    """The items' windows, one row for each (k, gram, hash, check) with its items, and the short lengths."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("__text"))
    scanned = items.mapInArrow(
        _scan(tuple(range(1, WINDOW)), None, True), f"item string, n_words bigint, found {CANDIDATES}"
    )
    index = stage(
        scanned.select("item", F.inline("found"))
        .groupBy("k", "gram", "hash", "check").agg(F.collect_set("item").alias("items")), "winnow-items"
    )
    return index, tuple(r.k for r in index.filter("k > 0").select("k").distinct().orderBy("k").collect())


def bit_map(index: DataFrame, column: str = "hash") -> bytes:
    """Which leading bits the hashes of a column have: 2 ** MAP_BITS bits whatever their number."""
    byte = F.shiftrightunsigned(column, 64 - MAP_BITS).cast("int")
    rows = index.groupBy(F.shiftright(byte, 3).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), byte.bitwiseAND(7))).alias("bits")
    )
    out = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    for batch in rows.toArrow().to_batches():
        out[batch.column("at").to_numpy()] = batch.column("bits").to_numpy().astype(np.uint8)
    return out.tobytes()


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document row: its id, ``__hash`` of the text, ``n_words``, ``n_hit``, ``n_items``,
    ``items`` (sorted as strings), ``contaminated``.

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII characters. A
    word is hit if it lies in an occurrence of ten consecutive words of an item, or
    of a whole item of fewer; n_items counts the items with occurrences. NULL and
    empty texts have no words; items without words match nothing; a NULL item id
    counts as an empty one, and rows of one id are one item. Repeated documents each
    give a row. Other columns are not read. Without documents there is no row,
    without items nothing is hit.
    """
    spark = docs.sparkSession
    index, short = benchmark_index(benchmark)
    known = spark.sparkContext.broadcast((bit_map(index.filter("k = 0"), "gram"), bit_map(index)))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc).alias("doc"), text_hash(text).alias("text_hash"),
        F.col(text).alias("__text"),
    )
    scanned = stage(
        narrow.mapInArrow(
            _scan(short, known, False),
            f"row bigint, doc {docs.schema[doc].dataType.simpleString()}, text_hash bigint, n_words bigint, found {CANDIDATES}",
        ), "winnow",
    )
    hits = scanned.filter(F.size("found") > 0).select("row", F.inline("found"))
    other = index.select(*(F.col(c).alias(f"item_{c}") for c in index.columns))
    length = F.when(F.col("k") == 0, WINDOW).otherwise(F.col("k"))
    # The items' side has one row for each key.
    ranges = (
        join_reduced(hits, other, {c: f"item_{c}" for c in ("k", "gram", "hash", "check")}, "inner")
        .withColumn("span", F.struct(F.col("pos").alias("lo"), (F.col("pos") + length).alias("hi")))
        .groupBy("row").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("item_items").alias("lists"))
    )
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto"))
    covered = F.aggregate("spans", start, lambda a, s: F.struct(
        (a["total"] + F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], a["upto"]))).alias("total"),
        F.greatest(a["upto"], s["hi"]).alias("upto"),
    ))["total"]
    per_row = ranges.select(
        F.col("row").alias("hit_row"), covered.cast("long").alias("covered"),
        F.array_sort(F.array_distinct(F.flatten("lists"))).alias("hit_items"),
    )
    none = F.array().cast("array<string>")
    return join_reduced(scanned.drop("found"), per_row, {"row": "hit_row"}, "left").select(
        F.col("doc").alias(doc), F.col("text_hash").alias("__hash"), "n_words",
        F.coalesce("covered", F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("hit_items", none)).cast("long").alias("n_items"),
        F.coalesce("hit_items", none).alias("items"), F.col("covered").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no window of the benchmark occurs."""
    bad = (
        decontaminate(docs, benchmark, doc, text).filter("contaminated")
        .select(F.col(doc).alias("__bad_doc"), F.col("__hash").alias("__bad_hash")).distinct()
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    keyed = packed.withColumn("__doc", F.col(f"__row.`{doc}`")).withColumn("__hash", text_hash(f"__row.`{text}`"))
    clean = join_reduced(keyed, bad, {"__doc": "__bad_doc", "__hash": "__bad_hash"}, "left_anti", null_safe=True)
    return clean.select("__row.*")
