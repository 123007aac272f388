"""Byte-level BPE of whole texts, long ones by overlapping chunks, and back to bytes.

A text of at most ``chunk`` characters is one chunk and is encoded in the scan. A longer one is
cut into chunks that reach ``overlap`` characters into the next one. All chunks are pre-tokenised
side by side, each from its own start, which need not be a true boundary of pre-tokens. Chunks are
then stitched at the first boundary in the overlap that this chunk's and the next chunk's scan
share: from there on both are the same. Chunks without such a place are put together. What lies
between two stitches is a piece; pieces are encoded side by side, and their ids are put in order.

When is a shared boundary a true one? A pre-token never goes on from a character that is no white
space to white space. So every scan, wherever it starts, has a boundary at the first such place and
is true behind it. A stitch must lie behind that place of its chunk. Nor is a boundary used within
three characters of the chunk's end, as what follows could change the match before it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

# Characters of a chunk, and how far it reaches into the next one.
CHUNK = 1 << 15
OVERLAP = 1 << 9
# The longest alternative of a fixed length in the pattern ('re, 've, 'll).
MARGIN = 3
# Entries of a worker's cache; longer pre-tokens are not cached. Chunks of one Arrow batch.
CACHE = 1 << 18
CACHED_WORD = 64
BATCH_CHUNKS = 64

_anchor = regex.compile(r"(?<=\S)\s")


def read_ranks(path: str) -> bytes:
    """A vocabulary file of lines ``base64 rank``."""
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Pre-tokens, ids and bytes by one vocabulary and pattern, with a bounded cache."""

    def __init__(self, vocabulary: bytes, pattern: str):
        pairs = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.cache: dict[str, bytes] = {}

    def pre_tokens(self, text: str, start: int = 0) -> list[str]:
        """The pattern's matches from ``start`` on, which leave no character out."""
        found = self.pattern.findall(text, start)
        if sum(map(len, found)) != len(text) - start:
            raise ValueError("the pattern leaves characters out")
        return found

    def packed(self, words: list[str]) -> bytes:
        """The ids of pre-tokens as little-endian unsigned 32-bit integers."""
        cache = self.cache
        if len(cache) > CACHE:
            for word in list(islice(cache, CACHE // 2)):  # the oldest half
                del cache[word]
        long = {}
        for word in set(words).difference(cache):
            # One pre-token at a time: the library's own pattern fails on very long runs of spaces.
            ids = np.array(self.library._encode_single_piece(word.encode()), "<u4").tobytes()
            (cache if len(word) <= CACHED_WORD else long)[word] = ids
        if long:
            return b"".join([cache.get(w) or long[w] for w in words])
        return b"".join(map(cache.__getitem__, words))

    def decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(vocabulary: bytes, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def chunks_of(text: str, chunk: int, overlap: int) -> list[tuple[int, str, bool]]:
    """Place, characters with the overlap, and whether it is the last one, of each chunk."""
    starts = range(0, max(len(text), 1), chunk)
    return [(i, text[s : s + chunk + overlap], s + chunk >= len(text)) for i, s in enumerate(starts)]


def stitch_of(coder: Codec, place: int, text: str, chunk: int) -> int | None:
    """Where in the overlap the next chunk takes over, from its start; None if the scans share no sure boundary."""
    if place:
        found = _anchor.search(text)
        if found is None:
            return None
        sure = found.start()
    else:
        sure = 0
    last = len(text) - MARGIN
    own = {p for p in accumulate(map(len, coder.pre_tokens(text))) if max(sure, chunk) <= p <= last}
    following = accumulate(map(len, coder.pre_tokens(text[chunk:])), initial=chunk)
    return next((p - chunk for p in following if p in own), None)


def piece_words(coder: Codec, texts: list[str], begin: int, end: int | None, chunk: int) -> list[str]:
    """The pre-tokens of a piece: chunks in order, from ``begin`` of the first to ``end`` behind the last one's body."""
    whole = "".join([t[:chunk] for t in texts[:-1]] + texts[-1:])
    words = coder.pre_tokens(whole, begin)
    if end is None:
        return words
    limit = len(texts) * chunk + end
    starts = accumulate(map(len, words), initial=begin)
    return [w for w, s in zip(words, starts) if s < limit]


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int64)
    if offsets[-1] >= 2**31:
        raise ValueError("a batch holds more than 2^31 tokens")
    values = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def encode(
    docs: DataFrame, vocabulary_path: str, pattern: str, doc: str = "doc_id", text: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """For each row its id, ``n_tokens`` and ``ids`` (array<int>), as the library gives for the whole text.

    ``pattern`` must leave no character out and never match white space behind another
    character. NULL and empty texts have no ids. Repeated rows each give a row; a repeated
    long text is encoded once. Ids may be NULL or repeat; other columns are not read; an empty
    table gives no row. The vocabulary is read on the driver and broadcast. Chunks of long
    texts are staged in the shared folder.
    """
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(vocabulary_path), pattern))
    kind = docs.schema[doc].dataType.simpleString()
    narrow = docs.select(F.col(doc).alias("doc"), F.col(text).alias("body"))
    length = F.coalesce(F.char_length("body"), F.lit(0))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*shared.value)
        for batch in batches:
            ids = _id_lists([coder.packed(coder.pre_tokens(t or "")) for t in batch.column("body").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), ids], names=["doc", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, body in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist()):
                found = chunks_of(body, chunk, overlap)
                for at in range(0, len(found), BATCH_CHUNKS):
                    places, texts, lasts = zip(*found[at : at + BATCH_CHUNKS])
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key] * len(places), "place": pa.array(places, pa.int32()), "body": texts, "last": lasts}
                    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*shared.value)
        for batch in batches:
            places, bodies, lasts = (batch.column(c).to_pylist() for c in ("place", "body", "last"))
            stitches = [None if z else stitch_of(coder, p, b, chunk) for p, b, z in zip(places, bodies, lasts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("place"), batch.column("body"), pa.array(stitches, pa.int32())],
                names=["key", "place", "body", "stitch"],
            )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():  # a piece may be as long as its text, so one at a time
                words = piece_words(coder, row["bodies"], row["begin"] or 0, row["end"], chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["key"]]), pa.array([row["piece"]], pa.int64()), _id_lists([coder.packed(words)])],
                    names=["key", "piece", "ids"],
                )

    short = narrow.filter(length <= chunk).mapInArrow(whole, f"doc {kind}, ids array<int>")
    long = narrow.filter(length > chunk).withColumn("key", F.sha2("body", 256))
    cuts = long.select("key", "body").mapInArrow(cut, "key string, place int, body string, last boolean")
    # Copies of a text have equal chunks, of which one is kept before the shuffle.
    distinct = cuts.groupBy("key", "place").agg(F.first("body").alias("body"), F.first("last").alias("last"))
    scanned = stage(distinct.mapInArrow(scan, "key string, place int, body string, stitch int"), "bpe-chunks")
    # A row for each chunk of one text, without its characters.
    order = Window.partitionBy("key").orderBy("place")
    placed = scanned.select("key", "place", F.lag("stitch").over(order).alias("begin")).withColumn(
        "piece", F.sum((F.col("begin").isNotNull() | (F.col("place") == 0)).cast("long")).over(order)
    )
    part = F.struct("place", "body", "begin", "stitch")
    joined = scanned.join(placed, ["key", "place"]).groupBy("key", "piece").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    encoded = joined.select(
        "key", "piece", F.col("parts.body").alias("bodies"), F.element_at("parts", 1)["begin"].alias("begin"),
        F.element_at("parts", -1)["stitch"].alias("end"),
    ).mapInArrow(pieces, "key string, piece bigint, ids array<int>")
    texts = encoded.groupBy(F.col("key").alias("__key")).agg(
        F.flatten(F.array_sort(F.collect_list(F.struct("piece", "ids")))["ids"]).alias("ids")
    )
    stitched = join_reduced(long.select("doc", "key"), texts, {"key": "__key"}, "left").select("doc", "ids")
    return short.unionByName(stitched).select(
        F.col("doc").alias(doc), F.size("ids").cast("long").alias("n_tokens"), "ids"
    )


def decode(encoded: DataFrame, vocabulary_path: str, pattern: str, doc: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with ``packed`` (ids as little-endian unsigned 32-bit integers) and ``decoded`` bytes.

    ``decoded`` joins the bytes of the ids, which need not be UTF-8 for ids of other origin. A
    NULL list counts as empty; an id that the vocabulary lacks is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast((read_ranks(vocabulary_path), pattern))
    kind = encoded.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*shared.value)
        for batch in batches:
            lists = batch.column("ids")
            arrays = [np.asarray(s.values) if s.is_valid else np.empty(0, np.int32) for s in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("n_tokens"), pa.array([a.astype("<u4").tobytes() for a in arrays], pa.binary()),
                 pa.array([coder.decoded(a.tolist()) for a in arrays], pa.binary())],
                names=["doc", "n_tokens", "packed", "decoded"],
            )

    rows = encoded.select(F.col(doc).alias("doc"), "n_tokens", "ids")
    return rows.mapInArrow(run, f"doc {kind}, n_tokens bigint, packed binary, decoded binary").withColumnRenamed("doc", doc)
