"""Token counts of whole texts, by pre-tokens.

The vocabulary has no piece that goes on after a space mark, so a text's count is
the sum over its pre-tokens: a run of spaces with the word behind it. Lengths are
looked up in two steps inside the scan: a table of the most frequent pre-tokens,
broadcast with a bound on entries and their size, then a cache of each worker;
what both miss is encoded. No pre-token is ever shuffled: the frequent ones are
found from summaries of a bounded size, one for each task, over all texts.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse, islice, repeat

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Entries of the broadcast table, and their longest pre-token in characters.
TABLE = 1 << 16
WORD = 32
# Entries of a task's summary and of a worker's cache; longer pre-tokens are not cached.
SUMMARY = 1 << 14
CACHE = 1 << 18
CACHED_WORD = 128
MARK = "▁"


def pre_tokens(text: str) -> list[str]:
    """The parts of a text, each as it must be given to the tokenizer, which adds a space of its own."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    parts = text.split(" ")
    return parts if "" not in parts else [t[1:] for t in re.findall(" +[^ ]*", " " + text)]


def separable(model: bytes) -> bool:
    """Whether every piece keeps space marks in front, so that counts of pre-tokens add up."""
    processor = loaded(model)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    return not any(MARK in p.lstrip(MARK) for p in pieces) and processor.encode(["a  b", " a"], out_type=str) == [
        [*processor.encode("a", out_type=str), *processor.encode(" b", out_type=str)],
        processor.encode(" a", out_type=str),
    ] and processor.encode(" a", out_type=str) != processor.encode("a", out_type=str)


@lru_cache(maxsize=2)
def loaded(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def lengths(words: list[str], model: bytes) -> list[int]:
    """Tokens of each pre-token; a lone space, given as empty, is one."""
    return [len(ids) or 1 for ids in loaded(model).encode(words, num_threads=1)]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent pre-tokens of a task, counted in bounded memory."""
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(pre_tokens(text or ""))
            if len(seen) > 8 * SUMMARY:
                seen = Counter(dict(seen.most_common(2 * SUMMARY)))
    top = [(w, n) for w, n in seen.most_common(2 * SUMMARY) if len(w) <= WORD][:SUMMARY]
    for at in range(0, len(top), 4096):
        words, counts = zip(*top[at : at + 4096], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


def frequent(docs: DataFrame, text: str = "text", size: int = TABLE) -> list[str]:
    """About the most frequent pre-tokens of all texts; which they are changes speed, not counts."""
    found = docs.select(F.col(text)).mapInArrow(_summaries, "word string, n bigint")
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return [r.word for r in top.collect()]


def counter(table: dict[str, int], model: bytes):
    """A function from texts to token counts, with a cache it keeps between calls."""
    cache: dict[str, int] = {}

    def count(texts: list[str | None]) -> list[int]:
        if len(cache) > CACHE:
            for word in list(islice(cache, CACHE // 2)):  # the oldest half
                del cache[word]
        known, missed = [], []
        for text in texts:
            words = pre_tokens(text or "")
            known.append(sum(map(table.get, words, repeat(0))))
            missed.append(list(filterfalse(table.__contains__, words)))
        new = list({w for words in missed for w in filterfalse(cache.__contains__, words)})
        if new:
            cache.update(zip(new, lengths(new, model), strict=True))
        counts = [n + sum(map(cache.__getitem__, words)) for n, words in zip(known, missed, strict=True)]
        for word in new:
            if len(word) > CACHED_WORD:
                del cache[word]
        return counts

    return count


_counters: dict[str, tuple] = {}


def _worker_counter(name: str, shared):
    """The counter of this worker process; its cache serves all tasks of a run."""
    if name not in _counters:
        _counters.clear()
        _counters[name] = counter(*shared.value)
    return _counters[name]


def token_counts(
    docs: DataFrame, model_path: str, limit: int, doc: str = "doc_id", text: str = "text", table_size: int = TABLE,
) -> DataFrame:
    """For each row its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``).

    Counts are those of the SentencePiece model over the whole text, without begin or
    end tokens. NULL counts as empty, with 0 tokens. Repeated rows each give a row;
    other columns are not read; an empty table gives no row. The model is read on the
    driver and broadcast.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    if not separable(model):
        raise ValueError("this vocabulary has pieces across spaces, so pre-tokens do not add up")
    words = frequent(docs, text, table_size)
    shared = docs.sparkSession.sparkContext.broadcast((dict(zip(words, lengths(words, model), strict=True)), model))

    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _worker_counter(name, shared)
        for batch in batches:
            n = count(batch.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[doc].dataType.simpleString()
    narrow = docs.select(
        F.col(doc).alias("doc"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("__text"),
    )
    return narrow.mapInArrow(run, f"doc {kind}, n_bytes bigint, n_tokens bigint").select(
        F.col("doc").alias(doc), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
