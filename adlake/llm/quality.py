"""Quality rules: counts of each text, and an n-gram perplexity with bands for each language.

The model is a modified Kneser-Ney model over grams of five characters, counted and estimated by
Spark over all texts: every gram is kept, so the model grows with the texts. Characters are code
points; only letters A-Z (as a-z), digits (as one) and white space (as one) are merged. The model
is stored as arrays of gram hashes, sorted, with their log probabilities. It is dealt by
hash into slices of a bounded size; each is broadcast on its own, and the texts are read once for
each slice, to which a text's score adds what its grams in there weigh. (One slice up to some
two million grams; the grams of a language's words grow ever more slowly.)

Each text counts once, however many copies it has; else the copies of one text could move the
model and the bands until they fit no other. Bands come from the distribution of all texts of a
language: text far less or far more predictable than that is rejected.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.llm.common import text_hash
from adlake.llm.decontaminate import MAP_BITS, bit_map
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

ORDER = 5
# What stands before a text's first character.
START = "\x02"
# Characters that are worked on at a time, in scoring and in counting, and different grams that a task holds before
# it passes them on.
PIECE = 1 << 18
BLOCK = 1 << 20
HELD_GRAMS = 1 << 21
# So many different symbols leave a gram below 2 ** 64.
MOST_SYMBOLS = 7000
# Grams of a slice on average: 12 bytes each, and 4 for the index.
SLICE = 1 << 21
WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
REPEAT = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Steps of log perplexity that distributions are taken over; the band in quartile widths, and what a
# text of n grams may lie beyond it, times 1 / sqrt(n): some three standard errors of its mean.
STEPS = 1024
BELOW = ABOVE = 4.0
LEAST_WIDTH = 0.02
SHORT_TEXT = 3.0
IS_WHITE = np.isin(np.arange(256), list(WHITE))
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _merged() -> np.ndarray:
    """What each ASCII character counts as."""
    table = np.arange(128, dtype=np.uint32)
    table[65:91] += 32
    table[48:58] = 48
    table[list(WHITE)] = 32
    return table


MERGED = _merged()


def symbols(text: str) -> Iterator[np.ndarray]:
    """The symbols of a text with the ORDER - 1 before them, a piece at a time."""
    before = np.full(ORDER - 1, ord(START), np.uint32)
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        ascii_only = points < 128
        run = np.concatenate([before, np.where(ascii_only, MERGED[np.where(ascii_only, points, 0)], points)])
        before = run[-(ORDER - 1) :]
        yield run


def hashes(run: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of a run of symbols."""
    n = len(run) - ORDER + 1
    found = np.zeros(n, np.uint64)
    wide = run.astype(np.uint64)
    for j in range(ORDER):
        found = (found ^ wide[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    return found * np.uint64(0xBF58476D1CE4E5B9)


def grams_of(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different grams of some runs as rows of symbols, and how often each occurs.

    Symbols are numbered, so that a gram is one whole number and sorting finds its copies. Runs with
    more different symbols than that allows are halved.
    """
    used = np.unique(np.concatenate([np.unique(r) for r in runs])).astype(np.uint32)
    base = len(used)
    if base > MOST_SYMBOLS:
        if len(runs) == 1:
            middle = len(runs[0]) // 2
            runs = [runs[0][: middle + ORDER - 1], runs[0][middle:]]
        half = len(runs) // 2
        parts = [grams_of(runs[:half]), grams_of(runs[half:])]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    number = np.zeros(int(used[-1]) + 1, np.uint64)
    number[used] = np.arange(base, dtype=np.uint64)
    keys = []
    for run in runs:
        digits = number[run]
        n = len(run) - ORDER + 1
        key = digits[:n].copy()
        for j in range(1, ORDER):
            key *= np.uint64(base)
            key += digits[j : j + n]
        keys.append(key)
    whole = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]])) if len(whole) else np.zeros(0, np.int64)
    different, counts = whole[first], np.diff(np.append(first, len(whole)))
    rows = np.empty((len(different), ORDER), np.uint32)
    for j in range(ORDER - 1, -1, -1):
        rows[:, j] = used[(different % np.uint64(base)).astype(np.int64)]
        different = different // np.uint64(base)
    return rows, counts


def hashes_of_rows(rows: np.ndarray) -> np.ndarray:
    return hashes(rows.reshape(-1))[::ORDER] if len(rows) else np.zeros(0, np.uint64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams and counts of a task, each gram once unless the task meets more than it may hold."""
    seen, n = np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
    waiting: list[np.ndarray] = []
    size = 0

    def settled() -> tuple[np.ndarray, np.ndarray]:
        rows, counts = grams_of(waiting)
        rows, counts = np.concatenate([seen, rows]), np.concatenate([n, counts])
        keys = hashes_of_rows(rows)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return rows[order[first]], np.add.reduceat(counts[order], first)

    def passed_on() -> Iterator[pa.RecordBatch]:
        for at in range(0, len(n), 1 << 16):
            whole = seen[at : at + (1 << 16)].tobytes().decode("utf-32-le", "surrogatepass")
            grams = [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(n[at : at + (1 << 16)])], names=["gram", "n"])

    for batch in batches:
        for text in batch.column(0):
            for run in symbols(text.as_py() or ""):
                if len(run) >= ORDER:
                    waiting.append(run)
                    size += len(run)
                if size > BLOCK:
                    seen, n = settled()
                    waiting, size = [], 0
                    if len(n) > HELD_GRAMS:
                        yield from passed_on()
                        seen, n = seen[:0], n[:0]
    if waiting:
        seen, n = settled()
    yield from passed_on()


def discounts(found: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, from how many grams have counts of 1 to 4."""
    if min(found) == 0:
        return [0.5, 0.75, 0.75]
    y = found[0] / (found[0] + 2 * found[1])
    plain = [i + 1 - (i + 2) * y * found[i + 1] / found[i] for i in range(3)]
    return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(plain)]


def estimate(counts: DataFrame) -> DataFrame:
    """``gram`` and its interpolated ``probability``, from counts of grams of the highest order.

    Lower orders count the different characters before a gram. A window holds the grams with one
    context: no more rows than there are characters.
    """
    tables = [stage(counts, "grams")]
    for order in range(ORDER - 1, 0, -1):
        shorter = tables[-1].groupBy(F.substring("gram", 2, order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        tables.append(stage(shorter, "grams"))
    below = None
    for order, table in enumerate(reversed(tables), 1):
        seen = table.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)], F.count(F.lit(1)).alias("all")).first()
        d = discounts(list(seen[:4]))
        context = Window.partitionBy(F.substring("gram", 1, order - 1))
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = table.withColumn("cut", cut).withColumns({"total": F.sum("n").over(context), "cuts": F.sum("cut").over(context)})
        own, weight = (F.col("n") - F.col("cut")) / F.col("total"), F.col("cuts") / F.col("total")
        if below is None:
            below = rows.select("gram", (own + weight / F.lit(max(seen["all"], 1))).alias("probability"))
            continue
        shorter = below.toDF("__shorter", "__lower")
        joined = rows.join(shorter, F.substring("gram", 2, order - 1) == F.col("__shorter"))
        below = joined.select("gram", (own + weight * F.col("__lower")).alias("probability"))
    return below


@dataclass(frozen=True)
class Slice:
    """The grams whose hashes lie from ``low`` to ``high``: sorted hashes less ``low``, log probabilities, and where
    each range of hashes begins."""

    low: int
    high: int
    hashes: np.ndarray
    logs: np.ndarray
    shift: int
    begins: np.ndarray

    @classmethod
    def made(cls, low: int, high: int, found: np.ndarray, logs: np.ndarray) -> Slice:
        order = np.argsort(found)
        found, logs = found[order], logs[order].astype(np.float32)
        # Some four ranges for each gram: most are found at once.
        shift = max(0, (high - low).bit_length() - max(1, len(found)).bit_length() - 2)
        ranges = ((found - np.uint64(low)) >> np.uint64(shift)).astype(np.int64)
        begins = np.searchsorted(ranges, np.arange(((high - low) >> shift) + 2)).astype(np.int32)
        # One more of each at the end, for lookups behind the last gram.
        found = found - np.uint64(low)
        return cls(low, high, np.append(found, np.uint64(0)), np.append(logs, np.float32(0)), shift, begins)

    def log_sum(self, wanted: np.ndarray) -> float:
        """What the grams of this slice weigh; all grams that are scored have been counted."""
        if self.low or self.high != (1 << 64) - 1:
            wanted = wanted[(wanted >= np.uint64(self.low)) & (wanted <= np.uint64(self.high))] - np.uint64(self.low)
        at = self.begins[(wanted >> np.uint64(self.shift)).astype(np.int64)]
        total = 0.0
        while len(wanted):
            hit = self.hashes[at] == wanted
            total += float(self.logs[at[hit]].sum(dtype=np.float64))
            miss = ~hit
            wanted, at = wanted[miss], at[miss] + 1
            if len(wanted) and (at >= self.begins[(wanted >> np.uint64(self.shift)).astype(np.int64) + 1]).any():
                raise ValueError("a gram was not counted: the texts have changed since")
        return total


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = "".join(batch.column("gram").to_pylist()).encode("utf-32-le", "surrogatepass")
        found = hashes_of_rows(np.frombuffer(whole, np.uint32).reshape(-1, ORDER))
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), batch.column("probability")], names=["hash", "probability"])


class Model:
    """The staged grams by hash, and how many slices they make."""

    def __init__(self, texts: DataFrame, text: str = "text", size: int = 0) -> None:
        counted = texts.select(F.col(text)).mapInArrow(_count_grams, "gram string, n bigint")
        counts = counted.groupBy("gram").agg(F.sum("n").alias("n"))
        self.grams = stage(estimate(counts).mapInArrow(_hashed, "hash bigint, probability double"), "model")
        self.slices = max(1, -(-self.grams.count() // (size or SLICE)))

    def slice(self, number: int) -> Slice:
        """One slice, which is all that the driver holds at a time."""
        bound = [(1 << 64) * i // self.slices for i in (number, number + 1)]
        low, high = bound[0], bound[1] - 1
        # Unsigned order by flipping the sign bit.
        flipped = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
        rows = self.grams.filter(flipped.between(F.lit(low - (1 << 63)), F.lit(high - (1 << 63)))).toArrow()
        found = rows.column("hash").to_numpy().view(np.uint64)
        return Slice.made(low, high, found, np.log(np.maximum(rows.column("probability").to_numpy(), 1e-12)))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each text once.

    A bit map of the repeated hashes, of a fixed size, tells which rows may have copies.
    Only these are shuffled; the others are known to have none.
    """
    hashed = docs.select(F.col(text).alias("text"), text_hash(text).alias("hash"))
    counts = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    known = docs.sparkSession.sparkContext.broadcast(bit_map(counts.filter("n > 1")))

    @F.pandas_udf(T.BooleanType())
    def on_map(hashes: pd.Series) -> pd.Series:
        slot = (hashes.to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.int64)
        return pd.Series((np.frombuffer(known.value, np.uint8)[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool))

    alone = hashed.filter(~on_map("hash")).select("text")
    return alone.union(hashed.filter(on_map("hash")).dropDuplicates(["hash"]).select("text"))


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of REPEAT words that the text has twice or more."""
    n = len(words) - REPEAT + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = hashes[:n].copy()
    for j in range(1, REPEAT):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # Equal hashes are only candidates: the words decide.
    candidates = np.flatnonzero(np.isin(windows, twice)).tolist()
    seen = Counter(tuple(words[i : i + REPEAT]) for i in candidates)
    edges = np.zeros(len(words) + 1, np.int64)
    for i in candidates:
        if seen[tuple(words[i : i + REPEAT])] > 1:
            edges[i] += 1
            edges[i + REPEAT] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def text_counts(blob: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = np.frombuffer(blob, np.uint8)
    words = blob.split()
    lines = [line for line in blob.split(b"\n") if line.strip()]
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80) - np.count_nonzero(IS_WHITE[raw]))
    return len(words), chars, int(np.count_nonzero(IS_SYMBOL[raw])), len(lines) - len(set(lines)), repeated_words(words)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORES = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, "n_grams")] + [T.StructField("total", T.DoubleType())])


def scores(shared):
    """A column function: the counts of a text, its grams, and what those of one slice weigh; NULL counts as empty.

    It is declared not deterministic, so that no plan computes it twice, once for a filter
    moved below and once for the column.
    """

    @F.pandas_udf(SCORES)
    def score(texts: pd.Series) -> pd.DataFrame:
        model, rows = shared.value, []
        for text in texts:
            total, n = 0.0, 0
            for run in symbols(text or ""):
                found = hashes(run)
                total += model.log_sum(found)
                n += len(found)
            rows.append((*text_counts((text or "").encode()), n, total))
        return pd.DataFrame(rows, columns=SCORES.names)

    return score.asNondeterministic()


def weights(shared):
    """A column function: what a text's grams in one slice weigh."""

    @F.pandas_udf(T.DoubleType())
    def weight(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([sum(model.log_sum(hashes(run)) for run in symbols(t or "")) for t in texts], dtype=float)

    return weight.asNondeterministic()


def scored_rows(docs: DataFrame, model: Model, columns: dict[str, Column], text: str = "text") -> DataFrame:
    """``columns`` of each row with its text's ``hash`` and ``score``: the counts, ``n_grams`` and ``judged`` (log perplexity)."""
    context = docs.sparkSession.sparkContext
    named = [c.alias(n) for n, c in columns.items()]
    held = context.broadcast(model.slice(0))
    rows = stage(docs.select(*named, text_hash(text).alias("hash"), scores(held)(F.col(text)).alias("score")), "scores")
    held.unpersist()  # else every worker keeps it
    total = F.col("score.total")
    if model.slices > 1:
        parts = []
        for number in range(1, model.slices):
            held = context.broadcast(model.slice(number))
            part = docs.select(text_hash(text).alias("__hash"), weights(held)(F.col(text)).alias("__total"))
            parts.append(stage(part.groupBy("__hash").agg(F.first("__total").alias("__total")), "scores"))
            held.unpersist()
        rest = parts[0]
        for part in parts[1:]:
            rest = rest.unionByName(part)
        sums = rest.groupBy("__hash").agg(F.sum("__total").alias("__total"))
        rows = stage(join_reduced(rows, sums, {"hash": "__hash"}, "left"), "scores")
        total = total + F.col("__total")
    n = F.col("score.n_grams")
    judged = F.when(n > 0, -total / n)
    fields = [F.col(f"score.{c}").alias(c) for c in (*COUNTS, "n_grams")]
    return rows.select(*columns, "hash", F.struct(*fields, judged.alias("judged")).alias("score"))


def base_failed(score: Column) -> Column:
    repeats = 100 * score["n_repeat_words"] > MAX_REPEAT_PERCENT * score["n_words"]
    return (score["n_words"] < MIN_WORDS) | repeats


def bands(scored: DataFrame) -> DataFrame:
    """``band_lang``, ``low``, ``high``: around the median of log perplexity, in widths of the quartile next to it.

    Over the distinct texts (column ``hash``) that pass the counts; values are taken in
    steps, so that exact percentiles hold few distinct values.
    """
    step = F.round(F.col("score.judged") * STEPS).cast("long").alias("step")
    once = scored.filter(~base_failed(F.col("score"))).select(F.col("lang").alias("band_lang"), "hash", step).distinct()
    quartiles = once.groupBy("band_lang").agg(
        F.percentile("step", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q")
    )
    width = lambda a, b: F.greatest((F.col("q")[b] - F.col("q")[a]) / STEPS, F.lit(LEAST_WIDTH))
    return quartiles.select(
        "band_lang", (F.col("q")[1] / STEPS - BELOW * width(0, 1)).alias("low"),
        (F.col("q")[1] / STEPS + ABOVE * width(1, 2)).alias("high"),
    )


def verdicts(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to rows with ``lang`` and ``score``."""
    judged = join_reduced(scored, limits, {"lang": "band_lang"}, "left", null_safe=True)
    slack = SHORT_TEXT / F.sqrt(F.greatest(F.col("score.n_grams"), F.lit(1)))
    inside = F.col("score.judged").between(F.col("low") - slack, F.col("high") + slack)
    failed = base_failed(F.col("score"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(inside, F.lit(True))).drop(
        "band_lang", "low", "high"
    )


def quality(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """For each row its id, the counts, ``log_perplexity``, ``base_failed`` and ``kept``.

    NULL texts count as empty: no words, so they fail, and no perplexity. NULL languages form a
    language. Repeated rows each give a row; model and bands take each distinct text once. Other
    columns are not read; an empty table gives no row.
    """
    model = Model(distinct_texts(docs, text))
    scored = scored_rows(docs, model, {"doc": F.col(doc), "lang": F.col(lang)}, text)
    return verdicts(scored, bands(scored)).select(
        F.col("doc").alias(doc), *[F.col("score")[c].alias(c) for c in (*COUNTS, "n_grams")],
        F.col("score.judged").alias("log_perplexity"), "base_failed", "kept",
    )


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns.

    A verdict depends on text and language only, so the rejected pairs of these, each once, are
    what the documents are compared with.
    """
    scored = scored_rows(docs, Model(distinct_texts(docs, text)), {"lang": F.col(lang)}, text)
    judged = verdicts(scored, bands(scored))
    bad = stage(judged.filter("NOT kept").select(F.col("lang").alias("__lang"), F.col("hash").alias("__hash")).distinct(), "rejected")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(lang).alias("lang"), text_hash(text).alias("hash"))
    return join_reduced(rows, bad, {"lang": "__lang", "hash": "__hash"}, "left_anti", null_safe=True).select("__row.*")
