"""What each filter of a set does in every order of them: removals, overlaps, losses, Shapley sums.

A document is nothing but the set of filters it fails (a mask), so documents are first counted by
part and mask. Each such cell folds once over the fixed array of all orders: a document of the
cell goes from filter to filter until one removes it, which gives one struct of weighted counts
for each order and step. The structs of a part's cells are summed place by place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.relational import join_reduced

WHITE = " \t\n\x0b\x0c\r"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
MOST_FILTERS = 6


def words(text: Column) -> Column:
    """The runs of characters other than space and tab to carriage return."""
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")


def text_rules(text: Column, found: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides, by letter; ``found`` has its words."""
    n, distinct = F.size(found), F.size(F.array_distinct(found))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 50,
        "B": F.lit(100) * distinct < F.lit(65) * n,
        "C": F.lit(100) * capitals > F.lit(5) * F.char_length(text),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def masked(
    docs: DataFrame, rules: Callable[[Column, Column], Mapping[str, Column]], copies: str,
    labels: DataFrame | None = None, doc: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """A row for each document: ``part``, its ``mask`` of failed filters and whether it is ``good`` or ``toxic``.

    ``rules`` gives failure conditions by letter from a text and its words; NULL counts as empty. Bit i
    of the mask is the i-th letter of these and ``copies``, in alphabetical order. The filter ``copies`` fails a document whose whole text a smaller id has, anywhere in the table; a
    NULL id is neither smaller nor larger. Texts are compared by SHA-256, and only the least id of each
    text is shuffled against the documents, so a group of copies may be of any size. A label
    holds if any label row of the id has it.
    """
    failures = rules(F.col("__body"), F.col("__words"))
    bits = {letter: i for i, letter in enumerate(sorted([*failures, copies]))}
    mask = sum((F.when(failed, 1 << bits[letter]).otherwise(0) for letter, failed in failures.items()), F.lit(0))
    whole = docs.select(
        F.col(doc).alias("__doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("__body"),
    ).withColumn("__words", words(F.col("__body")))
    narrow = whole.select("__doc", "part", mask.alias("mask"), F.sha2("__body", 256).alias("__text"))
    first = narrow.groupBy(F.col("__text").alias("__same")).agg(F.min("__doc").alias("__least"), F.count(F.lit(1)).alias("__n"))
    # Texts that occur once have no copies, and most do.
    repeated = first.filter(F.col("__n") > 1).drop("__n")
    rows = join_reduced(narrow, repeated, {"__text": "__same"}, "left")
    late = F.coalesce(F.col("__doc") > F.col("__least"), F.lit(False))
    rows = rows.select(
        "__doc", "part", (F.col("mask") + F.when(late, 1 << bits[copies]).otherwise(0)).alias("mask")
    )
    if labels is None:
        return rows.select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    held = {name: F.coalesce(F.max(F.col(column) == 1), F.lit(False)).alias(name) for name, column in (("good", "quality"), ("toxic", "toxic"))}
    known = labels.groupBy(F.col(doc).alias("__labelled")).agg(*held.values())
    joined = join_reduced(rows, known, {"__doc": "__labelled"}, "left")
    return joined.select("part", "mask", *[F.coalesce(name, F.lit(False)).alias(name) for name in held])


def orders(letters: Sequence[str]) -> Column:
    """All orders of the filters, each an array of their bits: a constant that every task holds."""
    places = ("array({})".format(", ".join(str(letters.index(x)) for x in order)) for order in permutations(letters))
    return F.expr(f"array({', '.join(places)})")


def _profile(letters: Sequence[str], mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """One struct for each order and step of what happens to the documents of a cell, in the order of ``orders``."""
    nothing = F.lit(0).cast("long")
    zero = F.struct(*[nothing.alias(c) for c in COUNTS])

    def step(state: Column, bit: Column) -> Column:
        alive, failing = state["alive"], F.call_function("getbit", mask, bit) == 1
        removed = alive & failing
        values = {
            "kept": F.when(alive & ~failing, n), "removed": F.when(removed, n), "redundant": F.when(failing & ~alive, n),
            "unique_fails": F.when(failing & (F.bit_count(mask) == 1), n), "good_lost": F.when(removed, good),
            "toxic_lost": F.when(removed, toxic),
        }
        row = F.struct(*[F.coalesce(v, nothing).alias(c) for c, v in values.items()])
        return F.struct((alive & ~failing).alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows"))

    start = F.struct(F.lit(True).alias("alive"), F.slice(F.array(zero), 1, 0).alias("rows"))
    return F.flatten(F.transform(orders(letters), lambda order: F.aggregate(order, start, step, lambda s: s["rows"])))


def interactions(rows: DataFrame, letters: Sequence[str]) -> DataFrame:
    """For each part, order (``filter_order``) and ``step`` (from 1): the counts, and ``shapley`` of the step's filter.

    ``rows`` are those of ``masked``, whose bits are the sorted ``letters``. Counts are within the part:
    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter, removed
    earlier), ``unique_fails`` (failing its filter only), ``good_lost`` and ``toxic_lost`` (removed by
    it, with the label). ``shapley`` sums what the filter removes over all orders. Every part gives
    all orders and steps, zeros included; no documents give no row. At most six filters, as the
    orders are held whole.
    """
    letters = sorted(letters)
    if not 0 < len(letters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    size = len(letters)
    cells = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    profiles = cells.select("part", F.posexplode(_profile(letters, *map(F.col, ("mask", "n", "good", "toxic")))).alias("place", "at"))
    summed = profiles.groupBy("part", "place").agg(*[F.sum(f"at.{c}").alias(c) for c in COUNTS])
    order = F.element_at(orders(letters), (F.floor(F.col("place") / size) + 1).cast("int"))
    named = F.transform(order, lambda bit: F.element_at(F.array(*map(F.lit, letters)), bit + 1))
    steps = summed.select(
        "part", F.array_join(named, "").alias("filter_order"), (F.col("place") % size + 1).cast("int").alias("step"), *COUNTS
    ).withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
    # A window holds the steps of one filter in one part: as many as there are orders.
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return steps.withColumn("shapley", shapley)
