"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

The list is tested in two steps. A blocked Bloom filter, small enough to be
broadcast by construction, lets possible hits pass; only these are shuffled and
joined with the list itself, which removes the filter's false positives. A longer
list makes the filter fuller, never larger: more rows reach the join, the result
stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.relational import join_reduced

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that say where a visitor came from, not which page is meant.
TRACKING = r"(?s)^(utm_[^=]*|ref|gclid|fbclid|msclkid|mc_eid)(=.*)?\z"
# 256 bits a block, in four lanes of 64; a key sets two bits in each lane.
LANES = 4
BLOCKS = 1 << 16


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, below a path prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(df: DataFrame, url: str) -> DataFrame:
    """Add ``host`` (A-Z lower-cased), ``path`` and ``__query``; NULL or no ``://`` leaves all empty."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")
    return (
        df.withColumn("__rest", F.coalesce(rest, F.lit("")))
        .withColumn("host", F.translate(F.regexp_extract("__rest", r"^[^/?#]*", 0), UPPER, LOWER))
        .withColumn("path", F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1))
        .withColumn("__query", F.regexp_extract("__rest", r"^[^?#]*\?([^#]*)", 1))
        .drop("__rest")
    )


def canonical(host: Column, path: Column, query: Column) -> Column:
    """One spelling for the spellings of a page: no scheme, ``www.``, default port, trailing
    slash, fragment or tracking parameter; parameters sorted. NULL for an empty host."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)\z", "")
    wanted = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.concat_ws("&", wanted)
    asked = F.when(tail == "", "").otherwise(F.concat(F.lit("?"), tail))
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path, r"/+\z", ""), asked))


def rule_for(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: str) -> list[Column]:
    """The two bits of a key in each lane, six bits of a second hash for each."""
    bits = F.xxhash64(key, F.lit(1))

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(LANES)]


def bloom(listed: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The filter of a list: one row for each block in use, so ``blocks`` rows of 36 bytes at most."""
    lanes = [F.bit_or(m).alias(f"__lane{i}") for i, m in enumerate(_masks(key))]
    return listed.groupBy(_block(key, blocks).alias("__block")).agg(*lanes)


def url_filter(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], url: str = "url", blocks: int = BLOCKS,
) -> DataFrame:
    """Judge every row: ``host``, ``path``, ``canonical``, ``rule``, ``listed`` and ``verdict``.

    A rule's verdict wins; without one, listed URLs are blocked and all others
    allowed. ``listed`` has URLs in its first column, in any spelling; NULLs, URLs
    without a host and repeats in it do nothing. A row whose URL is NULL or has no
    ``://`` has an empty host and path and is allowed. Rows may repeat; columns of
    ``pages`` with the names above are replaced. Tables may be empty.
    """
    known = parts(listed.select(F.col(f"`{listed.columns[0]}`").alias("__listed")), "__listed").select(
        canonical(F.col("host"), F.col("path"), F.col("__query")).alias("__known")
    ).filter("__known IS NOT NULL").distinct()
    blocks_used = F.broadcast(bloom(known, "__known", blocks))

    own = [F.col(f"`{c}`") for c in pages.columns]
    name, verdict = rule_for(rules, F.col("host"), F.col("path"))
    judged = (
        parts(pages.select(F.struct(*own).alias("__row"), F.col(f"`{url}`").alias("__url")), "__url")
        .select("__row", "host", "path", name.alias("rule"), verdict.alias("__ruled"),
                canonical(F.col("host"), F.col("path"), F.col("__query")).alias("canonical"))
        .withColumn("__block", _block("canonical", blocks))
    )
    probed = judged.join(blocks_used, "__block", "left")
    lanes = [F.col(f"__lane{i}").bitwiseAND(m) == m for i, m in enumerate(_masks("canonical"))]
    maybe = F.coalesce(F.col("canonical").isNotNull() & reduce(lambda a, b: a & b, lanes), F.lit(False))
    columns = ["__row", "host", "path", "rule", "__ruled", "canonical"]
    probed = probed.withColumn("__maybe", maybe)
    hits = join_reduced(
        probed.filter("__maybe").select(*columns), known, {"canonical": "__known"}, "left"
    ).withColumn("listed", F.col("__known").isNotNull()).drop("__known")
    passed = probed.filter("NOT __maybe").select(*columns, F.lit(False).alias("listed"))
    taken = {"host", "path", "rule", "canonical", "listed", "verdict"}
    kept = [F.col(f"__row.`{c}`").alias(c) for c in pages.columns if c.lower() not in taken]
    final = F.coalesce("__ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return passed.unionByName(hits).select(
        *kept, "host", "path", "rule", final.alias("verdict"), "canonical", "listed"
    )
