"""The pipeline's stages against plain Python, over the smallest table with planted copies and benchmark passages."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_groups import slow_components, slow_print
from test_texts import slow_counts, slow_hits, slow_model, slow_perplexity

import corpus_pipeline
from adlake.llm import mixing

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def items(spark):
    return [(str(r.item_id), r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]


@pytest.fixture(scope="module")
def planted(spark, items):
    """The documents with exact copies, copies that differ in one word, passages of items, and gibberish."""
    random.seed(7)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [r for r in docs.collect() if r.text and len(r.text.split()) > 120]
    more = []
    for place, r in enumerate(rows[:30]):
        words = r.text.split(" ")
        near = list(words)
        near[len(near) // 2] = "othrword"
        item = items[place % len(items)][1]
        letters = "".join(random.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in r.text)
        for kind, text in enumerate((r.text, " ".join(near), " ".join(words[:60] + [item] + words[60:]), letters)):
            more.append((100_000 + 10 * place + kind, text, r.lang, r.source, len(text)))
    return docs.unionByName(spark.createDataFrame(more, docs.schema))


def collected(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def after(spark, planted):
    """The rows behind each stage, each stage reading what the one before gave."""
    found, docs = {"start": collected(planted)}, planted
    for name, function in corpus_pipeline.STAGES:
        rows = function(spark, docs, FOLDER)
        found[name] = collected(rows)
        docs = spark.createDataFrame(found[name], rows.schema)
    return found


def test_quality_drops_what_counts_and_bands_reject(after):
    rows = after["start"]
    texts = {r[1] or "" for r in rows}
    p = slow_model(texts)
    score, counts = {t: slow_perplexity(p, t) for t in texts}, {t: slow_counts(t) for t in texts}
    failed = {t: c[0] < 20 or 100 * c[4] > 30 * c[0] for t, c in counts.items()}
    limits = {}
    for lang in {r[2] for r in rows}:
        steps = [math.floor(score[t] * 1024 + 0.5) for t in {r[1] or "" for r in rows if r[2] == lang} if not failed[t] and t]
        q = np.percentile(steps, [25, 50, 75]) / 1024
        limits[lang] = q[1] - 4 * max(q[1] - q[0], 0.02), q[1] + 4 * max(q[2] - q[1], 0.02)

    def stays(row):
        text, slack = row[1] or "", 3 / math.sqrt(max(1, len(row[1] or "")))
        return not failed[text] and limits[row[2]][0] - slack <= score[text] <= limits[row[2]][1] + slack

    assert Counter(after["quality"]) == Counter(r for r in rows if stays(r))


def test_one_of_each_near_group_stays(after):
    rows = after["quality"]
    prints = {r: slow_print(r[1]) for r in rows}
    root = slow_components(set(prints.values()))
    least = {}
    for r in rows:
        group = root[prints[r]]
        least[group] = min(least.get(group, r[0]), r[0])
    assert sorted(r[0] for r in after["near_dedup"]) == sorted(least.values())
    kept = {r[0] for r in after["near_dedup"]}
    assert not any(i >= 100_000 and i % 10 == 0 for i in kept)  # exact copies


def test_documents_with_a_passage_go(after, items):
    rows = after["near_dedup"]
    assert Counter(after["decontaminate"]) == Counter(r for r in rows if not slow_hits(r[1], items)[-1])
    assert not any(r[0] >= 100_000 and r[0] % 10 == 2 for r in after["decontaminate"])


def test_the_mix_takes_what_its_plan_says(spark, after, planted):
    """The picks are computed again from the lengths; only the hash that orders them is Spark's."""
    rows = after["decontaminate"]
    docs = spark.createDataFrame(rows, planted.schema)
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(F.lit(7), "doc_id", "text").alias("h")).collect()}
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r[0])
    sizes = {s: sum(size[i] for i in ids) for s, ids in by_source.items()}
    goals = mixing.targets(sizes, (1, 2, 3))
    want = Counter()
    for source, ids in by_source.items():
        repeats = min(3, int(goals[source] // sizes[source])) if sizes[source] else 0
        rest = round(goals[source]) - repeats * sizes[source] if repeats < 3 else 0
        have = Counter(size[i] for i in ids)
        lengths = sorted(have)
        picked = dict(zip(lengths, mixing.fit(lengths, [have[n] for n in lengths], rest)))
        taken = 0
        for n in lengths:
            same = sorted((i for i in ids if size[i] == n), key=lambda i: (order[i] % 64, order[i]))
            for place, i in enumerate(same):
                want[i] = repeats + (place < picked[n]) if n else 0
                taken += want[i] * n
        assert abs(taken - goals[source]) <= max(lengths)
    got = Counter(r[0] for r in after["mix"])
    assert Counter({i: n for i, n in want.items() if n}) == got
    assert {r[0]: r for r in after["mix"]} == {r[0]: r for r in rows if want[r[0]]}


def test_shards_hold_whole_groups_and_are_even(after):
    rows = after["shard"]
    assert Counter(r[:-2] for r in rows) == Counter(after["mix"])
    shard_of, slots, loads, groups = {}, defaultdict(list), Counter(), Counter()
    for r in rows:
        text, shard, slot = r[1] or "", r[-2], r[-1]
        assert shard_of.setdefault(text, shard) == shard
        slots[shard].append(slot)
        loads[shard] += len(text.encode()) + 1
        groups[zlib.crc32(text.encode()), len(text)] += len(text.encode()) + 1
    assert set(shard_of.values()) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    heap = [0] * 16
    for n in sorted(groups.values(), reverse=True):
        heap[heap.index(min(heap))] += n
    assert max(loads.values()) <= 1.02 * max(heap)


def test_odd_rows_come_through_every_stage(spark, both_docs, nothing):
    """What is left is always part of what was there, and nothing comes of nothing."""
    docs, before = both_docs, Counter((r.doc_id, r.text) for r in both_docs.collect())
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, FOLDER)
        found = Counter((r.doc_id, r.text) for r in docs.collect())
        assert set(found) <= set(before) and (name in ("mix", "shard") or not found - before)
        before = found
    assert sum(before.values()) > 0
    empty = nothing
    for _, function in corpus_pipeline.STAGES:
        empty = function(spark, empty, FOLDER)
    assert empty.collect() == []
