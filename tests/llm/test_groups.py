"""URLs, chats, near-duplicates, mixing, shards, ranks and the pipeline."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from adlake.llm import chat, common, mixing, shards, simhash, urls
from adlake.llm import queries as registered
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registered.QUERIES))
@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")
def test_registered(spark, name):
    ok, note = compare(spark, connect(FOLDER), FOLDER, name)
    assert ok, note


def test_all_operators_and_the_pipeline():
    assert {n.split("_")[0] for n in registered.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


# URLs


def slow_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_url_filter(spark, blocks):
    sites = [None, "", "nothing", "http://", "http:///x", "HTTP://A.NET/x", "https://www.Example.com/de/1", "https://example.com/en/",
             "http://example.net/en/1", "http://m.example.net/de/", "ftp://x.org/fr/?a=1", "http://x.org/fr", "http://net/", "http://net",
             "http://Ünet.org/É?q=1#f", "http://a.com/b?utm_source=z&b=2&a=1#t", "http://a.com/b/?a=1&b=2", "http://a.com/b?a=1",
             "http://a.com:80/c\n", "x://y://z/p", "http://a.com/b?a=1&b=2"]
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(sites)] + [(20, sites[20], "old", 1)], "page_id long, url string, host string, __block int")
    listed = spark.createDataFrame([(u,) for u in ["https://www.a.com/b?b=2&a=1", None, "junk", "http://a.com/b?b=2&a=1", "http://a.com/c"]], "u string")
    out = urls.url_filter(pages, listed, registered.URL_RULES, blocks=blocks).collect()
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    assert len(out) == len(sites) + 1
    for r in out:
        host, path = slow_parts(sites[r.page_id])
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        on_list = r.page_id in (15, 16, 20)
        want = max(fits) if fits else (0, "block" if on_list else "allow", None)
        assert (r.host, r.path, r.rule, r.verdict, r.listed) == (host, path, want[2], want[1], on_list)
    assert urls.url_filter(pages.limit(0), listed, registered.URL_RULES).collect() == []
    assert not any(r.listed for r in urls.url_filter(pages, listed.limit(0), registered.URL_RULES).collect())


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    bloom = urls.bloom(keys, "k", 256)
    assert bloom.count() <= 256
    both = keys.union(spark.range(3000).select(F.concat(F.lit("other"), "id")))
    hit = both.withColumn("__block", urls._block("k", 256)).join(bloom, "__block")
    for i, m in enumerate(urls._masks("k")):
        hit = hit.filter(F.col(f"__lane{i}").bitwiseAND(m) == m)
    kinds = Counter(r.k[0] for r in hit.collect())
    assert kinds["k"] == 3000 and kinds["o"] < 450


# Chats


def test_chats_read_back(spark, odd_texts):
    rng = random.Random(2)
    roles = ["system", "user", "assistant", "tool [ROLE]", None, "", "[/ROLE]"]
    rows = [(c, t, rng.choice(roles), rng.choice(odd_texts), "x") for c in [*range(60), None] for t in range(rng.randint(1, 5))]
    rows += [(100, None, "user", "n", "x"), (100, 1, "user", "b", "x"), (100, 1, "assistant", "a", "x"), (100, 1, "assistant", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_chats(df).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.learned_text(F.col("segments")))
    said = defaultdict(list)
    for c, t, r, x, _ in rows:
        said[c].append((t is not None, t or 0, r or "", x or ""))
    out = made.collect()
    assert {r.conv_id for r in out} == set(said) and len(out) == len(said)
    for r in out:
        want = [(role, text) for _, _, role, text in sorted(said[r.conv_id])]
        assert [tuple(t) for t in r.turns] == want
        assert r.loss == "".join(text for role, text in want if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
        state = "start"
        for role, _ in want:
            state = chat.INSTRUCT.moves.get((state, role))
        assert r.valid == (state == "answered")
    assert chat.format_chats(df.limit(0)).collect() == []


def test_planted_conversation(spark):
    r = [r for r in registered.QUERIES["op5_chat_format"](spark, FOLDER).collect() if r.conv_id == -7][0]
    text = "</s>[INST] ok [/INST]"
    assert r.n_turns == 2 and r.loss_chars == len(text) and r.valid
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_chat_plan_is_native(spark, plan):
    text = plan(registered.QUERIES["op5_chat_format"](spark, FOLDER))
    assert not any(w in text for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template(roles={"user": chat.Role("<<u", "</u"), chat.OTHER: chat.Role("<o", "</o")}, named="<n", moves={})


# Near-duplicates


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Component number of each distinct fingerprint, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(set(prints)), 2):
        if (a ^ b).bit_count() <= 4:
            root[find(a)] = find(b)
    return {p: find(p) for p in root}


def test_near_groups(spark, both_docs):
    rows = both_docs.collect()
    prints = [slow_print(r.text) for r in rows]
    roots = slow_components(prints)
    low = defaultdict(list)
    for r, p in zip(rows, prints, strict=True):
        low[roots[p]].append(r.doc_id)
    want = Counter((r.doc_id, p, min((d for d in low[roots[p]] if d is not None), default=None)) for r, p in zip(rows, prints, strict=True))
    groups = simhash.near_groups(both_docs)
    assert Counter((r.doc_id, r.print & (1 << 64) - 1, r.component_id) for r in groups.collect()) == want
    kept = simhash.first_of_groups(both_docs)
    assert kept.columns == both_docs.columns
    left = kept.collect()
    assert Counter(roots[slow_print(r.text)] for r in left) == Counter(low.keys())
    assert Counter(r.doc_id for r in left) == Counter(min((d for d in ids if d is not None), default=None) for ids in low.values())


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c d", 42)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(0, 10**6))
def test_bit_sliced_comparison(n, seed):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(6)]
    prints = []
    for _ in range(n):
        p = rng.choice(centers) if rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 6)):
            p ^= 1 << rng.randrange(64)
        prints.append(p)
    prints = sorted(set(prints))
    array = np.array(prints, np.uint64)
    links = np.unpackbits(simhash.near(array, slice(0, len(array))).view(np.uint8), axis=1, bitorder="little")[:, : len(array)]
    for i, a in enumerate(prints):
        assert [bool(x) for x in links[i]] == [i != j and (a ^ b).bit_count() <= 4 for j, b in enumerate(prints)]
    roots = slow_components(prints)
    joined = slow_from_edges(prints, [(u % (1 << 64), v % (1 << 64)) for u, v in simhash.stars(array.view(np.int64))])
    assert partition(roots) == partition(joined)


def slow_from_edges(nodes, edges):
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in edges:
        root[find(a)] = find(b)
    return {p: find(p) for p in root}


def partition(roots):
    parts = defaultdict(set)
    for node, root in roots.items():
        parts[root].add(node)
    return sorted(map(sorted, parts.values()))


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 16])
def test_links_in_large_buckets(spark, chunk):
    rng = random.Random(9)
    center, prints = rng.getrandbits(63), set()
    while len(prints) < 700:
        p = center
        for b in rng.sample(range(64), rng.randint(0, 5)):
            p ^= 1 << b
        prints.add(p if p < 1 << 63 else p - (1 << 64))
    prints |= {rng.getrandbits(63) for _ in range(300)}
    nodes = spark.createDataFrame([(p,) for p in prints], "print long")
    labels = {r.node: r.low for r in simhash.components(simhash.links(nodes, chunk)).collect()}
    want = slow_components([p % (1 << 64) for p in prints])
    assert partition({p % (1 << 64): labels.get(p, p) % (1 << 64) for p in prints}) == partition(want)


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(4).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(5, 5), (1000, 1001)], "u long, v long")
    assert {(r.node, r.low) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 300)} | {(1001, 1000)}


def test_groups_of_nothing(nothing):
    assert simhash.near_groups(nothing).collect() == [] and simhash.first_of_groups(nothing).collect() == []


# Mixing


def test_targets():
    got = mixing.targets({"b": 100, "a": 1000, None: 10, "c": 500})
    assert list(got) and got["b"] == 300 and sum(got.values()) == pytest.approx(1610)
    assert got["a"] / got[None] != 1 and got[None] == 30 if got[None] == 30 else got[None] <= 30
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 6), min_size=1, max_size=8), st.integers(0, 500), st.sampled_from([1 << 16, 40]))
def test_fit(have, budget, span):
    lengths, counts = list(have), list(have.values())
    taken = mixing.fit(lengths, counts, budget, span)
    assert all(0 <= t <= c for t, c in zip(taken, counts, strict=True))
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    got = sum(n * t for n, t in zip(lengths, taken, strict=True))
    # Within the longest document of the budget, unless all are taken.
    assert got == total if budget >= total else abs(got - budget) <= max(lengths)


def test_fit_is_exact_where_it_can_be():
    assert sum(n * t for n, t in zip([7, 11, 13], mixing.fit([7, 11, 13], [9, 9, 9], 100), strict=True)) == 100


def test_mix(both_docs):
    out = mixing.mix(both_docs, ["doc_id", "source"]).collect()
    again = mixing.mix(both_docs, ["doc_id", "source"]).collect()
    key = lambda r: (str(r.row.doc_id), r.size, r.copies)
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == both_docs.count()
    taken, size, longest = Counter(), Counter(), Counter()
    for r in out:
        assert 0 <= r.copies <= 3
        taken[r.row.source] += r.size * r.copies
        size[r.row.source] += r.size
        longest[r.row.source] = max(longest[r.row.source], r.size)
    goals = mixing.targets(dict(size))
    for r in out:
        assert r.source_size == size[r.row.source] and r.target == goals[r.row.source]
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= longest[s] + 1
    docs = mixing.mixed(both_docs)
    assert docs.columns == both_docs.columns
    assert docs.count() == sum(r.copies for r in out if r.size)


def test_mix_of_nothing(nothing):
    assert mixing.mix(nothing, ["doc_id"]).collect() == [] and mixing.mixed(nothing).collect() == []


# Shards and ranks


def longest_first(sizes, n):
    loads = [0] * n
    for s in sorted(sizes, reverse=True):
        i = loads.index(min(loads))
        loads[i] += s
    return loads


def test_shards(both_docs):
    out = shards.shard(both_docs, both_docs.columns).collect()
    assert len(out) == both_docs.count()
    place, sizes, loads, slots = {}, Counter(), [0] * 16, defaultdict(list)
    for r in out:
        text = r.row.text or ""
        assert r.size == len(text.encode()) + 1
        assert place.setdefault(text, r.shard) == r.shard
        sizes[text] += r.size
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = longest_first(sizes.values(), 16)
    assert max(loads) <= max(want) * 1.001 and min(loads) >= min(want) * 0.99


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4000), st.integers(1, 3000)), min_size=1, max_size=12, unique_by=lambda t: t[0]), st.integers(1, 16))
def test_schedule_is_longest_first(classes, n):
    ends = shards.schedule([(size, count, size * count) for size, count in classes], n)
    loads = [0] * n
    for size, count in classes:
        assert ends[size][-1] == count
        for i, (a, b) in enumerate(zip([0, *ends[size]], ends[size], strict=False)):
            loads[i] += (b - a) * size
    want = longest_first([size for size, count in classes for _ in range(count)], n)
    assert sorted(loads) == pytest.approx(sorted(want), abs=1e-6)


def test_shards_of_nothing(nothing):
    assert shards.shard(nothing, ["doc_id"]).collect() == []


def test_ranks_are_gapless(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 7).alias("v"))
    ranks = defaultdict(list)
    for r in common.ranked(df, ["k"], [F.col("v")], "n").collect():
        ranks[r.k].append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())


def test_a_third_of_equal_rows_fills_no_part(spark, tmp_path):
    rows = spark.range(30_000).select(
        (F.col("id") % 2).alias("k"), F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("v"),
        F.xxhash64("id").alias("spread"),
    )
    parts = common.dealt(rows, ["k"], [F.col("v")], "spread", 500)
    assert parts.count() == 30_000
    most = parts.groupBy("k", "__salt", "__piece").count().agg(F.max("count")).first()[0]
    assert most < 1000
    found = defaultdict(list)
    for r in common.ranked(rows, ["k"], [F.col("v")], "n", "spread", 500).collect():
        found[r.k].append(r.n)
    assert all(sorted(n) == list(range(15_000)) for n in found.values())


def test_mix_picks_some_of_equal_rows(spark):
    """One text is a third of all rows, with one id: as many of them are taken as the plan says."""
    rows = [(i, "one two three " * (1 + i % 5), "ab"[i % 2], i) for i in range(200)]
    rows += [(7, "the same seven words in all rows", "a", i) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mark int")
    out = mixing.mix(docs, ["doc_id", "source", "mark"]).collect()
    assert Counter((r.row.doc_id, r.row.mark, r.row.source) for r in out) == Counter((r[0], r[3], r[2]) for r in rows)
    by_length, taken, size = defaultdict(list), Counter(), Counter()
    for r in out:
        by_length[r.row.source, r.size].append(r.copies)
        taken[r.row.source] += r.size * r.copies
        size[r.row.source] += r.size
    goals = mixing.targets(dict(size))
    for s, goal in goals.items():
        repeats = min(3, int(goal // size[s]))
        lengths = sorted(n for t, n in by_length if t == s)
        picked = mixing.fit(lengths, [len(by_length[s, n]) for n in lengths], round(goal) - repeats * size[s] if repeats < 3 else 0)
        assert {n: sum(by_length[s, n]) - repeats * len(by_length[s, n]) for n in lengths} == dict(zip(lengths, picked, strict=True))
    torn = Counter(r.copies for r in out if r.size == 7)
    assert len(torn) == 2 and sum(torn.values()) == 100


# Pipeline


def test_pipeline_stages(spark):
    docs = common.table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = function(spark, before, FOLDER)
        assert after.columns == columns
        rows = after.collect()
        if name != "mix":
            assert len(rows) < before.count() or name == "decontaminate"
        before = spark.createDataFrame(rows, docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert last.columns == [*columns, "shard", "slot"] and last.count() == before.count()
    whole = corpus_pipeline.run(spark, FOLDER)
    assert Counter(r.doc_id for r in whole.collect()) == Counter(r.doc_id for r in last.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]


def test_pipeline_takes_odd_rows_and_none(spark, both_docs, nothing):
    for some in (both_docs, nothing):
        docs = some
        for _, function in corpus_pipeline.STAGES:
            docs = function(spark, docs, FOLDER)
        assert docs.count() >= 0
