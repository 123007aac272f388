"""BPE codec, filter audit and conversation repair against the library, plain loops and all edit sequences."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.llm import audit, bpe, queries, turns

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
CODER = bpe.codec(bpe.read_ranks(RANKS), PATTERN)


# BPE codec


def test_codec_equals_the_library(both_docs):
    encoded = bpe.encode(both_docs, RANKS, PATTERN, chunk=3000, overlap=40)
    got = Counter(
        (r.doc_id, r.n_tokens, bytes(r.packed), bytes(r.decoded)) for r in bpe.decode(encoded, RANKS, PATTERN).collect()
    )
    want = Counter()
    for r in both_docs.collect():
        ids = CODER.library.encode_ordinary(r.text or "")
        want[(r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (r.text or "").encode())] += 1
    assert got == want


def stitched(text, chunk, overlap):
    """Pre-tokens by chunks and stitches, as the job puts them together; and how many stitches there were."""
    chunks = bpe.chunks_of(text, chunk, overlap)
    cuts = [None if last else bpe.stitch_of(CODER, place, body, chunk) for place, body, last in chunks]
    words, begin, held = [], 0, []
    for (_, body, last), cut in zip(chunks, cuts):
        held.append(body)
        if last or cut is not None:
            words += bpe.piece_words(CODER, held, begin, cut, chunk)
            begin, held = cut, []
    return words, sum(c is not None for c in cuts)


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("  \n\tab'resvtlmd1.é😀　"), max_size=80), st.integers(1, 12), st.integers(0, 12))
def test_stitched_pre_tokens_are_those_of_the_whole_text(text, chunk, overlap):
    assert stitched(text, chunk, overlap)[0] == CODER.pre_tokens(text)


def test_prose_is_stitched_at_every_border(test_docs):
    text = " ".join(r.text for r in test_docs.limit(40).collect())
    words, stitches = stitched(text, 500, 60)
    assert words == CODER.pre_tokens(text) and stitches == len(range(0, len(text), 500)) - 1


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000 + "b", "ab " * 10 + "x" * 7000 + " c d" * 500, "\n" * 5000 + "a" + " " * 4000])
def test_runs_over_many_chunks(text):
    assert stitched(text, 100, 20)[0] == CODER.pre_tokens(text)


def test_pre_tokens_of_every_kind_of_character_are_the_librarys():
    for code in itertools.chain(range(0xD800), range(0xE000, 0x30000, 3)):
        c = chr(code)
        text = f"a{c}{c}b 1{c}2 .{c}. {c}"
        assert CODER.packed(CODER.pre_tokens(text)) == np.array(CODER.library.encode_ordinary(text), "<u4").tobytes(), hex(code)


def test_codec_of_runs_that_the_librarys_pattern_fails_on(spark):
    docs = spark.createDataFrame([(1, " " * 2_000_000 + "x"), (2, "y " * 300_000)], "doc_id long, text string")
    for r in bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect():
        assert bytes(r.decoded) == {1: b" " * 2_000_000 + b"x", 2: b"y " * 300_000}[r.doc_id]


def test_codec_of_nothing_and_of_patterns_with_gaps(nothing):
    assert bpe.encode(nothing, RANKS, PATTERN).collect() == []
    with pytest.raises(ValueError):
        bpe.Codec(bpe.read_ranks(RANKS), r"\p{L}+").pre_tokens("a b")


def test_codec_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 100)
    coder = bpe.Codec(bpe.read_ranks(RANKS), PATTERN)
    words = [[f"w{i}", "z" * 90, " of"] for i in range(400)]
    first = [coder.packed(w) for w in words]
    assert [coder.packed(w) for w in words] == first and len(coder.cache) <= 110


def test_decode_takes_ids_of_half_characters_and_null(spark):
    half = CODER.library.encode_ordinary("\U0001f600")[:1]
    rows = spark.createDataFrame([(1, 1, half), (2, 0, None)], "doc_id long, n_tokens long, ids array<int>")
    found = {r.doc_id: bytes(r.decoded) for r in bpe.decode(rows, RANKS, PATTERN).collect()}
    assert found == {1: CODER.bytes_of[half[0]], 2: b""}


# Filter audit


def plain_audit(docs, labels):
    """All orders over all documents, one by one."""
    white = " \t\n\x0b\x0c\r"
    docs = [(r.doc_id, r.source or "", r.text or "") for r in docs]
    good, toxic = ({r.doc_id for r in labels if r.doc_id is not None and r[c] == 1} for c in ("quality", "toxic"))
    least = {}
    for i, _, t in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    failing = []
    for i, part, t in docs:
        found = "".join(" " if c in white else c for c in t).split(" ")
        found = [w for w in found if w]
        fails = {"A": len(found) < 50, "B": 100 * len(set(found)) < 65 * len(found),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in t for c in "#$%&*|"),
                 "E": i is not None and least[t] < i}
        failing.append((part, {x for x in fails if fails[x]}, i in good, i in toxic))
    out = {}
    for part in {p for p, *_ in failing}:
        rows = [f for f in failing if f[0] == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            gone = set()
            for step, x in enumerate(order, 1):
                failed = [k for k, f in enumerate(rows) if x in f[1]]
                removed = [k for k in failed if k not in gone]
                shapley[x] += len(removed)
                out[part, "".join(order), step] = [
                    len(rows) - len(gone) - len(removed), len(removed), len(failed) - len(removed), sum(rows[k][1] == {x} for k in failed),
                    sum(rows[k][2] for k in removed), sum(rows[k][3] for k in removed),
                ]
                gone.update(removed)
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_going_through_all_orders(spark, both_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").unionByName(
        spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    )
    docs = both_docs.repartition(5)
    found = audit.interactions(audit.masked(docs, audit.text_rules, "E", labels), "ABCDE").collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(got) == len(found) and got == plain_audit(docs.collect(), labels.collect())


def test_audit_of_one_hot_text_and_of_nothing(spark, nothing):
    copies = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit(None).cast("string").alias("source"))
    rows = audit.interactions(audit.masked(copies, audit.text_rules, "E"), "ABCDE").filter("filter_order = 'EABCD'").orderBy("step").collect()
    assert [(r.part, r.removed, r.redundant, r.kept) for r in rows[:2]] == [("", 2999, 0, 1), ("", 1, 2999, 0)]
    assert audit.interactions(audit.masked(nothing, audit.text_rules, "E"), "ABCDE").collect() == []


def test_audit_plan_holds_one_scan_of_counts(both_docs, plan):
    """The order array is a constant, and counting by mask comes before it is used."""
    text = plan(audit.interactions(audit.masked(both_docs, audit.text_rules, "E"), "ABCDE"))
    assert text.count("Generate posexplode") == 1 and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("letters", ["", "ABCDEFG"])
def test_audit_bounds_the_number_of_filters(spark, letters):
    with pytest.raises(ValueError):
        audit.interactions(spark.createDataFrame([], "part string, mask int, good boolean, toxic boolean"), letters)


# Conversation repair


def all_repairs(rows):
    """The least (cost, audit) of every edit sequence with up to three inserts in a row; rows are (role, fault)."""
    after = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}

    def inserts(paths):
        out = dict(paths)
        for (state, edits), cost in paths.items():
            for n in range(1, 4):
                state = after[state][1]
                key = (state, edits + "I" * n)
                out[key] = min(out.get(key, 999), cost + 2 * n)
        return out

    paths = {(0, ""): 0}
    for role, fault in rows:
        new = {}
        for (state, edits), cost in inserts(paths).items():
            extra = fault == "truncated"
            moves = [("D", state, 3)]
            if fault not in ("blank", "duplicate"):
                moves.append(("R", after[state][1], 2 + extra))
                if role[:1] == "s" and state == 0:
                    moves.append(("K", 1, extra))
                if role[:1] == after[state][0]:
                    moves.append(("K", after[state][1], extra))
            for op, behind, price in moves:
                key = (behind, edits + op)
                new[key] = min(new.get(key, 999), cost + price)
        paths = new
    return min((cost, edits) for (state, edits), cost in inserts(paths).items() if state in (0, 3))


def repaired(rows):
    work = turns.Repair(0)
    for place, (role, fault) in enumerate(rows):
        work.add(place, role, "t", fault)
    cost = work.cost + turns.ending(work.costs, work.ranks)[0]
    return cost, list(work.edits())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from([None, None, "blank", "duplicate", "truncated"])), max_size=4))
def test_repair_is_the_cheapest_and_least_of_all(rows):
    cost, edits = repaired(rows)
    assert (cost, "".join(e[6] for e in edits)) == all_repairs(rows)
    initials = "".join(e[7][:1] for e in edits if e[7] is not None)
    assert initials.removeprefix("s") in {"ua" * n for n in range(9)} and initials != "s"


def plain_summary(rows):
    """The contract over one conversation's rows (turn, role, text), in plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, judged = set(), []
    for turn, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        judged.append((role, fault))
    cost, edits = all_repairs(judged) if len(rows) < 7 else (lambda c, e: (c, "".join(x[6] for x in e)))(*repaired(judged))
    lines, state, at = [], 0, 0
    following = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    for op in edits:
        if op == "I":
            lines.append(following[state][0] + ":")
            state = following[state][1]
            continue
        _, role, text = rows[at]
        at += 1
        if op != "D":
            new = role if op == "K" else following[state][0]
            lines.append(f"{new}:{text}")
            state = 1 if op == "K" and role[:1] == "s" else following[state][1]
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    faults = Counter(f for _, f in judged)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


@pytest.fixture(scope="module")
def odd_turns(spark):
    random.seed(5)
    rows = [(None, 0, "user", "A."), (None, 1, "assistant", "B"), (900, None, "user", "no turn."), (900, None, "user", "no turn."),
            (901, 3, None, None), (902, 1, "", "x."), (902, 1, "system", "x."), (903, 7, "sysop", " \n\t"), (904, 2**40, "user", "far.")]
    rows += [(1000 + i % 60, random.choice([None, 0, 1, 2, 3, 4]), random.choice(["system", "user", "assistant", "tool"]),
              random.choice(["Yes.", "No", "Why?", " ", "", "So.\n"])) for i in range(250)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, conv int, place string")


def test_repair_query_equals_plain_python(odd_turns, spark, tmp_path):
    real = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    both = real.unionByName(odd_turns.select(real.columns))
    both.write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op13_turn_repair(spark, str(tmp_path)).collect()
    rows = [tuple(r) for r in both.select("conv_id", "turn", "role", "text").collect()]
    by_conv = {r[0]: [] for r in rows}
    for conv, *rest in plain_damage(rows):
        by_conv[conv].append(tuple(rest))
    want = {conv: plain_summary(rest) for conv, rest in by_conv.items()}
    assert len(found) == len(want)
    assert {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found} == want


def test_repair_gives_its_turns(odd_turns):
    edits = turns.repair(odd_turns).collect()
    assert Counter((e.conv, e.turn, e.role or " ", e.text) for e in edits if e.edit != "I") == Counter(
        (r.conv_id, r.turn, r.role or " ", " " if r.text is None else r.text) for r in odd_turns.collect() if r.role != ""
    ) + Counter((r.conv_id, r.turn, " ", r.text) for r in odd_turns.collect() if r.role == "")
    for conv, mine in itertools.groupby(sorted(edits, key=lambda e: (e.conv is not None, e.conv or 0, e.place)), key=lambda e: e.conv):
        mine = list(mine)
        assert [e.place for e in mine] == list(range(len(mine)))
        assert all((e.new_role is None) == (e.edit == "D") for e in mine)


def test_giant_conversations_spill_and_stay_right(monkeypatch):
    random.seed(3)
    rows = [(random.choice(["user", "assistant", "system"]), random.choice([None, None, "blank", "truncated"])) for _ in range(5000)]
    whole = repaired(rows)
    monkeypatch.setattr(turns, "HELD_TURNS", 64)
    work = turns.Repair(0)
    for place, (role, fault) in enumerate(rows):
        work.add(place, role, "t", fault)
    assert len(work.kept.turns) < 64 and len(work.kept.places) == 5000 // 64 and work.kept.file is not None
    assert list(work.edits()) == whole[1] and work.kept.file.closed


def test_the_programme_has_few_different_steps():
    random.seed(4)
    turns.advance.cache_clear()
    for _ in range(300):
        repaired([(random.choice("suax"), random.choice([None, "blank", "truncated"])) for _ in range(60)])
    assert turns.advance.cache_info().currsize < 1 << 12


def test_repair_carries_state_across_batches(spark, odd_turns):
    whole = Counter(map(tuple, turns.repair(odd_turns).collect()))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "3")
    try:
        assert Counter(map(tuple, turns.repair(odd_turns).collect())) == whole
        assert turns.summaries(turns.repair(odd_turns)).count() == odd_turns.select("conv_id").distinct().count()
    finally:
        spark.conf.set(limit, before)


def test_repair_shuffles_once_and_takes_nothing(odd_turns, plan):
    made = turns.repair(odd_turns)
    assert plan(made).split("== Initial Plan ==")[-1].count("Exchange") == 1
    assert turns.summaries(turns.repair(odd_turns.limit(0))).collect() == []
