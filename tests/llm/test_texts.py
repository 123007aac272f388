"""Token counts, quality, secrets, licences and decontamination against plain Python."""

import hashlib
import math
import random
import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.llm import decontaminate, licenses, quality, secrets, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def plain_words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


# Token counts


def test_token_counts_equal_the_library(both_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = Counter(map(tuple, tokens.token_counts(both_docs, MODEL, 300, table_size=500).collect()))
    want = Counter()
    for r in both_docs.collect():
        n = len(library.encode(r.text or ""))
        want[(r.doc_id, len((r.text or "").encode()), n, n > 300)] += 1
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" ▁ab\n\tthe<s>éß２\x00😀"), max_size=40))
def test_pre_tokens_add_up(text):
    with open(MODEL, "rb") as file:
        model = file.read()
    count = tokens.counter({"the": 1}, model)
    assert count([text, text]) == [len(tokens.loaded(model).encode(text))] * 2


def test_token_counts_of_nothing(nothing):
    assert tokens.token_counts(nothing, MODEL, 10).collect() == []


def test_worker_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    with open(MODEL, "rb") as file:
        count = tokens.counter({}, file.read())
    first = [count([f"w{i} z{i}"]) for i in range(200)]
    assert [count([f"w{i} z{i}"]) for i in range(200)] == first
    assert len(count.__closure__[0].cell_contents if isinstance(count.__closure__[0].cell_contents, dict) else {}) <= 60


# Quality


def slow_counts(text):
    words = plain_words(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if plain_words(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit))


def test_quality_counts(both_docs):
    got = Counter(tuple(r)[:6] + (r.base_failed,) for r in quality.quality(both_docs).collect())
    want = Counter()
    for r in both_docs.collect():
        c = slow_counts(r.text)
        want[(r.doc_id, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
    assert got == want


def run_of(text):
    """A text's symbols behind the start marks, one by one."""
    out = ["\x02"] * 4
    for c in text or "":
        out.append(" " if c in " \t\n\x0b\x0c\r" else "0" if c in "0123456789" else c.lower() if "A" <= c <= "Z" else c)
    return tuple(out)


def slow_model(texts):
    """Interpolated modified Kneser-Ney with dictionaries, straight from the definition."""
    grams = Counter()
    for text in texts:
        run = run_of(text)
        grams.update(run[i : i + 5] for i in range(len(run) - 4))
    tables = {5: grams}
    for order in (4, 3, 2, 1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    d = {}
    for order, table in tables.items():
        n = [sum(v == i for v in table.values()) for i in (1, 2, 3, 4)]
        if min(n) == 0:
            d[order] = [0, 0.5, 0.75, 0.75]
        else:
            y = n[0] / (n[0] + 2 * n[1])
            d[order] = [0] + [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.1), i + 0.9) for i in range(3)]
    sums, cuts = {}, {}
    for order, table in tables.items():
        for g, c in table.items():
            sums[g[:-1]] = sums.get(g[:-1], 0) + c
            cuts[g[:-1]] = cuts.get(g[:-1], 0) + d[order][min(c, 3)]

    def p(gram):
        if not gram:
            return 1 / len(tables[1])
        context, order = gram[:-1], len(gram)
        c = tables[order][gram]
        return (c - d[order][min(c, 3)]) / sums[context] + cuts[context] / sums[context] * p(gram[1:])

    return p


def slow_perplexity(p, text):
    run = run_of(text)
    logs = [math.log(p(run[i : i + 5])) for i in range(len(run) - 4)]
    return -sum(logs) / len(logs) if logs else None


@pytest.fixture(scope="module")
def quality_rows(both_docs):
    return [(r.doc_id, r.lang, r.text or "") for r in both_docs.collect()]


@pytest.mark.parametrize("size", [1 << 21, 3000])
def test_perplexity_is_kneser_ney_over_distinct_texts(both_docs, quality_rows, monkeypatch, size):
    """Whether the model is one slice or many."""
    monkeypatch.setattr(quality, "SLICE", size)
    p = slow_model({t for *_, t in quality_rows})
    known = {}
    for doc, _, text in quality_rows:
        known.setdefault(doc, []).append(slow_perplexity(p, text))
    for r in quality.quality(both_docs).collect():
        assert any(r.log_perplexity == w if w is None else r.log_perplexity == pytest.approx(w, abs=1e-4) for w in known[r.doc_id])


def test_kept_equals_plain_bands(both_docs, quality_rows):
    p = slow_model({t for *_, t in quality_rows})
    score = {t: slow_perplexity(p, t) for *_, t in quality_rows}
    counts = {t: slow_counts(t) for *_, t in quality_rows}
    failed = {t: c[0] < 20 or 100 * c[4] > 30 * c[0] for t, c in counts.items()}
    limits = {}
    for lang in {x for _, x, _ in quality_rows}:
        steps = [math.floor(score[t] * 1024 + 0.5) for t in {t for _, x, t in quality_rows if x == lang} if not failed[t] and score[t] is not None]
        if steps:
            q = np.percentile(steps, [25, 50, 75]) / 1024
            limits[lang] = q[1] - 4 * max(q[1] - q[0], 0.02), q[1] + 4 * max(q[2] - q[1], 0.02)
    want = Counter()
    for doc, lang, text in quality_rows:
        kept = not failed[text]
        if kept and lang in limits:
            slack = 3 / math.sqrt(max(1, len(text)))
            kept = limits[lang][0] - slack <= score[text] <= limits[lang][1] + slack
        want[doc, kept] += 1
    assert Counter((r.doc_id, r.kept) for r in quality.quality(both_docs).collect()) == want


def test_pieces_and_full_tasks_do_not_change_counts(monkeypatch, test_docs):
    texts = ["Ünï côdé und Wörter 😀 12 " * 30, "", None, "ab"] + [r.text for r in test_docs.limit(20).collect()]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5], pa.string())], names=["text"]) for i in range(0, len(texts), 5)]

    def counted():
        found = Counter()
        for batch in quality._count_grams(iter(batches)):
            for gram, n in zip(batch.column("gram").to_pylist(), batch.column("n").to_pylist()):
                found[tuple(gram)] += n
        return found

    want = Counter()
    for text in texts:
        run = run_of(text)
        want.update(run[i : i + 5] for i in range(len(run) - 4))
    assert counted() == want
    monkeypatch.setattr(quality, "PIECE", 7)
    monkeypatch.setattr(quality, "BLOCK", 30)
    monkeypatch.setattr(quality, "HELD_GRAMS", 50)
    assert counted() == want


def test_a_slice_finds_every_hash_and_only_its_own():
    rng = np.random.default_rng(1)
    found = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    logs = -np.arange(1, len(found) + 1, dtype=float)
    low, high = 1 << 62, (1 << 63) - 1
    mine = (found >= low) & (found <= high)
    part = quality.Slice.made(low, high, found[mine][::-1], logs[mine][::-1])
    assert part.log_sum(found) == pytest.approx(logs[mine].sum(), rel=1e-6)
    with pytest.raises(ValueError):
        part.log_sum(np.array([low + 12345], np.uint64))
    assert quality.Slice.made(0, (1 << 64) - 1, np.array([7], np.uint64), np.array([-2.0])).log_sum(np.array([7, 7], np.uint64)) == -4


def test_gibberish_goes_in_every_script_and_clean_texts_stay(spark):
    """Random letters in the shape of the texts, Latin and Cyrillic; the Cyrillic texts are the Latin ones, letter for letter."""
    random.seed(2)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in docs.collect() if r.lang in ("en", "de")]
    cyrillic = str.maketrans("abcdefghijklmnopqrstuvwxyz", "абцдефгхийклмнопярстувжьыз")
    told = [(r.doc_id, r.text, r.lang) for r in rows] + [(10**6 + r.doc_id, r.text.lower().translate(cyrillic), "ru") for r in rows if r.lang == "en"]
    picked = [t for t in told if len(t[1].split()) > 80]
    junk = {"en": "abcdefghijklmnopqrstuvwxyz", "de": "abcdefghijklmnopqrstuvwxyz", "ru": "абцдефгхийклмнопярстувжьыз"}
    mangled = []
    for lang, letters in junk.items():
        for doc, text, _ in [t for t in picked if t[2] == lang][:25]:
            mangled.append((-1 - len(mangled), "".join(random.choice(letters) if c.isalpha() else c for c in text), lang))
    judged = {r.doc_id: r for r in quality.quality(spark.createDataFrame(told + mangled, "doc_id long, text string, lang string")).collect()}
    # The model has counted the gibberish too, which speaks for it: not all of it need go.
    assert sum(judged[m[0]].kept for m in mangled) <= 0.05 * len(mangled)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1 AND toxic = 0")
    clean = {r.doc_id for r in labels.collect()}
    stay = [judged[t[0]] for t in told if t[0] % 10**6 in clean]
    stay = [r.kept for r in stay if not r.base_failed]
    assert len(stay) > 100 and sum(stay) >= 0.99 * len(stay), (sum(stay), len(stay))


def test_keep_good_is_the_verdict(spark, both_docs):
    kept = Counter(r.doc_id for r in quality.keep_good(both_docs).collect())
    assert kept == Counter(r.doc_id for r in quality.quality(both_docs).collect() if r.kept)
    assert quality.keep_good(both_docs).columns == both_docs.columns


def test_clean_documents_stay(spark, test_docs):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1 AND toxic = 0")
    judged = quality.quality(big).filter("NOT base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept for r in judged) >= 0.99 * len(judged)


@pytest.mark.parametrize("lang", ["de", "fr", "es"])
def test_copies_of_one_text_change_no_verdict(spark, lang):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1 AND toxic = 0")
    before = quality.quality(docs).join(docs.select("doc_id", "lang"), "doc_id").filter(f"lang = '{lang}' AND NOT base_failed").collect()
    clean = {r.doc_id for r in labels.collect()}
    middle = sorted(before, key=lambda r: r.log_perplexity)[len(before) // 2].doc_id
    copies = docs.filter(F.col("doc_id") == middle).crossJoin(spark.range(500)).select(docs.columns)
    hot = docs.union(copies.withColumn("doc_id", F.lit(-1).cast("long")))
    judged = quality.quality(hot).filter("doc_id <> -1").collect()
    assert {r.doc_id for r in before if r.kept} == {r.doc_id for r in judged if r.kept} & {r.doc_id for r in before}
    mine = [r for r in judged if r.doc_id in clean and r.doc_id in {b.doc_id for b in before}]
    rejected = sum(not r.kept for r in mine)
    assert mine and rejected <= 0.05 * len(mine), (rejected, len(mine))


def test_distinct_texts(spark, both_docs):
    rows = [r.text or "" for r in both_docs.union(both_docs.limit(50)).collect()]
    got = [r.text or "" for r in quality.distinct_texts(both_docs.union(both_docs.limit(50))).collect()]
    assert sorted(got) == sorted(set(rows))


def test_quality_of_nothing(nothing):
    assert quality.quality(nothing).collect() == [] and quality.keep_good(nothing).collect() == []


# Secrets


def slow_secrets(text):
    text, found = text or "", []
    patterns = (
        (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        (r"(AKIA[A-Z0-9]+)", 20), (r"([0-9a-f]+)", 24),
    )
    for kind, (pattern, least) in enumerate(patterns):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return sorted(found)


def test_base_secrets(both_docs):
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.find_secrets(both_docs).collect())
    want = Counter()
    for r in both_docs.collect():
        spans = slow_secrets(r.text)
        digest = hashlib.sha256(",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
        want[(r.doc_id, *(sum(s[1] == k for s in spans) for k in range(3)), digest)] += 1
    assert got == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("token=secret: \"'AKIAZ09abcdefſK_."), max_size=60))
def test_base_spans(text):
    assert secrets.base_spans(text) == slow_secrets(text)


def test_network_learns_and_keeps_recall():
    rng = random.Random(3)
    make = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    windows, labels = [], []
    for i in range(900):
        label = i % 3 == 0
        token = make("0123456789abcdef", 40) if label else make("0123456789", 16) if i % 3 == 1 else make("thenand", 14) + "12"
        left = rng.choice(["call me at ", "token = \"", "of the and "])[-secrets.LEFT :].rjust(secrets.LEFT, "\0")
        windows.append(left + token[: secrets.INSIDE].ljust(secrets.INSIDE, "\0") + " more".ljust(secrets.RIGHT, "\0"))
        labels.append(label)
    network = secrets.train(windows[:700], labels[:700])
    said = network.probabilities(windows[700:]) >= network.threshold
    truth = np.array(labels[700:])
    assert said[truth].mean() >= 0.95 and said[~truth].mean() <= 0.05


def test_learned_spans_are_added(spark):
    """Secrets whose shape the patterns' findings teach are found without the patterns' words."""
    rng = random.Random(1)
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    make = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    rows = [(i, f"some words secret: {make(letters, 40)} and card {make('0123456789', 16)} more") for i in range(300)]
    bare = [(1000 + i, f"key material {make(letters, 40)} here") for i in range(5)]
    out = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows + bare, "doc_id long, text string")).collect()}
    assert all(out[i].n_learned == 0 and out[i].n_assign == 1 for i in range(300))
    assert sum(out[1000 + i].n_learned for i in range(5)) >= 4
    assert all(out[1000 + i].spans == "learned:13:53" for i in range(5) if out[1000 + i].n_learned)


def test_windows_reach_the_end_of_a_candidate():
    token = "config/prod/eu-west-1/service/database/v" + "Zq8" * 14
    found = secrets.candidates(f"see {token} now", [])
    assert found == [(4, 4 + len(token), "see ", token, " now", False)]
    seen = list(secrets.windows(*found[0][2:5]))
    insides = [w[secrets.LEFT : secrets.LEFT + secrets.INSIDE] for w in seen]
    assert token[-secrets.INSIDE :] in insides and all(len(w) == secrets.LEFT + secrets.INSIDE + secrets.RIGHT for w in seen)
    assert all(any(token[i : i + 30] in w for w in insides) for i in range(len(token) - 29))
    whole = "see ".rjust(secrets.LEFT, "\0") + token + " now".ljust(secrets.RIGHT, "\0")
    assert all(w.strip("\0") in whole for w in seen)
    assert [c[:2] for c in secrets.candidates("pin abc12345 and QwErTyUiOpAsDfGh, geHeimWort but not abcdefgh", [])] == [(4, 12), (17, 33), (35, 45)]
    parts = secrets.candidates(token, [(0, 0, 8)])
    assert [(c[0], c[1], c[5]) for c in parts] == [(0, 8, True), (8, len(token), False)] and parts[1][2] == "config/p"


KEY_LETTERS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


@pytest.mark.parametrize("findings", [0, 1, 6, 40])
def test_hidden_secrets_are_found_at_every_size(spark, findings):
    rng = random.Random(findings)
    key = lambda n, of=KEY_LETTERS: "".join(rng.choice(of) for _ in range(n))
    rows = [(i, f"some words secret: {key(40)} more words") for i in range(findings)]
    hidden = [f"key material {key(40)} here", f"ghp_{key(36)}", f"use sk-{key(44)} for it", f"({key(32, KEY_LETTERS[:10] + 'ABCDEF')})", f"x {key(24)}\n"]
    plain = ["id 123e4567-e89b-12d3-a456-426614174000", "see src/main/java/com/example/report/DailyReport.java", "call getElementsByTagName2 first",
             "at 2024-01-31T10.00.00 it", "the daily_stats_by_account_2024 table", "=" * 40, "version-1.12.3-rc1 of it", "https://example.com/en/some-long-article-about-it"]
    rows += [(1000 + i, t) for i, t in enumerate(hidden)] + [(2000 + i, t) for i, t in enumerate(plain)]
    out = {r.doc_id: r.n_learned for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(out[1000 + i] for i in range(len(hidden))) >= 4
    assert sum(out[2000 + i] for i in range(len(plain))) <= 1


def test_recall_and_precision_on_unseen_kinds():
    """Each kind of secret is left out of training and then looked for; hex in small letters is the patterns' own."""
    fresh = secrets.made_findings(size=100, seed=99)
    of = lambda kind, said: np.mean([s for s, (_, _, k) in zip(said, fresh) if k == kind])
    found = {}
    for kind in secrets.SECRET_KINDS:
        network = secrets.train([], [], without=[kind])
        said = network.probabilities([w for w, *_ in fresh]) >= network.threshold
        found[kind] = of(kind, said)
        assert np.mean([of(k, said) for k in secrets.LOOKALIKES]) <= 0.03
    assert all(recall >= 0.9 for kind, recall in found.items() if kind != "hex"), found
    unseen = {}
    for kind in secrets.LOOKALIKES:
        network = secrets.train([], [], without=[kind])
        unseen[kind] = of(kind, network.probabilities([w for w, *_ in fresh]) >= network.threshold)
    assert sum(v <= 0.05 for v in unseen.values()) >= 8, unseen


def test_very_long_tokens_take_bounded_memory():
    """A megabyte without a gap, a secret at its end: the windows are judged some at a time."""
    network = secrets.train([], [])
    token = "value/" * 170_000
    tracemalloc.start()
    rng = random.Random(8)
    hidden = token + "".join(rng.choice(KEY_LETTERS) for _ in range(40))
    assert secrets.passed(network, [("", token, ""), ("", hidden, "")]) == [False, True]
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()
    assert len(secrets.candidates(hidden, [])) == 1


def test_secret_behind_a_long_path_is_found(spark):
    rng = random.Random(1)
    letters = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    make = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    path = "config/prod/eu-west-1/service/database/values/key="
    rows = [(i, f"some words secret: {make(letters, 40)} and card {make('0123456789', 16)} in {path}default more") for i in range(300)]
    hidden = [(1000 + i, f"look at {path}{make(letters, 40)} here") for i in range(5)]
    out = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows + hidden, "doc_id long, text string")).collect()}
    assert sum(out[1000 + i].spans == f"learned:8:{8 + len(path) + 40}" for i in range(5)) >= 4
    assert sum(out[i].n_learned for i in range(300)) <= 15


def learning_docs(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = "array<struct<start:int,kind:int,end:int>>"
    return docs.select("doc_id", "text").mapInArrow(secrets._collect, f"doc long, base {base}, found {secrets.FOUND}")


def test_findings_beyond_a_part_are_learned_from(spark):
    """Constants are made look-alikes; the texts' findings say otherwise, but only those that a least-hash sample of 1500 leaves out."""
    rng = random.Random(4)
    key = lambda: "".join(rng.choice(KEY_LETTERS) for _ in range(36))
    constant = lambda: "_".join(rng.choice(secrets.PLAIN_WORDS).upper() for _ in range(5))
    tokens = [(True, key()) for _ in range(3600)] + [(False, constant()) for _ in range(3200)]
    frame = spark.createDataFrame(tokens, "common boolean, token string")
    kept = frame.filter((F.xxhash64(F.lit("words secret: "), "token", F.lit(" more words")) < 0) == F.col("common")).collect()
    assert sum(r.common for r in kept) > 1500 and sum(not r.common for r in kept) > 1400
    network = secrets.learned(learning_docs(spark, [f"words secret: {r.token} more words" for r in kept]))
    said = secrets.passed(network, [("words secrets: ", constant(), " more words") for _ in range(50)])
    assert np.mean(said) >= 0.9


def test_parts_hold_every_window(spark):
    """All windows of both labels, long tokens' too, are held out or in a part; the fewer secrets are repeated over the parts."""
    rng = random.Random(6)
    make = lambda n, of=KEY_LETTERS: "".join(rng.choice(of) for _ in range(n))
    texts = [f"words secret: {make(60)} more" for _ in range(40)] + [f"the {make(7, 'abcdef')}_{make(8, 'abcdef')}_table is" for _ in range(300)]
    collected = learning_docs(spark, texts + texts[:50] + ["", None])
    tried, want = secrets.train([], []), set()
    found = [c for text in texts for c in secrets.candidates(text, secrets.base_spans(text))]
    for c, doubtful in zip(found, secrets.passed(tried, [c[2:5] for c in found]), strict=True):
        want |= {(w, c[5]) for w in secrets.windows(*c[2:5]) if c[5] or not doubtful}
    own = secrets.labelled_windows(collected, tried).collect()
    assert len(want) > 300 and Counter((r.window, r.label) for r in own) == Counter(want)
    own = secrets.held_out(spark.createDataFrame(own), len(own))
    parts = secrets.dealt_parts(own, counts := Counter(r.label for r in own.collect()), 50).collect()
    own = sorted(own.collect(), key=lambda r: (r.hash, r.window, r.label))
    assert [r.held for r in own] == [i % 4 == 3 for i in range(len(own))]
    assert len(parts) == -(-max(counts.values()) // 50)
    dealt = Counter((w.window, w.label) for p in parts for w in p.rows)
    assert set(dealt) == {(r.window, r.label) for r in own if not r.held}
    fewer = counts[True] < counts[False]
    assert {n for w, n in dealt.items() if w[1] != fewer} == {1}
    assert {n for w, n in dealt.items() if w[1] == fewer} == {min(len(parts), len(parts) * 50 // counts[fewer])}


def test_many_parts_learn_what_one_does(spark):
    rng = random.Random(9)
    make = lambda n, of=KEY_LETTERS: "".join(rng.choice(of) for _ in range(n))
    texts = [f"words secret: {make(40)} and card {make(16, '0123456789')} more" for _ in range(200)]
    collected = learning_docs(spark, texts).persist()
    fresh = [f"key {make(40)} here" for _ in range(60)] + [f"card {make(16, '0123456789')} more" for _ in range(60)]
    one, many, again = secrets.learned(collected, 1000), secrets.learned(collected, 60), secrets.learned(collected.repartition(3), 60)
    for network in (one, many):
        said = secrets.passed(network, [c[2:5] for t in fresh for c in secrets.candidates(t, [])])
        assert np.mean(said[:60]) >= 0.95 and np.mean(said[60:]) <= 0.05
    assert np.array_equal(many.kernel, again.kernel) and many.threshold == again.threshold


def test_secrets_of_nothing(nothing):
    assert secrets.find_secrets(nothing).collect() == []


# Licences


def slow_scan(text, templates, least):
    lines = [licenses.words(line) for line in text.split("\n")]
    made = {name: licenses.bigrams(licenses.words(template)) for name, template in templates.items()}
    found = []
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            run = [w for line in lines[i : j + 1] for w in line]
            if not lines[i] or not lines[j]:
                continue
            own = licenses.bigrams(run)
            for name, other in made.items():
                score = 0 if other.keys().isdisjoint(own) else licenses.dice(own, other)
                if score >= least:
                    found.append((-score, j - i, i, name, j))
    chosen = []
    for score, _, i, name, j in sorted(found):
        if all(j < a or i > b for a, b, _, _ in chosen):
            chosen.append((i, j, name, -score))
    return sorted(chosen)


def test_licenses(both_docs):
    got = Counter((r.doc_id, tuple(map(tuple, r.matches))) for r in licenses.scan_licenses(both_docs).collect())
    want = Counter((r.doc_id, tuple(slow_scan(r.text or "", licenses.TEMPLATES, 0.8))) for r in both_docs.collect())
    assert got == want


def test_license_over_several_lines():
    text = "intro line here\n\n" + licenses.TEMPLATES["GPL-3.0-notice"].replace(", either", ",\neither").replace(" the GNU", "\n  the GNU") + "\nafter it"
    assert licenses.Scanner().scan(text) == slow_scan(text, licenses.TEMPLATES, 0.8)
    assert [m[2] for m in licenses.Scanner().scan(text)] == ["GPL-3.0-notice"]


def slow_windows(flat, templates, least, most):
    free, chosen = [True] * len(flat), []
    made = {n: licenses.bigrams(licenses.words(t)) for n, t in templates.items()}
    while True:
        found = [
            (-score, i - j, i, name)
            for i in range(len(flat)) for j in range(i + 1, min(len(flat), i + most)) if all(free[i : j + 1])
            for name, own in made.items() if (score := licenses.dice(licenses.bigrams(flat[i : j + 1]), own)) >= least
        ]
        if not found:
            return sorted(chosen)
        score, less, i, name = min(found)
        length = -less
        chosen.append((i, i + length, name, -score))
        free[i : i + length + 1] = [False] * (length + 1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdx"), max_size=30))
def test_license_windows(flat):
    templates = {"one": "a b c d a", "two": "b c b", "three": "d c b a b c d"}
    scanner = licenses.Scanner(templates)
    assert sorted(scanner.windows(flat, bytearray(len(flat)))) == slow_windows(flat, templates, 0.8, 12)


def test_license_inside_lines():
    scan, filler = licenses.Scanner().scan, " ".join(f"w{i}" for i in range(100))
    names = lambda text: [m[2] for m in scan(text)]
    assert names("Copyright (c) 2024 Foo. Released under the MIT License.") == ["MIT"]
    for name, template in licenses.TEMPLATES.items():
        assert names(f"{filler} {template} {filler}") == [name]
        assert names(f"a\n{filler} {template.replace(' ', chr(10), 3)} {filler}\nb") == [name]
    both = licenses.TEMPLATES["GPL-3.0-notice"] + " " + licenses.TEMPLATES["MIT"]
    assert names(both) == ["GPL-3.0-notice", "MIT"]
    assert names(f"{filler} {both} {filler}") == ["GPL-3.0-notice", "MIT"]


def test_license_tags_and_short_notices():
    scan = licenses.Scanner().scan
    told = {
        "// SPDX-License-Identifier: MIT": "MIT-tag", "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later-tag",
        "Licensed under the BSD 2-Clause License": "BSD-2-Clause", "under the GNU Lesser General Public License version 2.1 as": "LGPL-2.1",
        "Licensed under the terms of the MIT license": "MIT-terms", "foo.c is in the style of bar": None,
    }
    assert {text: next((m[2] for m in scan(text)), None) for text in told} == told


def test_license_scan_is_linear_in_its_matches():
    """Ten times the notices take some ten times as long, on lines of their own and within one line."""
    scan = licenses.Scanner().scan
    for form in ("Released under the MIT License.\n", "Released under the MIT License. w1 w2 w3 "):
        took = []
        for n in (500, 5_000):
            began = time.process_time()
            assert len(scan(form * n)) == n
            took.append(time.process_time() - began)
        assert took[1] < 25 * took[0], took


def test_licenses_of_nothing(nothing):
    assert licenses.scan_licenses(nothing).collect() == []


# Decontamination

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def slow_hits(text, items):
    words = re.findall(PATTERN, (text or "").translate(LOWER))
    hit, names = set(), set()
    for name, item in items:
        own = re.findall(PATTERN, (item or "").translate(LOWER))
        n = min(10, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                names.add(name)
    return (len(words), len(hit), len(names), tuple(sorted(names)), bool(hit))


def test_decontamination(spark, both_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text")
    own = [(90, None), (91, ""), (92, "A"), (93, "fox jumps"), (94, "quick brown fox jumps over the lazy dog and then it goes on"),
           (95, "again now repeat these"), (95, "É ß"), (96, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14"),
           (97, "repeat these eight words again and again now " * 3), (None, "lazy dog and")]
    benchmark = benchmark.union(spark.createDataFrame(own, "item_id long, text string"))
    items = [("" if r.item_id is None else str(r.item_id), r.text) for r in benchmark.collect()]
    found = decontaminate.decontaminate(both_docs, benchmark)
    got = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r.items), r.contaminated) for r in found.collect())
    want = Counter((r.doc_id, *slow_hits(r.text, items)) for r in both_docs.collect())
    assert got == want
    clean = decontaminate.drop_contaminated(both_docs, benchmark)
    assert clean.columns == both_docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(
        r.doc_id for r in both_docs.collect() if not slow_hits(r.text, items)[-1]
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=0, max_size=60), st.lists(st.sampled_from("abc"), min_size=10, max_size=25))
def test_every_shared_window_has_a_common_fingerprint(doc, item):
    texts = [" ".join(doc), " ".join(item)]
    _, (a, b) = decontaminate.fingerprints(texts, (), None)
    common = {f[2] for f in a} & {f[2] for f in b}
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    for i in range(len(doc) - 9):
        if tuple(doc[i : i + 10]) in windows:
            assert any(i <= f[0] <= i + 5 and f[2] in common for f in a)


def test_a_phrase_that_many_share_makes_no_rows(spark):
    """1,500 items and 1,500 documents share five words and nothing else: no window leaves the scan, nothing is joined."""
    told = lambda side, i: " ".join([*(f"{side}{i}x{j}" for j in range(8)), "choose the right answer now", *(f"{side}{i}y{j}" for j in range(8))])
    items = spark.createDataFrame([(i, told("i", i)) for i in range(1500)], "item_id long, text string")
    index, short = decontaminate.benchmark_index(items)
    maps = tuple(np.frombuffer(decontaminate.bit_map(index, c), np.uint8) for c in ("gram", "hash"))
    _, found = decontaminate.fingerprints([told("d", i) for i in range(1500)], short, maps)
    assert sum(map(len, found)) <= 3  # a bit may be set by chance
    assert index.groupBy("k", "gram", "hash", "check").count().filter("count > 1").count() == 0
    docs = spark.createDataFrame([(i, told("d", i)) for i in range(1499)] + [(9999, "see " + told("i", 7))], "doc_id long, text string")
    assert [(r.doc_id, r.n_hit, r.items) for r in decontaminate.decontaminate(docs, items).filter("contaminated").collect()] == [(9999, 21, ["7"])]


def test_decontamination_of_and_by_nothing(spark, nothing, odd_docs):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(nothing, no_items).collect() == []
    assert not any(r.contaminated for r in decontaminate.decontaminate(odd_docs, no_items).collect())
