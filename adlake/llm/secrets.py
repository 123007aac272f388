"""Secret scan: fixed patterns, and a small character network over every other candidate.

The texts are read once. That pass finds the patterns' spans and, with the text around them, all
tokens that could be secrets. A convolutional network in numpy is trained on labelled
findings: a fixed set of made ones (kinds of secrets, and of what looks like them), and all
windows of the texts' own (tokens inside the patterns' spans are secrets, other candidates are
not). Spark deals these into parts of bounded size; every epoch runs on all parts, each beside the made
ones, and their networks are averaged. The scores are calibrated on a fourth of all windows, which no
part has seen, and the threshold keeps the wanted recall there. A candidate passes if any part of it
does; it is added to the patterns' spans.
"""

from __future__ import annotations

import copy
import hashlib
import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import PART_ROWS
from adlake.sources.writers import stage

KINDS = ("assign", "access", "hex", "learned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Maximal runs: no match can begin inside one, and shorter runs would be dropped.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
# Shorter ones need a digit, or a capital behind a small letter.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])(?:[A-Za-z0-9+/_=.-]{16,}|(?=[A-Za-z+/_=.-]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9+/_=.-]{8,})")
# Characters left of a candidate, of the candidate itself, and right of it.
LEFT, INSIDE, RIGHT = 24, 40, 16
# A longer candidate has a window at every SLIDE characters, up to its end.
SLIDE = 8
# Windows that are judged at a time.
STEP = 1024
# Windows of the more frequent label in a part, made findings of each kind, epochs, and the recall the
# threshold must keep. All windows of a label weigh as much as a part's in the calibration, or less if fewer.
PART = 1500
MADE = 120
EPOCHS = 6
RECALL = 0.98
# Tasks that train parts, at most, and cells of a logit that scores are counted by.
TASKS = 8192
CELLS = 256
CHARACTERS = " \"'=:;,.-_/+()[]{}<>#&@%$*!?\\|~`^\n0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
OTHER = len(CHARACTERS)
PAD = OTHER + 1
CODE = {c: i for i, c in enumerate(CHARACTERS)}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted; ends are exclusive, positions are code points."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, spans: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, str, str, str, bool | None]]:
    """(start, end, left, token, right, label) of every token that could be a secret.

    The label says that a fixed span is meant: the token is then the part of the span that lies in it,
    for learning only. The parts of such a token beside the spans are candidates of their own
    (False), if as long as a window.
    """
    out = []

    def add(start: int, end: int, label: bool) -> None:
        out.append((start, end, text[max(0, start - LEFT) : start], text[start:end], text[end : end + RIGHT], label))

    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        met = [(max(s, start), min(e, end)) for s, _, e in spans if s < end and start < e]
        if not met:
            add(start, end, False)
            continue
        at = start
        for s, e in sorted(met):
            add(s, e, True)
            if s - at >= INSIDE:
                add(at, s, False)
            at = max(at, e)
        if end - at >= INSIDE:
            add(at, end, False)
    return out


def window(left: str, token: str, right: str, at: int = 0) -> str:
    """What the network sees of a token from character ``at`` on, with NULs where there is no text."""
    before = (left + token[max(0, at - LEFT) : at])[-LEFT:]
    inside = token[at : at + INSIDE]
    after = (token[at + INSIDE : at + INSIDE + RIGHT] + right)[:RIGHT] if len(inside) == INSIDE else right[:RIGHT]
    return before.rjust(LEFT, "\0") + inside.ljust(INSIDE, "\0") + after.ljust(RIGHT, "\0")


def windows(left: str, token: str, right: str) -> Iterator[str]:
    """The windows of a token: one at every SLIDE characters, and one that ends with it."""
    last = max(0, len(token) - INSIDE)
    for at in range(0, last, SLIDE):
        yield window(left, token, right, at)
    yield window(left, token, right, last)


LOWER, CAPITAL, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Made secrets, as what stands in front, the characters that follow and how many.
SECRET_KINDS = {
    "base64": ("", LOWER + CAPITAL + DIGIT + "+/", 40, 44), "base64url": ("", LOWER + CAPITAL + DIGIT + "-_", 32, 64),
    "mixed": ("", LOWER + CAPITAL + DIGIT, 20, 48), "mixed-short": ("", LOWER + CAPITAL + DIGIT, 12, 20), "lower": ("", LOWER + DIGIT, 24, 48),
    "upper": ("", CAPITAL + DIGIT, 20, 40), "hex-upper": ("", DIGIT + "ABCDEF", 32, 64), "hex": ("", DIGIT + "abcdef", 24, 64),
    "hub": ("ghp_", LOWER + CAPITAL + DIGIT, 36, 36), "model": ("sk-", LOWER + CAPITAL + DIGIT, 40, 48), "maps": ("AIza", LOWER + CAPITAL + DIGIT + "-_", 35, 35),
    "chat": ("xoxb-", DIGIT + LOWER + CAPITAL, 40, 52), "signed": ("eyJ", LOWER + CAPITAL + DIGIT + "-_.", 60, 120),
}
# Words that look-alikes and surroundings are made of.
PLAIN_WORDS = (
    "account address article backup build button cache client color config content context control customer data database default deploy detail "
    "document element error event export field file filter format function group handler header history image import index input item label layer "
    "length library list local main manager message method model module name network node number object option order output package page panel "
    "parent path pattern process product profile project property query queue random record region report request resource result return route "
    "schema screen section select server service session setting simple source start state status storage stream string style system table target "
    "task template test text title track type update user value version video view window work"
).split()
LOOKALIKES = ("uuid", "time", "number", "snake", "camel", "path", "host", "version", "slug", "rule", "file", "constant")
SURROUNDINGS = (
    ("", ""), ("export KEY=", "\n"), ("key = \"", "\"\n"), ("the value ", " was used"), ("see ", ", then"), ("Authorization: Bearer ", "\n"),
    ("id: ", "\n"), ("('", "')"), ("https://", " and"), ("- ", "\n"),
)


def _lookalike(kind: str, rng: np.random.Generator) -> str:
    word = lambda: PLAIN_WORDS[rng.integers(len(PLAIN_WORDS))]
    some = lambda low, high: [word() for _ in range(rng.integers(low, high + 1))]
    digits = lambda n, of=DIGIT: "".join(of[k] for k in rng.integers(len(of), size=n))
    match kind:
        case "uuid":
            return "-".join(digits(n, DIGIT + "abcdef") for n in (8, 4, 4, 4, 12))
        case "time":
            return f"20{digits(2)}-0{rng.integers(1, 10)}-1{digits(1)}T1{digits(1)}:00:00"[: rng.choice([10, 19])].replace(":", ".")
        case "number":
            return digits(rng.integers(8, 24)) if rng.random() < 0.5 else f"{digits(6)}.{digits(6)}"
        case "snake":
            return "_".join(some(3, 5)) + digits(rng.integers(0, 3))
        case "camel":
            return word() + "".join(w.capitalize() for w in some(1, 4)) + digits(rng.integers(0, 3))
        case "path":
            return "/".join(some(3, 6)) + rng.choice(["", ".py", ".java", ".html", "/v" + digits(1)])
        case "host":
            return ".".join(some(2, 4)) + rng.choice([".com", ".org", ".net", ".io"]) + rng.choice(["", "/" + "/".join(some(1, 3))])
        case "version":
            return f"{word()}-{digits(1)}.{digits(2)}.{digits(1)}" + rng.choice(["", "-rc" + digits(1), "-SNAPSHOT", ".tar.gz"])
        case "slug":
            return "-".join(some(3, 7)) + rng.choice(["", "-20" + digits(2)])
        case "rule":
            return rng.choice(["-", "=", "_", "."]) * int(rng.integers(16, 60))
        case "file":
            return f"{'_'.join(some(1, 3))}-20{digits(6)}.{rng.choice(['csv', 'log', 'json', 'png'])}"
    return "_".join(w.upper() for w in some(3, 5))


def made_findings(size: int = MADE, without: Sequence[str] = (), seed: int = 17) -> list[tuple[str, bool, str]]:
    """(window, label, kind): ``size`` labelled findings of every kind but those left out, the same on every call.

    All stand in the same surroundings, so that these tell nothing.
    """
    out = []
    for place, kind in enumerate((*SECRET_KINDS, *LOOKALIKES)):
        if kind in without:
            continue
        rng = np.random.default_rng([seed, place])
        for _ in range(size):
            if kind in SECRET_KINDS:
                front, of, low, high = SECRET_KINDS[kind]
                token = front + "".join(of[k] for k in rng.integers(len(of), size=rng.integers(low, high + 1)))
            else:
                token = _lookalike(kind, rng)
            left, right = SURROUNDINGS[rng.integers(len(SURROUNDINGS))]
            parts = list(windows(left, token, right))
            out.append((parts[rng.integers(len(parts))], kind in SECRET_KINDS, kind))
    return out


def encoded(windows: Sequence[str]) -> np.ndarray:
    rows = [[PAD if c == "\0" else CODE.get(c, OTHER) for c in w] for w in windows]
    return np.array(rows, np.int64).reshape(len(windows), LEFT + INSIDE + RIGHT)


def alone(x: np.ndarray) -> np.ndarray:
    """The windows without what surrounds the candidate."""
    out = x.copy()
    out[:, :LEFT] = out[:, LEFT + INSIDE :] = PAD
    return out


@dataclass
class Network:
    """Convolution over characters, the largest response left of the token, inside and right of it, a logistic output.

    ``scale`` and ``shift`` calibrate the output; ``threshold`` is a calibrated probability.
    """

    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    @classmethod
    def new(cls, seed: int = 11, width: int = 5, filters: int = 16) -> Network:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.2, (width, PAD + 1, filters)), np.zeros(filters), rng.normal(0, 0.2, 4 * filters))

    def features(self, x: np.ndarray):
        """Pooled responses; where the largest ones are; the token's responses and which of them are its own."""
        width = len(self.kernel)
        length = x.shape[1] - width + 1
        z = self.bias + sum(self.kernel[j][x[:, j : j + length]] for j in range(width))
        begins = (0, LEFT - width + 1, LEFT + INSIDE - width + 1)
        parts = np.split(z, begins[1:], axis=1)
        at = [p.argmax(axis=1) + o for p, o in zip(parts, begins, strict=True)]
        pooled = [np.maximum(p.max(axis=1), 0) for p in parts]
        # How often a pattern occurs in the token tells more than that it does.
        own = np.zeros((len(x), length), bool)
        own[:, LEFT : LEFT + INSIDE - width + 1] = x[:, LEFT + width - 1 : LEFT + INSIDE] != PAD
        weight = own / np.maximum(own.sum(axis=1, keepdims=True), 1)
        pooled.append((np.maximum(z, 0) * weight[:, :, None]).sum(axis=1))
        return np.concatenate(pooled, axis=1), at, z, weight

    def logits(self, x: np.ndarray) -> np.ndarray:
        """The larger of the token with its surroundings and the token by itself."""
        return np.maximum(*(self.features(v)[0] @ self.out + self.out_bias for v in (x, alone(x))))

    def probabilities(self, windows: Sequence[str], step: int = STEP) -> np.ndarray:
        parts = [self.logits(encoded(windows[i : i + step])) for i in range(0, len(windows), step)]
        logits = np.concatenate(parts) if parts else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -50, 50)))

    def weights(self) -> list:
        return [self.kernel, self.bias, self.out, self.out_bias]

    def squares(self) -> list:
        """What Adagrad's sums of squares begin with."""
        return [np.full(np.shape(p), 1e-8) for p in self.weights()]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> None:
        sums = self.squares()
        for number in range(epochs):
            self.epoch(x, y, sums, number)

    def epoch(self, x: np.ndarray, y: np.ndarray, sums: list, number: int, rate: float = 0.05, seed: int = 5) -> None:
        """Adagrad on the log loss, once over the rows; ``sums`` goes from epoch to epoch.

        In half of the rows the surroundings are blanked, so that the token itself must tell.
        """
        rng = np.random.default_rng(seed)
        for _ in range(number + 1):
            order, blank = rng.permutation(len(y)), rng.random(len(y)) < 0.5
        weights = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        filters = len(self.bias)
        for i in range(0, len(order), 128):
            rows = order[i : i + 128]
            batch = np.where(blank[i : i + 128, None], alone(x[rows]), x[rows])
            pooled, at, z, weight = self.features(batch)
            error = (1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -50, 50))) - y[rows]) * weights[rows] / len(rows)
            back = error[:, None] * self.out * (pooled > 0)
            kernel = np.zeros_like(self.kernel)
            for part, places in enumerate(at):
                some = back[:, part * filters : (part + 1) * filters]
                for j in range(len(kernel)):
                    seen = batch[np.arange(len(rows))[:, None], places + j]
                    np.add.at(kernel[j], (seen, np.arange(filters)[None, :]), some)
            # The mean spreads its share over all of the token's places.
            spread = (error[:, None] * self.out[3 * filters :])[:, None, :] * weight[:, :, None] * (z > 0)
            place, where = np.nonzero(weight)
            shares = spread[place, where]
            for j in range(len(kernel)):
                symbol = batch[place, where + j]
                for f in range(filters):
                    kernel[j][:, f] += np.bincount(symbol, shares[:, f], PAD + 1)
            bias = back[:, : 3 * filters].reshape(len(rows), -1, filters).sum((0, 1)) + shares.sum(axis=0)
            grads = [kernel, bias, pooled.T @ error, error.sum()]
            for k, g in enumerate(grads):
                sums[k] = sums[k] + g * g
                grads[k] = rate * g / np.sqrt(sums[k])
            self.kernel -= grads[0]
            self.bias -= grads[1]
            self.out -= grads[2]
            self.out_bias -= float(grads[3])

    def calibrate(self, logits: np.ndarray, y: np.ndarray, recall: float, weight: np.ndarray | None = None) -> None:
        """Fit scale and shift of the logits (Platt), then set the threshold.

        The highest one that reaches ``recall`` is lowered half way to the candidates that are no
        secrets, which leaves room for secrets of another shape.
        """
        weight = np.ones(len(y)) if weight is None else weight
        secrets, others = weight[y > 0].sum(), weight[y <= 0].sum()
        target = np.where(y > 0, (secrets + 1) / (secrets + 2), 1 / (others + 2))
        mean = lambda v: float(np.average(v, weights=weight))
        a, b = 1.0, 0.0
        for _ in range(300):
            p = 1 / (1 + np.exp(-np.clip(a * logits + b, -50, 50)))
            g = p - target
            a -= 0.5 * mean(g * logits) / max(1.0, mean(logits**2))
            b -= 0.5 * mean(g)
        self.scale, self.shift = max(a, 1e-3), b
        scores = np.clip(self.scale * logits + self.shift, -50, 50)
        order = np.argsort(scores[y > 0])
        below = np.cumsum(weight[y > 0][order]) - weight[y > 0][order]
        highest = scores[y > 0][order][below <= (1 - recall) * secrets].max()
        middle = (highest + min(highest, scores[y <= 0].max(initial=-50.0))) / 2
        self.threshold = float(1 / (1 + np.exp(-middle)))


def shaped(vector: np.ndarray, like: Sequence) -> list[np.ndarray]:
    """The vector cut into arrays of the shapes of ``like``."""
    parts = np.split(vector, np.cumsum([np.size(v) for v in like])[:-1])
    return [p.reshape(np.shape(v)) for p, v in zip(parts, like, strict=True)]


def made_rows(without: Sequence[str] = ()) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Three of four made findings, to train on, and the fourth, which is held out."""
    made = made_findings(without=without)
    x, y = encoded([w for w, *_ in made]), np.array([label for _, label, _ in made], np.float64)
    held = np.arange(len(y)) % 4 == 3
    return (x[~held], y[~held]), (x[held], y[held])


def train(found: Sequence[str], labels: Sequence[bool], recall: float = RECALL, without: Sequence[str] = ()) -> Network:
    """Train on three of four rows of the made findings and of labelled windows in memory, calibrate on the fourth.

    A first network, of the made ones only, points out which of the other candidates look like secrets;
    they may be secrets that the patterns miss, so the second network does without them.
    ``without`` leaves kinds of made findings out.
    """
    (x, y), (held_x, held_y) = made_rows(without)
    tried = Network.new()
    tried.fit(x, y)
    tried.calibrate(tried.logits(held_x), held_y, recall)
    if not len(found):
        return tried
    own, own_y = encoded(found), np.array(labels, np.float64)
    clear = (own_y > 0) | (tried.probabilities(found) < tried.threshold)
    own, own_y = own[clear], own_y[clear]
    held = np.arange(len(own_y)) % 4 == 3
    network = Network.new()
    network.fit(np.concatenate([x, own[~held]]), np.concatenate([y, own_y[~held]]))
    held_x, held_y = np.concatenate([held_x, own[held]]), np.concatenate([held_y, own_y[held]])
    network.calibrate(network.logits(held_x), held_y, recall)
    return network


FOUND = "array<struct<start:int,end:int,left:string,token:string,right:string,label:boolean>>"
FIELDS = ("start", "end", "left", "token", "right", "label")


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_())
    for batch in batches:
        spans, rest = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            spans.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in base])
            rest.append([dict(zip(FIELDS, c, strict=True)) for c in candidates(text, base)])
        found = pa.array(rest, pa.list_(pa.struct(list(zip(FIELDS, kinds)))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span)), found], names=["doc", "base", "found"])


def passed(model: Network, tokens: Sequence[tuple[str, str, str]]) -> list[bool]:
    """Whether the best window of each (left, token, right) reaches the threshold; STEP windows are held at a time."""
    out, waiting, owners = [False] * len(tokens), [], []

    def judge() -> None:
        for place, p in zip(owners, model.probabilities(waiting)):
            out[place] |= bool(p >= model.threshold)
        waiting.clear()
        owners.clear()

    for place, token in enumerate(tokens):
        for part in windows(*token):
            waiting.append(part)
            owners.append(place)
            if len(waiting) >= STEP:
                judge()
    judge()
    return out


def labelled_windows(collected: DataFrame, tried: Network) -> DataFrame:
    """(window, label, hash) of all windows of all candidates, each once.

    A candidate without a label that ``tried`` takes for a secret may be one that the patterns miss, and is left out.
    """
    shared = collected.sparkSession.sparkContext.broadcast(tried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [c for row in batch.column(0).to_pylist() for c in row]
            doubtful = iter(passed(shared.value, [(c["left"], c["token"], c["right"]) for c in found if not c["label"]]))
            clear = [c for c in found if c["label"] or not next(doubtful)]
            seen = ((w, c["label"]) for c in clear for w in windows(c["left"], c["token"], c["right"]))
            while some := list(islice(seen, STEP)):
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some]), pa.array([v for _, v in some])], names=["window", "label"])

    each = collected.select("found").mapInArrow(run, "window string, label boolean").distinct()
    pieces = ((1, LEFT), (1 + LEFT, INSIDE), (1 + LEFT + INSIDE, RIGHT))
    texts = [F.replace(F.substring("window", at, n), F.lit("\0"), F.lit("")) for at, n in pieces]
    return stage(each.withColumn("hash", F.xxhash64(*texts)), "secret-windows")


def held_out(windows: DataFrame, n: int) -> DataFrame:
    """Add ``held``: every fourth of the ``n`` windows in the order of their hash.

    They are numbered in even ranges of the hash of at most some PART_ROWS rows.
    """
    bits = max(0, math.ceil(math.log2(n / PART_ROWS)))
    ranges = windows.withColumn("range", F.shiftright("hash", 63 - bits))
    earlier = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("range").count().select("range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("range").orderBy("hash", "window", "label")) - 1
    numbered = ranges.withColumn("local", local).join(offsets, "range")
    held = (F.col("local") + F.col("before")) % 4 == 3
    return stage(numbered.select("window", "label", "hash", held.alias("held")), "secret-held")


def dealt_parts(windows: DataFrame, counts: dict[bool, int], size: int = PART) -> DataFrame:
    """(place, rows): the windows that are not held out, in parts of some ``size`` of the more frequent label.

    Those of the other label are repeated over the parts, so that each has as many of them if there are so many.
    A part without rows is there too.
    """
    parts = math.ceil(max(counts.values()) / size)
    repeats = {label: min(parts, max(1, parts * size // n)) for label, n in counts.items()}
    of_label = F.when(F.col("label"), F.lit(repeats.get(True, 1))).otherwise(F.lit(repeats.get(False, 1)))
    copies = windows.filter(~F.col("held")).withColumn("copy", F.explode(F.sequence(F.lit(0), of_label - 1)))
    place = F.pmod(F.pmod("hash", F.lit(parts)) + F.col("copy"), F.lit(parts)).cast("long")
    rows = copies.select(place.alias("place"), F.struct("hash", "window", "label").alias("row"))
    empty = windows.sparkSession.range(parts).select(F.col("id").alias("place"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    # By number, since Spark would put small parts into one task, and an epoch takes long for its bytes.
    spread = rows.union(empty).repartition(min(parts, TASKS), "place")
    return stage(spread.groupBy("place").agg(F.sort_array(F.collect_list("row")).alias("rows")), "secret-parts")


def _epoch_of(shared: Broadcast, number: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One epoch over the rows of each part and the made ones: a row of all weights and sums of squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                rows = rows.as_py()
                network, sums, (x, y) = copy.deepcopy(shared.value)
                x = np.concatenate([x, encoded([r["window"] for r in rows])])
                y = np.concatenate([y, [float(r["label"]) for r in rows]])
                network.epoch(x, y, sums, number)
                vector = np.concatenate([np.ravel(v) for v in (*network.weights(), *sums)])
                yield pa.RecordBatch.from_arrays([pa.array([vector], pa.list_(pa.float64()))], names=["vector"])

    return run


def learned(collected: DataFrame, size: int = PART, recall: float = RECALL) -> Network:
    """The network that all labelled windows of the texts and the made findings teach.

    Each epoch is a job: every part goes on from the same network, with its own rows and the made ones, and
    the mean of what they come to, sums of squares included, is the next network. A single part's training is
    that of ``train``. Means are taken in decimals, so that their order does not matter.
    """
    context = collected.sparkSession.sparkContext
    made, (held_x, held_y) = made_rows()
    tried = train([], [], recall)
    own = labelled_windows(collected, tried)
    counts = {r.label: r["count"] for r in own.groupBy("label").count().collect()}
    if not counts:
        return tried
    own = held_out(own, sum(counts.values()))
    parts = dealt_parts(own, counts, size)
    network = Network.new()
    sums = network.squares()
    for number in range(EPOCHS):
        shared = context.broadcast((network, sums, made))
        values = parts.select("rows").mapInArrow(_epoch_of(shared, number), "vector array<double>").select(F.posexplode("vector").alias("at", "value"))
        means = values.groupBy("at").agg(F.avg(F.col("value").cast("decimal(30,18)")).cast("double").alias("mean")).collect()
        shared.unpersist()
        state = shaped(np.array([r.mean for r in sorted(means)]), [*network.weights(), *sums])
        network, sums = Network(*state[:3], float(state[3])), state[4:]
    shared = context.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = shared.value.logits(encoded(batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(logits, pa.float64())], names=["label", "logit"])

    # A cell of secrets counts as its least logit and one of others as its largest, so that the recall is kept.
    scores = own.filter("held").select("window", "label").mapInArrow(score, "label boolean, logit double")
    cell = F.floor(F.greatest(F.least("logit", F.lit(50.0)), F.lit(-50.0)) * CELLS).alias("cell")
    end = F.when(F.col("label"), F.min("logit")).otherwise(F.max("logit")).alias("end")
    cells = sorted(scores.groupBy("label", cell).agg(end, F.count(F.lit(1)).alias("n")).collect())
    weight = [r.n * min(1.0, size / counts[r.label]) for r in cells]
    network.calibrate(
        np.concatenate([network.logits(held_x), [r.end for r in cells]]), np.concatenate([held_y, [float(r.label) for r in cells]]),
        recall, np.concatenate([np.ones(len(held_y)), weight]),
    )
    shared.unpersist()
    return network


def joined(spans: Sequence[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, doc: str = "doc_id", text: str = "text", part: int = PART, recall: float = RECALL) -> DataFrame:
    """For each row its id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and ``n_learned``.

    Spans are kind:start:end in code points, sorted by start, then kind. NULL and
    empty texts have none; repeated rows each give a row; other columns are not read. The
    network judges at every size: what the texts do not teach, the made findings do. It learns from
    all candidates, ``part`` windows of the more frequent label at a time. An empty table gives no row.
    """
    kind = docs.schema[doc].dataType.simpleString()
    base = "array<struct<start:int,kind:int,end:int>>"
    collected = stage(
        docs.select(F.col(doc).alias("doc"), F.col(text)).mapInArrow(_collect, f"doc {kind}, base {base}, found {FOUND}"), "secrets"
    )
    network = docs.sparkSession.sparkContext.broadcast(learned(collected, part, recall))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Network = network.value
        for batch in batches:
            bases = [[(s["start"], s["kind"], s["end"]) for s in row] for row in batch.column("base").to_pylist()]
            found = batch.column("found").to_pylist()
            open_ones = [(c["left"], c["token"], c["right"]) for row in found for c in row if not c["label"]]
            verdict = iter(passed(model, open_ones))
            spans = [sorted([*b, *{(c["start"], 3, c["end"]) for c in row if not c["label"] and next(verdict)}])
                     for b, row in zip(bases, found, strict=True)]
            count = lambda k, of: pa.array([sum(s[1] == k for s in row) for row in of], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(count(k, spans) for k in range(4)),
                 pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases]), pa.array([joined(s) for s in spans], pa.string())],
                names=["doc", "n_assign", "n_access", "n_hex", "n_learned", "base_sha256", "spans"],
            )

    return collected.mapInArrow(
        judge, f"doc {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_learned bigint, base_sha256 string, spans string"
    ).withColumnRenamed("doc", doc)
