"""Toxicity of texts: a support vector machine on sentences with a subsequence string kernel.

Two words are alike by the subsequences of three letters they share. A subsequence counts less the longer
the stretch is that it spans, so that a letter put in, a dot between letters or a changed ending costs
some likeness and not all of it. Letters spelled out one by one ("i d i o t") are one word. The kernel
of two words is that likeness, normalised, to a power; the kernel of two sentences is its sum over all
pairs of their different words. Both are proper kernels.

Nyström: a few hundred words of the labelled sentences are landmarks, and a word is the vector of its
kernel values against them, times the inverse root of the landmarks' own kernel. A sentence is the sum of
its words' vectors, and a linear machine (squared hinge, Newton steps) is fitted on the sentences of a
bounded number of labelled documents. A label says that some sentence of a document is toxic, not which:
the first fit takes the sentences with words that tell toxic documents from clean ones by a likelihood
ratio, later ones those that the machine has on the toxic side. All sentences of clean documents are clean.
A document's margin is that of its most toxic sentence;
a logistic curve, fitted on labelled documents that the machine has not seen, turns it into a score.

As the machine is linear, every word has one value, and a task computes it once for the words it remembers.
Scoring is one scan: no shuffle, no join.

Defined results: null and empty texts have the margin of a sentence without words. Rows without id are
scored and not learnt from. An id that is labelled both ways counts as toxic; null labels do not count.
Without labels of both kinds every document gets the (smoothed) share of toxic labels as its score. Very
long words are cut into overlapping pieces, very long sentences into runs of words, and all of a text is
read. Repeated rows are scored alike; an empty table gives no rows. Other columns, whatever their names,
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import text_of, words_of
from roomledger.session import ship_package


@dataclass(frozen=True)
class Settings:
    """The kernel, and the bounds of what the machine is fitted on."""

    #: Letters a subsequence may span, and what each of them costs.
    span: int = 7
    decay: float = 0.75
    power: int = 2
    landmarks: int = 128
    #: The sample of labelled documents: so many of either label, by hash, of at most so many words.
    documents: int = 1500
    longest: int = 600
    #: Words of a sentence at most, letters of a piece of a word at most.
    sentence: int = 16
    piece: int = 24
    cost: float = 1.0
    rounds: int = 4
    #: One of so many sampled documents is kept for the logistic curve.
    calibration: int = 4
    threshold: float = 0.7
    #: Words a task remembers.
    memory: int = 1_000_000


# --- words and their subsequences ----------------------------------------------------------

_END = re.compile(r"(?<=[.!?…])\s+|\n+")
_SPELLED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~…·"
_BITS = 6
_CODES = 1 << (3 * _BITS)


def _classes() -> np.ndarray:
    """The class of every character: letters and digits of their own, other letters in 27 classes, 0 between."""
    found = np.zeros(1 << 16, np.int64)
    for i in range(1 << 16):
        c = chr(i)
        if "a" <= c <= "z":
            found[i] = i - 96
        elif "0" <= c <= "9":
            found[i] = i - 48 + 27
        elif c.isalnum():
            found[i] = 37 + i % 27
    return found


_CLASS: list[np.ndarray] = []


def _class_of(points: np.ndarray) -> np.ndarray:
    if not _CLASS:
        _CLASS.append(_classes())
    return _CLASS[0][np.where(points < 1 << 16, points, 0)]


def sentences(text: str, settings: Settings) -> list[dict[str, None]]:
    """The different words of all sentences, in lower case and in order."""
    text = _SPELLED.sub(lambda m: m[0].replace(" ", "·"), text.lower())
    found, size, different = [], settings.sentence, dict.fromkeys
    for part in _END.split(text):
        words = part.split()
        if len(words) <= size:
            if words:
                found.append(different(words))
        else:
            found += [different(words[i : i + size]) for i in range(0, len(words), size)]
    return found


def pieces(word: str, size: int) -> list[str]:
    """The word, or the pieces of a long one, each half over the one before."""
    if len(word) <= size:
        return [word]
    return [word[i : i + size] for i in range(0, len(word) - size // 2, size // 2)]


def subsequences(words: Sequence[str], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) sorted by both, and the norm of every word."""
    gap = "\0" * (settings.span - 1)
    points = np.frombuffer((gap.join(words) + gap).encode("utf-32-le"), np.uint32)
    kinds = _class_of(points)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + len(gap))
    keys, weights, n = [], [], len(kinds)
    for last in range(2, settings.span):
        first, end = kinds[: n - last], kinds[last:]
        for middle in range(1, last):
            mid = kinds[middle : n - last + middle]
            at = np.flatnonzero((first > 0) & (mid > 0) & (end > 0))
            code = (first[at] << 2 * _BITS) | (mid[at] << _BITS) | end[at]
            keys.append(owner[at] * _CODES + code)
            weights.append(np.full(len(at), settings.decay ** (last + 1)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    key = key[starts]
    weight = np.add.reduceat(weight, starts) if len(starts) else weight
    norm = np.sqrt(np.bincount(key // _CODES, weight * weight, len(words)))
    return key // _CODES, key % _CODES, weight, norm


class Landmarks:
    """Kernel values of words against the landmarks; of each subsequence, the landmarks that have it."""

    def __init__(self, words: Sequence[str], settings: Settings):
        owner, code, weight, norm = subsequences(words, settings)
        order = np.argsort(code, kind="stable")
        self.words, self.settings = list(words), settings
        self.owner, self.weight = owner[order], (weight / norm[owner])[order]
        self.first = np.searchsorted(code[order], np.arange(_CODES + 1))

    def kernel(self, words: Sequence[str]) -> np.ndarray:
        """A row for every word, a column for every landmark."""
        owner, code, weight, norm = subsequences(words, self.settings)
        first = self.first[code]
        size = self.first[code + 1] - first
        used = np.flatnonzero(size)
        first, size, owner, weight = first[used], size[used], owner[used], weight[used] / norm[owner[used]]
        at = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
        cells = np.repeat(owner, size) * len(self.words) + self.owner[at]
        found = np.bincount(cells, np.repeat(weight, size) * self.weight[at], len(words) * len(self.words))
        return np.clip(found.reshape(len(words), -1), 0, 1) ** self.settings.power


_STEP = 4096  # words whose kernel values are computed at a time


def _rows(words: Iterable[str], size: int) -> tuple[list[str], np.ndarray]:
    """All pieces of some words, and the number of the word each is of."""
    parts, owner = [], []
    for i, word in enumerate(words):
        own = pieces(word, size)
        parts += own
        owner += [i] * len(own)
    return parts, np.array(owner, np.int64)


@dataclass
class Model:
    """What every worker needs: the landmarks, a factor for each, the bias, and the logistic curve."""

    settings: Settings
    words: list[str]
    factors: np.ndarray
    bias: float
    slope: float
    shift: float

    def prepare(self) -> None:
        self.landmarks = Landmarks(self.words, self.settings) if self.words else None
        self.known: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        """Remember the values of words; those of earlier ones are given up when there are too many."""
        if len(self.known) + len(words) > self.settings.memory:
            self.known = {}
        bare = {w: w.strip(_MARKS) for w in words.difference(self.known)}  # marks around a word weigh nothing
        new = [w for w in dict.fromkeys(bare.values()) if w not in self.known]
        for at in range(0, len(new), _STEP):
            part = new[at : at + _STEP]
            units, owner = _rows(part, self.settings.piece)
            value = np.zeros(len(units))
            for i in range(0, len(units), _STEP):
                value[i : i + _STEP] = self.landmarks.kernel(units[i : i + _STEP]) @ self.factors
            self.known.update(zip(part, np.bincount(owner, value, len(part)).tolist()))
        self.known.update((w, self.known[b]) for w, b in bare.items())

    def judged(self, texts: list[str]) -> list[tuple[float, str | None]]:
        """The margin of every text and its most toxic sentence."""
        if self.landmarks is None:
            return [(self.bias, None)] * len(texts)
        cut = [sentences(t, self.settings) for t in texts]
        words = set()
        for own in cut:
            words.update(*own)
        self.learn(words)
        value, found = self.known.__getitem__, []
        for own in cut:
            best, where = 0.0, None
            for words in own:
                margin = sum(map(value, words))
                if where is None or margin > best:
                    best, where = margin, words
            found.append((self.bias + best, " ".join(where) if where else None))
        return found

    def score(self, margin: float) -> float:
        z = self.slope * margin + self.shift
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


# --- fitting, on a bounded sample -------------------------------------------------------------

#: The likelihood ratio that one word in a thousand reaches by chance.
SURE = 10.83


def telling(documents: Sequence[set[str]], toxic: Sequence[bool]) -> dict[str, float]:
    """Words that occur in three times the share of toxic documents as of clean ones, with their likelihood ratios."""
    n = [sum(1 for t in toxic if not t), sum(1 for t in toxic if t)]
    counts = [Counter(), Counter()]
    for words, t in zip(documents, toxic):
        counts[t].update(words)

    def ratio(a: int, b: int) -> float:
        share = (a + b) / (n[0] + n[1])
        part = lambda k, expected: k * math.log(k / expected) if k else 0.0
        inside = part(a, n[1] * share) + part(b, n[0] * share)
        return 2 * (inside + part(n[1] - a, n[1] * (1 - share)) + part(n[0] - b, n[0] * (1 - share)))

    return {w: ratio(a, counts[0][w]) for w, a in counts[1].items() if a > 1 and a * n[0] > 3 * counts[0][w] * n[1]}


def chosen_landmarks(documents: Sequence[set[str]], tell: dict[str, float], settings: Settings) -> list[str]:
    """Half of them the words that tell toxic from clean documents most surely, half the most frequent words.

    A word that is nearly one of the landmarks before it is left out.
    """
    sure = [w for w in tell if tell[w] > SURE]
    tells = sorted(sure or tell, key=lambda w: (-tell[w], w))
    every = Counter()
    for words in documents:
        every.update(words)
    common = sorted(every, key=lambda w: (-every[w], w))
    found: list[str] = []
    seen = np.zeros((0, 0))
    for words, size in ((tells, settings.landmarks // 2), (common, settings.landmarks)):
        words = [w for w in words[: 8 * settings.landmarks] if len(w) <= settings.piece]
        words = [w for w, r in zip(words, subsequences(words, settings)[3]) if r > 0] if words else []
        if not words:
            continue
        all_words = found + words
        seen = Landmarks(all_words, settings).kernel(all_words)
        kept = list(range(len(found)))
        for i in range(len(found), len(all_words)):
            if len(kept) >= size:
                break
            if not kept or seen[i, kept].max() < 0.8:
                kept.append(i)
        found = [all_words[i] for i in kept]
    return found


def inverse_root(kernel: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    fine = values > 1e-6 * values.max()
    return vectors[:, fine] / np.sqrt(values[fine])


def separated(x: np.ndarray, y: np.ndarray, cost: float) -> np.ndarray:
    """The linear machine of least |w|^2 / 2 + cost * sum of squared hinges; the last column of x is the bias's."""
    rule = np.eye(x.shape[1])
    rule[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    blocks = [slice(i, i + _STEP) for i in range(0, len(x), _STEP)]

    def loss(v: np.ndarray) -> float:
        return v @ rule @ v / 2 + cost * sum(float((np.maximum(0, 1 - y[b] * (x[b] @ v)) ** 2).sum()) for b in blocks)

    now = loss(w)
    for _ in range(50):
        gradient, curvature = rule @ w, rule.copy()
        for b in blocks:
            own, side = x[b].astype(np.float64), y[b]
            active = side * (own @ w) < 1
            own = own[active]
            gradient += 2 * cost * own.T @ (own @ w - side[active])
            curvature += 2 * cost * own.T @ own
        step = np.linalg.solve(curvature, gradient)
        size = 1.0
        while loss(w - size * step) > now - 1e-4 * size * (gradient @ step) and size > 1e-6:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now <= 1e-9 * before:
            break
    return w


def logistic(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve, with smoothed targets so that they stay finite."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.c_[margin, np.ones(len(margin))]
    w = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(weight @ (np.logaddexp(0, z) - target * z)) + 1e-6 * float(v @ v)

    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (weight * (p - target)) + 2e-6 * w
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + 2e-6 * np.eye(2), gradient)
        size = 1.0
        while loss(w - size * step) > now and size > 1e-9:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now <= 1e-10 * max(before, 1e-12):
            break
    return float(w[0]), float(w[1])


def _vectors(cut: Sequence[Iterable[str]], landmarks: Landmarks, root: np.ndarray) -> np.ndarray:
    """The vector of every sentence, and a column of ones; some sentences' words are handled at a time."""
    found = np.ones((len(cut), root.shape[1] + 1), np.float32)
    for at in range(0, len(cut), _STEP // 4):
        part = cut[at : at + _STEP // 4]
        words = list(dict.fromkeys(w for ws in part for w in ws))
        units, owner = _rows(words, landmarks.settings.piece)
        values = np.zeros((len(words), len(landmarks.words)))
        for i in range(0, len(units), _STEP):
            np.add.at(values, owner[i : i + _STEP], landmarks.kernel(units[i : i + _STEP]))
        number = {w: i for i, w in enumerate(words)}
        for i, ws in enumerate(part):
            found[at + i, :-1] = values[[number[w] for w in ws]].sum(0) @ root
    return found


def fit(texts: Sequence[str], toxic: Sequence[bool], held: Sequence[bool], share: float, settings: Settings) -> Model:
    """The machine of some labelled texts; those that are held are for the curve only.

    `share` is that of toxic documents among all that are labelled.
    """
    cut = [sentences(t, settings) for t in texts]
    y, held_ = np.array(toxic, bool), np.array(held, bool)
    learn = np.flatnonzero(~held_)
    words = [{w for s in cut[i] for w in s} for i in learn]
    tell = telling(words, [bool(y[i]) for i in learn])
    names = chosen_landmarks(words, tell, settings)
    constant = Model(settings, [], np.zeros(0), 0.0, 0.0, math.log(share / (1 - share)))
    if not names or y[learn].all() or not y[learn].any():
        return constant
    landmarks = Landmarks(names, settings)
    root = inverse_root(landmarks.kernel(names).astype(np.float64))
    doc_of = np.array([i for i, s in enumerate(cut) for _ in s], np.int64)
    x = _vectors([ws for s in cut for ws in s], landmarks, root)
    label = np.where(y[doc_of], 1.0, -1.0)
    # At first by the likelihood ratio of a sentence's surest word.
    margin = np.array([max((tell.get(w, 0.0) for w in ws), default=0.0) for s in cut for ws in s]) - SURE
    for _ in range(settings.rounds):
        used = ~held_[doc_of] & (~y[doc_of] | (margin > 0))
        if not (used & y[doc_of]).any():
            used = ~held_[doc_of]
        w = separated(x[used], label[used], settings.cost)
        margin = x @ w
    best = np.full(len(cut), -np.inf)
    np.maximum.at(best, doc_of, margin)
    best[~np.isfinite(best)] = w[-1]
    curve = np.flatnonzero(held_) if len(set(y[held_].tolist())) == 2 else np.arange(len(cut))
    odds = share / (1 - share) * (~y[curve]).sum() / y[curve].sum()
    slope, shift = logistic(best[curve], y[curve], np.where(y[curve], min(1.0, odds), min(1.0, 1 / odds)))
    return Model(settings, names, root @ w[:-1], float(w[-1]), slope, shift)


# --- on Spark ----------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The machine from labels (doc_id, toxic) and the texts of a bounded sample of them.

    The driver gets at most `documents` texts of either label, of at most `longest` words each.
    """
    rows = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    rows = rows.where(~held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    share = (counts.get(True, 0) + 1) / (sum(counts.values()) + 2)
    order = F.xxhash64("doc_id")
    ids = [
        tuple(r) for side in (True, False)
        for r in rows.where(F.col("toxic") == side).orderBy(order, "doc_id").limit(settings.documents).collect()
    ]
    if len(counts) < 2:
        return fit([], [], [], share, settings)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A bounded number of ids, so it is sent to all tasks.
    sample = F.broadcast(docs.sparkSession.createDataFrame(ids, f"doc_id {kind}, toxic boolean"))
    texts = docs.select("doc_id", text_of(docs).alias("text")).join(sample, "doc_id")
    texts = texts.where(F.size(words_of(F.col("text"))) <= settings.longest).dropDuplicates(["doc_id", "text"])
    held = F.pmod(F.xxhash64("doc_id", F.lit(settings.calibration)), F.lit(settings.calibration)) == 0
    found = sorted((r["doc_id"], r["text"], r["toxic"], r["held"]) for r in texts.withColumn("held", held).collect())
    return fit([f[1] for f in found], [f[2] for f in found], [f[3] for f in found], share, settings)


_AT_ONCE = 128  # texts that are handled at a time


def _scorer(model):
    names = ["doc_id", "held_out", "score", "sentence"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        if not hasattr(own, "known"):
            own.prepare()
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                found = own.judged(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([own.score(m) for m, _ in found], pa.float64()),
                     pa.array([s for _, s in found], pa.string())],
                    names=names,
                )

    return run


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted, sentence) of every document; sentence is its most toxic one."""
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(fitted(docs, labels, settings))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of(docs).alias("text"))
    judged = rows.mapInArrow(_scorer(model), f"doc_id {kind}, held_out boolean, score double, sentence string")
    return judged.select(
        "doc_id", "held_out", "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"), "sentence"
    )
