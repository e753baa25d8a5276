"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history). The most frequent words are modelled:
they are cut into classes by frequency, and both factors are softmaxes over weights of hashed features:
the word before, the two words before, and the word before the last (a skip). All other words fall
into classes by their last two bytes; inside such a class a word has its smoothed share of the class's
counts. Weights start at the shares of classes and words in the corpus, so training only learns what
the history adds.

Training runs in rounds. In each, every task takes gradient steps over its part of the round's
documents, from the same weights; the changes are summed over the tasks in two exchanges and their mean,
weighted by tokens, moves the weights. Each training document is used once. A task takes some million
tokens, so that its changes (the size of the weights) are small beside what it reads; the sums of a round
are of the size of the weights, whatever the input. Scoring takes batches of tokens through numpy.

Counts cover all training documents. Workers know the counts of a bounded number of frequent words;
those of other words are joined.

Defined results: null and empty texts are a single end token. A null id is in training and stays null.
With no training documents every word is unknown and the counts are zero. Repeated rows are scored
alike, and each counts in training. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import frequent, lower_ascii, stored, text_of, words_of
from roomledger.session import ship_package

END = ""
_CHUNK = 16384  # tokens of a step
_DOCS = 256  # texts that are handled at a time


@dataclass(frozen=True)
class Shape:
    """Sizes of the model; all are bounds that the input does not change."""

    known: int = 100_000  # words whose counts the workers know
    classes: int = 16  # of modelled words
    words: int = 32  # of a class
    others: int = 16  # classes of all other words
    one: int = 4096  # rows of weights for the word before
    two: int = 8192  # for the two words before
    skip: int = 4096  # for the word before the last
    inner: int = 8192  # for words inside a class
    rounds: int = 2
    tokens: int = 4_000_000  # least number of tokens of a training task, where there are so many
    rate: float = 0.3

    @property
    def modelled(self) -> int:
        return self.classes * self.words


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _other_class(word: bytes, shape: Shape) -> int:
    return zlib.crc32(word[-2:]) % shape.others


def counts(train: DataFrame) -> DataFrame:
    """(word, c) over all training texts, an end after each; stored."""
    words = F.concat(words_of(lower_ascii(text_of(train))), F.array(F.lit(END)))
    return stored(
        train.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("c")), "lm-counts"
    )


@dataclass
class Lexicon:
    """What every worker knows of the corpus: bounded by the shape."""

    words: list[bytes]
    c: np.ndarray
    n: int
    v: int
    other_n: np.ndarray
    other_v: np.ndarray
    shape: Shape

    def prepare(self) -> None:
        """Tables by word number; done on each worker once."""
        s = self.shape
        self.number = {w: i for i, w in enumerate(self.words)}
        m = min(s.modelled, len(self.words))
        self.cls = np.array([i // s.words if i < m else s.classes + _other_class(w, s) for i, w in enumerate(self.words)], np.int64)
        self.place = np.arange(len(self.words)) % s.words
        self.log_c = np.log10(self.c + 0.1)
        shares = np.zeros(s.classes + s.others)
        np.add.at(shares, self.cls[:m], self.c[:m])
        shares[s.classes :] = self.other_n
        self.class_prior = np.log((shares + 0.1) / (shares.sum() + 0.1 * len(shares))).astype(np.float32)
        inner = np.full((s.classes, s.words), -30.0)
        for i in range(m):
            inner[self.cls[i], self.place[i]] = np.log(self.c[i] + 0.1)
        self.word_prior = (inner - np.log(np.exp(inner).sum(1, keepdims=True))).astype(np.float32)
        self.other_log = np.log10(self.other_n + 0.1 * (self.other_v + 1))


def lexicon(vocabulary: DataFrame, shape: Shape) -> Lexicon:
    n, v = vocabulary.select(F.sum("c"), F.count("*")).first()
    # The end is always modelled.
    ends = [(END, r["c"]) for r in vocabulary.where(F.col("word") == END).collect()]
    top = ends + [x for x in frequent(vocabulary, shape.known) if x[0] != END]
    words = [word.encode() for word, _ in top]
    tail = F.substring(F.col("word").cast("binary"), -2, 2)
    per_class = vocabulary.groupBy((F.crc32(tail) % shape.others).alias("g")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    other_n, other_v = np.zeros(shape.others), np.zeros(shape.others)
    for r in per_class:
        other_n[r["g"]], other_v[r["g"]] = r["n"], r["v"]
    for (_, c), w in zip(top[: shape.modelled], words):
        g = _other_class(w, shape)
        other_n[g] -= c
        other_v[g] -= 1
    return Lexicon(words, np.array([c for _, c in top], np.float64), n or 0, v, other_n, other_v, shape)


def start(shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    rows = shape.one + shape.two + shape.skip
    return (
        np.zeros((rows, shape.classes + shape.others), np.float32),
        np.zeros((shape.inner, shape.words), np.float32),
    )


class Tokens:
    """Numbers and features of the tokens of some texts."""

    def __init__(self, texts: list[str | None], lex: Lexicon):
        s, number, size = lex.shape, lex.number, len(lex.words)
        ids, rare, lengths, self.rare = [], [], [], []
        for text in texts:
            words = (text or "").encode().lower().split()
            words.append(b"")
            own = list(map(number.get, words))
            if None in own:
                unknown: dict[bytes, int] = {}
                for i, x in enumerate(own):
                    if x is None:
                        w = words[i]
                        own[i] = size + zlib.crc32(w) % 65536
                        rare.append((len(ids) + i, s.classes + _other_class(w, s)))
                        unknown[w] = unknown.get(w, 0) + 1
                self.rare.append(unknown)
            else:
                self.rare.append({})
            lengths.append(len(own))
            ids.extend(own)
        self.lengths = np.array(lengths)
        self.ids = np.array(ids, np.int64)
        self.is_known = self.ids < size
        safe = np.where(self.is_known, self.ids, 0)
        self.cls = lex.cls[safe] if size else np.zeros(len(ids), np.int64)
        for i, g in rare:
            self.cls[i] = g
        self.place = safe % s.words
        self.inner = self.cls < s.classes
        first = np.cumsum(self.lengths) - self.lengths
        one = np.r_[-1, self.ids[:-1]]
        one[first] = -1
        two = np.r_[-1, one[:-1]]
        two[first] = -2
        mix = lambda x, k: ((x.astype(np.uint64) * np.uint64(k)) ^ np.uint64(k >> 7)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
        with np.errstate(over="ignore"):
            a, b = mix(one, 0xC2B2AE3D27D4EB4F), mix(two, 0x165667B19E3779F9)
            both = mix(a * np.uint64(31) + b, 0xD6E8FEB86659FD93)
            self.features = np.stack([
                a % np.uint64(s.one),
                np.uint64(s.one) + both % np.uint64(s.two),
                np.uint64(s.one + s.two) + b % np.uint64(s.skip),
            ]).astype(np.int64)
            c = self.cls.astype(np.uint64)
            self.inner_features = np.stack([
                mix(x * np.uint64(64) + c, 0xA0761D6478BD642F) % np.uint64(s.inner) for x in (a, both, b)
            ]).astype(np.int64)


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Log probabilities by row."""
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def _forward(w: np.ndarray, prior: np.ndarray, features: np.ndarray) -> np.ndarray:
    return _softmax(w[features[0]] + w[features[1]] + w[features[2]] + prior)


class Step:
    """Gradient steps on one table of weights; rows that were moved often move less."""

    def __init__(self, w: np.ndarray, rate: float):
        self.w, self.rate, self.seen = w, rate, np.full(w.shape, 1e-2, np.float32)

    def take(self, logp: np.ndarray, features: np.ndarray, target: np.ndarray) -> None:
        error = -np.exp(logp)
        error[np.arange(len(target)), target] += 1
        gradient = np.empty_like(self.w)
        where = features.ravel()
        for k in range(self.w.shape[1]):
            column = np.ascontiguousarray(error[:, k])
            gradient[:, k] = np.bincount(where, np.concatenate([column, column, column]), len(self.w))
        gradient /= np.sqrt(len(target))
        self.seen += gradient * gradient
        self.w += self.rate * gradient / np.sqrt(self.seen)


_UPDATE = "chunk int, task bigint, tokens double, delta binary"
_CHUNKS = 32


def _updates(lex, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lexicon_ = _prepared(lex)
        before = weights.value
        w, u = before[0].copy(), before[1].copy()
        outer, inner, tokens = Step(w, lexicon_.shape.rate), Step(u, lexicon_.shape.rate), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS):
                t = Tokens(batch.column(0).slice(at, _DOCS).to_pylist(), lexicon_)
                for i in range(0, len(t.ids), _CHUNK):
                    x = slice(i, i + _CHUNK)
                    f, c = t.features[:, x], t.cls[x]
                    outer.take(_forward(w, lexicon_.class_prior, f), f, c)
                    use = np.flatnonzero(t.inner[x]) + i
                    if len(use):
                        f = t.inner_features[:, use]
                        inner.take(_forward(u, lexicon_.word_prior[t.cls[use]], f), f, t.place[use])
                tokens += len(t.ids)
        if tokens:
            delta = np.concatenate([(w - before[0]).ravel(), (u - before[1]).ravel()]) * tokens
            parts = np.array_split(delta.astype(np.float32), _CHUNKS)
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([TaskContext.get().partitionId()] * n, pa.int64()),
                 pa.array([float(tokens)] * n), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["chunk", "task", "tokens", "delta"],
            )

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the updates of each chunk that a partition holds; only the sums are kept."""
    kept: dict[tuple, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            delta = np.frombuffer(r["delta"], np.float32)
            if (r["chunk"], r["task"] % 32) in kept:
                own = kept[r["chunk"], r["task"] % 32]
                own[0] += r["tokens"]
                own[1] += delta
            else:
                kept[r["chunk"], r["task"] % 32] = [r["tokens"], delta.copy()]
    rows = sorted(kept.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in rows], pa.int32()), pa.array([k[1] for k, _ in rows], pa.int64()),
         pa.array([v[0] for _, v in rows], pa.float64()), pa.array([v[1].tobytes() for _, v in rows], pa.binary())],
        ["chunk", "task", "tokens", "delta"],
    )


def _prepared(broadcast) -> Lexicon:
    lex = broadcast.value
    if not hasattr(lex, "number"):
        lex.prepare()
    return lex


def trained(train: DataFrame, lex, tokens: int, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Weights after all rounds; `lex` is a broadcast lexicon of so many training tokens."""
    spark = train.sparkSession
    tasks = max(1, tokens // (shape.rounds * shape.tokens))
    w, u = start(shape)
    for round_ in range(shape.rounds):
        weights = spark.sparkContext.broadcast((w, u))
        part = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(shape.rounds)) == round_).select("text").coalesce(tasks)
        each = part.mapInArrow(_updates(lex, weights), _UPDATE)
        # First within 32 groups of tasks, then over the groups.
        summed = each.repartition("chunk", F.col("task") % 32).mapInArrow(_sums, _UPDATE)
        total = summed.withColumn("task", F.lit(0).cast("long")).repartition("chunk").mapInArrow(_sums, _UPDATE)
        rows = {r["chunk"]: r for r in total.collect()}  # the size of the weights
        weights.unpersist()
        if not rows:
            continue
        mean = np.concatenate([np.frombuffer(rows[k]["delta"], np.float32) / rows[k]["tokens"] for k in range(_CHUNKS)])
        w = w + mean[: w.size].reshape(w.shape)
        u = u + mean[w.size :].reshape(u.shape)
    return w, u


_SCORED = "n_tokens bigint, known bigint, base double, score double, rare array<struct<word:string,n:int>>"


def _scorer(lex, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon_, (w, u) = _prepared(lex), weights.value
        ln10 = np.log(10.0)
        kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS):
                part = batch.slice(at, _DOCS)
                t = Tokens(part.column(2).to_pylist(), lexicon_)
                score, base = np.zeros(len(t.ids)), np.zeros(len(t.ids))
                for i in range(0, len(t.ids), _CHUNK):
                    x = slice(i, i + _CHUNK)
                    logp = _forward(w, lexicon_.class_prior, t.features[:, x])
                    score[x] = logp[np.arange(len(logp)), t.cls[x]] / ln10
                    use = np.flatnonzero(t.inner[x]) + i
                    if len(use):
                        logp = _forward(u, lexicon_.word_prior[t.cls[use]], t.inner_features[:, use])
                        score[use] += logp[np.arange(len(use)), t.place[use]] / ln10
                if len(lexicon_.words):
                    base[t.is_known] = lexicon_.log_c[t.ids[t.is_known]]
                other = ~t.inner
                # Inside a class of other words: the share of its counts; what is not known follows by join.
                score[other] += base[other] - lexicon_.other_log[t.cls[other] - lexicon_.shape.classes]
                first = np.cumsum(t.lengths) - t.lengths
                add = lambda a: np.add.reduceat(a, first)
                rare = [[{"word": k.decode(), "n": n} for k, n in r.items()] for r in t.rare]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(t.lengths), pa.array(add(t.is_known.astype(np.int64))),
                     pa.array(add(base)), pa.array(add(score)), pa.array(rare, kind)],
                    ["doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"],
                )

    return run


def scored(docs: DataFrame, held: Column | None = None, shape: Shape = Shape()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Rows where `held` is true are kept out of training; base_score is the smoothed unigram.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        "doc_id", (held_out(F.col("doc_id")) if held is None else held).alias("held_out"), F.col("text")
    )
    train = rows.where("not held_out")
    vocabulary = counts(train)
    lex_ = lexicon(vocabulary, shape)
    lex = spark.sparkContext.broadcast(lex_)
    weights = spark.sparkContext.broadcast(trained(train, lex, lex_.n, shape))
    kind = docs.schema["doc_id"].dataType.simpleString()
    passed = stored(
        rows.mapInArrow(_scorer(lex, weights), f"doc_id {kind}, held_out boolean, {_SCORED}")
        .withColumn("_row", F.monotonically_increasing_id()),
        "lm-scores",
    )
    each = passed.select("_row", F.explode("rare").alias("r")).select("_row", "r.word", "r.n")
    log_c = F.log10(F.coalesce("c", F.lit(0)) + 0.1)
    rare = each.join(vocabulary, "word", "left").groupBy("_row").agg(
        F.sum(F.col("n") * log_c).alias("rare_log"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
    )
    unit = float(np.log10(lex_.n + 0.1 * (lex_.v + 1)))
    add = F.coalesce("rare_log", F.lit(0.0))
    return passed.join(rare, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(lex_.n).cast("long").alias("train_tokens"),
        (F.col("base") + add - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("score") + add).alias("score"),
    )
