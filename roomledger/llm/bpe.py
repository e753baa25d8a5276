"""BPE encoding and decoding over a lexicon automaton.

The lexicon is a minimal acyclic automaton over the frequent words of the corpus: equal suffixes are
one set of states. Every state knows how many words end below it, so a walk along a word gives the
word's number, and the number leads to the word's ids. States, arcs and ids are flat arrays in one file
that Spark hands to the executors, where it is memory-mapped. Words of a batch that the automaton lacks
are merged exactly by rank. The lexicon only saves time: any lexicon gives the same ids.

Encoding follows the tokenizer file: special tokens are cut out of the raw text, the rest is brought to
NFC and lower case, split by its pattern, mapped from bytes, and merged. Decoding joins the pieces of
the ids by blanks, special tokens included, as a file without a decoder asks for.

Defined results: null and empty texts have no ids and decode to an empty text. A character that has
no id after all merges is left out. Repeated rows are encoded alike. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.llm.common import frequent, stored, text_of, words_of
from roomledger.session import ship_package

#: Largest number of frequent words that the lexicon holds.
LEXICON = 100_000
#: Merged words that a worker remembers; when it is full it starts anew.
REMEMBERED = 300_000
_END = "</w>"
#: Words of more letters are merged with a heap; the result is the same.
_LONG = 64


def byte_letters() -> list[str]:
    """The letter for each byte: printable ones stand for themselves, others move up from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b if b in own else next(moved)) for b in range(256)]


class Rules:
    """What a tokenizer file says, as far as encoding needs it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.ids: dict[str, int] = data["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in data["model"]["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # \s is the Unicode property, which the regex module takes more widely.
        self.pattern = split.replace("\\s", "\\p{White_Space}")
        self.letters = byte_letters()
        by_id = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.pieces = [by_id.get(i, "") for i in range(max(by_id) + 1)]

    def merged(self, word: str) -> list[int]:
        """The ids of one word, by merging the pair of lowest rank until none is left."""
        parts = [self.letters[b] for b in word.encode()]
        parts[-1] += _END
        if len(parts) > _LONG:
            return [self.ids[p] for p in self._joined(parts) if p in self.ids]
        none, rank_of = len(self.ranks), self.ranks.get
        ranks = [rank_of(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            left, right = parts[i], parts[i + 1]
            # All pairs of this rank, from the left; a merge changes the ranks beside it only.
            while i < len(ranks):
                if ranks[i] == rank and parts[i] == left and parts[i + 1] == right:
                    parts[i : i + 2] = [left + right]
                    del ranks[i]
                    if i:
                        ranks[i - 1] = rank_of((parts[i - 1], parts[i]), none)
                    if i < len(ranks):
                        ranks[i] = rank_of((parts[i], parts[i + 1]), none)
                i += 1
        return [self.ids[p] for p in parts if p in self.ids]


    def _joined(self, parts: list[str | None]) -> list[str]:
        """The parts of a long word after all merges: pairs wait in a heap by rank and place."""
        n, rank_of = len(parts), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            # A pair that has changed since it was put here has another rank, or its left part is gone.
            if parts[i] is None or j == n or rank_of((parts[i], parts[j])) != rank:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for at in (before[i], i):
                if at >= 0 and after[at] < n and (r := rank_of((parts[at], parts[after[at]]))) is not None:
                    heappush(heap, (r, at))
        return [p for p in parts if p is not None]


class Words:
    """Splits texts into words and special ids."""

    def __init__(self, rules: Rules):
        self.find = regex.compile(rules.pattern).findall
        self.special = rules.special
        names = sorted(rules.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None

    def plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower case by character: a final sigma stays an ordinary one.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.find(text.lower())

    def parts(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Words, and the special id that follows them."""
        if self.cut is None or not any(name in text for name in self.special):
            yield self.plain(text), None
            return
        pieces = self.cut(text)
        for i in range(0, len(pieces), 2):
            yield self.plain(pieces[i]), self.special[pieces[i + 1]] if i + 1 < len(pieces) else None


class _Builder:
    """Sorted words into a minimal acyclic automaton: a finished branch is shared with an equal one."""

    def __init__(self) -> None:
        self.arcs: list[dict[int, int]] = [{}]
        self.final = [False]
        self.known: dict[tuple, int] = {}
        self.path: list[tuple[int, int, int]] = []  # parent, byte, child
        self.last = b""

    def add(self, word: bytes) -> None:
        n = len(os.path.commonprefix([word, self.last]))
        self._close(n)
        state = self.path[-1][2] if self.path else 0
        for b in word[n:]:
            self.arcs.append({})
            self.final.append(False)
            child = len(self.arcs) - 1
            self.arcs[state][b] = child
            self.path.append((state, b, child))
            state = child
        self.final[state] = True
        self.last = word

    def _close(self, keep: int) -> None:
        while len(self.path) > keep:
            parent, b, child = self.path.pop()
            key = (self.final[child], tuple(self.arcs[child].items()))
            same = self.known.setdefault(key, child)
            self.arcs[parent][b] = same

    def finished(self) -> tuple[list[dict[int, int]], list[bool]]:
        """Arcs and marks of the states that are reached, the start first."""
        self._close(0)
        order, number = [0], {0: 0}
        for state in order:
            for child in self.arcs[state].values():
                if child not in number:
                    number[child] = len(order)
                    order.append(child)
        return (
            [{b: number[c] for b, c in self.arcs[s].items()} for s in order],
            [self.final[s] for s in order],
        )


def compiled(words: Iterable[str], rules: Rules) -> dict[str, np.ndarray]:
    """The automaton of the words, and their ids in order of their numbers."""
    sorted_words = sorted({w.encode() for w in words if w})
    builder = _Builder()
    for word in sorted_words:
        builder.add(word)
    arcs, final = builder.finished()
    below = [-1] * len(arcs)  # words that end at or below a state
    stack = [0]
    while stack:
        state = stack[-1]
        missing = [c for c in arcs[state].values() if below[c] < 0]
        if missing:
            stack.extend(missing)
        else:
            below[state] = final[state] + sum(below[c] for c in arcs[state].values())
            stack.pop()
    first, keys, targets, skips = [0], [], [], []
    for state, out in enumerate(arcs):
        skip = int(final[state])
        for b in sorted(out):
            keys.append(state << 8 | b)
            targets.append(out[b])
            skips.append(skip)  # words before the ones along this arc
            skip += below[out[b]]
        first.append(len(keys))
    ids = [rules.merged(w.decode()) for w in sorted_words]
    starts = np.cumsum([0, *map(len, ids)])
    return {
        "keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32), "skips": np.array(skips, np.int32),
        "final": np.array(final, np.int8), "starts": starts.astype(np.int64),
        "ids": np.array([i for w in ids for i in w], "<u4"),
    }


def write(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file: a line that says what is where, then the arrays."""
    at, head = 0, {}
    for name, a in arrays.items():
        head[name] = (at, a.dtype.str, len(a))
        at += (a.nbytes + 7) // 8 * 8
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    with open(path, "wb") as f:
        f.write(line)
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


class Lexicon:
    """A memory-mapped automaton."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            line = f.readline()
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        for name, (at, kind, n) in json.loads(line).items():
            setattr(self, name, np.frombuffer(data, kind, n, len(line) + at))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that are not there; all words step together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        out = np.full(len(words), -1, np.int64)
        live, state, number, depth = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0
        while len(live) and len(self.keys):
            done = lengths[live] == depth
            ended = done & (self.final[state] > 0)
            out[live[ended]] = number[ended]
            live, state, number = live[~done], state[~done], number[~done]
            if not len(live):
                break
            key = state << 8 | text[starts[live] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            live, arc = live[ok], arc[ok]
            state, number = self.targets[arc].astype(np.int64), number[ok] + self.skips[arc]
            depth += 1
        return out


class Coder:
    """Encodes and decodes texts on an executor."""

    def __init__(self, rules: Rules, lexicon: Lexicon):
        self.rules, self.lexicon, self.words = rules, lexicon, Words(rules)
        self.bytes_of = [i.to_bytes(4, "little") for i in range(len(rules.pieces))]
        self.merged: dict[str, bytes] = {}

    def encoded(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers. Each different word is looked up once."""
        parts = [list(self.words.parts(t)) if t else [] for t in texts]
        different = list({w for p in parts for ws, _ in p for w in ws})
        known: dict[str, bytes] = {}
        lexicon = self.lexicon
        numbers = lexicon.numbers([w.encode() for w in different]).tolist()
        for word, number in zip(different, numbers):
            if number >= 0:
                known[word] = lexicon.ids[lexicon.starts[number] : lexicon.starts[number + 1]].tobytes()
            else:
                known[word] = self._merged(word)
        out = []
        for p in parts:
            pieces = []
            for words, special in p:
                pieces.extend(map(known.__getitem__, words))
                if special is not None:
                    pieces.append(self.bytes_of[special])
            out.append(b"".join(pieces))
        return out

    def _merged(self, word: str) -> bytes:
        ids = self.merged.get(word)
        if ids is None:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            ids = self.merged[word] = b"".join(map(self.bytes_of.__getitem__, self.rules.merged(word)))
        return ids

    def decoded(self, ids: bytes) -> str:
        return " ".join(map(self.rules.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def frequent_words(docs: DataFrame, size: int = LEXICON) -> list[str]:
    """The words that stand most often between white space, in lower case: at most `size`."""
    words = docs.select(F.explode(words_of(F.lower(text_of(docs)))).alias("word"))
    counts = stored(words.groupBy("word").agg(F.count("*").alias("c")).where("c > 1"), "bpe-words")
    return [word for word, _ in frequent(counts, size)]


def lexicon_file(words: Iterable[str], rules: Rules) -> str:
    """Compile a lexicon on the driver; the name says what is in it."""
    split = Words(rules)
    arrays = compiled({w for word in words for w in split.plain(word)}, rules)
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), "lexicon")
    write(arrays, path)
    with open(path, "rb") as f:
        name = f"{path}-{hashlib.sha256(f.read()).hexdigest()[:16]}"
    os.rename(path, name)
    return name


_CODERS: dict[tuple, Coder] = {}


def _coder(rules_name: str, lexicon_name: str) -> Coder:
    key = (rules_name, lexicon_name)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(Rules(SparkFiles.get(rules_name)), Lexicon(SparkFiles.get(lexicon_name)))
    return _CODERS[key]


def _shared(spark: SparkSession, path: str) -> str:
    """Give a file to all executors; a name that they have already is the same content."""
    name = os.path.basename(path)
    if not any(name == os.path.basename(f) for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    return name


def coded(docs: DataFrame, vocabulary: str, size: int = LEXICON, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids, decoded): the ids as bytes of 32-bit integers, and the text they decode to."""
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    lexicon = lexicon_file(frequent_words(docs, size), Rules(vocabulary))
    names = tuple(_shared(spark, path) for path in (vocabulary, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*names)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = coder.encoded(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(map(coder.decoded, ids), pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
