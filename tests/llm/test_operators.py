"""Operators against plain versions of themselves, and on odd rows."""

import collections
import hashlib
import math
import pathlib
import random
import time
import re
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

from roomledger.llm import (  # noqa: E402
    bpe, components, licenses, lm, neardups, packing, quality, repeats, secrets, simhash, topk, webtext,
)

LONG = " ".join(f"word{i} and the other one" for i in range(40_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, f string, _row int, words int"


def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [
        (1, "the same text of the day", "en", "a"), (1, "the same text of the day", "en", "a"),
        (2, None, None, None), (None, "no id here at all, but words", "en", "b"), (3, "", "", ""),
        (4, " \t\n ", "en", "b"), (5, LONG, "en", "a"), (6, "the same text of the day", "en", "b"),
        (7, "ß ü 日本語 \x00 \x1f end", "de", "c"), (None, None, None, None),
    ]
    full = [(*r, None if r[1] is None else len(r[1]), "x", "y", 1, 2) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def texts(spark):
    return [(r["doc_id"], r["text"] or "") for r in odd(spark).collect()]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def spaced(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# --- packing ------------------------------------------------------------------------


def test_packing_takes_the_tightest_compatible_bin():
    random.seed(3)
    for _ in range(200):
        capacity = random.randrange(5, 40)
        rows = [(i, random.randrange(1, 60), random.choice([None, "a", "a", "b", "c"]), random.choice([None, None, "u", "v", "w"]))
                for i in range(random.randrange(50))]
        bins = {}
        for row, _, _, size, bin_, offset, _ in packing.pack(rows, capacity):
            source, cluster = rows[row][2:] if size < capacity else (None, None)
            fit = [b[0] for b in bins.values()
                   if b[0] >= size and (source is None or source not in b[1]) and (cluster is None or cluster not in b[2])]
            if bin_ in bins:
                assert bins[bin_][0] == min(fit)
            else:
                assert not fit or size == capacity
                bins[bin_] = [capacity, set(), set()]
            b = bins[bin_]
            assert offset == capacity - b[0]
            b[0] -= size
            b[1].add(source)
            b[2].add(cluster)
        assert sum(capacity - b[0] for b in bins.values()) == sum(r[1] for r in rows)


def test_packing_of_odd_rows(spark):
    rows = packing.packed(odd(spark), shard=4).collect()
    want = collections.Counter()
    for doc_id, text in texts(spark):
        want[doc_id] += len(spaced(text))
    got = collections.Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
    assert got == want
    used = collections.Counter()
    for r in rows:
        if r["bin_id"]:
            used[r["bin_id"]] += r["n_tokens"]
    assert max(used.values()) <= packing.CAPACITY
    assert packing.packed(empty(spark)).count() == 0


# --- BPE ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    rules = bpe.Rules(public_tokenizers.path("word_bpe_49k.json"))
    words = ["the", "then", "other", "others", "mother", "übergang", "123", "!!"]
    return bpe.Coder(rules, bpe.Lexicon(bpe.lexicon_file(words, rules)))


def test_bpe_equals_the_library(coder):
    from tokenizers import Tokenizer

    real = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    random.seed(1)
    letters = "aAbB'sSΣσς tTrevmldé́İı\n\t\x0b\x0c\r\x1c\x85\xa0᠎ 　中文١½²0129<|endoftext|>!?#_-‍😀ﬁǅ\x00"
    cases = ["".join(random.choice(letters) for _ in range(random.randrange(30))) for _ in range(3000)]
    cases += ["", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "the others then mother", "I'LL don't 'S", "x" * 5000]
    for text, ids in zip(cases, coder.encoded(cases)):
        want = real.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert coder.decoded(ids) == real.decode(want, skip_special_tokens=False), text


def test_lexicon_shares_suffixes_and_numbers_words():
    rules = bpe.Rules(public_tokenizers.path("word_bpe_49k.json"))
    random.seed(2)
    words = sorted({"".join(random.choice("ab") for _ in range(random.randrange(1, 8))) for _ in range(100)})
    lexicon = bpe.Lexicon(bpe.lexicon_file(words, rules))
    others = ["", "c", "abc", "a" * 20]
    assert lexicon.numbers([w.encode() for w in words + others]).tolist() == [*range(len(words)), -1, -1, -1, -1]
    tree = {w[:i] for w in words for i in range(len(w) + 1)}
    assert len(lexicon.final) < len(tree)
    # Minimal: no two states have equal right languages.
    right = [frozenset()] * len(lexicon.final)
    state_arcs = collections.defaultdict(list)
    for key, target in zip(lexicon.keys.tolist(), lexicon.targets.tolist()):
        state_arcs[key >> 8].append((key & 255, target))

    def language(state):
        return frozenset(([""] if lexicon.final[state] else []) + [chr(b) + x for b, t in state_arcs[state] for x in language(t)])

    right = [language(s) for s in range(len(lexicon.final))]
    assert len(set(right)) == len(right)


def test_bpe_of_odd_rows(spark):
    from tokenizers import Tokenizer

    real = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = bpe.coded(odd(spark), public_tokenizers.path("word_bpe_49k.json"), size=100).collect()
    want = collections.Counter(
        (i, np.array(real.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for i, t in texts(spark))
    assert collections.Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want
    assert bpe.coded(empty(spark), public_tokenizers.path("word_bpe_49k.json")).count() == 0


# --- secrets ------------------------------------------------------------------------


def test_secrets(spark):
    random.seed(4)
    hex_ = lambda n: "".join(random.choice("0123456789abcdef") for _ in range(n))
    rows, planted = [], {}
    for i in range(300):
        kind = i % 4
        value = hex_(40) if kind == 0 else "AKIA" + hex_(16).upper() if kind == 1 else f"{random.randrange(10**15, 10**16)}"
        lead = 'token = "' if kind == 0 else "key id " if kind == 1 else "call me at "
        text = f"Some words first, {lead}{value}" + ('"' if kind == 0 else "") + " and some after."
        rows.append((i, text))
        if kind < 2:
            planted[i] = (text.index(value), len(value))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: [(s["start"], s["length"]) for s in r["secrets"]] for r in secrets.scanned(docs).collect()}
    assert found == {i: [planted[i]] if i in planted else [] for i, _ in rows}
    for r in secrets.masked(docs).collect():
        text = rows[r["doc_id"]][1]
        if r["doc_id"] in planted:
            start, length = planted[r["doc_id"]]
            text = text[:start] + secrets.MASK + text[start + length :]
        assert r["text"] == text


def test_secrets_of_odd_rows(spark):
    rows = secrets.scanned(odd(spark)).collect()
    assert len(rows) == 10 and all(r["n_secrets"] == 0 for r in rows)
    same = secrets.masked(odd(spark))
    assert same.columns == odd(spark).columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd(spark).collect()))
    assert secrets.masked(empty(spark)).count() == 0 and secrets.scanned(empty(spark)).count() == 0


def test_secrets_assigned_without_quotes(spark):
    """NAME=value, .env lines, URL parameters and names with digits: the value goes, the name stays."""
    random.seed(14)
    some = lambda chars, n: "".join(random.choice(chars) for _ in range(n - 1)) + "7"
    low, high = "abcdef0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    forms = [
        ("api_key=", lambda: "AKIA" + some(high, 16), " and more"),
        ("AWS_REGION=eu-west\nAWS_ACCESS_KEY_ID=", lambda: "AKIA" + some(high, 16), "\nDEBUG=no\n"),
        ("aws_access_key_id2=", lambda: "AKIA" + some(high, 16), ""),
        ("https://a.example/v?access_token=", lambda: "ghp_" + some(high, 36), "&page=2"),
        ("password=", lambda: "hunter2hunter2" + some(low, 6), ""),
        ('oauth2_token_v2: "', lambda: some(low, 32), '" ends'),
        ("client_secret_v10=", lambda: some(low, 32) + "==", " ends"),
        ("call me at ", lambda: "4" + some("0123456789", 15), " or later"),
        ("width=", lambda: "4" + some("0123456789", 15), " or later"),
    ]
    rows, want = [], {}
    for i in range(360):
        lead, value, tail = forms[i % 9]
        value = value()
        rows.append((i, f"Some words first. {lead}{value}{tail}"))
        want[i] = f"Some words first. {lead}{value if i % 9 > 6 else secrets.MASK}{tail}"
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"]: r["text"] for r in secrets.masked(docs).collect()} == want


def test_secret_contexts_are_of_the_whole_text(spark):
    random.seed(15)
    text = ""
    for i in range(60):
        text += f"ab{i:02}" + "x" * random.choice([8, 9, 40]) + random.choice([" ", "=", ': "', " ü ", " some words between " * 4])
    cands = secrets.with_candidates(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["cands"]
    end = 0
    for c in cands:
        start = end + c["gap"]
        end = start + len(c["text"])
        assert text[start:end] == c["text"]
        assert c["before"] == text[max(0, start - secrets.BEFORE) : start] and c["after"] == text[end : end + secrets.AFTER]
    assert len(cands) == 60


# --- language model -----------------------------------------------------------------


def test_lm_of_odd_rows(spark):
    got = lm.scored(odd(spark), held=F.coalesce(F.col("doc_id") == 6, F.lit(False))).collect()
    rows = [(i, spaced(lower(t)) + [""], i == 6) for i, t in texts(spark)]
    c = collections.Counter(w for _, words, held in rows if not held for w in words)
    n, v = sum(c.values()), len(c)
    want = sorted(
        (str(i), held, len(words), sum(c[w] > 0 for w in words), n,
         round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), 4)) for i, words, held in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert lm.scored(empty(spark)).count() == 0


def test_lm_rare_words_and_gain(spark):
    """Words beyond the known ones are joined; on regular text the model beats the unigram."""
    random.seed(6)
    follow = {w: random.sample(range(60), 2) for w in range(60)}
    rows = []
    for i in range(400):
        w, words = random.randrange(60), []
        for _ in range(60):
            w = random.choice(follow[w])
            words.append(f"w{w}")
        rows.append((i, " ".join(words) + f" rare{i % 90}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    shape = lm.Shape(known=40, classes=4, words=8)
    got = {r["doc_id"]: r for r in lm.scored(docs, shape=shape).collect()}
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    c = collections.Counter(w for i, t in rows if i not in held for w in t.split() + [""])
    n, v = sum(c.values()), len(c)
    for i, text in rows:
        words = text.split() + [""]
        assert got[i]["held_out"] == (i in held) and got[i]["n_known"] == sum(c[w] > 0 for w in words)
        assert abs(got[i]["base_score"] - sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)) < 1e-6
    base, score = (sum(got[i][k] for i in held) for k in ("base_score", "score"))
    assert score > base


def test_bpe_of_long_words_takes_little_more_than_linear_time():
    from tokenizers import Tokenizer

    rules = bpe.Rules(public_tokenizers.path("word_bpe_49k.json"))
    real = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pick = random.Random(5)
    for letters, n in (("ab", 65), ("a", 500), ("etaoinshr", 700), ("abcdefghijklmnopqrstuvwxyz", 3000), ("élö", 400)):
        word = "".join(pick.choice(letters) for _ in range(n))
        assert rules.merged(word) == real.encode(word, add_special_tokens=False).ids
    word = "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    start = time.perf_counter()
    rules.merged(word)
    assert time.perf_counter() - start < 10


# --- licenses -----------------------------------------------------------------------


def test_own_license_phrases(spark):
    assert licenses.telling_words(licenses.PHRASES) == ["license", "cc"]
    docs = spark.createDataFrame([(1, "This is the ZLIB notice here"), (2, "zlib, not noticed")], "doc_id bigint, text string")
    rows = licenses.scanned(docs, phrases=(("zlib notice", "zlib"), ("free as in beer", "beer"))).collect()
    assert {r["doc_id"]: (r["n_base"], r["first_word"], r["base_labels"]) for r in rows} == {1: (1, 3, "zlib"), 2: (0, None, "")}
    assert {r["n_base"] for r in licenses.scanned(docs, phrases=()).collect()} == {0}


def test_licenses_equal_a_plain_version(spark):
    random.seed(7)
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect()]
    for i in range(60):
        template = random.choice(licenses.TEMPLATES)
        words = template.text.split()
        for _ in range(random.randrange(0, 8)):
            words[random.randrange(len(words))] = random.choice(["the", "other", "x"])
        end = random.choice([".\n", "\n\n", " ", "\n"])
        phrase = random.choice(["Apache License", "MIT  license", "cc-by", "nothing", "GNU general PUBLIC license"])
        rows.append((100 + i, f"Intro.{end}{' '.join(words)}{end}{phrase}, {phrase} end"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = []
    for i, text in rows:
        text = lower(text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        places = sorted((k, name) for p, name in licenses.PHRASES for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        labels, best = {name for _, name in places}, 0.0
        base = ",".join(sorted(labels))
        for block in re.split(licenses.BLOCKS, text):
            own = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", block))
            for t in licenses.TEMPLATES:
                both = len(own & set(t.words))
                if both >= t.required:
                    labels.add(t.label)
                    best = max(best, both / len(t.words))
        want.append((str(i), len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                     base, ",".join(sorted(labels)), 1.0 if places else best))
    got = [(str(r[0]), *r[1:]) for r in licenses.scanned(docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(bool(r[6]) for r in want) > 20
    assert licenses.scanned(empty(spark)).count() == 0


# --- SimHash ------------------------------------------------------------------------


def plain_fingerprint(text):
    words = spaced(lower(text))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def groups_of(prints):
    """Smallest index that links reach, by comparing all pairs."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def chained(n):
    """Fingerprints in random places, and chains and dense groups around some of them."""
    random.seed(8)
    prints = []
    while len(prints) < n:
        x = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 3, 30])):
            prints.append(x)
            for b in random.sample(range(64), random.randrange(0, 6)):
                x ^= 1 << b
    return prints[:n]


@pytest.mark.parametrize("block", [4096, 12])
def test_simhash_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    prints = chained(500)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    rows = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    got = {r["doc_id"]: r["component_id"] for r in simhash.grouped(rows).collect()}
    assert [got[i] for i in range(500)] == groups_of(prints)


def test_simhash_blocks_of_a_large_bucket(monkeypatch):
    """What is too large for one piece comes out as rows, whatever the batches."""
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BLOCK", 10)
    random.seed(9)
    rows = sorted((random.randrange(5) if random.random() < 0.7 else random.randrange(5, 60), random.random() < 0.5, random.getrandbits(60)) for _ in range(300))
    want = {b for b in range(60) if sum(r[0] == b for r in rows) > 10 and any(r[0] == b and not r[1] for r in rows)}
    for size in (1, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + size]]) for i in range(3)], ["bucket", "probe", "fp"])
                   for k in range(0, 300, size)]
        out = [r for b in simhash._links(iter(batches)) for r in b.to_pylist() if r["b"] is None]
        assert {r["bucket"] for r in out} == want
        for b in want:
            assert sorted(r["a"] for r in out if r["bucket"] == b) == sorted(r[2] for r in rows if r[0] == b)


def test_simhash_of_odd_rows(spark):
    rows = simhash.with_fingerprint(odd(spark)).select("doc_id", "fp", "text").collect()
    assert [r["fp"] & (1 << 64) - 1 for r in rows] == [plain_fingerprint(r["text"] or "") for r in rows]
    kept = simhash.kept(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "7", "None"]
    assert simhash.kept(empty(spark)).count() == 0


@pytest.mark.parametrize("words,changed", [(200, 1), (200, 3), (500, 8), (100, 1)])
def test_near_copies_share_a_band(words, changed):
    """Copies of an index of 0.85 or more are candidates; 64-bit fingerprints at four bits leave most of them apart."""
    random.seed(words + changed)
    for _ in range(50):
        a = [f"w{random.randrange(10**6)}" for _ in range(words)]
        b = list(a)
        for i in random.sample(range(words), changed):
            b[i] = "other"
        x, y = neardups.bands(neardups.shingles(" ".join(a))), neardups.bands(neardups.shingles(" ".join(b)))
        assert any(p == q for p, q in zip(x, y))


def test_near_duplicates_equal_a_plain_version(spark):
    random.seed(16)
    word = lambda: f"w{random.randrange(10**5)}"
    group = [word() for _ in range(60)]
    rows = [(0, " ".join(word() for _ in range(60)))]
    for i in range(1, 240):
        text = list(group) if i % 3 == 0 else rows[random.randrange(len(rows))][1].split() if i % 3 == 1 else [word() for _ in range(random.choice([3, 5, 30, 200]))]
        for _ in range(random.randrange(4)):
            text[random.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = {r["doc_id"] for r in neardups.kept(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == set(root)
    kept = neardups.kept(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == 5
    assert neardups.kept(empty(spark)).count() == 0


def test_a_large_group_of_near_copies(spark):
    """2,000 copies of one text, a tenth of all pairs at 0.8 or more, and 300 texts that share half of it."""
    random.seed(17)
    base = [f"w{random.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(2300):
        text = list(base)
        if i < 2000:
            for j in random.sample(range(120), random.choice([1, 1, 2, 3])):
                text[j] = f"x{random.randrange(10**6)}"
        else:
            text[60:] = [f"y{random.randrange(10**6)}" for _ in range(60)]
        rows.append((i, " ".join(text)))
    sets = [neardups.shingles(t) for _, t in rows]
    marks = {h: i for i, h in enumerate(sorted({h for x in sets for h in x.tolist()}))}
    table = np.zeros((len(sets), len(marks)), np.float32)
    for i, x in enumerate(sets):
        table[i, [marks[h] for h in x.tolist()]] = 1
    common, n = table @ table.T, table.sum(1)
    near = 9 * common >= 4 * (n[:, None] + n[None, :])
    label = np.arange(len(sets))
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], len(sets)).min(1))
        if (lower == label).all():
            break
        label = lower
    kept = {r["doc_id"] for r in neardups.kept(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)).collect()}
    assert kept == set(label.tolist())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 900)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 1000: 900}


def test_merging_sorts_only_symbols_that_can_begin_a_repeated_string(monkeypatch):
    """A shard of 200 to 368 bytes has few strings of 200; the other suffixes take no part in the rounds."""
    rng = random.Random(21)
    letters = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    common = letters(230)
    shards = [letters(i) + common[: 180 + i] + letters(9 * i) for i in range(4, 50)]
    seen, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, **options: seen.append(len(x)) or sort(x, **options))
    got = repeats.repeated(shards)
    strings = collections.Counter(s[i : i + 200] for s in shards for i in range(len(s) - 199))
    want = [[i for i in range(len(s) - 199) if strings[s[i : i + 200]] > 1] for s in shards]
    assert [x.tolist() for x in got] == want and any(want)
    assert max(seen) <= sum(max(0, len(s) - 199) for s in shards)


# --- top-k --------------------------------------------------------------------------


def test_topk_equals_all_scores(spark):
    random.seed(10)
    rows = [(i, [random.choice([0.0, random.gauss(0, 1), 0.25]) for _ in range(8)]) for i in range(400)]
    rows += [(7, rows[7][1]), (50, rows[50][1]), (500, None), (501, []), (502, [None] * 8), (503, [float("nan")] * 8), (None, [1.0] * 8), (550, [1.0, 2.0])]
    vectors = topk.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    got = collections.Counter(map(tuple, topk.search(vectors, vectors.where("vec_id % 50 = 0")).collect()))
    good = [(r[0], r[1].tolist() if hasattr(r[1], "tolist") else list(r[1])) for r in vectors.collect()]
    want = collections.Counter()
    for q, x in good:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(x) == len(y))
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5]))
    assert got == want
    none = vectors.where("vec_id < 0")
    assert topk.search(none, none).count() == 0


def test_topk_candidates_hold_the_best():
    rng = np.random.default_rng(11)
    for scale in (3, 200, 1 << 40):
        v = rng.integers(-scale, scale + 1, (700, 12))
        index = topk.Index(v)
        for q in v[:20]:
            rows = index.candidates(q, np.arange(700), 5)
            best = np.lexsort((np.arange(700), -(v.astype(object) @ q.astype(object)).astype(float)))[:5] if scale > 1000 else np.argsort(-(v @ q), kind="stable")[:5]
            assert set(best) <= set(rows.tolist())


# --- web pages ----------------------------------------------------------------------


def test_common_lines():
    def length(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    random.seed(12)
    for _ in range(1000):
        a, b = ([random.randrange(4) for _ in range(random.randrange(9))] for _ in range(2))
        chosen = [x for x, keep in zip(a, webtext.common(a, b)) if keep]
        rest = iter(b)
        assert len(chosen) == length(a, b) and all(x in rest for x in chosen)


PAGE = (
    "<html><head><title>T</title><style>p{}</style></head><body class='has-sidebar'><nav><a href=x>Menu</a></nav>"
    "<div class='ad top'>Buy</div><article><h1>Head &amp; line</h1><p>One<br>two &lt;3&nbsp; x<p>Three <b>bold</b>"
    "<script>var t='</p>';</script><aside>side</aside><form>f</form><ul><li><a href=y>Share this</a></ul>"
    "<div id=comments><p>me too</div></article><div class=cookie-notice>ok?</div><footer>foot</footer>"
)


def test_main_text():
    assert webtext.lines_of(PAGE) == [("Head & line", 0), ("One two <3 x", 0), ("Three bold", 0), ("Share this", 1)]
    assert webtext.lines_of(None) == [] and webtext.lines_of("plain") == [("plain", 2)]
    for broken in ("<a ", '<p class="x', "<!-- x", "<p>t</p><script>x", "a < b <3 c", "</", "<"):
        webtext.lines_of(broken)


def test_page_differencing(spark):
    loose = "<div>Home and help</div><div>{}</div><div>Call us now</div>"
    rows = [
        (1, "http://h/a/1", loose.format("First story of the day, told at length")),
        (2, "http://h/a/2", loose.format("Second story, with other words in it, as long")),
        (3, "http://h/z/9", "<div>Call us now</div><div>Third, and far from the others</div>"),
        (4, "http://other/a/1", loose.format("Alone on its host")), (5, None, None), (6, "http://h/b/1", ""),
        (7, "http://copy/a", loose.format("A copy")), (8, "http://copy/b", loose.format("A copy")),
        (9, "http://h/a/3", PAGE),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = {
        1: "First story of the day, told at length", 2: "Second story, with other words in it, as long",
        3: "Call us now\n\nThird, and far from the others", 4: "Home and help\n\nAlone on its host\n\nCall us now", 5: "", 6: "",
        7: "Home and help\n\nA copy\n\nCall us now", 8: "Home and help\n\nA copy\n\nCall us now",
        9: "Head & line\n\nOne two <3 x\n\nThree bold\n\nShare this",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r["page_id"]: r for r in webtext.extracted(pages).collect()}
        assert {k: r["text"] for k, r in got.items()} == want
        assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert webtext.extracted(pages.limit(0)).count() == 0


# --- quality ------------------------------------------------------------------------


def test_quality_of_odd_rows(spark):
    want = []
    for i, text in texts(spark):
        words = spaced(text)
        lines = [x for x in text.split("\n") if spaced(x)]
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        counts = collections.Counter(windows)
        repeat = len({k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)})
        failed = len(words) < 10 or 100 * repeat > 20 * len(words)
        want.append((str(i), len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, failed))
    rows = quality.judged(odd(spark)).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((str(r[0]), *r[1:7]) for r in rows) == sorted(want)
    assert all(not (r["kept"] and r["base_failed"]) for r in rows)
    assert quality.kept(odd(spark)).columns == odd(spark).columns
    assert quality.judged(empty(spark)).count() == 0


def test_quality_rejects_text_far_from_its_language(spark):
    random.seed(13)
    plain = "the of and to in that was for it with house river garden winter letter morning".split()
    make = lambda words, n: " ".join(random.choice(words) for _ in range(n))
    rows = [(i, make(plain, 200), "en") for i in range(30)]
    rows += [(100, make(["###", "$$$x", "|%%", "&&&"], 200), "en"), (101, make(["xqzt", "vvkj", "wpqr", "zzkt"], 200), "en")]
    kept = {r["doc_id"] for r in quality.kept(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert kept == set(range(30))


# --- repeats ------------------------------------------------------------------------


def test_merged_transforms_find_repeats():
    random.seed(14)
    for _ in range(300):
        length = random.randrange(1, 14)
        shards = [bytes(random.choice(b"ab") for _ in range(random.randrange(length, 30))) for _ in range(random.randrange(1, 7))]
        counts = collections.Counter(s[i : i + length] for s in shards for i in range(len(s) - length + 1))
        want = [[i for i in range(len(s) - length + 1) if counts[s[i : i + length]] > 1] for s in shards]
        assert [x.tolist() for x in repeats.repeated(shards, length)] == want


def test_leftmost_least():
    rng = np.random.default_rng(15)
    h = rng.integers(0, 6, 500).astype(np.uint64)
    for width in (1, 2, 7, 50, 500):
        assert repeats.leftmost_least(h, width).tolist() == [i + int(np.argmin(h[i : i + width])) for i in range(500 - width + 1)]


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_equal_a_plain_version(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "_PART", 700)
    random.seed(16)
    make = lambda n: "".join(random.choice("abcdefgh é") for _ in range(n))
    passage, other = make(320), make(205)
    rows = [(r["doc_id"], r["text"]) for r in odd(spark).collect() if r["doc_id"] != 5]
    rows += [(10 + i, make(random.randrange(300)) + passage[random.randrange(80) : 320 - random.randrange(60)] + make(random.randrange(900))) for i in range(12)]
    rows += [(30, other), (31, make(50) + other), (32, "ab" * 400), (33, "é" * 300), (34, make(150) * 3), (35, make(1500)), (35, make(1500)), (36, passage), (36, passage)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = collections.Counter(b[k : k + 200] for _, b in data for k in range(len(b) - 199))
    want = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if counts[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((str(i), len(b), int(gone.sum()), int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]])) if len(b) else 0, hashlib.sha256(kept).hexdigest()))
    out = repeats.removed(docs).collect()
    assert sorted((str(r["row"]["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out) == sorted(want)


def test_text_without_repeats(spark):
    random.seed(17)
    passage = "".join(random.choice("abcdefgh é") for _ in range(300))
    rows = [(1, f"One {passage} end", 4), (2, f"Two {passage}", 5), (3, "clean", 5), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in repeats.without_repeats(docs).collect()}
    assert got[3] == ("clean", 5) and got[4] == (None, None)
    assert all(got[i][1] == len(got[i][0]) for i in (1, 2))
    assert got[1][0].startswith("On") and got[1][0].endswith("end") and len(got[1][0]) < 12 and len(got[2][0]) < 6
    assert repeats.removed(empty(spark)).count() == 0
    assert repeats.without_repeats(odd(spark)).columns == odd(spark).columns
