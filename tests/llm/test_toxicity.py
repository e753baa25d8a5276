"""The string kernel against its definition, and the machine on labelled texts it has not seen."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from roomledger.llm import toxicity
from test_operators import empty, odd

SETTINGS = toxicity.Settings()


def plain_kernel(a, b, settings=SETTINGS):
    def vector(word):
        found = Counter()
        for i, j, k in itertools.combinations(range(len(word)), 3):
            if k - i < settings.span and all(word[x].isalnum() for x in (i, j, k)):
                found[word[i] + word[j] + word[k]] += settings.decay ** (k - i + 1)
        return found

    u, v = vector(a), vector(b)
    size = np.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))
    return (sum(u[s] * v[s] for s in u) / size) ** settings.power if size else 0.0


def test_kernel_equals_its_definition():
    random.seed(2)
    words = ["".join(random.choices("abcdi.0-", k=random.randrange(1, 14))) for _ in range(60)] + ["idiot", "idxiot", "i.d.i.o.t", "", "ab"]
    marks = [w for w in words if toxicity.subsequences([w], SETTINGS)[3][0] > 0]
    got = toxicity.Landmarks(marks, SETTINGS).kernel(words)
    want = [[plain_kernel(a, b) for b in marks] for a in words]
    assert np.abs(got - np.array(want)).max() < 1e-9


def test_nystrom_vectors_give_the_kernel_of_landmarks():
    names = ["idiot", "moron", "clown", "the", "table", "stable", "tables"]
    landmarks = toxicity.Landmarks(names, SETTINGS)
    x = toxicity._vectors([[n] for n in names], landmarks, toxicity.inverse_root(landmarks.kernel(names)))[:, :-1].astype(float)
    assert np.abs(x @ x.T - landmarks.kernel(names)).max() < 1e-4


def test_separated_is_the_optimum():
    random_ = np.random.RandomState(1)
    x = np.c_[random_.standard_normal((300, 4)), np.ones(300)]
    y = np.where(x[:, 0] + 0.3 * random_.standard_normal(300) > 0.2, 1.0, -1.0)
    w = toxicity.separated(x, y, 1.0)
    loss = lambda v: (v[:-1] @ v[:-1] + 1e-6 * v[-1] ** 2) / 2 + (np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
    for step in random_.standard_normal((200, 5)):
        assert loss(w) <= loss(w + 1e-3 * step) + 1e-9


def made(n):
    """Labelled texts: toxic ones hold an insult, and some of the held-out ones a disguised one."""
    random.seed(6)
    syllables = "ta re no mi la su ke vo pi den ser tal gor".split()
    word = lambda: "".join(random.choices(syllables, k=random.randrange(1, 4)))
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        sentences = [[word() for _ in range(random.randrange(4, 12))] for _ in range(random.randrange(1, 6))]
        if toxic:
            random.choice(sentences).insert(2, random.choice(["idiot", "scumbag", "moron"]))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", int(toxic)))
    return rows


def test_held_out_and_disguised_insults(spark):
    rows = made(900)
    clean = rows[1][1]
    disguised = [f"{clean} you {x} there." for x in ("i.d.i.o.t", "IDIOT!!", "i d i o t", "idi-ot", "scum_bag", "scumbags")]
    rows += [(2000 + i, t, None) for i, t in enumerate(disguised)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    assert set(got) == {i for i, _, _ in rows}
    held = [(got[i], y) for i, _, y in rows if y is not None and zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r["held_out"] for r, _ in held) and len(held) > 200
    assert sum(r["predicted"] == y for r, y in held) / len(held) > 0.98
    assert [got[2000 + i]["predicted"] for i in range(len(disguised))] == [1] * len(disguised), [got[2000 + i]["score"] for i in range(len(disguised))]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    assert any("idiot" in (r["sentence"] or "") for r in got.values())


def test_labels_of_the_held_out_do_not_matter(spark):
    rows = made(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, _, y in rows]
    scores = [
        {r["doc_id"]: r["score"] for r in toxicity.scored(docs, spark.createDataFrame(ls, "doc_id bigint, toxic int")).collect()}
        for ls in ([(i, y) for i, _, y in rows], turned)
    ]
    assert scores[0] == pytest.approx(scores[1], abs=1e-12)


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (5, 0), (99, 1)], "doc_id bigint, toxic int")
    rows = toxicity.scored(odd(spark), labels).collect()
    assert len(rows) == odd(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.scored(empty(spark), labels).collect() == []
    # Without labels of both kinds: the smoothed share.
    for some, share in ((labels.limit(0), 0.5), (labels.where("toxic = 0"), 1 / (2 + labels.where("toxic = 0 and crc32(string(doc_id)) % 3 <> 1").count()))):
        assert {round(r["score"], 9) for r in toxicity.scored(odd(spark), some).collect()} == {round(share, 9)}


def test_long_words_and_long_sentences():
    model = toxicity.fit(
        [t for _, t, _ in made(400)], [y == 1 for _, _, y in made(400)], [i % 4 == 0 and i % 8 == 0 for i in range(400)], 0.25, SETTINGS
    )
    model.prepare()
    dull = " ".join(["tamire"] * 50_000)
    margins = [m for m, _ in model.judged([f"{dull} idiot {dull}", dull, "x" * 1_000_000, "", "vo" * 500 + "scumbag" + "vo" * 500])]
    assert margins[0] > margins[1] + 1 and margins[3] == model.bias and np.isfinite(margins).all()
