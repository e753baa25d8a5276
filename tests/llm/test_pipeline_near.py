"""The near-duplicate stage takes the groups of fingerprints, then those of the index."""

import random

import corpus_pipeline
import pytest
from roomledger.llm import neardups, simhash
from roomledger.llm.common import stored
from roomledger.llm.components import components
from roomledger.session import ship_package


def test_no_two_documents_stay_that_fingerprints_or_the_index_link(spark, sf):
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, i = [], 0
    for n, changed in [(200, 1)] * 6 + [(60, 3)] * 60 + [(40, 4)] * 60:  # index of 0.95 to 0.4
        base = words(n)
        near = list(base)
        for at in rng.sample(range(n), changed):
            near[at] = "other"
        rows += [(i, " ".join(base)), (i + 1, " ".join(near))]
        i += 2
    # A pair that fingerprints link and the index does not: three of the four-word shingles are common.
    for _ in range(4000):
        base = words(8)
        near = [*base[:7], words(1)[0]]
        if (simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(near))).bit_count() <= 4:
            rows += [(i, " ".join(base)), (i + 1, " ".join(near))]
            i += 2
            break
    else:
        raise AssertionError("no such pair")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    by_index = {r["doc_id"] for r in neardups.kept(docs).collect()}
    left = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert {i - 2, i - 1} <= by_index and i - 2 in left and i - 1 not in left and left < by_index
    text = dict(rows)
    prints = {d: simhash.fingerprint(text[d]) for d in left}
    sets = {d: set(neardups.shingles(text[d]).tolist()) for d in left}
    for a in left:
        for b in left:
            if a < b:
                assert (prints[a] ^ prints[b]).bit_count() > 4
                assert len(sets[a] & sets[b]) < 0.8 * len(sets[a] | sets[b])


@pytest.mark.parametrize("block", [None, 4000])
def test_a_group_of_texts_below_the_index_makes_no_rows_of_pairs(spark, monkeypatch, block):
    """400 texts that share most of their shingles, few pairs of them at 0.8 or more, in one block or in many."""
    rng = random.Random(6)
    base, texts = [f"w{i}" for i in range(120)], []
    for i in range(400):
        words = base if i % 10 else texts[-1].split() if texts else base
        words = list(words)
        for at in rng.sample(range(120), 5 if i % 10 else 1):
            words[at] = f"x{i}-{at}"
        texts.append(" ".join(words))
    ship_package(spark)
    made = []

    def counted(frame, name):
        out = stored(frame, name)
        made.append(out.count())
        return out

    monkeypatch.setattr(neardups, "stored", counted)
    sets = [neardups.shingles(t) for t in texts]
    entries = [(i, len(x), b) for i, x in enumerate(sets) for b in neardups.bands(x)]
    found = components(neardups.links(
        spark.createDataFrame(entries, "same bigint, n int, bucket bigint"),
        spark.createDataFrame(list(enumerate(texts)), "same bigint, text string"), *([block] if block else []),
    ))
    root = list(range(len(sets)))
    keys = [set(neardups.bands(x)) for x in sets]
    for i in range(len(sets)):
        for j in range(i):
            common = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if keys[i] & keys[j] and 9 * common >= 4 * (len(sets[i]) + len(sets[j])) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert 1 < len(set(root)) < 400
    got = {r["node"]: r["root"] for r in found.collect()}
    assert [got.get(i, i) for i in range(len(sets))] == root
    if block is None:
        assert sum(made) <= 1.2 * len(entries), made
