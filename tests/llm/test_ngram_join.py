import random
from collections import defaultdict

import numpy as np
import pytest

from entryflow.llm import ngram_join as J
from entryflow.llm.graph import components
from helpers import ODD, documents, with_clashing, words


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_force(docs, percent=85, k=4):
    """Components by comparing every two documents."""
    sets = [(d, shingles(t, k)) for d, t in docs if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d, _ in sets}


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        i = rng.randrange(len(w))
        w[i:i + rng.randrange(2)] = [f"e{rng.randrange(10**6)}"] * rng.randrange(2)
    return " ".join(w)


def corpus(rng):
    """Chains of edits, groups of near copies, short texts, shared passages, odd texts."""
    texts = list(ODD)
    for n in (4, 5, 6, 7, 8, 12, 20, 45, 90, 200, 700):
        base = words(rng, n, 60 if n < 20 else 4000)
        texts += [base, base.upper()] + [edited(rng, base, 1 + rng.randrange(3)) for _ in range(8)]
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, max(1, n // 40))
            texts.append(chain)
    group = words(rng, 150)
    texts += [edited(rng, group, 1 + rng.randrange(4)) for _ in range(60)]
    passages = [words(rng, 60) for _ in range(4)]
    texts += [" ".join(rng.sample(passages, 2)) + " " + words(rng, rng.randrange(12)) for _ in range(60)]
    texts += [words(rng, rng.randrange(1, 9), 6) for _ in range(80)]
    return texts


@pytest.mark.parametrize("frequent, very, first", [(16, 256, 4), (2, 4, 4), (3, 10, 1), (2, 3, 10)])
def test_components_equal_brute_force(spark, monkeypatch, frequent, very, first):
    for name, value in (("FREQUENT", frequent), ("VERY_FREQUENT", very), ("FIRST_TENTHS", first)):
        monkeypatch.setattr(J, name, value)
    if very < 16:
        for name, value in (("GATHER", 3000), ("RANGE_TOKENS", 900), ("TILE", 5)):
            monkeypatch.setattr(J, name, value)
    texts = corpus(random.Random(first + very))
    ids = random.Random(1).sample(range(10 * len(texts)), len(texts) - 1) + [None]
    df = with_clashing(documents(spark, texts, ids, partitions=4)).drop("id")
    got = {r.id: r for r in J.near_components(df, k=4, percent=85).collect()}
    want = brute_force(list(zip(ids, texts)))
    assert {d: r.component_id for d, r in got.items() if d is not None} == want
    sizes = {d: len(shingles(t)) for d, t in zip(ids, texts)}
    assert {d: r.n_shingles for d, r in got.items()} == sizes
    assert got[None].component_id is None


@pytest.mark.parametrize("percent", [76, 80, 85, 95])
def test_similar_sets_share_a_signature(percent):
    """The prefix argument itself, on random pairs just above the threshold."""
    rng = random.Random(percent)
    for _ in range(400):
        n = rng.choice([4, 5, 6, 7, 8, 9, 12, 20, 33, 60, 130, 400])
        both = [rng.getrandbits(64) for _ in range(n)]
        extra = rng.randrange(0, n // 3 + 1)
        x, y = set(both), set(both)
        for _ in range(extra):
            (x if rng.random() < 0.5 else y).add(rng.getrandbits(64))
        if rng.random() < 0.5 and len(x) > 4:
            x.discard(both[0])
        if 100 * len(x & y) < percent * len(x | y) or x == y or min(len(x), len(y)) < J.SMALLEST:
            continue
        kind = {t: 1 + t // 7 % 3 for t in x | y}
        found = []
        for s in (x, y):
            tokens = np.array(sorted(s), dtype=np.uint64)
            index, first = J.indexable(tokens, percent)
            index.sort()
            kinds = np.array([kind[t] for t in index.tolist()])
            found.append(set(J.signatures(len(s), first, index, kinds, percent)))
        assert found[0] & found[1]


def test_other_shingles_and_similarity(spark):
    texts = corpus(random.Random(8))
    got = {r.id: r.component_id for r in J.near_components(documents(spark, texts)).collect()}
    assert got == brute_force(list(enumerate(texts)), percent=80, k=5)


def test_small_tables(spark):
    df = documents(spark, ["a b c d e", "a b c d e", "", None], ids=[5, 5, 1, 2])
    got = sorted((r.id, r.n_shingles, r.component_id) for r in J.near_components(df).collect())
    assert got == [(1, 0, 1), (2, 0, 2), (5, 1, 5), (5, 1, 5)]
    assert J.near_components(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        J.near_components(df, percent=75)


def test_graph_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40, 90)] + [(90, 3), (100, 101), (7, 7), (None, 1)]
    links += [(200 + rng.randrange(60), 200 + rng.randrange(60)) for _ in range(40)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in links:
        if a is not None:
            near[a].add(b)
            near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)
    assert set(got) == set(near)
