import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from entryflow.llm import katz
from helpers import ODD, documents, with_clashing

BEGIN, END = "<s>", "</s>"


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + [END]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class BruteForce:
    """The same model with dictionaries, its backoff weights summed word by word."""

    def __init__(self, docs):
        train = [tokens(t) for d, t in docs if not held(d)]
        self.one = Counter(w for t in train for w in t)
        self.two = Counter(p for t in train for p in zip([BEGIN] + t, t))
        self.context = Counter(w for t in train for w in [BEGIN] + t[:-1])
        self.n = sum(self.one.values())
        self.d1 = katz.Discounts(Counter(c for c in self.one.values() if c <= katz.FIT_COUNTS))
        self.d2 = katz.Discounts(Counter(c for c in self.two.values() if c <= katz.FIT_COUNTS))
        self.unknown = 1 - sum(self.of(self.d1, c) for c in self.one.values()) / self.n if self.n else 1.0
        self.after = defaultdict(list)
        for h, w in self.two:
            self.after[h].append(w)

    @staticmethod
    def of(d, c):
        return float(d(np.array([c]))[0])

    def word(self, w):
        c = self.one[w]
        return self.of(self.d1, c) / self.n if c else self.unknown

    def weight(self, h):
        seen = sum(self.of(self.d2, self.two[h, w]) / self.context[h] for w in self.after[h])
        return (1 - seen) / (1 - sum(map(self.word, self.after[h])))

    def probability(self, h, w):
        if self.two[h, w]:
            return self.of(self.d2, self.two[h, w]) / self.context[h]
        return (self.weight(h) if self.context[h] else 1.0) * self.word(w)


def zipf_docs(rng, n):
    """Texts in which a word says something about the next."""
    vocabulary = [f"W{i}" if i % 5 else f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    out = []
    for _ in range(n):
        at, text = 0, []
        for step in rng.choices(range(300), weights, k=rng.randrange(1, 60)):
            at = (7 * at + step) % 300
            text.append(vocabulary[at])
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    texts = zipf_docs(rng, 250) + ODD + [zipf_docs(rng, 1)[0] + " newword newword"] * 2
    ids = [*range(len(texts) - 3), None, len(texts) - 2, len(texts) - 2]
    old, katz.BLOCK_TOKENS, ranges, katz.RANGE_KEYS = katz.BLOCK_TOKENS, 700, katz.RANGE_KEYS, 300
    rows = katz.score(with_clashing(documents(spark, texts, ids))).collect()
    katz.BLOCK_TOKENS, katz.RANGE_KEYS = old, ranges
    return list(zip(ids, texts)), rows


def test_scores_equal_brute_force(scored):
    docs, rows = scored
    model = BruteForce(docs)
    texts = {d: t for d, t in docs}
    assert len(rows) == len(docs)
    for r in rows:
        t = tokens(texts[r.id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.id), len(t), model.n)
        assert r.n_known == sum(model.one[w] > 0 for w in t)
        base = sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in t)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        want = sum(math.log10(model.probability(h, w)) for h, w in zip([BEGIN] + t, t))
        assert r.score == pytest.approx(want, rel=1e-9)


def test_model_is_normalised(scored):
    model = BruteForce(scored[0])
    everything = [*model.one, "<unknown>"]
    for h in [BEGIN, "w0", "w5", "newword", "never seen"]:
        assert sum(model.probability(h, w) for w in everything) == pytest.approx(1, abs=1e-9)


def test_held_out_text_is_likelier_than_by_base(scored):
    rows = [r for r in scored[1] if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_codec():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert (katz.expand_keys(katz.squeeze_keys(keys)) == keys).all()
    for a in (np.empty(0, np.int64), np.array([3, -1, 2**62])):
        assert (katz.expand(katz.squeeze(a)).astype(np.int64) == a).all()


def test_small_tables(spark):
    df = documents(spark, ["a b", None], ids=[2, 7])
    assert katz.score(df.limit(0)).count() == 0
    held_ids = [d for d in range(100) if held(d)][:2]
    rows = katz.score(documents(spark, ["a b", "c"], ids=held_ids)).collect()
    assert [(r.train_tokens, r.n_known, r.score, r.base_score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2
