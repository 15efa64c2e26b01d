import random
import re
from fractions import Fraction

import pytest

from entryflow.llm import mixing
from helpers import CLASHING, ODD, documents, with_clashing, words


def targets(sizes, weights=mixing.WEIGHTS, share=Fraction(3, 2), most=2):
    """Targets by source in exact numbers; the rounds as they are told."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        level = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if level[s] > most * sizes[s]}
        if not above:
            return {**out, **level}
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        free -= above
    return out


def count(text):
    return len(re.findall(mixing.WORD, text or ""))


def check(rows, docs):
    """Sizes and targets of the sources of ``docs`` (text, source), after what holds for any rows."""
    sizes = {}
    for text, source in docs:
        sizes[source] = sizes.get(source, 0) + count(text)
    assert len(rows) == len(docs) and all(r.taken == r.copies * r.size <= 2 * r.size for r in rows)
    return sizes, targets(sizes)


def test_targets_rates_and_draws(spark):
    rng = random.Random(5)
    docs = [(i, words(rng, rng.choice((3, 20, 60)), 900), f"s{i % 7}" if i % 3 else "hot") for i in range(900)]
    frame = documents(spark, [t for _, t, _ in docs], sources=[s for _, _, s in docs])
    rows = mixing.mix(frame).collect()
    sizes, want = check(rows, [d[1:] for d in docs])
    source = {i: s for i, _, s in docs}
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        s = source[r.id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(want[s]), rel=1e-12)
        rate = want[s] / sizes[s]
        assert r.copies in (rate // 1, -(-rate // 1)) and r.size == count(docs[r.id][1])
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.02 * want[s] for s in sizes)
    assert sum(want.values()) == Fraction(3, 2) * sum(sizes.values())
    # another partitioning draws the same
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_a_draw_is_fair(spark):
    """Without turns to choose from, a share of the documents near the fraction gets the copy."""
    docs = documents(spark, [f"word{i} x" for i in range(4000)], sources=["a", "b"] * 2000)
    # a: 5 of 7 parts of 24,000 words, but at most 16,000; b: the rest
    rates = {r.target / r.source_size for r in mixing.mix(docs, trials=1).select("target", "source_size").distinct().collect()}
    assert rates == {2.0, 1.0}
    docs = documents(spark, [f"word{i} x" for i in range(4000)], sources=["a"] * 4000)
    copies = [r.copies for r in mixing.mix(docs, trials=1).collect()]
    assert set(copies) == {1, 2} and abs(sum(copies) / 4000 - 1.5) < 0.04


def test_odd_documents(spark):
    sources = [None, "a", "", "a", None, "b", "b", "é", "z", None, "a", "\U0001f600"]
    docs = documents(spark, ODD, ids=[None, 1, 1, 2, 2, *range(5, 12)], sources=sources)
    rows = mixing.mix(with_clashing(docs), keep_docs=True).collect()
    sizes, want = check(rows, list(zip(ODD, sources)))
    for r in rows:
        assert r.target == pytest.approx(float(want[r.doc.source])) and r.doc["rank"] == "x"
        assert r.size == count(r.doc.text) and r.source_size == sizes[r.doc.source]
    assert set(CLASHING) < set(rows[0].doc.asDict())


def test_repeated_rows_empty_tables_and_sources_without_words(spark):
    same = documents(spark, ["one two"] * 6 + [None, ""], ids=[1] * 6 + [2, 3], sources=["a"] * 6 + ["b", "b"])
    rows = mixing.mix(same).collect()
    assert len({r.copies for r in rows if r.id == 1}) == 1 and len(rows) == 8
    assert all((r.target, r.taken, r.copies) == (0, 0, 0) for r in rows if r.id != 1)
    assert mixing.mix(same.where("doc_id > 9")).collect() == []
    nothing = documents(spark, [None, " "])
    assert [(r.size, r.target, r.taken) for r in mixing.mix(nothing).collect()] == [(0, 0.0, 0)] * 2


def test_long_text_and_emission(spark):
    docs = documents(spark, ["w " * 300_000, "a b c", "d e f"], sources=["x", "y", "y"])
    rows = mixing.mix(docs, keep_docs=True)
    copies = {r.id: (r.size, r.copies) for r in rows.collect()}
    assert copies[0][0] == 300_000 and copies[1][1] == copies[2][1] == 2
    out = mixing.emit(rows)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(
        i for i, (_, n) in copies.items() for _ in range(n))
