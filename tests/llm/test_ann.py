import numpy as np
import pytest
from pyspark.sql import functions as F

from entryflow.llm import ann

EVERY = 5


def brute_force(rows, k):
    """Exact nearest by id and score, over usable rows."""
    out = {}
    for q, v in rows:
        if q % EVERY == 0:
            hits = sorted({(-float((np.array(v) * np.array(x)).sum()), i) for i, x in rows if i != q})
            out[q] = hits[:k]
    return out


def run(spark, rows, k=20, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string")
    df = df.withColumn("rank", F.lit(1)).repartition(4)
    got = {}
    for r in ann.nearest(df, lambda i: i % EVERY == 0, k, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r["id"], r.score))
    return {q: sorted(v) for q, v in got.items()}


def recall(got, want):
    hits = sum(len({i for _, i, _ in got.get(q, [])} & {i for _, i in v}) for q, v in want.items())
    return hits / sum(len(v) for v in want.values())


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall_against_brute_force(spark, clusters):
    rng = np.random.default_rng(clusters)
    x = rng.standard_normal((1500, 48)).astype(np.float32)
    if clusters:
        x += 4 * rng.standard_normal((clusters, 48)).astype(np.float32)[rng.integers(0, clusters, 1500)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = run(spark, rows), brute_force(rows, 20)
    assert recall(got, want) >= 0.9
    for q, hits in got.items():
        assert [r for r, _, _ in hits] == list(range(1, 21))
        assert [(-s, i) for _, i, s in hits] == sorted((-s, i) for _, i, s in hits)
        for _, i, s in hits[:3]:
            assert s == pytest.approx(float(x[q].astype(float) @ x[i].astype(float)), rel=1e-12)


def test_chunks_and_batches_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 16)).astype(np.float32))]
    want = run(spark, rows, probes=10**6)
    assert recall(want, brute_force(rows, 20)) == 1
    monkeypatch.setattr(ann, "CHUNK_ROWS", 7)
    monkeypatch.setattr(ann, "BATCH_QUERIES", 3)
    assert run(spark, rows, probes=10**6) == want


def test_ties_copies_and_unusable_rows(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(0, e), (3, e), (2, e), (1, e), (4, [0.0, 2.0, 0.0]), (5, [0.0, 1.0, 0.0])]
    odd = [(None, e), (6, None), (7, [0.0] * 3), (8, [1.0, None, 0.0]), (9, [float("nan"), 0.0, 0.0]),
           (11, [float("inf"), 0.0, 0.0]), (12, [1.0]), (10, None), (3, e)]
    got = run(spark, rows + odd, k=3)
    assert got == {0: [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)], 5: [(1, 4, 2.0), (2, 0, 0.0), (3, 1, 0.0)]}
    assert len(run(spark, rows, k=20)[0]) == 5
    assert run(spark, [(1, None)]) == {} and run(spark, [(0, e)]) == {}


def test_scan_abandons_far_rows():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x[:40] = x[0] + 0.1 * rng.standard_normal((40, 64))
    for queries in (1, 9):
        of, row = ann.adaptive_scan(x[:queries], x, 20)
        for i in range(queries):
            near = np.argsort(((x - x[i]) ** 2).sum(1))[:20]
            alive = row[of == i]
            assert set(near.tolist()) == set(alive.tolist())
