import math
from collections import Counter

import numpy as np
import pytest

from entryflow.llm import sharding
from helpers import ODD, documents, with_clashing


def test_sizes_and_blocks():
    assert sharding.shard_sizes(10, 4) == [3, 3, 2, 2]
    cut = sharding.blocks(10, 3, 2)
    assert [sum(n for s, _, n in cut if s == k) for k in range(3)] == [4, 3, 3]
    assert all(n <= 2 for _, _, n in cut) and sharding.blocks(0, 3, 2) == []


def test_matrix_rows_add_up():
    counts, sizes = np.array([5, 0, 17, 3]), np.array([10, 9, 6])
    starts = np.concatenate([[0], np.cumsum(counts)])
    rows = [sharding.matrix_row(3, starts, sizes, p) for p in range(4)]
    assert [r.sum() for r, _ in rows] == counts.tolist()
    assert (sum(r for r, _ in rows) == sizes).all()
    for p, (_, before) in enumerate(rows):
        assert (before == sum((r for r, _ in rows[:p]), np.zeros(3, int))).all()


def test_matrix_law():
    """First cell of a 2 x 2 matrix against the hypergeometric probabilities."""
    starts, sizes, n = np.array([0, 4, 10]), np.array([5, 5]), 4000
    seen = Counter(int(sharding.matrix_row(s, starts, sizes, 0)[0][0]) for s in range(n))
    for k in range(5):
        p = math.comb(5, k) * math.comb(5, 4 - k) / math.comb(10, 4)
        assert abs(seen[k] / n - p) < 0.03


def test_large_populations_have_mean_and_spread(monkeypatch):
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(rng, 3 * 10**9, 7 * 10**9, 10_000) for _ in range(400)]
    assert abs(np.mean(big) - 3000) < 12 and 35 < np.std(big) < 57
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    assert [sharding.hypergeometric(rng, 5, 0, 3), sharding.hypergeometric(rng, 0, 5, 3)] == [3, 0]
    got = [sharding.hypergeometric(rng, 5, 5, 4) for _ in range(4000)]
    assert abs(np.mean(np.array(got) == 2) - 100 / 210) < 0.03
    assert sharding.deal(rng, np.array([3, 4, 5]), 12).tolist() == [3, 4, 5]


@pytest.mark.parametrize("block_rows", [3, 20_000])
def test_shards(spark, block_rows):
    texts = ODD * 4
    df = with_clashing(documents(spark, texts, ids=[None, 1, 1, *range(3, len(texts))], partitions=5))
    got = sharding.shard(df, 7, block_rows=block_rows).collect()
    assert Counter(r.row.doc_id for r in got) == Counter(r.doc_id for r in df.collect())
    assert len(got[0].row) == len(df.columns)
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    other = {(r.row.doc_id, r.shard, r.slot) for r in sharding.shard(df, 7, seed=8).collect()}
    assert other != {(r.row.doc_id, r.shard, r.slot) for r in got}


def test_small_tables(spark):
    df = documents(spark, ["a", "b"])
    assert sorted(r.shard for r in sharding.shard(df, 40).collect()) == [0, 1]
    assert sharding.shard(df.limit(0), 40).count() == 0


def test_places_are_uniform(spark):
    """Over seeds, every row is as likely in each shard."""
    df = documents(spark, list("abcdef"), partitions=3)
    seen = Counter()
    for seed in range(40):
        seen.update((r.row.text, r.shard) for r in sharding.shard(df, 2, seed=seed).collect())
    assert all(6 <= seen[t, s] <= 34 for t in "abcdef" for s in (0, 1))


def test_a_partition_is_drawn_once(spark):
    """Several Arrow batches of one partition, several partitions of one task."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = documents(spark, [f"t{i}" for i in range(900)], partitions=4)
    want = sorted((r.row.doc_id, r.shard, r.slot) for r in sharding.shard(df, 5, block_rows=50).collect())
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = sorted((r.row.doc_id, r.shard, r.slot) for r in sharding.shard(df, 5, block_rows=50).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want and len({(s, k) for _, s, k in got}) == 900
