"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows lie in partitions of known counts; the targets are blocks of slots,
a shard being one block or several. The matrix of how many rows each
partition sends to each block is drawn exactly: its law is multivariate
hypergeometric, and it is drawn down a binary tree over the partitions, each
node splitting its blocks' places between its two halves with a generator
seeded by the node. So a task finds its own row of the matrix, and how many
rows earlier partitions put in each block, without the rest of the matrix.
Rows are permuted within their partition, dealt by the counts, exchanged, and
permuted again within their block: every order of all rows is equally likely,
and no shard's size depends on chance.

The input is written once with a row number per partition, so a lost executor
or a changed partitioning cannot deal a row twice. The driver holds one count
per partition. A block is at most ``BLOCK_ROWS`` rows, whatever the shard's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from entryflow.llm.common import stage

BLOCK_ROWS = 20_000
#: Tasks that blocks are dealt to at most; below that, about a block a task.
MOST_TASKS = 50_000
#: numpy draws hypergeometric numbers below this population only.
NUMPY_LIMIT = 1_000_000_000


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Row counts that differ by one at most, the larger first."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def blocks(rows: int, shards: int, block_rows: int) -> list[tuple[int, int, int]]:
    """(shard, first slot, rows) of every block."""
    out = []
    for s, size in enumerate(shard_sizes(rows, shards)):
        cuts = shard_sizes(size, -(-size // block_rows)) if size else []
        first = 0
        for n in cuts:
            out.append((s, first, n))
            first += n
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` items drawn without replacement are good.

    Beyond numpy's population limit the distribution is summed over 12
    standard deviations each side of its mean and inverted.
    """
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if good and draws else 0
    total = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    mean = draws * good / total
    spread = 12 * np.sqrt(mean * (bad / total) * ((total - draws) / max(1, total - 1))) + 12
    low, high = max(low, int(mean - spread)), min(high, int(mean + spread) + 1)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def deal(rng: np.random.Generator, places: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric: how many of ``draws`` rows fall to each block's places."""
    out = np.zeros_like(places)
    rest = int(places.sum())
    if rest < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(places, draws, method="marginals")
    for i, n in enumerate(places.tolist()):
        out[i] = got = hypergeometric(rng, n, rest - n, draws)
        rest, draws = rest - n, draws - got
    return out


def matrix_row(seed: int, starts: np.ndarray, sizes: np.ndarray,
               part: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that ``part`` sends to each block, and rows sent there by the parts before.

    ``starts``: rows before each partition, and the number of all rows.
    """
    low, high = 0, len(starts) - 1
    places, before = sizes.copy(), np.zeros_like(sizes)
    while high - low > 1:
        mid = (low + high) // 2
        left = deal(np.random.default_rng([seed, low, high]), places,
                    int(starts[mid] - starts[low]))
        if part < mid:
            places, high = left, mid
        else:
            places, before, low = places - left, before + left, mid
    return places, before


def shard(docs: DataFrame, shards: int, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All columns of ``docs`` under ``row``, with ``shard int`` and ``slot long``.

    Shard sizes differ by one at most; slots are gapless from 0 in each
    shard. Values do not matter, so nulls, long texts, repeated rows and any
    column names are dealt like other rows. An empty table gives no rows;
    with fewer rows than shards the last shards are empty.
    """
    spark = docs.sparkSession
    rows = stage(docs.select(F.struct("*").alias("row"),
                             F.monotonically_increasing_id().alias("at")), "shard_input")
    part = F.shiftright("at", 33)
    counts = {r["part"]: r["n"] for r in
              rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    index = {p: i for i, p in enumerate(sorted(counts))}
    starts = np.concatenate([[0], np.cumsum([counts[p] for p in sorted(counts)])]).astype(np.int64)
    plan = blocks(int(starts[-1]), shards, block_rows)
    sizes = np.array([n for _, _, n in plan], dtype=np.int64)
    firsts = np.array([first for _, first, _ in plan], dtype=np.int64)
    of_shard = np.array([s for s, _, _ in plan], dtype=np.int32)
    shared = spark.sparkContext.broadcast((index, starts, sizes, firsts, of_shard))

    place = StructType([StructField("block", LongType()), StructField("rank", LongType())])

    @F.pandas_udf(place)
    def dealt(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, starts, sizes, _, _ = shared.value
        drawn = None  # a partition's row of the matrix and its order are drawn once
        for at in parts:
            at = at.to_numpy()
            out = np.empty((len(at), 2), dtype=np.int64)
            for p in np.unique(at >> 33).tolist():
                i = index[p]
                if drawn is None or drawn[0] != i:
                    sent, before = matrix_row(seed, starts, sizes, i)
                    block = np.repeat(np.arange(len(sizes)), sent)
                    cell = np.repeat(np.cumsum(sent) - sent, sent)
                    rank = before[block] + np.arange(len(block)) - cell
                    order = np.random.default_rng([seed, 1, i]).permutation(len(block))
                    drawn = i, block[order], rank[order]
                here = at >> 33 == p
                pos = at[here] & ((1 << 33) - 1)
                out[here, 0], out[here, 1] = drawn[1][pos], drawn[2][pos]
            yield pd.DataFrame({"block": out[:, 0], "rank": out[:, 1]})

    spot = StructType([StructField("shard", IntegerType()), StructField("slot", LongType())])

    @F.pandas_udf(spot)
    def permuted(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        _, _, sizes, firsts, of_shard = shared.value
        drawn = None  # rows come block by block
        for block, rank in parts:
            block, rank = block.to_numpy(), rank.to_numpy()
            slots = np.empty(len(block), dtype=np.int64)
            for b in np.unique(block).tolist():
                if drawn is None or drawn[0] != b:
                    drawn = b, np.random.default_rng([seed, 2, b]).permutation(int(sizes[b]))
                here = block == b
                slots[here] = firsts[b] + drawn[1][rank[here]]
            yield pd.DataFrame({"shard": of_shard[block], "slot": slots})

    dealt_rows = rows.withColumn("to", dealt("at")).select("row", "to.block", "to.rank")
    tasks = max(1, min(len(plan), MOST_TASKS))
    placed = (dealt_rows.repartition(tasks, "block").sortWithinPartitions("block")
              .withColumn("spot", permuted("block", "rank")))
    return (placed.select("row", "spot.shard", "spot.slot")
            .sortWithinPartitions("shard", "slot"))
