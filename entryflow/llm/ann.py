"""Nearest neighbours by inner product with an adaptive dimension scan.

Vectors get one more component so that the largest inner product becomes the
smallest distance, and are rotated at random: the first dimensions then tell
a bounded, unbiased part of every distance. They lie in inverted lists
around k-means centres. A query probes the lists of its nearest centres;
there, distances grow by blocks of columns, and after each block a candidate
is abandoned when a hypothesis test says that its whole distance exceeds
that of the k-th best so far. Survivors are scored exactly, in double
precision, on the original vectors.

Centres are fitted on a bounded sample (``TRAIN_ROWS``), on which the number of
lists to probe is measured too: vectors without clusters need most lists,
clustered ones few. Every vector is indexed. A list is cut into chunks of about ``CHUNK_ROWS`` vectors and its
queries into batches of about ``BATCH_QUERIES``, so that a task holds one
chunk and one batch however large a list is. What is broadcast is the centres
and list sizes (``MAX_LISTS`` at most).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from entryflow.llm.common import stage

MAX_LISTS = 2048
TRAIN_ROWS = 30_000
#: Probed lists hold this share of the true neighbours of sampled queries.
PROBE_RECALL, PROBE_QUERIES = 0.97, 256
CHUNK_ROWS, BATCH_QUERIES = 20_000, 5_000
#: Pairs of queries and vectors that a task scans at a time.
SCAN_PAIRS = 1_000_000
#: Columns of a block, and how sure a test is before it abandons a candidate.
BLOCK_COLUMNS, EPSILON = 16, 2.1


def element_type(vectors: DataFrame, vector_col: str) -> str:
    kind = vectors.schema[vector_col].dataType.simpleString()
    return "float" if kind == "array<float>" else "double"


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: ids with non-zero vectors of finite components, of the commonest length."""
    v = F.col("v")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast(f"array<{element_type(vectors, vector_col)}>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull()
                   & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
                   & F.exists(v, lambda x: x != 0)))
    length = (rows.groupBy(F.size("v").alias("n")).count()
              .orderBy(F.desc("count"), F.desc("n")).first())
    return rows.where(F.size("v") == (length["n"] if length else 0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


class Space:
    """The added component, the rotation and the centres."""

    def __init__(self, width: int, longest: float, seed: int):
        self.width, self.longest = width, longest
        turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((width + 1, width + 1)))
        self.turn = turn
        self.centres = np.zeros((1, width + 1))

    def stored(self, x: np.ndarray) -> np.ndarray:
        """Vectors on a sphere of the longest norm, rotated."""
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest]) @ self.turn

    def asked(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.turn

    def to_centres(self, y: np.ndarray) -> np.ndarray:
        """Squared distances to the centres, without the vectors' own norm."""
        return (self.centres * self.centres).sum(1) - 2 * y @ self.centres.T

    def fit(self, y: np.ndarray, lists: int, seed: int, rounds: int = 12) -> None:
        """k-means; an emptied centre restarts at a random vector."""
        rng = np.random.default_rng(seed)
        self.centres = y[rng.permutation(len(y))[:lists]].copy()
        for _ in range(rounds):
            of = self.to_centres(y).argmin(1)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, of, y)
            n = np.bincount(of, minlength=len(self.centres))
            sums[n == 0] = y[rng.integers(0, len(y), int((n == 0).sum()))]
            self.centres = sums / np.maximum(n, 1)[:, None]

    def measure_probes(self, x: np.ndarray, k: int, seed: int) -> int:
        """Lists that sampled queries must probe for ``PROBE_RECALL`` of their neighbours in ``x``."""
        if len(x) < 2:
            return 1
        at = np.random.default_rng(seed).permutation(len(x))[:PROBE_QUERIES]
        scores = x[at] @ x.T
        scores[np.arange(len(at)), at] = -np.inf
        k = min(k, len(x) - 1)
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        order = self.to_centres(self.asked(x[at])).argsort(1)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(order.shape[1])[None].repeat(len(at), 0), 1)
        of = self.to_centres(self.stored(x)).argmin(1)
        needed = np.sort(np.take_along_axis(place, of[near], 1).ravel())
        return int(needed[math.ceil(PROBE_RECALL * len(needed)) - 1]) + 1


def adaptive_scan(queries: np.ndarray, rows: np.ndarray, k: int,
                  allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs whose distance was not abandoned, by query; the ``k`` nearest
    rows of a query are among them unless a test erred.

    ``allowed`` masks pairs that count. Distances of all pairs grow block by
    block, in bulk while most pairs live and pair by pair when few do.
    """
    width, n = queries.shape[1], len(rows)
    if allowed is None:
        allowed = np.ones((len(queries), n), dtype=bool)
    if n <= k:
        return np.nonzero(allowed)
    every = np.arange(len(queries))[:, None]

    def far(a, b):
        """Squared distances over columns a to b, all pairs."""
        q, x = queries[:, a:b], rows[:, a:b]
        return (q * q).sum(1)[:, None] + (x * x).sum(1) - 2 * q @ x.T

    partial = np.where(allowed, far(0, BLOCK_COLUMNS), np.inf)
    limit = np.full(len(queries), np.inf)
    seen = min(BLOCK_COLUMNS, width)
    while True:
        near = np.argpartition(partial, k - 1, axis=1)[:, :k]
        whole = ((rows[near] - queries[:, None]) ** 2).sum(2)
        whole[np.isinf(partial[every, near])] = np.inf
        limit = np.minimum(limit, whole.max(1))  # k rows are no farther
        spare = (1 + EPSILON / math.sqrt(seen)) ** 2 * seen / width if seen < width else 1.0
        partial[partial > (spare * limit * (1 + 1e-9) + 1e-12)[:, None]] = np.inf
        if seen == width:
            return np.nonzero(np.isfinite(partial))
        b = min(seen + BLOCK_COLUMNS, width)
        at = np.nonzero(np.isfinite(partial))
        if len(at[0]) * 8 > partial.size:
            partial += far(seen, b)
        else:
            partial[at] += ((queries[at[0], seen:b] - rows[at[1], seen:b]) ** 2).sum(1)
        seen = b


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", probes: int | None = None, seed: int = 42) -> DataFrame:
    """``query_id long, rank int, id long, score double``: each query's ``k`` nearest found.

    ``is_query`` is a condition on ``id``; ``probes`` is measured unless given. Candidates are all usable rows but
    those with the query's id. Null ids and vectors, zero vectors, vectors
    with null or non-finite components and of another length than the
    commonest take no part. Ties go to the smaller id; rows with an equal id
    and score count once. With ``k`` candidates or fewer, all are returned;
    an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stage(usable_vectors(vectors, id_col, vector_col), "ann_vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total = rows.agg(F.count(F.lit(1)), F.max(norm), F.max(F.size("v"))).first()
    n, longest, width = total[0], math.sqrt(total[1] or 0.0), total[2] or 0
    space = Space(width, longest, seed)
    if n:
        share = max(1, -(-n // TRAIN_ROWS))
        sample = (rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(share)) == 0)
                  .select("v").limit(2 * TRAIN_ROWS).toArrow())
        if not sample.num_rows:
            sample = rows.select("v").limit(1).toArrow()
        x = matrix(sample["v"], width)
        space.fit(space.stored(x), min(MAX_LISTS, max(1, int(math.sqrt(n) / 2))), seed)
        probes = probes or space.measure_probes(x, k, seed)
    shared = spark.sparkContext.broadcast(space)

    kind = element_type(vectors, vector_col)
    v_type = pa.list_(pa.float32() if kind == "float" else pa.float64())

    def assign(batches):
        schema = pa.schema([("id", pa.int64()), ("v", v_type), ("list", pa.int32())])
        for b in batches:
            if b.num_rows:
                of = shared.value.to_centres(shared.value.stored(matrix(b.column(1), width))).argmin(1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(schema[1].type),
                                                  pa.array(of, pa.int32())], schema=schema)

    listed = stage(rows.mapInArrow(assign, f"id long, v array<{kind}>, list int"), "ann_lists")
    sizes = np.zeros(len(space.centres), dtype=np.int64)
    for r in listed.groupBy("list").count().collect():  # MAX_LISTS rows at most
        sizes[r["list"]] = r["count"]
    shared_sizes = spark.sparkContext.broadcast(sizes)

    def probe(batches):
        schema = pa.schema([("id", pa.int64()), ("v", v_type), ("lists", pa.list_(pa.int32()))])
        for b in batches:
            if not b.num_rows:
                continue
            order = shared.value.to_centres(shared.value.asked(matrix(b.column(1), width))).argsort(1)
            # as many lists as asked for, or until they hold enough candidates
            held = np.cumsum(shared_sizes.value[order], axis=1)
            need = np.maximum(probes, (held < 4 * k + 1).sum(1) + 1)
            lists = pa.array([o[:c] for o, c in zip(order, need)], schema[2].type)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(v_type), lists],
                                             schema=schema)

    asked = (listed.where(is_query(F.col("id"))).select("id", "v")
             .mapInArrow(probe, f"id long, v array<{kind}>, lists array<int>")
             .select("id", "v", F.explode("lists").alias("list")))
    asked = stage(asked, "ann_probes")
    batches = {r["list"]: -(-r["count"] // BATCH_QUERIES)
               for r in asked.groupBy("list").count().collect()}
    chunks = {i: -(-int(s) // CHUNK_ROWS) for i, s in enumerate(sizes) if s}
    grid = spark.createDataFrame([(i, c, batches[i]) for i, c in chunks.items() if i in batches],
                                 "list int, chunks int, batches int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (asked.join(F.broadcast(grid), "list")
            .withColumn("batch", F.pmod(F.xxhash64("id"), F.col("batches")).cast("int"))
            .select("list", "batch", upto("chunks").alias("chunk"), "id", "v"))
    right = (listed.join(F.broadcast(grid), "list")
             .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
             .select("list", upto("batches").alias("batch"), "chunk", "id", "v"))
    cell = ["list", "batch", "chunk"]

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            space, ids = shared.value, candidates["id"].to_numpy()
            x, q = matrix(candidates["v"], width), matrix(queries["v"], width)
            own, stored, asked = queries["id"].to_numpy(), space.stored(x), space.asked(q)
            step = max(1, SCAN_PAIRS // len(x))
            for a in range(0, len(q), step):
                of, row = adaptive_scan(asked[a:a + step], stored, k, own[a:a + step, None] != ids)
                of += a
                # row by row, so that equal vectors get equal scores
                score = (x[row] * q[of]).sum(1)
                order = np.lexsort((ids[row], -score, of))
                of, row, score = of[order], row[order], score[order]
                first = np.searchsorted(of, of)
                best = np.arange(len(of)) - first < k
                out["query_id"].append(own[of[best]])
                out["id"].append(ids[row[best]])
                out["score"].append(score[best])
        empty = np.empty(0)
        return pa.table({c: pa.array(np.concatenate(v) if v else empty, t) for (c, v), t in
                         zip(out.items(), (pa.int64(), pa.int64(), pa.float64()))})

    hits = (left.groupBy(*cell).cogroup(right.groupBy(*cell))
            .applyInArrow(search, "query_id long, id long, score double").distinct())
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
