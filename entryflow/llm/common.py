"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from entryflow.session import scratch_path

_ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def ascii_lower(text: str) -> str:
    return text.translate(_ASCII_LOWER)


class Staged(threading.local):
    """Folders that ``stage`` writes, as told to those who watch (in the same thread)."""

    def __init__(self):
        self._lists: list[list[str]] = []

    @contextmanager
    def watched(self) -> Iterator[list[str]]:
        """A list of the folders written, and not deleted again, while the block runs."""
        self._lists.append([])
        try:
            yield self._lists[-1]
        finally:
            own = self._lists.pop()
            for outer in self._lists[-1:]:
                outer.extend(own)

    def add(self, path: str) -> None:
        for innermost in self._lists[-1:]:
            innermost.append(path)


STAGED = Staged()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back.

    This cuts the lineage: a lost executor makes Spark reread files, not
    recompute the steps before, and rows that carry generated ids keep them.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    STAGED.add(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reads_from(df: DataFrame) -> set[str]:
    """The folders that a DataFrame reads (not their files), as they were named."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if (leaf.getClass().getSimpleName() == "LogicalRelation"
                and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation"):
            roots = leaf.relation().location().rootPaths()
            found |= {roots.apply(k).toString() for k in range(roots.size())}
    return {p for r in found for p in (r, r.removeprefix("file:"), r.replace("file:/", "file:///", 1))}


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stage`` wrote, wherever the scratch folder is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, Iterable]],
             schema: str) -> DataFrame:
    """Apply ``fn`` to Arrow batches given as Python lists by column name.

    ``fn`` returns the output columns by name (any number of rows); their
    Arrow types follow ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_models()
        for batch in batches:
            for b in parts(batch):
                cols = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
                yield as_batch(cols, out)
        give_back()

    return df.mapInArrow(run, schema)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` of ``mapInArrow`` in a worker that first drops other steps' models, and gives memory back."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_models()
        yield from run(batches)
        give_back()

    return tidied


#: Large models that a Python worker keeps for the next task of the same step; the first
#: task of another step, in a worker that it takes over, drops them.
MODELS: dict[tuple[str, str], object] = {}


def drop_models() -> None:
    if MODELS:
        MODELS.clear()
        give_back()


#: Bytes of an Arrow batch that are Python objects at a time, about.
PART_BYTES = 4_000_000


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of some ``PART_BYTES``: Arrow's hold many rows, however long those are."""
    step = max(1, batch.num_rows // max(1, -(-batch.nbytes // PART_BYTES)))
    for a in range(0, batch.num_rows, step):
        yield batch.slice(a, step)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on for other stages, and what
    Arrow and the C library keep for themselves counts as theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no such call in this C library
        pass


def as_batch(cols: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(cols[f.name], type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (xor-shift and odd multipliers)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# Odd, so that it has an inverse modulo 2**64; any such number of many digits will do.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(b" \t\n\v\f\r")] = True
_INSIDE = (~_SPACE).tobytes()
#: Bytes hashed at a time; a longer text is cut between words.
_PIECE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:  # double what is there
        step = np.uint64(pow(base, len(out), 1 << 64))
        out = np.concatenate([out, out * step])
    return out[:n]


class _Powers:
    """Powers of the base and of its inverse, as many as the texts so far needed."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1 << 12), _powers(_BASE_INVERSE, 1 << 12)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
        return self.up, self.down


_POWERS = _Powers()


def hashed_words(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of a UTF-8 text (as ``bytes.split`` cuts it), in order.

    A word's hash is a polynomial of its bytes, scrambled; differences of one
    running sum give all words of a text at once. ``lower`` lower-cases A-Z.
    """
    if len(data) <= _PIECE:
        return _piece_hashes(data, lower)
    spaces = np.flatnonzero(_SPACE[np.frombuffer(data, dtype=np.uint8)])
    cuts = [0]
    while len(data) - cuts[-1] > _PIECE:
        i = np.searchsorted(spaces, cuts[-1] + _PIECE)
        if i == len(spaces):
            break
        cuts.append(int(spaces[i]))
    found = [_piece_hashes(data[a:z], lower) for a, z in zip(cuts, [*cuts[1:], len(data)])]
    return (np.concatenate([a + start for a, (start, _) in zip(cuts, found)]),
            np.concatenate([h for _, h in found]))


def word_hashes(data: bytes, lower: bool = False) -> np.ndarray:
    """The hashes of ``hashed_words``."""
    return hashed_words(data, lower)[1]


def _piece_hashes(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = np.frombuffer(data.translate(_INSIDE), dtype=bool)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return start, np.empty(0, dtype=np.uint64)
    up, down = _POWERS.get(len(data))
    values = np.add(np.frombuffer(data.lower() if lower else data, dtype=np.uint8), 1, dtype=np.uint64)
    values *= up[:len(data)]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return start, mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def span_hashes(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the sequences of words [start, end), of the words' hashes ``h``, in the same way."""
    up, down = _POWERS.get(len(h) + 1)
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all windows of ``k`` words in order; a shorter non-empty text is one window."""
    n = len(h)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    size = min(k, n)
    acc = np.full(n - size + 1, size, dtype=np.uint64)
    for i in range(size):
        acc = acc * np.uint64(0x9FB21C651E98DF25) + h[i:n - size + 1 + i]
    return mix64(acc)


def squeeze(a: np.ndarray) -> bytes:
    """64-bit numbers as compressed byte planes."""
    import zstandard
    planes = np.ascontiguousarray(a, dtype="<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(data: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


def squeeze_keys(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_keys(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=np.uint64)
