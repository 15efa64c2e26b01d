"""First-fit decreasing packing of token pieces, in randomised groups of documents.

Every document's ids are cut into pieces no longer than a sequence. The
pieces fall at random into groups of bounded size. A group takes its pieces
from the longest down and puts each into the first sequence with enough room,
found by descending a tournament tree whose leaves are the sequences' free
places and whose inner nodes hold the larger of two: O(log n) a piece.

Groups are independent tasks and as large as ``GROUP_PIECES`` on average, so
the work grows linearly; each leaves one part-filled sequence or a few.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import MODELS, as_batch, drop_models, give_back, stage
from entryflow.llm.word_merge import WordMerger, simple_words

GROUP_PIECES = 20_000
#: Tokens of pieces that a task holds before it hands them on.
HELD_TOKENS = 250_000

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Tournament:
    """Free places of up to ``bins`` sequences; the first with room for a piece."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put a piece in; its sequence and the free places there before."""
        tree, node, leaves = self.tree, 1, self.leaves
        while node < leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        bin_, free = node - leaves, tree[node]
        tree[node] = free - length
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return bin_, free


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(sequence, offset) of every piece; equal lengths go in the given order."""
    trees = Tournament(len(lengths), capacity)
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        bin_, free = trees.place(lengths[i])
        out[i] = (bin_, capacity - free)
    return out


class ChunkIds:
    """Ids of whole texts by the tokenizers library.

    The vocabulary ignores white space and merges within words only, so a
    text's ids are those of its chunks between ASCII white space. Arrow cuts
    the texts and numbers the distinct chunks. Of those not met lately, plain
    words are merged together by ``WordMerger``, which gives the library's
    ids; the others are encoded by the library in one call, kept apart by a
    special token. numpy puts the ids of all chunks in order.
    """

    #: Chunks remembered, and bytes of text cut at a time.
    MEMO, SLICE = 120_000, 2_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.coder = Tokenizer.from_file(path)
        special = [(t.content, i) for i, t in self.coder.get_added_tokens_decoder().items()]
        if not special:
            raise ValueError("a vocabulary without special tokens has nothing to keep chunks apart")
        self.mark, self.mark_id = special[0]
        self.special = [text for text, _ in special]
        self.merger = WordMerger(path)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, chunks: list[str]) -> None:
        words: dict[str, int] = {}
        simple, others = [], []
        for chunk in chunks:
            found = simple_words(chunk)
            if found is None:
                others.append(chunk)
            else:
                simple.append((chunk, [words.setdefault(w, len(words)) for w in found]))
        ids, count = self.merger(list(words))
        data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
        at = [0, *ends]
        for chunk, of in simple:
            self.memo[chunk] = b"".join([data[at[w]:at[w + 1]] for w in of])
        self._learn_others(others)

    def _learn_others(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if not any(x in c for x in self.special)]
        for c in set(chunks).difference(plain):
            self.memo[c] = self.ids(c).tobytes()
        ids = self.ids(self.mark.join(plain))
        bounds = np.flatnonzero(ids == self.mark_id).tolist()
        data = ids.tobytes()
        for chunk, a, b in zip(plain, [-1, *bounds], [*bounds, len(ids)]):
            self.memo[chunk] = data[4 * a + 4:4 * b]

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every chunk."""
        if len(self.memo) > self.MEMO:
            self.older, self.memo = self.memo, {}
        new = [c for c in chunks if c not in self.memo]
        self.memo.update({c: self.older[c] for c in new if c in self.older})
        if new := [c for c in new if c not in self.memo]:
            self._learn(new)
        return list(map(self.memo.__getitem__, chunks))

    def encode(self, texts: pa.Array, slice_bytes: int = SLICE) -> Iterator[np.ndarray]:
        """The ids of each text, in order (null: none)."""
        texts = texts.fill_null("")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        a = 0
        while a < len(texts):
            done = sizes[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(sizes, done + slice_bytes, side="right")))
            yield from self._slice(texts.slice(a, z - a))
            a = z

    def _slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        cut = pc.ascii_split_whitespace(texts)
        chunks = cut.flatten().dictionary_encode()
        known = self.chunk_ids(chunks.dictionary.to_pylist())
        table = np.frombuffer(b"".join(known), dtype="<u4")
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        of = chunks.indices.to_numpy()
        count = size[of]
        ends = np.concatenate([[0], np.cumsum(count)])
        # where the ids of each chunk stand in the table, less where they go
        shift = (np.cumsum(size) - size)[of] - ends[:-1]
        ids = table[np.arange(ends[-1]) + np.repeat(shift, count)]
        bounds = ends[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        for a, z in zip(bounds[:-1], bounds[1:]):
            yield ids[a:z]


def coder(path: str) -> ChunkIds:
    """The encoder of a file, loaded once in a Python worker."""
    key = "packing", path
    if key not in MODELS:
        MODELS[key] = ChunkIds(path)
    return MODELS[key]


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, keep_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text",
                 slice_bytes: int = ChunkIds.SLICE) -> DataFrame:
    """Pieces of every document's ids and its end id, in order.

    A null or empty text has the end id alone. With ``keep_ids`` a row also
    carries its ids as ``array<int>``. Null ids and repeated rows stay as they are;
    an empty table gives no rows; a longer text than ``slice_bytes`` is a slice of
    its own. More bytes of text cut at a time cost memory and save some time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = PIECE + ", ids array<int>" * keep_ids
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, ids in zip(batch.column(0).to_pylist(), coder(path).encode(batch.column(1), slice_bytes)):
                ids = np.append(ids, np.uint32(end_id))
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity]
                    row = (doc, start, len(part), zlib.crc32(part), len(ids))
                    rows.append(row + (part.astype(np.int32),) if keep_ids else row)
                held += len(ids)
                if held >= HELD_TOKENS:
                    yield as_batch(dict(zip(schema.names, zip(*rows))), schema)
                    rows, held = [], 0
            if rows:
                yield as_batch(dict(zip(schema.names, zip(*rows))), schema)
            pa.default_memory_pool().release_unused()
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, ddl)


def pack(pieces: DataFrame, capacity: int, seed: int = 42,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Each piece with its ``sequence_id long`` and ``offset long``.

    ``pieces`` has a ``length`` from 1 to ``capacity``; its other columns are
    kept. Rows go to groups by their place in the written table, not by
    their values, so repeated rows and null ids do not meet in one group. An
    empty table gives no rows.
    """
    rows = stage(pieces.select(F.struct("*").alias("piece"), F.col("length"),
                               F.monotonically_increasing_id().alias("at")), "pieces")
    groups = max(1, -(-rows.count() // group_pieces))
    keyed = rows.withColumn("grp", F.pmod(F.xxhash64("at", F.lit(seed)), F.lit(groups)))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        drop_models()  # all pieces are written
        part = part.sort_values("at")
        spots = first_fit_decreasing(part["length"].tolist(), capacity)
        first = int(part["grp"].iloc[0]) << 32
        return pd.DataFrame({"at": part["at"].to_numpy(),
                             "sequence_id": [first + b for b, _ in spots],
                             "offset": [o for _, o in spots]})

    spots = (keyed.select("grp", "at", "length").groupBy("grp")
             .applyInPandas(packed, "at long, sequence_id long, offset long"))
    return rows.join(spots, "at").select("piece.*", "sequence_id", "offset")
