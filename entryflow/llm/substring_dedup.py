"""Repeated passages by paragraph MinHash banding.

Paragraphs are a text's lines. Each paragraph's 5-word shingles get MinHash
values, combined into bands; the number of bands and rows is tuned so that
paragraphs of the wanted similarity collide almost surely. Colliding
paragraphs are verified by exact Jaccard similarity of their shingles and
clustered into components. A passage can also stand inside a longer
paragraph; so sentences are units too, matched by their whole hash.

A passage may begin and end anywhere, without any punctuation. So windows of
``RUN_WORDS`` words are matched, too: of any ``RUN_WINDOW`` successive ones the
least hash is picked, hence an equal run of ``RUN_WORDS + RUN_WINDOW - 1`` words
holds a pick in every document. Around picks that repeat, all windows are
compared, which finds the run's first and last word.

Units of one component that stand in different documents are repeats. Those
that follow each other in a document form a region, and regions of
``REGION_WORDS`` words or more are reported; short phrases that happen to
repeat are none. Of each component the first occurrence (least id, then
place) is kept, the others are removed.

A band's key is first brought together within a task: only the task's pivot of
the key goes into the exchange, the other members are paired with it at once.
So equal paragraphs of very many documents cost the exchange a row per task,
and nothing pairs all members of a bucket. Members that are not similar to their
pivot can be so to each other: keys whose members lie in several components are
then compared across components, in tiles. Verification reads the documents
that hold a colliding paragraph's first occurrence, once each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from entryflow.llm.common import (STAGED, as_batch, expand_keys, hashed_words, map_rows, mix64, reads_from,
                                  remove_folder, shingle_hashes, span_hashes, squeeze_keys, stage, tidy, utf8,
                                  word_hashes)
from entryflow.llm.graph import components
from entryflow.llm.ngram_join import spanning

SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Chance that two paragraphs of that similarity collide, and hash values to spend on it.
RECALL, MAX_HASHES = 0.999, 32
#: Words of a unit and of a region at least.
UNIT_WORDS, REGION_WORDS = 5, 30
#: Words of a window of a run, and successive windows of which one is picked.
RUN_WORDS, RUN_WINDOW = 8, 18
#: Words on each side of a repeated pick whose windows are compared.
REACH = 50
#: Words between two parts of a region at most, if no unit stands between them.
GAP_WORDS = UNIT_WORDS - 1
#: Paragraphs that a task brings together at a time, and shingles hashed at a time.
GATHER, CACHED = 50_000, 1 << 15
#: Rows of a range of keys, about, and ranges where their number is not known.
RANGE_ROWS, RANGES = 200_000, 16
#: Characters of texts whose words are hashed together.
TOGETHER = 1 << 15
#: Members of a tile's side, and shingles of a tile that are compared at a time.
TILE, SLICE = 500, 4096

_SENTENCE_END = re.compile(r"[.!?]+(?=\s)")
# Tables of bytes: sentence signs, white space, and what odd white space begins with.
_SIGN, _SPACE = (bytes(b in x for b in range(256)) for x in (b".!?", b" \t\n\v\f\r"))
_ODD = bytes(0x1c <= b <= 0x1f or b >= 0x80 for b in range(256))
# Sentence ends before white space that parts no words; there, a word ends nevertheless.
_ODD_END = re.compile(r"[.!?]+(?=[^\S \t\n\v\f\r])")


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL,
               max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands reach ``recall`` within ``max_hashes``."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = similarity ** rows
        bands = 1 if p >= recall else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("max_hashes is too small for the wanted recall")
    return best


# -- units -----------------------------------------------------------------

def _hash(words: list[bytes]) -> int:
    h = word_hashes(b" ".join(words))
    return int(span_hashes(h, np.array([0]), np.array([len(h)])).view(np.int64)[0])


def paragraphs(text: str | None) -> Iterator[tuple[int, list[tuple[int, int, list[bytes]]]]]:
    """(start, sentences) of every line; sentences as (start, end, lower-cased words)."""
    at = 0
    for line in (text or "").split("\n"):
        sentences, last = [], 0
        for end in [m.end() for m in _SENTENCE_END.finditer(line)] + [len(line)]:
            ws = line[last:end].encode("utf-8", "surrogatepass").lower().split()
            if ws:
                sentences.append((at + last, at + end, ws))
            last = end
        yield at, sentences
        at += len(line) + 1


UNIT = "id long, ord int, n int, w_start int, w_end int, start int, end int, hash long, line boolean"
UNIT_FIELDS = [c.split()[0] for c in UNIT.split(", ")]
_UNIT_TYPES = [{"long": np.int64, "int": np.int32, "boolean": bool}[c.split()[1]] for c in UNIT.split(", ")]


def units(text: str | None) -> list[tuple]:
    """Lines and, in lines of several sentences, sentences of ``UNIT_WORDS`` words or more.

    Sentences are numbered through the text; a line covers ``n`` numbers from ``ord``.
    """
    out, number, word = [], 0, 0
    for _, sentences in paragraphs(text):
        if not sentences:
            continue
        first, w = number, word
        for start, end, ws in sentences:
            if len(ws) >= UNIT_WORDS:
                if len(sentences) > 1:
                    out.append((number, 1, w, w + len(ws), start, end, _hash(ws), False))
                number += 1
            w += len(ws)
        if w - word >= UNIT_WORDS:
            number += number == first  # a line of short sentences takes a number, too
            whole = [x for _, _, ws in sentences for x in ws]
            out.append((first, number - first, word, w, sentences[0][0], sentences[-1][1],
                        _hash(whole), True))
        word = w
    return out


def unit_rows(rows: DataFrame) -> DataFrame:
    """All units of ``id, text`` rows, written to the shared folder."""
    def run(cols):
        ids, names = np.array(cols["id"], dtype=np.int64), UNIT_FIELDS
        found = [(ids[a + of], *fields) for a, texts in slices(cols["text"]) for of, *fields in [units_of(texts)]]
        return dict(zip(names, map(np.concatenate, zip(*found)))) if found else {n: [] for n in names}

    return stage(map_rows(rows, run, UNIT), "units")


def words_apart(text: str | None) -> bytes:
    """The text in UTF-8, lower-cased, so that ``bytes.split`` cuts it into the words of ``paragraphs``."""
    return utf8(_ODD_END.sub(lambda m: m[0] + " ", text or "")).lower()


def slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """The texts in slices of some ``TOGETHER`` characters, each with its first one's place."""
    a, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= TOGETHER or i == len(texts) - 1:
            yield a, [t or "" for t in texts[a:i + 1]]
            a, size = i + 1, 0


def bytes_in(data: bytes, which: bytes) -> np.ndarray:
    """Which bytes are marked in a table."""
    return np.frombuffer(data.translate(which), dtype=bool)


class SliceWords:
    """The words of the texts of a slice, hashed together. A line break parts the texts.

    ``data`` is what ``words_apart`` gives, ``plain`` says that it has the texts' own bytes;
    ``ends`` are the texts' ends there, ``bounds`` their first words (and the end),
    ``starts`` and ``hashes`` the words'.
    """

    def __init__(self, texts: list[str]):
        whole = "\n".join(texts)
        self.data = utf8(whole).lower()
        self.ascii = whole.isascii()
        sign, odd = (bytes_in(self.data, x) for x in (_SIGN, _ODD))
        self.plain = not (sign[:-1] & odd[1:]).any() or _ODD_END.search(whole) is None
        if self.plain:
            sizes = [len(t) if self.ascii else len(utf8(t)) for t in texts]
        else:
            self.data = words_apart(whole)
            sizes = [len(words_apart(t)) for t in texts]
        self.ends = np.cumsum(np.array(sizes, dtype=np.int64) + 1) - 1
        self.starts, self.hashes = hashed_words(self.data)
        self.bounds = np.concatenate([[0], np.searchsorted(self.starts, self.ends)])

    def before(self, places: np.ndarray) -> np.ndarray:
        """Words that start before each place."""
        return np.searchsorted(self.starts, places)


def units_of(texts: list[str]) -> tuple[np.ndarray, ...]:
    """The ``units`` of a slice, as columns; the first is the text's place in the slice."""
    words = SliceWords(texts)
    if not words.plain:  # rare
        found = [(i, *u) for i, t in enumerate(texts) for u in units(t)]
        return tuple(np.array(c, dtype=t) for c, t in zip(zip(*found) if found else [[]] * 9, _UNIT_TYPES))
    data = words.data + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    # a sentence ends after its signs, before white space; a line at its break
    cut = raw == 10
    cut[1:] |= bytes_in(data, _SIGN)[:-1] & bytes_in(data, _SPACE)[1:]
    cut = np.flatnonzero(cut)
    breaks = raw[cut] == 10
    last = np.concatenate([[0], cut[:-1] + breaks[:-1]])
    w = words.before(cut)
    w_before = np.concatenate([[0], w[:-1]])
    line = np.cumsum(breaks) - breaks
    some = np.flatnonzero(w > w_before)  # sentences with a word
    if not len(some):
        return tuple(np.empty(0, dtype=t) for t in _UNIT_TYPES)
    start, end, a, z, line = last[some], cut[some], w_before[some], w[some], line[some]
    of = np.searchsorted(words.ends, end)
    if not words.ascii:
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        start, end = points[start], points[end]
        offset = points[np.concatenate([[0], words.ends[:-1] + 1])]
    else:
        offset = np.concatenate([[0], words.ends[:-1] + 1])
    start, end = start - offset[of], end - offset[of]
    hit = z - a >= UNIT_WORDS
    # the lines, by their first and last sentences
    head = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    tail = np.append(head[1:], len(line)) - 1
    size = np.diff(np.append(head, len(line)))
    long_line = z[tail] - a[head] >= UNIT_WORDS
    inside = np.add.reduceat(hit.astype(np.int64), head)
    taken = inside + (long_line & (inside == 0))  # a line of short sentences takes a number, too
    number = np.cumsum(taken) - taken
    line_of = of[head]
    new = np.concatenate([[True], line_of[1:] != line_of[:-1]])
    number -= number[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    within = np.cumsum(hit) - hit
    order = np.repeat(number - within[head], size) + within
    one = np.flatnonzero(hit & (np.repeat(size, size) > 1))
    whole = np.flatnonzero(long_line)
    h, t = head[whole], tail[whole]
    first, end_word = np.concatenate([a[one], a[h]]), np.concatenate([z[one], z[t]])
    text = np.concatenate([of[one], of[h]])
    columns = (text, np.concatenate([order[one], number[whole]]),
               np.concatenate([np.ones(len(one), dtype=np.int64), taken[whole]]),
               first - words.bounds[text], end_word - words.bounds[text],
               np.concatenate([start[one], start[h]]), np.concatenate([end[one], end[t]]),
               span_hashes(words.hashes, first, end_word).view(np.int64),
               np.arange(len(text)) >= len(one))
    return tuple(c.astype(t) for c, t in zip(columns, _UNIT_TYPES))


def line_shingles(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """Hash and shingles, in order, of every line that is a unit (views of one array)."""
    return ((h, s) for _, h, s in lines_of([text or ""]))


def lines_of(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``line_shingles`` of a slice, each with its text's place."""
    words = SliceWords(texts)
    shingles = shingle_hashes(words.hashes, SHINGLE_WORDS)
    cut = np.flatnonzero(np.frombuffer(words.data + b"\n", dtype=np.uint8) == 10)
    z = words.before(cut)
    a = np.concatenate([[0], z[:-1]])
    hit = np.flatnonzero(z - a >= UNIT_WORDS)
    a, z, of = a[hit], z[hit], np.searchsorted(words.ends, cut[hit])
    hashes = span_hashes(words.hashes, a, z).view(np.int64)
    for i, h, x, y in zip(of.tolist(), hashes.tolist(), a.tolist(), (z - SHINGLE_WORDS + 1).tolist()):
        yield i, h, shingles[x:y]


# -- banding ---------------------------------------------------------------

def band_keys(sets: list[np.ndarray], bands: int, rows: int, seed: int = 7) -> np.ndarray:
    """(paragraphs, bands) keys; a band's number is part of its keys."""
    factors = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(seed)) | np.uint64(1)
    out = np.empty((len(sets), bands), dtype=np.uint64)
    sizes = np.cumsum([len(s) for s in sets])
    a = 0
    while a < len(sets):  # slices that stay in the processor's cache
        done = sizes[a - 1] if a else 0
        z = max(a + 1, int(np.searchsorted(sizes, done + CACHED, side="right")))
        flat = np.concatenate(sets[a:z])
        starts = np.concatenate([[0], sizes[a:z - 1] - done]).astype(np.int64)
        for b in range(bands):
            acc = np.full(z - a, b, dtype=np.uint64)
            for f in factors[b * rows:(b + 1) * rows]:
                scrambled = flat * f
                scrambled ^= scrambled >> np.uint64(32)
                scrambled *= f
                acc = mix64(acc + np.minimum.reduceat(scrambled, starts))
            out[a:z, b] = acc
        a = z
    return out


def _runs(keys: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by key and member: keys, each one's least member, members; repeats dropped."""
    order = np.lexsort((members, keys))
    k, m = keys[order], members[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
    k, m = k[new], m[new]
    first = np.ones(len(k), dtype=bool)
    first[1:] = k[1:] != k[:-1]
    return k, m[np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))], m


def by_ranges(rows: DataFrame, make: Callable, columns: dict[str, str], ranges: int, use: Callable,
              schema: str) -> DataFrame:
    """What ``use`` makes of the columns that ``make`` yields of its batches, a range of ``key`` at a time.

    A row per number would cost more to move than to use; a row holds a batch's numbers of a range.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    held_schema = pa.schema([("part", pa.int32()), *((n, pa.binary()) for n in columns)])
    used_schema = to_arrow_schema(StructType.fromDDL(schema))

    def hand_out(batches):
        for cols in make(batches):
            part = ((cols["key"].view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            starts, ends = _spans(part[order])
            held = {n: cols[n][order] for n in columns}
            yield as_batch({"part": part[order][starts],
                            **{n: [c[a:z].tobytes() for a, z in zip(starts, ends)] for n, c in held.items()}},
                           held_schema)

    def take(group: pa.Table) -> pa.Table:
        cols = {n: np.frombuffer(b"".join(group[n].to_pylist()), dtype=t) for n, t in columns.items()}
        return pa.Table.from_batches([as_batch(use(cols), used_schema)])

    return (rows.mapInArrow(tidy(hand_out), "part int, " + ", ".join(f"{n} binary" for n in columns))
            .groupBy("part").applyInArrow(take, schema))


def candidate_pairs(rows: DataFrame, bands: int, band_rows: int, ranges: int = RANGES) -> DataFrame:
    """Distinct ``a long, b long``: paragraphs that share a band's key with its pivot."""
    def local(batches):
        hashes, sets = {}, []  # minima need no distinct shingles

        def flush():
            keys = band_keys(sets, bands, band_rows).ravel()
            of = np.repeat(np.fromiter(hashes, dtype=np.int64, count=len(hashes)), bands)
            key, pivot, member = _runs(keys, of)
            mine = pivot == member
            # a pair found here goes along with a key that spreads pairs evenly
            spread = np.where(mine, key, mix64(pivot.view(np.uint64) ^ mix64(member.view(np.uint64))))
            return {"key": spread.view(np.int64), "a": pivot, "b": pivot ^ member}

        for batch in batches:
            for _, texts in slices(batch.column(0).to_pylist()):
                for _, h, s in lines_of(texts):
                    if h not in hashes:
                        hashes[h] = None
                        sets.append(s.copy())
                if len(sets) >= GATHER:
                    yield flush()
                    hashes, sets = {}, []
        if sets:
            yield flush()

    def join(cols):
        key, a, b = (cols[n] for n in ("key", "a", "b"))
        own = b == 0  # ``b`` is told apart from ``a``: zeros, the most of them, take no room
        order = np.lexsort((a[own], key[own]))
        k, m = key[own][order], a[own][order]
        starts, ends = _spans(k)
        lead = np.repeat(m[starts], ends - starts)
        found = lead != m
        return {"a": np.concatenate([a[~own], lead[found]]),
                "b": np.concatenate([a[~own] ^ b[~own], m[found]])}

    joined = by_ranges(rows.select("text"), local, {"key": "i8", "a": "i8", "b": "i8"}, ranges, join,
                       "a long, b long")
    return joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shingle_sets(rows: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """``hash long, shingles binary`` of the paragraphs in pairs."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct()
    at = (lines.join(wanted, "hash").groupBy("hash").agg(F.min("id").alias("id"))
          .groupBy("id").agg(F.collect_list("hash").alias("hashes")))

    def sets_of(cols):
        out = {"hash": [], "shingles": []}
        for at, texts in slices(cols["text"]):
            wanted = [set(hashes) for hashes in cols["hashes"][at:at + len(texts)]]
            for i, h, s in lines_of(texts):
                if h in wanted[i]:
                    wanted[i].discard(h)
                    out["hash"].append(h)
                    out["shingles"].append(squeeze_keys(np.unique(s)))
        return out

    return stage(map_rows(rows.join(stage(at, "passage_docs"), "id").select("text", "hashes"), sets_of,
                          "hash long, shingles binary").dropDuplicates(["hash"]), "passage_sets")


def similar_pairs(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose exact Jaccard similarity is ``SIMILARITY`` or more."""
    def verify(cols):
        out, last = {"a": [], "b": []}, None
        for a, b, sa, sb in zip(cols["a"], cols["b"], cols["sa"], cols["sb"]):
            if a != last:  # the join brings a pivot's pairs one after another
                last, x = a, expand_keys(sa)
            y = expand_keys(sb)
            if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
                continue
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            if both >= SIMILARITY * (len(x) + len(y) - both):
                out["a"].append(a)
                out["b"].append(b)
        return out

    left = sets.select(F.col("hash").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("hash").alias("b"), F.col("shingles").alias("sb"))
    return map_rows(pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb"), verify,
                    "a long, b long")


def similar_in_tile(labels: np.ndarray, chunks: np.ndarray,
                    sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what is similar across labels (and chunks, if there are two)."""
    sizes = np.array([len(x) for x in sets])
    _, shingle, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[shingle] > 1  # the others add to no intersection
    shingle = (np.cumsum(counts > 1) - 1)[shingle[shared]]
    member, order = member[shared], np.argsort(shingle, kind="stable")
    shingle, member = shingle[order], member[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for a in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, SLICE):
        x, y = np.searchsorted(shingle, [a, a + SLICE])
        holds = np.zeros((len(sets), SLICE), dtype=np.float32)
        holds[member[x:y], shingle[x:y] - a] = 1
        both += holds @ holds.T
    wanted = np.triu(both >= SIMILARITY * (sizes[:, None] + sizes - both), 1)
    wanted &= labels[:, None] != labels
    if len(np.unique(chunks)) > 1:
        wanted &= chunks[:, None] != chunks
    i, j = np.nonzero(wanted)
    return spanning(len(sets), i, j) if len(i) else (i, j)


def band_members(sets: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """``key long, hash long``: every band's key of every set."""
    def keys_of(cols):
        found = band_keys([expand_keys(x) for x in cols["shingles"]], bands, band_rows)
        return {"key": found.ravel().view(np.int64),
                "hash": np.repeat(np.array(cols["hash"], dtype=np.int64), bands)}

    return map_rows(sets, keys_of, "key long, hash long")


def mixed_pairs(sets: DataFrame, labels: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """Similar pairs of different components that share a band's key.

    With them, the components are those of all similar pairs that share a key.
    A key's members are cut into chunks, and each pair of chunks is a tile. Two members
    alone are a pivot and its member, which were compared.
    """
    members = stage(band_members(sets, bands, band_rows)
                    .join(labels.withColumnRenamed("node", "hash"), "hash", "left")
                    .withColumn("label", F.coalesce("label", "hash")), "passage_members")
    mixed = stage(members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                             F.count(F.lit(1)).alias("m"))
                  .where("x <> y and m > 2").select("key", F.ceil(F.col("m") / TILE).cast("int").alias("t")),
                  "passage_mixed")
    tiles = (members.join(mixed, "key")
             .withColumn("chunk", F.pmod(F.xxhash64("hash"), F.col("t")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
             .join(sets, "hash")
             .select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                     "hash", "label", "chunk", "shingles")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(held):
        node, label, chunk = (np.array([x[k] for x in held], dtype=np.int64) for k in range(3))
        i, j = similar_in_tile(label, chunk, [expand_keys(x[3]) for x in held])
        return as_batch({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])}, schema)

    def run(batches):
        tile, held = None, []
        for batch in batches:
            for *at, node, label, chunk, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if at != tile:
                    if len(held) > 1:
                        yield compare(held)
                    tile, held = at, []
                held.append((node, label, chunk, shingles))
        if len(held) > 1:
            yield compare(held)

    return tiles.mapInArrow(tidy(run), "a long, b long").distinct()


# -- runs ------------------------------------------------------------------

def run_hashes(text: str | None) -> np.ndarray:
    """Hashes of all windows of ``RUN_WORDS`` words; the words are those of ``paragraphs``."""
    h = word_hashes(words_apart(text))
    return shingle_hashes(h, RUN_WORDS) if len(h) >= RUN_WORDS else h[:0]


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, in code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = (points != 32) & ((points < 9) | (points > 13))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    odd = np.array([m.end() for m in _ODD_END.finditer(text)], dtype=edges.dtype)
    return np.sort(np.concatenate([edges[::2], odd])), np.sort(np.concatenate([edges[1::2], odd]))


def picked(windows: np.ndarray) -> np.ndarray:
    """Places of the least of any ``RUN_WINDOW`` successive windows, or of all if there are fewer."""
    if len(windows) <= RUN_WINDOW:
        return np.array([windows.argmin()] if len(windows) else [], dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(windows, RUN_WINDOW)
    return np.unique(np.arange(len(view)) + view.argmin(1))


def _pooled(values: np.ndarray, least: bool) -> np.ndarray:
    """The least (largest) of every ``RUN_WINDOW`` successive values."""
    f, size = np.minimum if least else np.maximum, 1
    while size < RUN_WINDOW:
        step = min(size, RUN_WINDOW - size)
        values, size = f(values[:-step], values[step:]), size + step
    return values


def runs_of(texts: list[str]) -> Iterator[np.ndarray]:
    """``run_hashes`` of every text of a slice (views of one array)."""
    words = SliceWords(texts)
    windows = shingle_hashes(words.hashes, RUN_WORDS)
    for a, z in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        yield windows[a:max(a, z - RUN_WORDS + 1)]


def picks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and hash of all ``picked`` windows of a slice."""
    words = SliceWords(texts)
    windows = shingle_hashes(words.hashes, RUN_WORDS)
    a, count = words.bounds[:-1], np.maximum(np.diff(words.bounds) - RUN_WORDS + 1, 0)
    alone = count <= RUN_WINDOW
    at = np.empty(0, dtype=np.int64)
    if not alone.all():
        least = _pooled(windows, True)
        change = np.zeros(len(least) + 1, dtype=np.int64)
        change[a[~alone]] += 1
        change[(a + count - RUN_WINDOW + 1)[~alone]] -= 1
        least[np.cumsum(change[:-1]) == 0] = 0  # a stretch that goes over a text's end
        margin = np.zeros(RUN_WINDOW - 1, dtype=np.uint64)
        # a window is the least of some stretch around it if the largest of their least ones is no less
        at = np.flatnonzero(_pooled(np.concatenate([margin, least, margin]), False) == windows)
        of = np.searchsorted(words.bounds, at, side="right") - 1
        # of equal ones the first is picked; that is left to ``picked``
        again = (windows[at[1:]] == windows[at[:-1]]) & (np.diff(at) < RUN_WINDOW) & (of[1:] == of[:-1])
        alone[of[1:][again]] = True
        at = at[~alone[of]]
    rest = [a[i] + picked(windows[a[i]:a[i] + count[i]]) for i in np.flatnonzero(alone & (count > 0))]
    at = np.concatenate([at, *rest])
    of = np.searchsorted(words.bounds, at, side="right") - 1
    return of, at - a[of], windows[at]


def _of_rows(ids: list[int], parts: list[np.ndarray]) -> np.ndarray:
    return np.repeat(np.array(ids, dtype=np.int64), [len(p) for p in parts])


def _joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts).astype(dtype, copy=False) if parts else np.empty(0, dtype)


def run_pieces(at: np.ndarray, first: np.ndarray, cut: np.ndarray) -> list[tuple[int, int]]:
    """[a, z) of the successive windows (by place) that go on with an equal document and fate."""
    new = np.flatnonzero((np.diff(at) != 1) | (first[1:] != first[:-1]) | (cut[1:] != cut[:-1])) + 1
    return list(zip([0, *new.tolist()], [*new.tolist(), len(at)])) if len(at) else []


RUN = "id long, w_start int, w_end int, start int, end int, first long, kept boolean"


def repeated_picks(rows: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``id long, at int``: picked windows whose hash several documents hold.

    One exchange by hash. What repeats within a batch of texts is known at once: a
    single row of it goes to the hash's task, the others are spread evenly.
    """
    def pick(batches):
        for batch in batches:
            docs, ids = [], batch.column(0).to_numpy()
            hashes, places = [], []
            for a, texts in slices(batch.column(1).to_pylist()):
                of, at, found_here = picks_of(texts)
                docs.append(ids[a + of])
                places.append(at)
                hashes.append(found_here)
            key, at = _joined(hashes, np.uint64).view(np.int64), _joined(places, np.int32)
            doc = _joined(docs, np.int64)
            if not len(key):
                continue
            order = np.lexsort((doc, key))
            key, doc, at = key[order], doc[order], at[order]
            starts, ends = _spans(key)
            known = np.repeat(doc[starts] != doc[ends - 1], ends - starts)
            apart = known.copy()
            apart[starts] = False
            key[apart] = mix64(key[apart].view(np.uint64) ^ mix64(doc[apart].view(np.uint64))).view(np.int64)
            yield {"key": key, "id": doc, "at": at, "known": known}

    def decide(cols):
        order = np.argsort(cols["key"])
        key, doc, at, known = (cols[n][order] for n in ("key", "id", "at", "known"))
        starts, ends = _spans(key)
        hit = np.logical_or.reduceat(known, starts)
        hit |= np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
        mine = np.repeat(hit, ends - starts)
        return {"id": doc[mine], "at": at[mine]}

    return by_ranges(rows.select("id", "text"), pick, {"key": "i8", "id": "i8", "at": "i4", "known": "?"}, ranges,
                     decide, "id long, at int")


def _spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return starts, np.append(starts[1:], len(keys))[:len(starts)]


def shared_runs(rows: DataFrame, ranges: int = RANGES) -> DataFrame:
    """Runs of words that stand in several documents, cut where their first document changes."""
    def around(cols):
        hashes, places, again = [], [], []
        runs = (windows for _, texts in slices(cols["text"]) for windows in runs_of(texts))
        for windows, near in zip(runs, cols["near"]):
            near = np.unique([x for x in near if x < len(windows)]).astype(np.int64)
            change = np.zeros(len(windows) + 1, dtype=np.int64)
            np.add.at(change, np.maximum(near - REACH, 0), 1)
            np.add.at(change, np.minimum(near + REACH + 1, len(windows)), -1)
            at = np.flatnonzero(np.cumsum(change[:-1]))
            _, least = np.unique(windows[at], return_index=True)
            later = np.ones(len(at), dtype=bool)
            later[least] = False
            hashes.append(windows[at])
            places.append(at)
            again.append(later)
        return {"id": _of_rows(cols["id"], places), "hash": _joined(hashes, np.uint64).view(np.int64),
                "at": _joined(places, np.int32), "again": _joined(again, bool)}

    def repeated(windows):
        return (windows.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                .where("first <> last").select("hash", "first"))

    out = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t])
                     for n, t in (c.split() for c in RUN.split(", "))])

    def place(batches):
        for batch in batches:
            found = {f.name: [] for f in out}
            shared = batch.column(2)
            ends = shared.offsets.to_numpy()
            fields = [shared.values.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
            for i, (doc, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1)))):
                at, first, again = (f[ends[i]:ends[i + 1]] for f in fields)
                starts, stops = word_places(text)
                at, order = np.unique(at, return_index=True)
                order = order[at + RUN_WORDS <= len(starts)]  # rows of an equal id may differ
                at = at[:len(order)]
                first, cut = first[order], again[order] | (first[order] != doc)
                for a, z in run_pieces(at, first, cut):
                    w, w_end = int(at[a]), int(at[z - 1]) + RUN_WORDS
                    for name, x in (("id", doc), ("w_start", w), ("w_end", w_end),
                                    ("start", int(starts[w])), ("end", int(stops[w_end - 1])),
                                    ("first", int(first[a])), ("kept", not cut[a])):
                        found[name].append(x)
            yield as_batch(found, out)

    with STAGED.watched() as done:
        near = stage(repeated_picks(rows, ranges).groupBy("id").agg(F.collect_set("at").alias("near")),
                     "passage_near")
        # written, so that both sides of the joins are plain shuffles that AQE can split
        windows = stage(map_rows(rows.join(near, "id").select("id", "text", "near"), around,
                                 "id long, hash long, at int, again boolean"), "passage_windows")
        _remove_all(done, windows)
        firsts = stage(repeated(windows), "passage_firsts")
        shared = stage(windows.join(firsts.hint("shuffle_hash"), "hash").groupBy("id").agg(
            F.collect_list(F.struct("at", "first", "again")).alias("shared")), "passage_shared")
        _remove_all(done, shared)
    return rows.join(shared, "id").select("id", "text", "shared").mapInArrow(tidy(place), RUN).distinct()


# -- regions ---------------------------------------------------------------

def _remove_all(staged: list[str], *keep: DataFrame) -> None:
    """Delete the listed tables that ``keep`` does not read, and take them off the list."""
    needed = {p for df in keep for p in reads_from(df)}
    for path in [p for p in staged if p not in needed]:
        remove_folder(keep[0].sparkSession, path)
        staged.remove(path)


def repeated_regions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     region_words: int = REGION_WORDS) -> DataFrame:
    """Regions of repeated text: ``id, start, end, n_words, component_id, removed, cuts``.

    ``start`` and ``end`` (exclusive) count code points; ``component_id`` is the
    first document (least id) that holds the repeated units. A region whose
    units come from several first documents has a row for each of them, with
    the part of the region that its units span (which may be less than
    ``region_words``), so documents that share a passage have rows of one class;
    ``cuts`` are the [start, end) of what goes, ``removed`` says whether there are any. A
    null, empty or unrepeated text has no regions; rows with a null id take no
    part; rows with an equal id are one document, so they don't repeat each
    other; an empty table gives no rows.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .where("id is not null"))
    with STAGED.watched() as done:
        found = unit_rows(rows)
        bands, band_rows = tune_bands()
        lines, n_words = found.where("line").agg(F.count(F.lit(1)), F.sum(F.col("w_end") - F.col("w_start"))).first()
        pairs = stage(candidate_pairs(rows, bands, band_rows, 1 + lines * bands // RANGE_ROWS), "passage_pairs")
        sets = shingle_sets(rows, found.where("line").select("hash", "id"), pairs)
        links = stage(similar_pairs(sets, pairs), "passage_links")
        more = stage(mixed_pairs(sets, components(links), bands, band_rows), "passage_more")
        labels = components(links.union(more)).withColumnRenamed("node", "hash")

        nodes = (found.groupBy("hash").agg(F.min(F.struct("id", "ord")).alias("first"),
                                           F.max("id").alias("last"))
                 .join(labels, "hash", "left").where("first.id <> last or label is not null")
                 .withColumn("label", F.coalesce("label", "hash")))
        nodes = stage(nodes, "passage_nodes")
        clusters = (nodes.groupBy("label").agg(F.min("first").alias("first"), F.max("last").alias("last"))
                    .where("first.id <> last").select("label", "first"))
        repeats = stage(nodes.select("hash", "label").join(clusters, "label").select("hash", "first"),
                        "passage_repeats")
        _remove_all(done, found, repeats)
    kept = (F.col("id") == F.col("first.id")) & (F.col("ord") == F.col("first.ord"))
    # a hash has one row there, so its parts of an exchange are small whatever the texts repeat
    of_units = (found.join(repeats.hint("shuffle_hash"), "hash").withColumn("kept", kept)
                .withColumn("first", F.col("first.id")).dropDuplicates(["id", "ord", "hash", "line"]))
    # of random windows, one in half a stretch is picked
    of_runs = shared_runs(rows, 1 + (n_words or 0) * 2 // (RUN_WINDOW + 1) // RANGE_ROWS).withColumns({c: F.lit(None).cast("int") for c in ("ord", "n")})
    columns = ["id", "ord", "n", "w_start", "w_end", "start", "end", "first", "kept"]
    marked = of_units.select(columns).union(of_runs.select(columns))

    earlier = Window.partitionBy("id").orderBy("w_start", "w_end", "ord", "n", "first", "kept")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.when(F.col("ord") <= F.max(F.col("ord") + F.col("n")).over(before), 0)
             .when(F.col("w_start") <= F.max("w_end").over(before) + GAP_WORDS, 0).otherwise(1))
    whole = Window.partitionBy("id", "island")
    islands = (marked.withColumn("opens", opens)
               .withColumn("island", F.sum("opens").over(earlier.rowsBetween(
                   Window.unboundedPreceding, Window.currentRow))))
    words = F.max("w_end").over(whole) - F.min("w_start").over(whole)
    cut = F.when(~F.col("kept"), F.struct("start", "end"))
    return (islands.withColumn("words", words).where(F.col("words") >= region_words)
            .groupBy("id", "island", F.col("first").alias("component_id"))
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 (F.max("w_end") - F.min("w_start")).cast("long").alias("n_words"),
                 F.array_sort(F.collect_list(cut)).alias("cuts"))
            .select("id", "start", "end", "n_words", "component_id",
                    (F.size("cuts") > 0).alias("removed"), "cuts"))


def cut_out(text: str, cuts: list[tuple[int, int]]) -> str:
    """``text`` without the (possibly overlapping) spans; blank lines left by them go."""
    out, last = [], 0
    for start, end in sorted(cuts):
        if start > last:
            out.append(text[last:start])
        last = max(last, end)
    return "\n".join(x for x in ("".join(out) + text[last:]).split("\n") if x.strip())
