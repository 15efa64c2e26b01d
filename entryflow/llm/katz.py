"""Katz backoff language model: Good-Turing counts, exactly normalised backoff weights.

A bigram model over words and a document end. With ``c`` for training counts,

    P(w|h) = d(c(hw)) c(hw) / c(h)      if hw was seen,
             a(h) P(w)                  else,
    P(w)   = d(c(w)) c(w) / N,          and what is left for the unknown word.

``d`` is the Good-Turing discount. ``a(h)`` makes the probabilities after
``h`` sum to one: both sums in it run over all words seen after ``h``. A word
never seen as a context leaves the unigram as it is.

How the work is laid out. Most bigrams of a corpus are rare, so a row per
token in every exchange would cost several times the text. Documents are
therefore encoded once into blocks of about ``BLOCK_TOKENS`` tokens, kept as a
table bucketed by block. A block asks for each distinct n-gram once: per key
range, one row with its sorted 64-bit keys and training counts (as deltas,
compressed). A range's task adds the counts and answers in the same order, so
answers need no keys. Contexts and weights are plain rows: sums per context
are aggregated into the weight table, and what a document needs from it (only
for bigrams unseen in training) is joined by key, where Spark splits contexts
that very many documents need. No task holds more than a block or a key range.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import (as_batch, expand, expand_keys, map_rows, mix64, squeeze,
                                  squeeze_keys, stage, utf8, word_hashes)
from entryflow.session import scratch_path

BLOCK_TOKENS = 1 << 19
#: Keys of a range's task, on average.
RANGE_KEYS = 300_000
#: Turing's estimate is used up to this count, a fitted power law beyond.
TURING_COUNTS = 5
#: The power law is fitted on counts up to this.
FIT_COUNTS = 1000

# Tokens that no word's text can be.
_END, _BEGIN = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0xB0E0B0E0B0E0B0E1)


def is_held_out(doc_id: int | None) -> bool:
    """crc32 of the id as text, modulo 7, is 2 (a null id trains)."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


# -- blocks ----------------------------------------------------------------

_BLOCK = ("ids array<long>, held array<boolean>, lengths array<int>, stream binary, words binary, "
          "n_tokens long, n_words long, n_train long")


def _block(docs: list[tuple[int | None, np.ndarray]]) -> dict:
    lengths = np.array([len(t) for _, t in docs], dtype=np.int32)
    held = [is_held_out(d) for d, _ in docs]
    found, inverse, counts = np.unique(np.concatenate([t for _, t in docs]),
                                       return_inverse=True, return_counts=True)
    by_count = np.argsort(-counts, kind="stable")  # small numbers for frequent words
    rank = np.empty(len(found), dtype=np.uint64)
    rank[by_count] = np.arange(len(found), dtype=np.uint64)
    return {"ids": [d for d, _ in docs], "held": held, "lengths": lengths,
            "stream": squeeze(rank[inverse]), "words": squeeze(found[by_count]),
            "n_tokens": int(lengths.sum()), "n_words": len(found),
            "n_train": len(held) - sum(held)}


def encode_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents as blocks of token numbers, written as a table bucketed by block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(_BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                h = np.append(word_hashes(utf8(text), lower=True), _END)
                held.append((doc, h))
                tokens += len(h)
                if tokens >= BLOCK_TOKENS:
                    yield as_batch({k: [v] for k, v in _block(held).items()}, schema)
                    held, tokens = [], 0
        if held:
            yield as_batch({k: [v] for k, v in _block(held).items()}, schema)

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    blocks = rows.mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id())
    name = f"llm_katz_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (blocks.write.bucketBy(buckets, "block").option("path", scratch_path(spark, "llm", "katz"))
     .saveAsTable(name))
    return spark.table(name)


class Block:
    """Token arrays of a block: words, contexts, documents, and distinct bigrams."""

    def __init__(self, lengths, held, stream: bytes, words: bytes):
        lengths = np.asarray(lengths, dtype=np.int64)
        self.held = np.asarray(held, dtype=bool)
        self.train = np.repeat(~self.held, lengths)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.starts = np.cumsum(lengths) - lengths
        vocabulary = expand(words)
        stream_ = expand(stream).astype(np.int64)
        order = np.argsort(vocabulary)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.words = vocabulary[order]
        self.word = place[stream_]
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.starts] = -1  # the beginning
        value = self.words[self.word]
        context = self.context_hash(self.before)
        self.bigrams, self.bigram = np.unique(
            mix64(context * np.uint64(0xA24BAED4963EE407) + value), return_inverse=True)

    def context_hash(self, places: np.ndarray) -> np.ndarray:
        return np.where(places < 0, _BEGIN, self.words[places])


# -- counting --------------------------------------------------------------

def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal ranges of 64-bit keys ends among sorted keys."""
    part = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(n, dtype=np.uint64), side="right")


def count_ngrams(blocks: DataFrame, n_ranges: tuple[int, int]) -> DataFrame:
    """Training counts of the n-grams of every block, in its own key order.

    Rows ``level, part, block, answer``: twice the count, plus one where this
    block owns the n-gram (it is the first with it in training). The row of
    block -1 has a range's counts of counts. Written to the shared folder.
    """
    def ask(cols):
        out = {k: [] for k in ("level", "part", "block", "keys", "counts")}
        for i, block in enumerate(cols["block"]):
            b = Block(cols["lengths"][i], cols["held"][i], cols["stream"][i], cols["words"][i])
            for level, (keys, of) in enumerate(((b.words, b.word), (b.bigrams, b.bigram))):
                counts = np.bincount(of[b.train], minlength=len(keys))
                first = 0
                for part, end in enumerate(_ranges(keys, n_ranges[level]).tolist()):
                    if end > first:
                        row = (level, part, block, squeeze_keys(keys[first:end]),
                               squeeze(counts[first:end]))
                        for k, v in zip(out, row):
                            out[k].append(v)
                    first = end
        return out

    def answer(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        keys = [expand_keys(k) for k in group["keys"].to_pylist()]
        counts = np.concatenate([expand(c) for c in group["counts"].to_pylist()]).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), dtype=np.int64)
        np.add.at(total, inverse, counts)
        owner = np.full(len(found), -1, dtype=np.int64)
        used = np.flatnonzero(counts)
        owner[inverse[used[::-1]]] = used[::-1]
        reply = total[inverse] * 2 + (owner[inverse] == np.arange(len(inverse)))
        value, times = np.unique(total[total > 0], return_counts=True)
        replies = [squeeze(x) for x in np.split(reply, ends[:-1])]
        replies.append(squeeze(np.concatenate([value, times])))
        n = len(replies)
        return pa.table({"level": pa.array([group["level"][0].as_py()] * n, pa.int32()),
                         "part": pa.array([group["part"][0].as_py()] * n, pa.int32()),
                         "block": pa.array(group["block"].to_pylist() + [-1], pa.int64()),
                         "answer": pa.array(replies, pa.binary())})

    asked = map_rows(blocks.select("block", "lengths", "held", "stream", "words"), ask,
                     "level int, part int, block long, keys binary, counts binary")
    answered = asked.groupBy("level", "part").applyInArrow(
        answer, "level int, part int, block long, answer binary")
    return stage(answered, "katz_counts")


# -- discounts -------------------------------------------------------------

class Discounts:
    """Good-Turing: an n-gram seen ``c`` times counts for ``c * d(c)``."""

    def __init__(self, times: dict[int, int]):
        """``times``: how many n-grams were seen c times, for c up to ``FIT_COUNTS``."""
        self.slope = self._fit(sorted(times.items()))
        self.table = np.ones(TURING_COUNTS + 1)
        for c in range(1, TURING_COUNTS + 1):
            turing = (c + 1) * times.get(c + 1, 0) / (c * times[c]) if times.get(c) else 0.0
            self.table[c] = turing if 0 < turing < 1 else (1 + 1 / c) ** (self.slope + 1)

    @staticmethod
    def _fit(points: list[tuple[int, int]]) -> float:
        """Slope of log (counts of counts) over log (count), gaps averaged; below -1."""
        if len(points) < 3:
            return -2.0
        c = np.array([p[0] for p in points], dtype=float)
        n = np.array([p[1] for p in points], dtype=float)
        below = np.concatenate([[0.0], c[:-1]])
        above = np.concatenate([c[1:], [2 * c[-1] - c[-2]]])
        x, y = np.log(c), np.log(2 * n / (above - below))
        return min(-1.1, float(np.polyfit(x, y, 1)[0]))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """``c * d(c)``, and 0 for 0."""
        c = np.asarray(counts, dtype=float)
        far = c * (1 + 1 / np.maximum(c, 1)) ** (self.slope + 1)
        near = c * self.table[np.minimum(c, TURING_COUNTS).astype(int)]
        return np.where(c <= TURING_COUNTS, near, far)


def _discounts(answers: DataFrame, level: int) -> tuple[Discounts, int, int, float]:
    """Discounts of a level, its tokens and types, and the sum of discounted counts."""
    def spread(cols):
        both = [expand(a).astype(np.int64) for a in cols["answer"]]
        return {"c": np.concatenate([b[:len(b) // 2] for b in both] or [[]]).astype(np.int64),
                "n": np.concatenate([b[len(b) // 2:] for b in both] or [[]]).astype(np.int64)}

    times = stage(map_rows(answers.where((F.col("block") < 0) & (F.col("level") == level))
                           .select("answer"), spread, "c long, n long")
                  .groupBy("c").agg(F.sum("n").alias("n")), "katz_times")
    few = {r["c"]: r["n"] for r in times.where(F.col("c") <= FIT_COUNTS).collect()}
    d = Discounts(few)
    far = F.col("c") * F.pow(1 + 1 / F.col("c"), F.lit(d.slope + 1))
    r = times.agg(F.sum(F.col("n") * F.col("c")).alias("tokens"), F.sum("n").alias("types"),
                  F.sum(F.when(F.col("c") > FIT_COUNTS, F.col("n") * far)).alias("far")).first()
    near = sum(n * float(d(np.array([c]))[0]) for c, n in few.items())
    return d, r["tokens"] or 0, r["types"] or 0, near + (r["far"] or 0.0)


class Model:
    """The numbers that every block needs: totals and discounts."""

    def __init__(self, blocks: DataFrame, answers: DataFrame):
        self.unigram, self.tokens, self.types, mass = _discounts(answers, 0)
        self.bigram = _discounts(answers, 1)[0]
        self.unknown = 1 - mass / self.tokens if self.tokens else 1.0
        self.documents = blocks.agg(F.sum("n_train")).first()[0] or 0

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, self.unigram(counts) / self.tokens, self.unknown)


class Scored:
    """Counts of a block's n-grams, and per token what the model says."""

    def __init__(self, model: Model, block: Block, answers: list[dict]):
        self.block = block
        per_level = [[], []]
        for a in sorted(answers, key=lambda a: (a["level"], a["part"])):
            per_level[a["level"]].append(expand(a["answer"]).astype(np.int64))
        words, bigrams = (np.concatenate(x) for x in per_level)
        self.word_counts = words >> 1
        self.bigram_counts, self.owned = bigrams >> 1, (bigrams & 1).astype(bool)
        self.p_word = model.word_probability(self.word_counts)
        self.context = np.where(block.before < 0, model.documents, self.word_counts[block.before])
        self.seen = self.bigram_counts[block.bigram] > 0
        self.mass = model.bigram(self.bigram_counts)[block.bigram]


_ANSWERS = "array<struct<level:int,part:int,answer:binary>>"


def _answered(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with its answers; the blocks' table is bucketed and not moved."""
    per_block = (answers.where("block >= 0").groupBy("block")
                 .agg(F.collect_list(F.struct("level", "part", "answer")).alias("answers")))
    return (blocks.hint("shuffle_merge").join(per_block, "block")
            .select("block", "ids", "lengths", "held", "stream", "words", "answers"))


def _per_block(cols):
    for i in range(len(cols["block"])):
        block = Block(cols["lengths"][i], cols["held"][i], cols["stream"][i], cols["words"][i])
        yield cols["block"][i], cols["ids"][i], block, cols["answers"][i]


# -- weights and scores ----------------------------------------------------

def backoff_weights(blocks: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """Table ``context long, weight double``, written to the shared folder.

    Every seen bigram is added once, by the block that owns it.
    """
    def sums(cols):
        out = {"context": [], "seen": [], "lower": []}
        for _, _, block, answers in _per_block(cols):
            s = Scored(model, block, answers)
            first = np.full(len(block.bigrams), -1, dtype=np.int64)
            first[block.bigram[::-1]] = np.arange(len(block.bigram))[::-1]
            at = first[s.owned]
            context, of = np.unique(block.before[at], return_inverse=True)
            out["context"].append(block.context_hash(context).view(np.int64))
            out["seen"].append(np.bincount(of, s.mass[at] / s.context[at], len(context)))
            out["lower"].append(np.bincount(of, s.p_word[block.word[at]], len(context)))
        return {k: np.concatenate(v) if v else [] for k, v in out.items()}

    weight = (1 - F.col("seen")) / (1 - F.col("lower"))
    return stage(map_rows(_answered(blocks, answers), sums,
                          "context long, seen double, lower double")
                 .groupBy("context").agg(F.sum("seen").alias("seen"), F.sum("lower").alias("lower"))
                 .select("context", weight.alias("weight")), "katz_weights")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents that are not held out; score every document.

    Columns: ``id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. ``base_score`` is the add-one unigram score. A null or empty
    text has the end token alone; a null id trains; repeated rows train and
    are scored repeatedly; an empty table gives no rows; without training
    documents every token has probability one.
    """
    blocks = encode_blocks(docs, id_col, text_col)
    total = blocks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    answers = count_ngrams(blocks, tuple(max(1, -(-(n or 0) // RANGE_KEYS)) for n in total))
    model = Model(blocks, answers)
    weights = backoff_weights(blocks, answers, model)

    def run(cols):
        names = ("block", "nr", "id", "held_out", "n_tokens", "n_known", "base_score", "part", "need")
        out = {k: [] for k in names}
        for number, ids, block, answers in _per_block(cols):
            s = Scored(model, block, answers)
            known = s.word_counts[block.word] > 0
            base = np.log10((s.word_counts + 1) / (model.tokens + model.types + 1))[block.word]
            with np.errstate(divide="ignore", invalid="ignore"):
                part = np.where(s.seen, np.log10(s.mass / s.context),
                                np.log10(s.p_word[block.word]))
            need = ~s.seen & (s.context > 0)
            asked = np.split(block.context_hash(block.before[need]).view(np.int64),
                             np.searchsorted(block.doc[need], np.arange(1, len(ids))))
            n = len(ids)
            out["block"].append(np.full(n, number, dtype=np.int64))
            out["nr"].append(np.arange(n))
            out["id"] += ids
            out["held_out"].append(block.held)
            out["n_tokens"].append(np.bincount(block.doc, minlength=n))
            out["n_known"].append(np.bincount(block.doc, known, n).astype(np.int64))
            out["base_score"].append(np.bincount(block.doc, base, n))
            out["part"].append(np.bincount(block.doc, part, n))
            out["need"] += asked
        return {k: np.concatenate(v) if v and k not in ("id", "need") else v
                for k, v in out.items()}

    scored = stage(map_rows(_answered(blocks, answers), run,
                            "block long, nr long, id long, held_out boolean, n_tokens long, n_known long, "
                            "base_score double, part double, need array<long>"), "katz_scores")
    backed = (scored.select("block", "nr", F.explode("need").alias("context"))
              .join(weights, "context").groupBy("block", "nr").agg(F.sum(F.log10("weight")).alias("backed")))
    return scored.join(backed, ["block", "nr"], "left").select(
        "id", "held_out", "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("part") + F.coalesce("backed", F.lit(0.0))).alias("score"))
