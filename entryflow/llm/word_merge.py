"""BPE of many words at once with numpy, for the packing operator.

All words lie in one array. In each round every word that still has a
mergeable pair merges its pair of the lowest rank (the leftmost among
equals), as the word-by-word algorithm would; words without one are done and
leave the array. Ranks are looked up in an open hash table of id pairs.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

_NONE = np.int64(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FULL = {".", ",", ";", ":", "!", "?"}


class PairRanks:
    """Rank of a pair of ids, by linear probing."""

    def __init__(self, pairs: np.ndarray):
        """``pairs``: distinct non-negative numbers by rank."""
        self.bits = max(4, int(len(pairs)).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int64)
        for rank, (pair, at) in enumerate(zip(pairs.tolist(), self._home(pairs).tolist())):
            while self.keys[at] != -1:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ranks[at] = pair, rank

    def _home(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        at = self._home(pairs)
        key = self.keys[at]
        out = np.where(key == pairs, self.ranks[at], _NONE)
        open_ = np.flatnonzero((key != pairs) & (key != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            key = self.keys[at[open_]]
            hit = key == pairs[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (key != -1)]
        return out


def simple_words(chunk: str) -> list[str] | None:
    """The words of letters with an optional sign at the end; None for other chunks."""
    text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
    if text.isalpha():
        return [text]
    if text[-1:] in _FULL and text[:-1].isalpha():
        return [text[:-1], text[-1]]
    return None


class WordMerger:
    """Ids of words by a byte-level BPE file with word-end symbols."""

    def __init__(self, path: str):
        from entryflow.llm.bpe import _byte_letters
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        letters = _byte_letters()
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.final = np.array([vocab[x + suffix] for x in letters], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        self.ranks = PairRanks(np.array([vocab[a] * self.size + vocab[b] for a, b in model["merges"]],
                                        dtype=np.int64))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has; no empty words."""
        data = [w.encode("utf-8") for w in words]
        length = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        raw = np.frombuffer(b"".join(data), dtype=np.uint8)
        ids = self.inner[raw]
        last = np.cumsum(length) - 1
        ids[last] = self.final[raw[last]]
        word = np.arange(len(words))  # the words still at work, by place in the array
        rank = np.full(len(ids), _NONE)
        rank[:-1] = self.ranks(ids[:-1] * self.size + ids[1:])
        rank[last] = _NONE
        done_word, done_ids, done_length = [], [], []
        while len(word):
            start = np.cumsum(length) - length
            best = np.minimum.reduceat((rank << 32) | np.arange(len(rank)), start)
            working = best >> 32 < _NONE
            if not working.all():
                of = np.repeat(working, length)
                done_word.append(word[~working])
                done_length.append(length[~working])
                done_ids.append(ids[~of])
                moved = np.cumsum(of) - 1  # new places of what stays
                ids, rank, word, length = ids[of], rank[of], word[working], length[working]
                best = best[working]
                at = moved[best & 0xFFFFFFFF]
                if not len(word):
                    break
                start = np.cumsum(length) - length
            else:
                at = best & 0xFFFFFFFF
            ids[at] = self.merged[best >> 32]
            rest = np.ones(len(ids), dtype=bool)
            rest[at + 1] = False
            ids, rank = ids[rest], rank[rest]
            at -= np.arange(len(at))  # one symbol less for every word before
            length = length - 1
            start = start - np.arange(len(start))
            after = at < start + length - 1
            rank[at[~after]] = _NONE
            a = at[after]
            rank[a] = self.ranks(ids[a] * self.size + ids[a + 1])
            a = at[at > start] - 1
            rank[a] = self.ranks(ids[a] * self.size + ids[a + 1])
        if not done_word:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        word, length = np.concatenate(done_word), np.concatenate(done_length)
        ids, first = np.concatenate(done_ids), np.cumsum(length) - length
        order = np.argsort(word)
        count = length[order]
        to = np.cumsum(count) - count
        return ids[np.arange(len(ids)) + np.repeat(first[order] - to, count)].astype(np.uint32), count
