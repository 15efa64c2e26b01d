"""BPE encoding and decoding with a public word-level BPE vocabulary.

A text is cut at white space into chunks, each chunk normalised and split by
the vocabulary's pattern into words, and each word merged: its symbols form a
doubly linked list, and a priority queue holds the merge ranks of adjacent
pairs. A popped entry whose symbols changed since it was queued is stale and
skipped. The loop is O(n log n) in a word's length, so a text without spaces
is no special case. Decoding puts the vocabulary strings of the ids together
(this vocabulary's file names no decoder: strings are joined by one space).

Chunks and words repeat, so their ids are memoised in each Python worker; the
memo is bounded and only saves time.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from heapq import heapify, heappop, heappush
from itertools import chain

from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import map_rows

MEMO = 250_000
#: Longer chunks are not kept in the memo.
MEMO_CHARS = 48


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


def _unassigned(letter: str) -> bool:
    return unicodedata.category(letter) == "Cn"


class _Memo(dict):
    """Results of ``make``; of older ones, those that are still used stay."""

    def __init__(self, make, limit: int = MEMO):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class WordBpe:
    """Encoder and decoder for a BPE file with word-end symbols."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)  # for its normalizer and pre-tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(max(self.vocab.values()), max(self.special.values(), default=0))
        self.strings = [""] * size
        for text, i in chain(self.vocab.items(), self.special.items()):
            self.strings[i] = text
        self.numbers = [str(i) for i in range(size)]
        self.size = size
        #: rank of a pair of ids, the pair as one number; what the merge of a rank gives
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks.setdefault(self.vocab[left] * size + self.vocab[right], rank)
            self.merged.append(self.vocab[left + right])
        letters = _byte_letters()
        #: ids of the 256 bytes inside a word and at its end
        self.inner = [self.vocab.get(x) for x in letters]
        self.final = [self.vocab.get(x + self.suffix) for x in letters]
        self.byte_of = {x: b for b, x in enumerate(letters)}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        self.spaces = regex.compile(r"\s+")
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = _Memo(self.merge_word, MEMO // 4)
        self.chunks = _Memo(self.encode_chunk)

    def merge_word(self, word: str) -> tuple[int, ...]:
        return self.merge_bytes(word.encode("utf-8", "surrogatepass"))

    def merge_bytes(self, data: bytes) -> tuple[int, ...]:
        """Ids of one word: lowest merge rank first, leftmost among equals."""
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        if None in ids:
            ids = [x for x in ids if x is not None]
        n, size, merged, rank_of = len(ids), self.size, self.merged, self.ranks.get
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []  # rank and position of a pair, as one number
        for i in range(n - 1):
            rank = rank_of(ids[i] * size + ids[i + 1])
            if rank is not None:
                queue.append(rank * n + i)
        heapify(queue)
        while queue:
            rank, i = divmod(heappop(queue), n)
            j = after[i]
            if j == n or rank_of(ids[i] * size + ids[j]) != rank:
                continue  # stale: a neighbour was merged meanwhile
            ids[i] = new = merged[rank]
            ids[j] = -1  # no pair with it has a rank
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(new * size + ids[k])
                if rank is not None:
                    heappush(queue, rank * n + i)
            h = before[i]
            if h >= 0:
                rank = rank_of(ids[h] * size + new)
                if rank is not None:
                    heappush(queue, rank * n + h)
        return tuple([x for x in ids if x >= 0])

    def encode_chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of text without white space and special tokens."""
        if not chunk.isascii() and any(map(_unassigned, chunk)):
            return tuple(chain.from_iterable(map(self.merge_bytes, self.library_words(chunk))))
        # lower-casing goes letter by letter: a final sigma is no special case
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        return tuple(chain.from_iterable(map(self.words.__getitem__, self.pattern.findall(text))))

    def library_words(self, chunk: str) -> list[bytes]:
        """Words of a chunk with letters that Python's tables do not know: case, composition
        and letter classes are the library's."""
        text = self.coder.normalizer.normalize_str(chunk)
        return [bytes(map(self.byte_of.__getitem__, piece))
                for piece, _ in self.coder.pre_tokenizer.pre_tokenize_str(text)]

    def _cut(self, text: str) -> list[str]:
        # str.split() also cuts at U+001C to U+001F, which the pattern counts as signs
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [x for x in self.spaces.split(text) if x]
        return text.split()

    def pieces(self, text: str | None) -> list[tuple[int, ...]]:
        """Ids of each chunk and special token, in order."""
        if not text:
            return []
        if "<|" not in text:
            return list(map(self.chunks.__getitem__, self._cut(text)))
        out: list[tuple[int, ...]] = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append((self.special[part],))
            else:
                out.extend(map(self.chunks.__getitem__, self._cut(part)))
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.pieces(text)))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))

    def id_text(self, ids: list[int]) -> str:
        return " ".join(map(self.numbers.__getitem__, ids))


_MODELS: dict[str, WordBpe] = {}


def model(path: str) -> WordBpe:
    """The encoder of a file, loaded once in a Python worker."""
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Ids of every whole text: ``id long, ids array<int>``.

    A null text counts as empty and has no ids. Null ids and repeated rows
    stay as they are; an empty table gives no rows.
    """
    def run(cols):
        bpe = model(path)
        return {"id": cols["id"], "ids": [bpe.encode(t) for t in cols["text"]]}

    return map_rows(_columns(docs, id_col, text_col), run, "id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ``encode_documents`` rows: ``id long, text string`` (null ids: empty)."""
    def run(cols):
        bpe = model(path)
        return {"id": cols["id"], "text": [bpe.decode(ids or []) for ids in cols["ids"]]}

    return map_rows(encoded.select("id", "ids"), run, "id long, text string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again; return counts and digests only.

    The same encoder and decoder as above, without moving the ids from one
    Python step to the next.
    """
    def digest(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(cols):
        bpe = model(path)
        out = {"id": cols["id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in cols["text"]:
            ids = bpe.encode(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(digest(bpe.id_text(ids)))
            out["decoded_sha256"].append(digest(bpe.decode(ids)))
        return out

    return map_rows(_columns(docs, id_col, text_col), run,
                    "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
