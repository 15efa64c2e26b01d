import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from entryflow.llm.bpe import WordBpe
from entryflow.llm.packing import ChunkIds, first_fit_decreasing, pack, token_pieces
from entryflow.llm.word_merge import PairRanks, WordMerger
from helpers import ODD, documents, with_clashing, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute_force(lengths, capacity):
    free, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(capacity)
        out[i] = (b, capacity - free[b])
        free[b] -= lengths[i]
    return out


def test_first_fit_decreasing_equals_scan():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 300):
        lengths = [rng.randint(1, 100) for _ in range(n)]
        assert first_fit_decreasing(lengths, 100) == brute_force(lengths, 100)
    assert first_fit_decreasing([], 100) == []


def test_chunk_ids_equal_library():
    coder, library = ChunkIds(PATH), Tokenizer.from_file(PATH)
    coder.MEMO, coder.SLICE = 40, 600
    rng = random.Random(2)
    texts = ODD + [words(rng, 25) + " Don't, ΑΣ" for _ in range(40)] + ["x<|endoftext|>y", "e\u0301 \u0301e",
                                                                  " a\u3000b\u2028c \v\f d "]
    for _ in range(2):
        for text, got in zip(texts, coder.encode(pa.array(texts, pa.string())), strict=True):
            assert got.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_merged_words_equal_the_word_by_word_encoder():
    merger, coder = WordMerger(PATH), WordBpe(PATH)
    rng = random.Random(4)
    texts = ["".join(rng.choice("aabcdeinorstthéöñß日") for _ in range(rng.randrange(1, 15))) for _ in range(3000)]
    texts += ["a", "th" * 400, "aaaaaaa", "x" * 999]
    ids, counts = merger(texts)
    at = 0
    for word, n in zip(texts, counts.tolist(), strict=True):
        assert tuple(ids[at:at + n].tolist()) == coder.merge_word(word)
        at += n
    assert at == len(ids) and len(merger([])[0]) == 0


def test_pair_ranks():
    rng = random.Random(6)
    pairs = rng.sample(range(10**9), 5000)
    ranks = PairRanks(np.array(pairs))
    asked = pairs + rng.sample(range(10**9, 2 * 10**9), 5000)
    assert ranks(np.array(asked)).tolist() == list(range(5000)) + [2**31 - 1] * 5000


def test_pack_documents(spark):
    rng = random.Random(3)
    texts = ODD + [words(rng, rng.randrange(1, 90)) for _ in range(60)]
    df = with_clashing(documents(spark, texts, ids=[None, *range(1, len(texts))]))
    pieces = token_pieces(df, PATH, end_id=2, capacity=64, keep_ids=True)
    got = pack(pieces, 64, group_pieces=40).collect()
    library = Tokenizer.from_file(PATH)
    assert len({r.sequence_id >> 32 for r in got}) > 1
    for doc, text in zip([None, *range(1, len(texts))], texts):
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert [x for r in mine for x in r.ids] == ids
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) for r in mine)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in mine)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    fill = sum(r.length for r in got) / (64 * len(by_sequence))
    assert fill > 0.85
    assert pack(pieces.limit(0), 64).count() == 0
