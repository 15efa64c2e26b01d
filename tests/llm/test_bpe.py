import hashlib
import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from entryflow.llm.bpe import WordBpe, decode_documents, encode_digests, encode_documents
from helpers import ODD, documents, with_clashing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return WordBpe(PATH)


TEXTS = [t for t in ODD if t] + [
    "Don't we'll 12 ½ ² Ⅷ", "ΑΣ ΣΑΣ İstanbul ẞ ǅ", "x<|endoftext|>y <|startoftext|>", "a\u200bb\u3000c",
    "aaaaaaaaaaaaaaaaaaaaaaaa", "thththththth the then", "日本語テキスト" * 300, "\x00\x01\x7f"]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(own, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_letters_equal_library(own, library):
    rng = random.Random(5)
    letters = "aaabcdeinorstth  .,'éöñçß0123ABCΣ日\n"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(80)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_memo_is_bounded(own):
    own.chunks.limit = 50
    for i in range(400):
        own.encode(f"word{i} again")
    assert len(own.chunks) <= 50
    own.chunks.limit = 250_000


def test_documents_round_trip(spark, library):
    df = with_clashing(documents(spark, ODD + TEXTS[-3:], ids=[None, *range(1, len(ODD) + 3)])).drop("id")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    encoded = encode_documents(df, PATH)
    decoded = {r.id: r.text for r in decode_documents(encoded, PATH).collect()}
    digests = {r.id: r for r in encode_digests(df, PATH).collect()}
    for r in encoded.collect():
        ids = library.encode(texts[r.id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, decoded[r.id]) == (ids, text)
        assert digests[r.id].n_tokens == len(ids)
        assert digests[r.id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[r.id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_digests(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("form", ["{}", "a{}", "{}b", "A{}b"])
def test_every_letter_equals_library(own, library, form):
    """All code points of the planes with letters, and some of each other plane, alone and between
    letters; many of them are unassigned in Python's tables or in the library's."""
    points = [*range(1, 0xD800), *range(0xE000, 0x32400), *range(0xE0000, 0xE0200)]
    points += [p * 0x10000 + i for p in range(4, 17) for i in (0, 1, 0xFFF, 0xFFFD)]
    for i in range(0, len(points), 2000):
        text = "\n".join(form.format(chr(c)) for c in points[i:i + 2000])
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
