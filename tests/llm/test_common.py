import random

import numpy as np

from entryflow.llm import common
from entryflow.llm.common import shingle_hashes, word_hashes
from helpers import ODD


def test_word_hashes_tell_words_apart(monkeypatch):
    rng = random.Random(1)
    texts = [(t or "").encode() for t in ODD]
    texts += [bytes(rng.choice(b"ab AB \t\n\x0b\x0c\r\x00\xc3\xa9") for _ in range(rng.randrange(400))) for _ in range(300)]
    for piece in (1 << 20, 16):
        monkeypatch.setattr(common, "_PIECE", piece)
        for lower in (False, True):
            seen = {}
            for text in texts:
                words = (text.lower() if lower else text).split()
                hashes = word_hashes(text, lower)
                assert len(hashes) == len(words)
                for w, h in zip(words, hashes.tolist()):
                    assert seen.setdefault(w, h) == h
            assert len(set(seen.values())) == len(seen)


def test_no_collisions_among_many_words():
    words = {"".join(p).encode() for p in zip(*[random.Random(i).choices("abcdefgh", k=200_000) for i in range(12)])}
    words |= {w[:n] for w in list(words)[:50_000] for n in range(1, 12)}
    words = list(words)
    hashes = word_hashes(b" ".join(words))
    assert len(np.unique(hashes)) == len(words)


def test_shingles():
    h = word_hashes(b"a b c a b c")
    assert len(shingle_hashes(h, 3)) == 4 and len(np.unique(shingle_hashes(h, 3))) == 3
    assert len(shingle_hashes(h[:2], 4)) == 1 and len(shingle_hashes(h[:0], 4)) == 0


def test_batches_become_objects_in_parts(spark, monkeypatch):
    import pyarrow as pa

    long, short = pa.record_batch({"t": ["x" * 100_000] * 300}), pa.record_batch({"t": ["x"] * 5000})
    for batch, most in ((long, 45), (short, 5000), (short.slice(0, 0), 0)):
        got = list(common.parts(batch))
        assert sum(b.num_rows for b in got) == batch.num_rows
        assert all(b.num_rows <= most for b in got)
    assert len(list(common.parts(short))) == 1
    rows = spark.range(3000).selectExpr("id", "repeat(string(id), 2000) t").coalesce(1)
    sizes = common.map_rows(rows, lambda cols: {"id": cols["id"], "n": [len(cols["id"])] * len(cols["id"])},
                            "id long, n long").collect()
    assert [r.id for r in sizes] == list(range(3000))
    assert max(r.n for r in sizes) < 1000


def test_another_step_drops_the_models_of_a_worker(spark):
    def keep(batches):
        common.MODELS["test", "x"] = object()
        yield from batches

    def held(cols):
        return {"n": [len(common.MODELS)] * len(cols["id"])}

    rows = spark.range(100).coalesce(1)
    assert rows.mapInArrow(keep, "id long").count() == 100
    assert {r.n for r in common.map_rows(rows, held, "n long").collect()} == {0}
