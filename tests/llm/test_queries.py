"""The registered queries on the smallest tables, against SQL or plain Python."""

import duckdb
import pytest

from entryflow.llm.oracle import SQL
from entryflow.llm.queries import QUERIES
from entryflow.session import build_session  # noqa: F401  (the package's session helper stays importable)
from test_katz import BruteForce
from test_ngram_join import brute_force, shingles
from test_quality import brute_force as measures, lost_words
from test_secret_scan import brute_force as spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(SQL[name])
    df = QUERIES[name](spark, SF)
    assert sorted(map(str, df.select(*rel.columns).collect())) \
        == sorted(str(r) for r in spark.createDataFrame(rel.df(), df.select(*rel.columns).schema).collect())


def test_op1(spark, docs):
    for r in QUERIES["op1_quality_rules"](spark, SF).collect():
        want = measures(docs[r.doc_id].text or "")
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    rows = list(docs.values())
    lost = lost_words([r.text or "" for r in rows], [r.source for r in rows])
    got = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert [got[r.doc_id].n_lost_words for r in rows] == lost
    assert all(got[r.doc_id].kept == (not got[r.doc_id].base_failed and n <= 0.5 * got[r.doc_id].n_words)
               for r, n in zip(rows, lost))


def test_op2(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    hits, total = 0, 0
    got = QUERIES["op2_adaptive_scan"](spark, SF).collect()
    for q in (i for i in rows if i % 20 == 0):
        score = {i: sum(float(a) * float(b) for a, b in zip(rows[q], v)) for i, v in rows.items() if i != q}
        want = set(sorted(score, key=lambda i: (-score[i], i))[:20])
        mine = {r.vec_id: r.score for r in got if r.query_id == q}
        assert all(s == pytest.approx(score[i], abs=1e-12) for i, s in mine.items())
        hits, total = hits + len(want & set(mine)), total + len(want)
    assert hits >= 0.9 * total


def test_op3(spark, docs):
    for r in QUERIES["op3_secret_scan"](spark, SF).collect():
        base = spans(docs[r.doc_id].text or "")
        kinds = [k for k, _, _ in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(kinds.count, ("assign", "access", "hex")))
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))


def test_op5(spark, docs):
    want = brute_force([(d, r.text) for d, r in docs.items()])
    got = QUERIES["op5_ngram_join"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(docs[r.doc_id].text)) for r in got)


def test_op8(spark, docs):
    model = BruteForce([(d, r.text) for d, r in docs.items()])
    got = QUERIES["op8_katz"](spark, SF).collect()
    assert {r.train_tokens for r in got} == {model.n}
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op10(spark, docs):
    for r in QUERIES["op10_substring_dedup"](spark, SF).collect():
        assert 0 <= r.start < r.end <= len(docs[r.doc_id].text) and r.component_id in docs


def test_op12(spark):
    from test_conversations import brute_force, damaged
    rows = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        rows.setdefault(r.conv_id, []).append(tuple(r))
    got = QUERIES["op12_conversations"](spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: brute_force(damaged(x)) for c, x in rows.items()}


def test_op6(spark, docs):
    import zlib
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    slots = {}
    for r in rows:
        data = (docs[r.doc_id].text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_op4_and_op9(spark, docs):
    """Against the tokenizers library on every document."""
    import hashlib
    import zlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: coder.encode(r.text or "", add_special_tokens=False).ids for d, r in docs.items()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for r in QUERIES["op4_bpe"](spark, SF).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids[r.doc_id]), digest(" ".join(map(str, ids[r.doc_id]))),
            digest(coder.decode(ids[r.doc_id], skip_special_tokens=False)))
    taken, filled = {}, {}
    for r in QUERIES["op9_packing"](spark, SF).collect():
        whole = np.array([*ids[r.doc_id], 2], dtype="<u4")
        assert r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[r.start:r.start + r.length].tobytes())
        taken.setdefault(r.doc_id, []).append((r.start, r.length))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces, ends in [(p, len(ids[d]) + 1) for d, p in taken.items()] + [(p, None) for p in filled.values()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == ends if ends is not None else at <= 4096
    assert set(taken) == set(docs)
