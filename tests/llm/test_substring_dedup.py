import random

import numpy as np

from entryflow.llm import substring_dedup as S
from helpers import ODD, documents, with_clashing


def sentence(rng, n):
    return " ".join(f"w{rng.randrange(9000)}" for _ in range(n)).capitalize() + "."


def passage(rng, sentences=6):
    return " ".join(sentence(rng, rng.randrange(8, 14)) for _ in range(sentences))


def test_tuned_bands_reach_the_recall():
    bands, rows = S.tune_bands()
    assert bands * rows <= S.MAX_HASHES
    assert 1 - (1 - S.SIMILARITY ** rows) ** bands >= S.RECALL
    assert S.tune_bands(0.8, 0.9, 100)[1] > rows


def test_band_keys_agree_as_often_as_similar():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b = np.sort(x[:800]), np.sort(x[100:])  # Jaccard 7/9
    keys = S.band_keys([a, b], 3000, 1)
    assert abs((keys[0] == keys[1]).mean() - 7 / 9) < 0.03


def test_units_cover_the_text():
    text = "One two three four five. Six seven eight nine ten!\n\nshort line\nÉin é̈ zwei drei vier fünf"
    got = S.units(text)
    assert [text[u[4]:u[5]].strip() for u in got] == [
        "One two three four five.", "Six seven eight nine ten!",
        "One two three four five. Six seven eight nine ten!", "Éin é̈ zwei drei vier fünf"]
    assert [(u[0], u[1], u[2], u[3]) for u in got] == [(0, 1, 0, 5), (1, 1, 5, 10), (0, 2, 0, 10), (2, 1, 12, 18)]
    assert S.units(None) == S.units("") == S.units(" \n ") == []


def test_cut_out():
    assert S.cut_out("abc\ndef\nghi", [(4, 7)]) == "abc\nghi"
    assert S.cut_out("abcdef", [(1, 3), (2, 4)]) == "aef"
    assert S.cut_out("abc", [(0, 3)]) == ""


def fixture(rng):
    whole, inside, near, split = passage(rng), passage(rng, 8), passage(rng, 7), passage(rng, 8)
    texts = {i: passage(rng) + "\n" + passage(rng) for i in range(40)}
    texts[100] = passage(rng) + "\n" + whole
    texts[101] = whole + "\n" + passage(rng)
    for i in (110, 111, 112):  # in the middle of a paragraph
        texts[i] = f"{passage(rng, 2)[:-1]} {inside} {passage(rng, 2)}"
    changed = near.split()
    changed[20] = "changed"
    texts[120], texts[121] = passage(rng) + "\n" + near, " ".join(changed) + "\n" + passage(rng)
    texts[130] = passage(rng) + "\n" + split.replace(". ", ".\n")  # over several lines
    texts[131] = split.replace(". ", ".\n") + "\n" + passage(rng)
    line = sentence(rng, 12)  # a short line that many share
    for i in range(10):
        texts[i] += "\n" + line
    own = sentence(rng, 40)
    texts[20] += "\n" + own + "\n" + own  # repeated within one document only
    return texts, {"whole": whole, "inside": inside}


def test_planted_repeats_are_found_and_others_left(spark):
    texts, planted = fixture(random.Random(3))
    ids = [*texts, None, 100]
    rows = [*texts.values(), texts[100], texts[100]]
    df = with_clashing(documents(spark, rows + ODD, ids + list(range(500, 500 + len(ODD)))))
    got = {}
    for r in S.repeated_regions(df.drop("id")).collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == {100, 101, 110, 111, 112, 120, 121, 130, 131}
    assert {i: {r.component_id for r in v} for i, v in got.items()} == {
        100: {100}, 101: {100}, 110: {110}, 111: {110}, 112: {110}, 120: {120}, 121: {120},
        130: {130}, 131: {130}}
    assert {i for i, v in got.items() if any(r.removed for r in v)} == {101, 111, 112, 121, 131}
    r = got[101][0]
    assert texts[101][r.start:r.end] == planted["whole"]
    left = S.cut_out(texts[101], [(c.start, c.end) for c in r.cuts])
    assert left == texts[101].split("\n")[1]
    r = got[111][0]
    assert r.n_words >= 50 and texts[111][r.start:r.end].strip() in planted["inside"]


def test_hierarchical_pivots_find_the_same_links(spark, monkeypatch):
    rng = random.Random(5)
    base = [passage(rng) for _ in range(3)]
    texts = [" ".join(w if rng.random() > 0.01 else "x" for w in rng.choice(base).split())
             for _ in range(60)] + [passage(rng) for _ in range(30)]
    df = documents(spark, texts, partitions=5)
    want = {r.id for r in S.repeated_regions(df).collect()}
    assert want >= set(range(60)) - {i for i in range(60) if texts[i].count("x") > 1}
    assert not want & set(range(60, 90))
    monkeypatch.setattr(S, "GATHER", 4)
    assert {r.id for r in S.repeated_regions(df).collect()} == want


def test_small_tables(spark):
    df = documents(spark, ["a b c d e f", None])
    assert S.repeated_regions(df).count() == 0
    assert S.repeated_regions(df.limit(0)).count() == 0


def bare(rng, n):
    return " ".join(f"w{rng.randrange(9000)}" for _ in range(n))


def test_passages_at_any_word_without_punctuation(spark):
    rng = random.Random(8)
    texts, planted = {}, {}
    for i in range(0, 60, 2):
        inside = bare(rng, rng.randrange(50, 70))
        for j in (i, i + 1):
            before, after = bare(rng, rng.randrange(1, 90)), bare(rng, rng.randrange(1, 90))
            if i % 4:  # sentences that begin and end inside the passage
                before, after = sentence(rng, 9) + " " + before, after + ". " + sentence(rng, 9)
            texts[j] = f"{before} {inside} {after}"
            planted[j] = (len(before) + 1, len(before) + 1 + len(inside))
    got = S.repeated_regions(documents(spark, list(texts.values()), list(texts))).collect()
    assert {(r.id, r.start, r.end) for r in got} == {(i, a, z) for i, (a, z) in planted.items()}
    assert all(r.component_id == r.id // 2 * 2 and r.removed == bool(r.id % 2) for r in got)


def test_a_changed_word_splits_no_passage(spark):
    rng = random.Random(9)
    ws = bare(rng, 50).split()
    for at in (9, 25, 40):
        changed = " ".join([*ws[:at], "changed", *ws[at + 1:]])
        df = documents(spark, [f"{bare(rng, 70)} {x} {bare(rng, 70)}" for x in (" ".join(ws), changed)])
        assert [r.n_words for r in S.repeated_regions(df).collect()] == [50, 50]


def test_words_of_runs_are_those_of_units():
    rng = random.Random(10)
    for text in [t for t in ODD if t] + ["".join(rng.choice("ab.! \n\u3000\x85\x1ct\u00e9") for _ in range(300))
                                         for _ in range(50)]:
        ws = [w for _, sentences in S.paragraphs(text) for _, _, s in sentences for w in s]
        starts, ends = S.word_places(text)
        assert [text[a:z].encode().lower() for a, z in zip(starts, ends)] == ws
        want = S.shingle_hashes(S.word_hashes(b" ".join(ws)), S.RUN_WORDS) if len(ws) >= S.RUN_WORDS else []
        assert list(S.run_hashes(text)) == list(want)


def test_members_unlike_their_pivot_are_linked(spark, monkeypatch):
    rng = random.Random(11)
    template = bare(rng, 60).split()
    texts = []
    for _ in range(250):  # variants of a template, half of them once more with a changed word
        ws = [w if rng.random() < 0.95 else f"v{rng.randrange(9000)}" for w in template]
        texts.append(" ".join(ws))
        if rng.random() < 0.5:
            ws[rng.randrange(1, 59)] = "changed"
            texts.append(" ".join(ws))
    df = documents(spark, texts)
    shingles = {h: s for t in texts for h, s in S.line_shingles(t)}
    nodes = list(shingles)
    bands, rows = S.tune_bands()
    keys = dict(zip(nodes, S.band_keys(list(shingles.values()), bands, rows)))
    root = {n: n for n in nodes}

    def find(n):
        return n if root[n] == n else find(root[n])

    for i, a in enumerate(nodes):  # brute force: all pairs that share a key and are similar
        for b in nodes[:i]:
            x, y = set(shingles[a].tolist()), set(shingles[b].tolist())
            if (keys[a] == keys[b]).any() and len(x & y) >= S.SIMILARITY * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    want = {n: find(n) for n in nodes}
    lines = S.unit_rows(df.selectExpr("doc_id id", "text")).where("line").select("hash", "id")
    rows_ = df.selectExpr("doc_id id", "text")
    pairs = S.stage(S.candidate_pairs(rows_, bands, rows), "passage_pairs")
    sets = S.shingle_sets(rows_, lines, pairs)
    links = S.stage(S.similar_pairs(sets, pairs), "passage_links")

    def labels(links):
        return {n: n for n in nodes} | {r.node: r.label for r in S.components(links).collect()}

    assert labels(links) != want  # pivots alone lose links
    for tile in (500, 7):
        monkeypatch.setattr(S, "TILE", tile)
        more = S.mixed_pairs(sets, S.components(links), bands, rows)
        assert labels(links.union(more)) == want


def test_adjacent_passages_keep_their_classes(spark):
    rng = random.Random(12)
    a, b = bare(rng, 40), bare(rng, 45)
    texts = {1: f"{bare(rng, 50)} {a} {bare(rng, 50)}", 20: f"{bare(rng, 50)} {b} {bare(rng, 50)}",
             30: f"{bare(rng, 50)} {a} {b} {bare(rng, 50)}", 40: f"{bare(rng, 50)}\n{b}\n{a}"}
    got = S.repeated_regions(documents(spark, list(texts.values()), list(texts))).collect()
    assert {(r.id, r.component_id, texts[r.id][r.start:r.end].strip()) for r in got} == {
        (1, 1, a), (30, 1, a), (40, 1, a), (20, 20, b), (30, 20, b), (40, 20, b)}


def test_shingles_that_a_line_repeats_count_once(spark):
    rng = random.Random(13)
    ws, again = bare(rng, 60).split(), bare(rng, 6)
    lines = [" ".join([*ws[:20], *mid, again, again, again, *ws[20:]]) for mid in (["left"] * 9, ["right"] * 9)]
    rows = documents(spark, lines).selectExpr("doc_id id", "text")
    pairs = S.stage(S.candidate_pairs(rows, 200, 1), "passage_pairs")
    sets = S.shingle_sets(rows, S.unit_rows(rows).where("line").select("hash", "id"), pairs)
    x, y = (set(s.tolist()) for t in lines for _, s in S.line_shingles(t))
    assert len(x & y) < S.SIMILARITY * len(x | y)
    assert pairs.count() == 1 and S.similar_pairs(sets, pairs).count() == 0
    assert {tuple(np.unique(S.expand_keys(r.shingles))) for r in sets.collect()} == {tuple(sorted(x)), tuple(sorted(y))}
    assert all(len(S.expand_keys(r.shingles)) in (len(x), len(y)) for r in sets.collect())


def test_picks_of_hot_hashes_cross_batches_and_tasks(spark):
    rng = random.Random(14)
    hot = bare(rng, 40)
    texts = [f"{bare(rng, 30)} {hot} {bare(rng, 30)}" for _ in range(90)] + [None, "", "a b", hot + " " + hot]
    texts += [bare(rng, 50) + " " + bare(rng, 3) for _ in range(20)]
    held = {}
    for i, t in enumerate(texts):
        windows = S.run_hashes(t)
        for at in S.picked(windows):
            held.setdefault(int(windows[at]), set()).add((i, int(at)))
    want = {p for places in held.values() if len({i for i, _ in places}) > 1 for p in places}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for records in ("7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            rows = documents(spark, texts, partitions=4).selectExpr("doc_id id", "text")
            got = [tuple(r) for r in S.repeated_picks(rows).collect()]
            assert len(got) == len(set(got)) and set(got) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def odd_texts(rng):
    texts = ODD + ["\n".join(t for t in ODD if t), "a " * 300, "ha. " * 90 + "\n" + "x y " * 200, bare(rng, 600)]
    for signs in ("ab.! \n　\x85\x1cté", "ab.!?  \n\tÉあ\U0001f600", "ab.  \n"):
        texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(500))) for _ in range(60)]
    texts += [" ".join(rng.choice(["a", "b", "c.", "\ud800"]) for _ in range(rng.randrange(150))) for _ in range(60)]
    rng.shuffle(texts)
    return texts


def test_texts_of_a_slice_are_read_as_alone(monkeypatch):
    rng = random.Random(15)
    texts = odd_texts(rng)
    for together in (1, 2000, 1 << 20):
        monkeypatch.setattr(S, "TOGETHER", together)
        got, picks, runs, lines = [], [], [], []
        for a, some in S.slices(texts):
            got += [(a + of, *u) for of, *u in zip(*(c.tolist() for c in S.units_of(some)))]
            picks += [(a + of, at, h) for of, at, h in zip(*(c.tolist() for c in S.picks_of(some)))]
            runs += [w.tolist() for w in S.runs_of(some)]
            lines += [(a + i, h, s.tolist()) for i, h, s in S.lines_of(some)]
        assert sorted(got) == sorted((i, *u) for i, t in enumerate(texts) for u in S.units(t))
        windows = [S.run_hashes(t) for t in texts]
        assert runs == [w.tolist() for w in windows]
        assert sorted(picks) == sorted((i, int(at), int(w[at])) for i, w in enumerate(windows) for at in S.picked(w))
        assert lines == [(i, h, s.tolist()) for i, t in enumerate(texts) for h, s in S.line_shingles(t)]
        # a line's hash is that of its unit
        assert {(i, h) for i, h, _ in lines} == {(u[0], u[7]) for u in got if u[8]}


def test_keys_of_two_members_make_no_tiles(spark, monkeypatch):
    rng = random.Random(16)
    a = bare(rng, 60).split()
    lines = [" ".join(a), " ".join([*a[:30], *bare(rng, 30).split()])]  # share keys, but are not similar
    rows = documents(spark, lines).selectExpr("doc_id id", "text")
    pairs = S.stage(S.candidate_pairs(rows, 200, 1), "passage_pairs")
    sets = S.shingle_sets(rows, S.unit_rows(rows).where("line").select("hash", "id"), pairs)
    links = S.stage(S.similar_pairs(sets, pairs), "passage_links")
    assert (pairs.count(), sets.count(), links.count()) == (1, 2, 0)
    with S.STAGED.watched() as written:
        assert S.mixed_pairs(sets, S.components(links), 200, 1).count() == 0
    mixed = [p for p in written if "/passage_mixed/" in p]
    assert len(mixed) == 1 and spark.read.parquet(mixed[0]).count() == 0


def test_ranges_of_keys_leave_nothing_out(spark):
    rng = random.Random(17)
    hot = bare(rng, 40)
    texts = [f"{bare(rng, 30)} {hot}" for _ in range(20)] + [bare(rng, 20) + "\n" + bare(rng, 9) for _ in range(20)]
    rows = documents(spark, [*texts, None, ""]).selectExpr("doc_id id", "text")
    bands, band_rows = S.tune_bands()
    found = [(S.repeated_picks(rows, n).collect(), S.candidate_pairs(rows, bands, band_rows, n).collect())
             for n in (1, 2, 97)]
    picks, pairs = ([sorted(map(tuple, x)) for x in y] for y in zip(*found))
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) >= 40
    assert pairs[0] == pairs[1] == pairs[2]
    none = rows.where("text is null")
    assert S.repeated_picks(none).count() == S.candidate_pairs(none, bands, band_rows).count() == 0
