import hashlib
import random
import zlib
from functools import cache
from itertools import pairwise, product

import pytest

from entryflow.llm import conversations as C
from helpers import with_clashing

AFTER = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
FULL = {"u": "user", "a": "assistant"}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        left = text.rstrip(C.BLANK)
        out.append("blank" if not left else "duplicate" if (role, text) in seen
                   else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_force(rows):
    """Rows ``(turn, role, text)`` of a conversation in order; every path compared as cost and text."""
    bad = faults(rows)

    @cache
    def best(i, before, inserted):
        found = [(0, "", ())] if i == len(rows) and before in ("", "a") else []

        def then(cost, letter, line, *state):
            rest = best(*state)
            if rest:
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))

        if inserted < 3:
            for r in "ua":
                if before in AFTER[r]:
                    then(2, "I", (FULL[r] + ":",), i, r, inserted + 1)
        if i < len(rows):
            _, role, text = rows[i]
            then(3, "D", (), i + 1, before, 0)
            if bad[i] not in ("blank", "duplicate"):
                short = bad[i] == "truncated"
                if before in AFTER.get(role[:1], ()):
                    then(short, "K", (f"{role}:{text}",), i + 1, role[:1], 0)
                for r in "ua":
                    if before in AFTER[r]:
                        then(2 + short, "R", (f"{FULL[r]}:{text}",), i + 1, r, 0)
        return min(found, default=None, key=lambda x: x[:2])

    for i in reversed(range(len(rows))):  # so that no call goes deep
        for before in ("", "s", "u", "a"):
            best(i, before, 0)
    cost, audit, lines = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(bad.count, C._FLAGS), illegal, cost,
            audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def damaged(rows):
    """Rows ``(conv_id, turn, role, text)`` of one conversation."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return in_order(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_block_against_all_paths():
    kinds = [("s", False, False), ("u", False, False), ("a", False, True), ("x", False, False), ("u", True, False)]
    for n in range(4):
        for rows in product(kinds, repeat=n):
            turns = [(i, {"s": "system", "u": "user", "a": "assistant", "x": "xyz"}[r] if not bad else "user",
                      "" if bad else f"t{i}" + ("" if short else ".")) for i, (r, bad, short) in enumerate(rows)]
            want = brute_force(turns)
            ends = [C.solve_block(list(rows), e)[0] for e in range(4)]
            mine = min((p[0] + 2 * len(C._ENDING[e]), p[1] + C._ENDING[e]) for e, p in enumerate(ends) if p)
            assert mine == want[5:7]


def test_weights_order_by_cost_then_text():
    w = C.Weights(3)
    paths = [(c, "".join(p)) for n in range(4) for p in product("DIKR", repeat=n) for c in (0, 2, 5)]
    def weigh(path):
        out = path[0] << w.bits
        for letter in reversed(path[1]):
            out = w.before((0, letter, 0), out)
        return out
    assert sorted(paths) == sorted(paths, key=weigh)
    assert all(w.read(weigh(p)) == p for p in paths)


def test_cutting_anywhere_changes_nothing():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randrange(1, 14)
        turns = in_order([(i, rng.choice(("system", "user", "user", "assistant", "tool")),
                           rng.choice(("a.", "b!", "c", "", f"{i}."))) for i in range(n)])
        kinds = [{"blank": 1, "duplicate": 2, "truncated": 3, "": 0}[f] for f in faults(turns)]
        whole = C._Conversation(1)
        at = 0
        while at < n:
            size = rng.randrange(1, 5)
            block = C._Block(1, at)
            for (turn, role, _), f in list(zip(turns, kinds))[at:at + size]:
                block.add(role[:1], turn, f)
            whole.add(block.summary())
            at += size
        *_, last = whole.close()
        assert (last["gaps"], *(last[f] for f in C._FLAGS), last["illegal"], last["cost"], last["audit"]) \
            == brute_force(turns)[:-1]


def test_report(spark):
    rng = random.Random(1)
    rows = []
    for conv in [None, -3, *range(70)]:
        for i in range(rng.choice((1, 2, 5, 12))):
            turn = rng.choice((None, i, i, i, i + 3))
            rows.append((conv, turn, rng.choice(("system", "user", "assistant", "user", "assistant", "", None, "ünknown")),
                         rng.choice((None, "", " \n", "yes.", "no", f"text {i}? ", "é!", "x ", "end.\x0b\x1c"))))
    rows += rows[:9]
    got = C.repair_report(with_clashing(table(spark, rows))).collect()
    want = {c: brute_force(damaged(x)) for c, x in by_conversation(rows).items()}
    assert {r.conv_id: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_one_conversation_with_most_rows_spans_slices_and_blocks(spark):
    rng = random.Random(6)
    rows = [(7, i, rng.choice(("user", "assistant")), f"t{rng.randrange(2000)}" + rng.choice((".", "", "!")))
            for i in range(1500)]
    rows += [(c, i, "user", "same.") for c in range(5) for i in range(40)]
    got = C.repair_report(table(spark, rows)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: brute_force(damaged(x)) for c, x in by_conversation(rows).items()}


def test_edits_give_the_repaired_rows(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi"), (1, 2, "user", "Hi"),
            (2, 0, "user", "Why?"), (3, 5, "assistant", "w " * 200_000 + "."), (4, 1, "user", "")]
    whole, edits = C.repair(table(spark, rows))
    found = {}
    for r in edits.orderBy("conv_id", "pos", "nth").collect():
        found.setdefault(r.conv_id, []).append((r.edit, r.role, r.text if r.conv_id != 3 else len(r.text)))
    assert found[2] == [("K", "user", "Why?"), ("I", "assistant", "")]
    assert found[3] == [("I", "user", 0), ("K", "assistant", 400_001)]
    assert found[4] == [("D", "user", "")]
    assert [e for e, _, _ in found[1]] == list({r.conv_id: r.audit for r in whole.collect()}[1])
    kept = [r[0] for _, *r in (x for x in found[1] if x[0] != "D")]
    assert kept[0] == "system" and kept[1:] == ["user", "assistant"] * (len(kept) // 2)


def test_conversations_without_rows(spark):
    dropped = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    got = C.repair_report(table(spark, [(i, 0, "user", "x.") for i in dropped])).collect()
    empty = hashlib.sha256().hexdigest()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "", empty) for i in dropped]
    assert C.repair_report(table(spark, [(1, 0, "user", "x.")]).where("turn > 1")).collect() == []


@pytest.mark.parametrize("text, fault", [("a.", 0), ("a. \n", 0), ("a.\x85", 3), ("\x1c", 3), (" \t", 1), ("!", 0)])
def test_what_is_blank_or_cut_short(spark, text, fault):
    marked = C._with_faults(table(spark, [(1, 1, "user", text)])).collect()
    assert [r.fault for r in marked] == [fault]
