"""Repairing the structure of conversations by their cheapest edits.

A conversation's roles should read ``(s?(ua)+)?`` by their initials. Its rows are
kept, reroled or deleted, and empty turns inserted; the cheapest edits win, and of
equally cheap ones those whose initials (the audit) come first in ASCII.

Both wishes are one number. The weight of a path is ``cost * 8 ** W + digits``: the
low ``W`` octal digits spell the audit from the left, a digit a letter, and zeros
fill the end, so of two audits of one cost the lesser number is the earlier text,
a prefix before what continues it. The programme runs over (row, state of the role
pattern) from the last row to the first and takes the least integer, nothing else.

A conversation may hold any share of all rows. Rows are sorted by range into
slices; each slice is cut into blocks of at most ``BLOCK`` rows of one
conversation, and a block's programme gives the least weight for each pair of
states at its two ends. These tables are then joined from left to right: per state
the cheapest audit so far, as a chain of blocks. Two audits of one cost that lead
to the same row and state are never prefixes of each other (what one has more are
insertions, which cost), so the lesser stays the lesser whatever follows. Only the
edits of a conversation, four letters a row, meet in one task, and, for its hash,
its repaired rows pass through one in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from entryflow.llm.common import as_batch, stage

#: Rows of a block, and the characters that count as blank.
BLOCK, BLANK = 256, " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1

#: Octal digits of the audit's letters, in ASCII order; 0 stands for no letter.
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = "\0DIKR"
# States: nothing yet, after s, after u, after a. What a role leads to from each.
_START, _STATES = 0, range(4)
_NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_GOOD = ("su", "ua", "au")
_FULL = {"u": "user", "a": "assistant"}
#: Cheapest insertions that end a conversation, by its last state.
_ENDING = ("", "II", "I", "")


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults, by crc32 of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the
    user's. Nulls count as a space in that key, and as roles and texts."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("conv_id", "turn", "role", "text")]
    key = F.crc32(F.concat(known[0], F.lit(":"), known[1])) % 20
    read = rows.select("conv_id", "turn", *known[2:], key.alias("kind")).where("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return read.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("n")).drop("n")


# -- a block ----------------------------------------------------------------

def _edits(state: int, initial: str, bad: bool, short: bool) -> Iterator[tuple[int, str, int]]:
    """Cost, letter and next state of what may be done with a row in a state."""
    yield DELETE, "D", state
    if not bad:
        kept = _NEXT.get(initial, {}).get(state)
        if kept is not None:
            yield KEEP + short, "K", kept
        for role in "ua":
            if state in _NEXT[role]:
                yield REROLE + short, "R", _NEXT[role][state]


def _insertions(state: int) -> Iterator[tuple[int, str, int]]:
    for role in "ua":
        if state in _NEXT[role]:
            yield INSERT, "I", _NEXT[role][state]


class Weights:
    """Weights of paths over a block of ``n`` rows.

    No least path has a row's cost in insertions more than deleting all rows and two
    insertions would have, which bounds the letters.
    """

    def __init__(self, n: int):
        digits = n + (DELETE * n + 2 * INSERT) // INSERT + 1
        self.bits, self.top = 3 * digits, 3 * (digits - 1)
        self.low = (1 << self.bits) - 1

    def before(self, edit: tuple[int, str, int], rest: int | None) -> int | None:
        """The weight of an edit followed by a path; all its letters move on by a place."""
        if rest is None:
            return None
        cost, letter, _ = edit
        return (((rest >> self.bits) + cost << self.bits)
                + (_DIGIT[letter] << self.top) + ((rest & self.low) >> 3))

    def read(self, weight: int) -> tuple[int, str]:
        digits = oct(weight & self.low | 1 << self.bits)[3:].rstrip("0")
        return weight >> self.bits, "".join(_LETTER[int(d)] for d in digits)


def _least(weights: Iterator[int | None]) -> int | None:
    return min((w for w in weights if w is not None), default=None)


def solve_block(rows: list[tuple[str, bool, bool]], end: int) -> list[tuple[int, str] | None]:
    """For each state at the start, cost and audit of the least path to state ``end``.

    A row is (initial of its role, must go, is cut short). Insertions stand before rows.
    """
    w = Weights(len(rows))
    best: list[int | None] = [0 if s == end else None for s in _STATES]
    for row in reversed(rows):
        best = [_least(w.before(e, best[e[2]]) for e in _edits(s, *row)) for s in _STATES]
        for _ in range(2):  # two insertions reach every state that any number reaches
            best = [_least([best[s], *(w.before(e, best[e[2]]) for e in _insertions(s))]) for s in _STATES]
    return [None if b is None else w.read(b) for b in best]


_FLAGS = ["blank", "duplicate", "truncated"]


class _Block:
    """Rows of one conversation that follow each other in a slice."""

    def __init__(self, conv_id, pos: int):
        self.conv_id, self.pos = conv_id, pos
        self.rows: list[tuple[str, int]] = []  # initial and fault (0 none, else 1 + place in _FLAGS)
        self.turns: list[int] = []  # different turns, not null

    def add(self, initial: str, turn, fault: int) -> None:
        self.rows.append((initial, fault))
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def summary(self) -> dict:
        rows = [(i, f in (1, 2), f == 3) for i, f in self.rows]
        paths = [solve_block(rows, end) for end in _STATES]
        faults = [f for _, f in self.rows]
        initials = [i for i, _ in self.rows]
        return {"conv_id": self.conv_id, "pos": self.pos, "initials": initials,
                "faults": [faults.count(k + 1) for k in range(3)],
                "turns": [*self.turns[:1], *self.turns[-1:]], "n_turns": len(self.turns),
                "costs": [p[0] if p else -1 for path in paths for p in path],
                "audits": [p[1] if p else None for path in paths for p in path]}


def _schema(texts: str = "", longs: str = "", **lists: pa.DataType) -> pa.Schema:
    return pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in longs.split()],
                      *[(c, pa.string()) for c in texts.split()],
                      *[(c, pa.list_(kind)) for c, kind in lists.items()]])


_ROWS = _schema("role text", "pos turn fault")
_BLOCKS = _schema("", "pos n_turns", initials=pa.string(), faults=pa.int64(), turns=pa.int64(),
                  costs=pa.int64(), audits=pa.string())
_EDITS = _schema("ending audit", "pos gaps blank duplicate truncated illegal cost", edits=pa.string())
_HASHES = _schema("repaired_sha256")


def _map(df: DataFrame, fn, schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(fn, from_arrow_schema(schema))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield as_batch({f.name: [x[f.name] for x in held] for f in schema}, schema)
            held = []
    yield as_batch({f.name: [x[f.name] for x in held] for f in schema}, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    """Blocks of rows ``conv_id, pos, turn, initial, fault``, which come in order of ``pos``."""
    block = None
    for b in batches:
        for conv, pos, turn, initial, fault in zip(*(c.to_pylist() for c in b.columns)):
            if block is None or conv != block.conv_id or pos != block.pos + len(block.rows) or len(block.rows) == BLOCK:
                if block is not None:
                    yield block
                block = _Block(conv, pos)
            block.add(initial, turn, fault)
    if block is not None:
        yield block


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batches((block.summary() for block in _cut(batches)), _BLOCKS)


# -- blocks of a conversation ------------------------------------------------

class _Link:
    """The end of a chain of blocks: cost so far, the last block's audit, the chain before."""

    __slots__ = ("cost", "audit", "state", "before")

    def __init__(self, cost: int, audit: str, state: int, before: _Link | None):
        self.cost, self.audit, self.state, self.before = cost, audit, state, before

    def chain(self, until: _Link | None = None) -> list[_Link]:
        out, at = [], self
        while at is not until:
            out.append(at)
            at = at.before
        return out[::-1]


def _first(a: _Link | None, b: _Link | None) -> _Link | None:
    """The lesser of two chains of equally many blocks."""
    if a is None or b is None:
        return a or b
    if a.cost != b.cost:
        return a if a.cost < b.cost else b
    x, y = a, b  # back to where they part
    while x.before is not y.before:
        x, y = x.before, y.before
    shared = x.before
    texts = ["".join(c.audit for c in end.chain(shared)) for end in (a, b)]
    return a if texts[0] <= texts[1] else b


class _Conversation:
    """What is known of a conversation after some of its blocks."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.faults, self.illegal, self.last = [0, 0, 0], 0, None
        self.turns, self.n_turns = [], 0
        self.blocks: list[tuple[int, list[str]]] = []  # first position and initials
        root = _Link(0, "", _START, None)
        self.ends: list[_Link | None] = [root, None, None, None]
        self.root = root

    def add(self, b: dict) -> None:
        self.faults = [x + y for x, y in zip(self.faults, b["faults"])]
        initials = ([] if self.last is None else [self.last]) + b["initials"]
        self.illegal += sum(x + y not in _GOOD for x, y in pairwise(initials))
        self.last = initials[-1]
        if b["turns"]:
            self.n_turns += b["n_turns"] - (self.turns[-1:] == b["turns"][:1])
            self.turns = [*self.turns[:1], *b["turns"]] if self.turns else b["turns"]
        self.blocks.append((b["pos"], b["initials"]))
        ends: list[_Link | None] = []
        for end in _STATES:
            found = None
            for start in _STATES:
                cost, before = b["costs"][4 * end + start], self.ends[start]
                if cost >= 0 and before is not None:
                    found = _first(found, _Link(before.cost + cost, b["audits"][4 * end + start], end, before))
            ends.append(found)
        self.ends = ends

    def close(self) -> Iterator[dict]:
        """A row per block with its rows' edits; the last one also has the conversation's result."""
        best = None
        for state, link in enumerate(self.ends):
            if link is not None:
                audit = _ENDING[state]
                best = _first(best, _Link(link.cost + INSERT * len(audit), audit, state, link))
        *chain, ending = best.chain(self.root)
        gaps = max(self.turns) - min(self.turns) + 1 - self.n_turns if self.turns else 0
        for i, ((pos, initials), link) in enumerate(zip(self.blocks, chain)):
            last = i == len(chain) - 1
            yield {"conv_id": self.conv_id, "pos": pos,
                   "edits": _spelled(link.before.state, link.audit, initials),
                   "ending": _spelled(link.state, ending.audit, [])[0] if last else None,
                   "gaps": min(gaps, 2**63 - 1) if last else None,
                   **{name: n if last else None for name, n in zip(_FLAGS, self.faults)},
                   "illegal": self.illegal if last else None, "cost": best.cost if last else None,
                   "audit": "".join(x.audit for x in (*chain, ending)) if last else None}


def _spelled(state: int, audit: str, initials: list[str]) -> list[str]:
    """The audit as a text for each row: ``u`` and ``a`` insert before it, then ``K`` keeps
    it, ``D`` deletes it, ``U`` and ``A`` rerole it. What follows the last row is one more text."""
    out, here, rows = [], "", iter(initials)
    for letter in audit:
        turn = "a" if state == 2 else "u"  # the only role that may come next, but for a leading s
        if letter == "I":
            here += turn
        else:
            initial = next(rows)
            turn = initial if letter == "K" else turn
            out.append(here + (turn.upper() if letter == "R" else letter))
            here = ""
        if letter != "D":
            state = _NEXT[turn][state]
    return out if initials else [here]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        at = None
        for b in batches:
            for block in b.to_pylist():
                if at is None or block["conv_id"] != at.conv_id:
                    if at is not None:
                        yield from at.close()
                    at = _Conversation(block["conv_id"])
                at.add(block)
        if at is not None:
            yield from at.close()
    yield from _batches(rows(), _EDITS)


# -- tables -----------------------------------------------------------------

def _with_faults(rows: DataFrame) -> DataFrame:
    """Rows in order with ``pos`` (growing with conversation, turn, role and text hash) and
    ``fault`` (0, or 1 blank, 2 duplicate, 3 truncated), written to the shared folder."""
    left = F.rtrim("text", F.lit(BLANK))
    read = rows.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"),
                       (left == "").alias("blank"), (~F.right(left, F.lit(1)).isin(".", "!", "?")).alias("short"))
    # first turn of texts that stand in several turns; of one turn's equal rows, all but one are later
    first = (read.where("not blank").groupBy(*[F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "digest")])
             .agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
             .where("not (first <=> last)"))
    marked = read.join(first, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("conv_id", "role", "digest")], "left")
    keys = ["conv_id", "turn", "role", "digest"]
    ranged = (marked.select(*keys, "text", "blank", "short",
                            (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("later"))
              .repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("pos", F.monotonically_increasing_id()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # equal keys are never in two slices
        for b in batches:
            cols = {c: b.column(c).to_pylist() for c in (*keys, "blank", "short", "later")}
            faults = []
            for key, blank, short, later in zip(zip(*(cols[k] for k in keys)), cols["blank"], cols["short"], cols["later"]):
                faults.append(1 if blank else 2 if later or key == before else 3 if short else 0)
                before = key
            yield pa.RecordBatch.from_arrays(
                [pa.array(faults, pa.int64()) if f.name == "fault" else b.column(f.name) for f in _ROWS], schema=_ROWS)

    return stage(_map(ranged, mark, _ROWS), "conversation_rows")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation of ``conv_id, turn, role, text``.

    Returns a row per conversation (``conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit``) and a row per edit (``conv_id, pos, nth, edit, role, text``): in the order
    of ``pos, nth`` the edits D, I, K and R with the row that each leaves (D: that it takes).

    Rows are taken by turn, null first; rows of one turn by role, then by a hash of the
    text, so equal rows stand together and all but the first of them are duplicates. Nulls
    in role and text count as a space; a null id is a conversation of its own. Texts are
    taken whole. An empty table has no conversations. Other columns are ignored.
    """
    nulls = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    marked = _with_faults(rows.select("conv_id", "turn", *nulls))
    initial = F.substring("role", 1, 1).alias("initial")
    blocks = stage(_map(marked.select("conv_id", "pos", "turn", initial, "fault"), _solved, _BLOCKS),
                   "conversation_blocks")
    in_order = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    edits = stage(_map(in_order, _joined, _EDITS), "conversation_edits")
    whole = edits.where("audit is not null").select("conv_id", "gaps", *_FLAGS, "illegal", "cost", "audit")

    per_row = edits.select("pos", F.posexplode("edits").alias("nth", "code")).select(
        (F.col("pos") + F.col("nth")).alias("pos"), "code")
    done = marked.join(per_row, "pos").select("conv_id", "pos", "code", "role", "text")
    at_end = (edits.where("ending <> ''").select(
        "conv_id", (F.col("pos") + F.size("edits") - 1).alias("pos"), F.lit(" ").alias("before"), "ending")
        .select("conv_id", "pos", F.concat("before", "ending").alias("code"),
                F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")))
    return whole, _edited(done.union(at_end))


def _edited(rows: DataFrame) -> DataFrame:
    """A row per letter of ``code``. Insertions after the last row have a code that begins
    with a space, so their numbers in the code come after the row's own."""
    letter, role = F.col("letter"), F.col("role")
    one = rows.select("conv_id", "pos", "role", "text", F.startswith("code", F.lit(" ")).alias("late"),
                      F.posexplode(F.split(F.trim("code"), "")).alias("nth", "letter")).where("letter <> ''")
    new = (F.when(F.upper("letter") == "U", _FULL["u"]).when(F.upper("letter") == "A", _FULL["a"]).otherwise(role))
    return one.select("conv_id", "pos", (F.col("nth") + F.when(F.col("late"), 3).otherwise(0)).alias("nth"),
                      F.when(letter.isin("u", "a"), "I").when(letter.isin("U", "A"), "R").otherwise(letter).alias("edit"),
                      new.alias("role"), F.when(letter.isin("u", "a"), "").otherwise(F.col("text")).alias("text"))


def transcript_hashes(edits: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of the repaired rows' ``role:text``, newline-joined.

    A hash runs over its conversation in order, so one task reads it, a batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            at, digest = None, None
            for b in batches:
                for conv, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if digest is None or conv != at:
                        if digest is not None:
                            yield {"conv_id": at, "repaired_sha256": digest.hexdigest()}
                        at, digest = conv, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(line.encode("utf-8", "surrogatepass"))
            if digest is not None:
                yield {"conv_id": at, "repaired_sha256": digest.hexdigest()}
        yield from _batches(rows(), _HASHES)

    order = ["conv_id", "pos", "nth"]
    lines = (edits.where("edit <> 'D'").select(*order, F.concat_ws(":", "role", "text").alias("line"))
             .repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "line"))
    return _map(lines, run, _HASHES)


def _with_id(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Left join by conversation, a null id included."""
    more = more.withColumnRenamed("conv_id", "_conv_id")
    return rows.join(more, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")


def repair_report(rows: DataFrame) -> DataFrame:
    """A row per conversation of ``rows`` after ``damage`` and ``repair``: counts of faults,
    cost, audit and the hash of what is left; one without rows has zeros and empty texts."""
    whole, edits = repair(damage(rows))
    hashes = transcript_hashes(edits)
    every = rows.select("conv_id").distinct()
    joined = _with_id(_with_id(every, whole), hashes)
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_FLAGS, "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
