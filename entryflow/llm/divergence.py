"""How the word use of sources differs, priced on hash-consed segment trees.

A group (a source within a language) has a count for every kept term of its
language. Terms get ids, frequent ones first, and ids are cut into blocks of
``BLOCK``. For a block, every group's counts are the leaves of a segment tree.
Trees are hash-consed: a node is named by its two children, so equal stretches of
counts are one node, in whichever group and place they stand (stretches of zeros
above all). Two trees are walked together from their roots; a pair of nodes that
was met before is not walked again, so each pair of equal stretches is priced
once. The price of a leaf pair depends on the two counts and on the groups' totals.

Where the work goes: words are counted per group inside the tasks, then summed by
(language, source, term), so no frequent word and no large source makes a large
group. A task of the pricing holds one block of terms of at most two tiles of
``TILE`` groups. Tables of groups (one row each) and of terms stay distributed.
The result itself has a row for each pair of sources of a language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from entryflow.llm.common import stage, utf8
from entryflow.operators.numbering import assign_numbers

#: Documents of its language that a term must stand in, to be kept.
MIN_DOCS = 10
#: Terms of a group that are reported.
TOP_TERMS = 10
#: Shares are whole numbers of this many parts, with so many counts added to each term.
PARTS, ADDED = 1_000_000_000, 2
#: Leaves of a tree (a power of two), and groups of a tile.
BLOCK, TILE = 4096, 64
#: Entries of a task's tables of counts, beyond which they are written out.
HELD = 400_000

# Everything but ASCII letters and bytes of other code points separates terms.
_TERMS = bytes(b if b >= 0x80 else b | 0x20 if chr(b).isalpha() else 0x20 for b in range(256))

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of ASCII letters, lower-cased, and of non-ASCII."""
    return utf8(text).translate(_TERMS).split()


class _Table:
    """Counts of one task, by group and term."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: str | None) -> None:
        n, docs = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(n)
        found = terms(text)
        n.update(found)
        docs.update(set(found))
        self.size += len(n) - before

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What was counted, a batch per group; the empty term stands for the group itself."""
        for (lang, source), (n, docs) in self.groups.items():
            n[b""], docs[b""] = 0, 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n)), pa.array([source] * len(n)),
                 pa.array(list(n), type=pa.binary()).cast(pa.string()),
                 pa.array(list(n.values()), type=pa.int64()),
                 pa.array([docs[t] for t in n], type=pa.int64())], schema=_COUNTS)
        self.__init__()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n`` (occurrences) and ``docs`` (documents with the term);
    each group also has a row with an empty term and no counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Table()
        for b in batches:
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                held.add(lang, source, text)
                if held.size > HELD:
                    yield from held.rows()
        yield from held.rows()

    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.col("text").alias("text"))
    rows = read.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n, total, terms) -> F.Column:
    """1 + floor(PARTS * (n + ADDED) / (total + ADDED * terms)), exactly."""
    return F.expr(f"1 + ({PARTS}BD * ({n} + {ADDED})) div (cast({total} as decimal(20, 0)) + {ADDED} * {terms})")


def price(p, q):
    return (p - q) * (p - q) // (p + q)


# -- trees ------------------------------------------------------------------

def build_trees(leaves: np.ndarray) -> list[np.ndarray]:
    """Node names by level, leaves first, of a matrix of counts (a row per group).

    A level's names number its different nodes from 0, over all groups: equal
    names are equal subtrees. Level ``0`` names counts by ``np.unique``.
    """
    levels = [np.unique(leaves, return_inverse=True)[1].reshape(leaves.shape)]
    while levels[-1].shape[1] > 1:
        below = levels[-1]
        both = below[:, 0::2] * (below.max() + 1) + below[:, 1::2]
        levels.append(np.unique(both, return_inverse=True)[1].reshape(both.shape))
    return levels


class _Children:
    """The two children of every node of a level."""

    def __init__(self, levels: list[np.ndarray]):
        self.left, self.right = [None], [None]
        for below, here in zip(levels, levels[1:]):
            _, first = np.unique(here.ravel(), return_index=True)
            row, col = np.divmod(first, here.shape[1])
            self.left.append(below[row, 2 * col])
            self.right.append(below[row, 2 * col + 1])


def price_roots(a: int, b: int, levels: list[np.ndarray], children: _Children,
                p: np.ndarray, q: np.ndarray) -> int:
    """The price of the trees of groups ``a`` and ``b``, whose leaf counts have shares ``p, q``.

    The walk goes down a level at a time with the pairs of nodes met there, each
    pair once, and adds the prices up again on the way back.
    """
    left, right = levels[-1][a], levels[-1][b]
    ways = []
    for level in range(len(levels) - 1, 0, -1):
        names = int(levels[level - 1].max()) + 1
        pairs = np.concatenate([children.left[level][left] * names + children.left[level][right],
                                children.right[level][left] * names + children.right[level][right]])
        met, way = np.unique(pairs, return_inverse=True)
        ways.append(way)
        left, right = np.divmod(met, names)
    prices = price(p[left], q[right])
    for way in reversed(ways):
        of_children = prices[way]
        half = len(of_children) // 2
        prices = of_children[:half] + of_children[half:]
    return int(prices[0])


def _block_prices(lo: list[tuple], hi: list[tuple] | None, size: int, n_terms: int) -> Iterator[tuple]:
    """Prices of all pairs of groups of two tiles, or within one (``hi`` None), in a
    block of ``size`` terms. A group is ``(number, total, offsets, counts)``."""
    groups = lo + (hi or [])
    leaves = np.zeros((len(groups), 1 << (size - 1).bit_length()), dtype=np.int64)
    for row, (_, _, at, n) in zip(leaves, groups):
        row[at] = n
    # beyond the block's end stand leaves that cost nothing
    leaves[:, size:] = -1
    counts = np.unique(leaves).tolist()
    levels = build_trees(leaves)
    children = _Children(levels)
    shares = [np.array([1 if c < 0 else 1 + PARTS * (c + ADDED) // (total + ADDED * n_terms)
                        for c in counts], dtype=np.int64) for _, total, _, _ in groups]
    for i in range(len(lo)):
        for j in range(i + 1 if hi is None else len(lo), len(groups)):
            yield groups[i][0], groups[j][0], price_roots(i, j, levels, children, shares[i], shares[j])


def _price_tiles(key: tuple, group: pa.Table) -> pa.Table:
    _, block, tile, other = (k.as_py() for k in key)
    cols = group.to_pydict()
    tiles: dict[int, list[tuple]] = {tile: [], other: []}
    # by number, so that a pair of groups is named alike in all blocks
    for g, total, at, n in sorted(zip(cols["g"], cols["total"], cols["at"], cols["n"]), key=lambda r: r[0]):
        tiles[g // TILE].append((g, total, np.asarray(at or [], dtype=np.int64), np.asarray(n or [], dtype=np.int64)))
    n_terms = cols["terms"][0]
    size = min(BLOCK, n_terms - block * BLOCK)
    lo, hi = tiles[tile], tiles[other] if other != tile else None
    found = list(_block_prices(lo, hi, size, n_terms))
    return pa.table({"lang": pa.array([cols["lang"][0]] * len(found), pa.string()),
                     "a": pa.array([x[0] for x in found], pa.int64()),
                     "b": pa.array([x[1] for x in found], pa.int64()),
                     "value": pa.array([x[2] for x in found], pa.int64())})


# -- the audit --------------------------------------------------------------

def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """How far the sources of each language are from each other, and by which terms.

    Takes ``lang, source, text``; returns ``lang, source, part, item, value, rank``.
    Part ``pair`` has, for each source, every other source of its language, the
    farthest first; part ``term`` the ``top`` terms that the source uses more than
    its language does, by what they add to its distance from the language. Ties
    go to the item that is less by its UTF-8 bytes.

    Nulls are read as ''. A group without terms counts as one whose terms all have
    count 0; a language without kept terms prices all pairs at 0 and reports no
    term. Texts are counted whole. Repeated rows are documents of their own. An
    empty table gives no rows. Other columns, of any name, are ignored.
    """
    counts = stage(term_counts(docs), "term_counts")
    by_term = (counts.where("term <> ''").groupBy("lang", "term")
               .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= min_docs)
               .select("lang", "term", "lang_n", (-F.col("lang_n")).alias("order")))
    kept = stage(assign_numbers(by_term, "lang", ["order", "term"], out_col="id").drop("order"), "kept_terms")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    used = stage(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "n", "lang_n"),
                 "used_terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term = ''").select("lang", "source")
              .join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms", "lang_total")]))
    groups = stage(assign_numbers(groups, "lang", ["source"], out_col="g"), "audit_groups")
    return _pairs(groups, used).union(_terms(groups, used, top))


def _pairs(groups: DataFrame, used: DataFrame) -> DataFrame:
    tiles = groups.groupBy("lang").agg((F.floor(F.max("g") / TILE) + 1).alias("tiles"))
    known = groups.join(tiles, "lang")
    leaves = (used.join(known.select("lang", "source", "g"), ["lang", "source"])
              .groupBy("lang", "g", F.expr(f"id div {BLOCK}").alias("block"))
              .agg(F.collect_list(F.struct(F.pmod("id", F.lit(BLOCK)).alias("at"), "n")).alias("leaves")))
    # a row for every group and block of its language, with counts or without
    blocks = (known.where("terms > 0").withColumn("block", F.explode(F.expr(f"sequence(0L, (terms - 1) div {BLOCK})")))
              .select("lang", "g", "block", "total", "terms", "tiles"))
    vectors = blocks.join(leaves, ["lang", "g", "block"], "left").select(
        "lang", "block", "g", "total", "terms", F.col("leaves.at").alias("at"), F.col("leaves.n").alias("n"),
        F.explode(F.expr("sequence(0L, tiles - 1)")).alias("other"))
    own = F.expr(f"g div {TILE}")
    tasks = vectors.select("*", F.least(own, "other").alias("tile"), F.greatest(own, "other").alias("with")).drop("other")
    partial = (tasks.groupBy("lang", "block", "tile", "with")
               .applyInArrow(_price_tiles, "lang string, a long, b long, value long"))
    priced = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # every pair of groups of a language, priced or (without kept terms) not
    others = (known.where("terms = 0").withColumn("b", F.explode(F.expr("sequence(0L, tiles * %d - 1)" % TILE)))
              .where("g < b").select("lang", F.col("g").alias("a"), "b", F.lit(0).cast("long").alias("value")))
    both = priced.union(others)
    both = stage(both.union(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")), "group_pairs")
    name = groups.select("lang", F.col("g").alias("a"), "source")
    item = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    return _ranked(both.join(name, ["lang", "a"]).join(item, ["lang", "b"]), "pair")


def _terms(groups: DataFrame, used: DataFrame, top: int) -> DataFrame:
    shares = (used.join(groups.select("lang", "source", "total", "lang_total", "terms"), ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), _share("n", "total", "terms").alias("p"),
                      _share("lang_n", "lang_total", "terms").alias("q")))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    return _ranked(shares.where("p > q").withColumn("value", value), "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value",
                       F.row_number().over(order).alias("rank"))
