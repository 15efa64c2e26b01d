"""Mixing sources to target weights.

The words of every source are summed, targets follow from the weights, and a
source's rate is its target over its words. Each document is emitted
``floor(rate)`` times, and once more with a probability equal to the rate's
fraction, by a draw hashed from the document: a rerun, in any partitioning,
draws the same.

The draws of a source are turned by one of ``TRIALS`` fixed angles, each of
which is as good a seed as any other. One aggregation sums the words that every
angle would take, and a source uses the angle that comes nearest its target.

Nothing is gathered by source: words and trials are summed with a map-side part,
so a source with most of the rows costs no single task more, and the table of
sources (one row each) stays distributed, its numbering included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from entryflow.llm.common import stage
from entryflow.operators.numbering import assign_numbers

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words, and how often a source may be taken.
SHARE, MOST = 1.5, 2.0
#: Angles that a source's draws may be turned by.
TRIALS = 32

_SPAN = 1 << 32
#: Turns that fill the circle evenly, however many are taken (the golden section of it).
_TURN = 2654435769


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hashed_draw(*values: Column) -> Column:
    """A number from 0 to 2**32 - 1 that depends on the values only."""
    key = F.concat_ws(":", *[F.coalesce(v.cast("string"), F.lit("")) for v in values])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def _extra(draw: Column, turn: Column | int, rate: Column) -> Column:
    """Whether the draw, turned, falls into the rate's fraction."""
    turned = F.pmod(draw + turn, F.lit(_SPAN))
    return turned < (rate - F.floor(rate)) * F.lit(float(_SPAN))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """``source, source_size, target`` of a table ``source, size``.

    Sources in the order of their UTF-8 bytes, null last, get the weights in
    turn and share ``share`` times all words by weight; none gets more than
    ``most`` times its own, and what is left over is shared again by weight
    among the others, round by round, until no target is above.
    """
    per_source = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                       .select(F.lit(0).alias("all"), F.col("source").isNull().alias("last"),
                               "source", "source_size"), "source_sizes")
    numbered = assign_numbers(per_source, "all", ["last", "source"], out_col="nth")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("nth", F.lit(len(weights))) + 1).cast("int"))
    table = stage(numbered.select("source", "source_size", weight.alias("weight"),
                                  (F.lit(most) * F.col("source_size")).alias("limit")),
                  "source_weights")
    whole = table.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level: tuple[float, float] | None = None  # words to share by weight, and the weights' sum
    while True:
        free = F.lit(True) if level is None else ~_above(level)
        sums = table.agg(F.sum(F.when(~free, F.col("limit"))).alias("held"),
                         F.sum(F.when(free, F.col("weight"))).alias("weight")).first()
        new = (share * whole - (sums["held"] or 0.0), sums["weight"] or 1.0)
        # what is left for a unit of weight only grows; rounding must not turn it back
        if level is not None and new[0] * level[1] <= level[0] * new[1]:
            break
        level = new
    target = F.when(_above(level), F.col("limit")).otherwise(_share(level))
    return table.select("source", "source_size", target.alias("target"))


def _share(level: tuple[float, float]) -> Column:
    return F.lit(level[0]) * F.col("weight") / F.lit(level[1])


def _above(level: tuple[float, float]) -> Column:
    return _share(level) > F.col("limit")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        most: float = MOST, trials: int = TRIALS, keep_docs: bool = False) -> DataFrame:
    """How often each document enters the mix.

    Takes ``doc_id, text, source``; returns a row for each row of ``docs``: ``id,
    size`` (words), ``source_size, target, copies, taken`` (``copies`` times
    ``size``), and with ``keep_docs`` all its columns as ``doc`` (see ``emit``).

    A null text has no words; it still gets copies by its source's rate. A null
    source is a source of its own. A source without words has target and rate 0.
    Ids may be null or repeated; rows equal in id and text draw alike. Texts are
    counted whole, whatever their length. An empty table gives no rows. Other
    columns, of any name, are only carried along.
    """
    doc = [F.struct("*").alias("doc")] if keep_docs else []
    sizes = stage(docs.select(F.col("doc_id").alias("id"), F.col("source").alias("source"),
                              n_words(F.col("text")).alias("size"),
                              hashed_draw(F.col("doc_id"), F.col("text")).alias("draw"), *doc),
                  "mix_sizes")
    targets = source_targets(sizes.select("source", "size"), weights, share, most)
    rate = F.when(F.col("source_size") > 0,
                  F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    targets = stage(targets.withColumn("rate", rate), "source_targets")

    words = [F.sum(F.when(_extra(F.col("draw"), j * _TURN % _SPAN, F.col("rate")), F.col("size"))
                   .otherwise(0)).alias(f"t{j}") for j in range(trials)]
    tried = (_with_source(sizes.select("source", "size", "draw"), targets)
             .groupBy("source").agg(F.first("target").alias("target"), F.first("rate").alias("rate"),
                                    F.first("source_size").alias("source_size"), *words))
    off = F.array(*[F.abs(F.floor("rate") * F.col("source_size") + F.col(f"t{j}") - F.col("target"))
                    for j in range(trials)])
    best = (F.array_position(off, F.array_min(off)) - 1) * F.lit(_TURN)
    turned = stage(tried.select("source", "source_size", "target", "rate",
                                F.pmod(best, F.lit(_SPAN)).alias("turn")), "source_turns")
    copies = (F.floor("rate") + _extra(F.col("draw"), F.col("turn"), F.col("rate")).cast("int"))
    return (_with_source(sizes, turned)
            .select("id", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    *[c for c in ("doc",) if keep_docs])
            .withColumn("taken", F.col("copies") * F.col("size")))


def _with_source(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Join by source, null included: the planner broadcasts a small table of sources
    and splits a hot source otherwise."""
    same = sizes["source"].eqNullSafe(sources["source"])
    return sizes.join(sources, same).drop(sources["source"])


def emit(mixed: DataFrame) -> DataFrame:
    """The documents of a mix (``keep_docs``), each as often as it is taken."""
    once = F.explode(F.expr("sequence(1, copies)"))
    return mixed.where("copies > 0").select("doc", once.alias("copy")).select("doc.*")
