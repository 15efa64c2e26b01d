"""Matching entries with promotions: inner match, winner flag, cogroup, guard.

Every function works on batch frames; ``match_winners`` and ``flag_winners``
also take a streaming ``entries`` frame with a static ``promotions`` frame
(stream-static inner and left joins are allowed in append mode).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MATCH_KEYS = ("day", "participation_number")


def match_winners(entries: DataFrame, promotions: DataFrame,
                  keys: Sequence[str] = MATCH_KEYS) -> DataFrame:
    """Entries that hit a promotion, with the promotion's text.

    Inner equi-join on ``keys``; the promotion side's key columns are dropped,
    so the output is the entry columns followed by ``promotion``.  Several
    promotions on one key give one row each (see ``unique_by`` to forbid it).
    """
    cond = None
    for k in keys:
        c = entries[k] == promotions[k]
        cond = c if cond is None else cond & c
    joined = entries.join(promotions, cond, "inner")
    for k in keys:
        joined = joined.drop(promotions[k])
    return joined


def unique_by(df: DataFrame, keys: Sequence[str], on_duplicate: str = "error",
              order_by: Sequence[str] = ()) -> DataFrame:
    """At most one row per key.

    ``error``: fail the job, naming the key, when a key has several rows;
    ``first``: keep the row that sorts first by ``order_by`` (then the other
    columns); ``keep``: no check.  The check is one aggregation with a
    map-side partial step, so a hot key is reduced before the shuffle.
    """
    if on_duplicate == "keep":
        return df
    others = [c for c in df.columns if c not in keys]
    ordered = list(order_by) + [c for c in others if c not in order_by]
    packed = F.struct(*[F.col(c) for c in ordered])
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ub_n"), F.min(packed).alias("_ub_row"))
    key_cols = [F.col(k) for k in keys]
    if on_duplicate == "error":
        # the check sits on the key itself, so it survives column pruning
        label = F.concat_ws("_", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
        fail = F.raise_error(F.concat(F.lit("duplicate rows for key "), label))
        key_cols[0] = F.when(F.col("_ub_n") > 1, fail).otherwise(F.col(keys[0]))
    elif on_duplicate != "first":
        raise ValueError(f"on_duplicate must be error, first or keep, not {on_duplicate!r}")
    out = agg.select(*[c.alias(k) for c, k in zip(key_cols, keys)],
                     *[F.col(f"_ub_row.{c}").alias(c) for c in others])
    return out.select(*df.columns)


def flag_winners(entries: DataFrame, promotions: DataFrame, entry_key: "Column | str",
                 promo_key: "Column | str", flag_col: str = "winner",
                 on_duplicate: str = "error") -> DataFrame:
    """Every entry with ``flag_col`` true when its key has a promotion.

    Promotion keys without an entry produce no row.  The promotion side is
    reduced to its distinct keys first (``on_duplicate="error"`` makes a key
    with two promotions fail the job), so the left join never multiplies
    entries.
    """
    pk = F.col(promo_key) if isinstance(promo_key, str) else promo_key
    ek = F.col(entry_key) if isinstance(entry_key, str) else entry_key
    keys = promotions.select(pk.alias("_fw_key"))
    if on_duplicate == "error":
        keys = unique_by(keys, ["_fw_key"], "error")
    else:
        keys = keys.distinct()
    keys = keys.withColumn("_fw_hit", F.lit(True))
    with_key = entries.withColumn("_fw_ekey", ek)
    joined = with_key.join(keys, with_key["_fw_ekey"] == keys["_fw_key"], "left")
    return (joined.withColumn(flag_col, F.coalesce(F.col("_fw_hit"), F.lit(False)))
                  .drop("_fw_ekey", "_fw_key", "_fw_hit"))


def cogroup_summary(left: DataFrame, right: DataFrame, key: str,
                    left_value: str | None = None, right_value: str | None = None,
                    left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Full cogroup of two keyed frames, reduced per key.

    One row per key present on either side, with the row count of each side
    (0 when absent) and, when a value column is named, the single value of
    that side (the smallest one when there are several).  Each side is
    aggregated before the join, so no key's rows are ever gathered into one
    list.
    """
    lhs = side_counts(left, [F.col(key).alias(key)], left_value, left_name)
    rhs = side_counts(right, [F.col(key).alias(key)], right_value, right_name)
    return join_sides(lhs, rhs, key, left_value, right_value, left_name, right_name)


def side_counts(df: DataFrame, keys: Sequence[Column], value: str | None, name: str) -> DataFrame:
    """One side of a cogroup: per key its row count ``n_<name>`` and least value ``only_<name>``."""
    aggs = [F.count(F.lit(1)).alias(f"n_{name}")]
    if value:
        aggs.append(F.min(value).alias(f"only_{name}"))
    return df.groupBy(*keys).agg(*aggs)


def join_sides(lhs: DataFrame, rhs: DataFrame, key: str, left_value: str | None,
               right_value: str | None, left_name: str, right_name: str) -> DataFrame:
    """Two sides of a cogroup (one row per key each), every key of either."""
    out = lhs.join(rhs, lhs[key].eqNullSafe(rhs[key]), "full")
    cols = [F.coalesce(lhs[key], rhs[key]).alias(key),
            F.coalesce(lhs[f"n_{left_name}"], F.lit(0)).alias(f"n_{left_name}"),
            F.coalesce(rhs[f"n_{right_name}"], F.lit(0)).alias(f"n_{right_name}")]
    if left_value:
        cols.append(lhs[f"only_{left_name}"])
    if right_value:
        cols.append(rhs[f"only_{right_name}"])
    return out.select(*cols)
