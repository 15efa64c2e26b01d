"""Scalar expressions for record keys, day keys and payload fields.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and work the same on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c: "Column | str") -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_key(c: "Column | str") -> Column:
    """Calendar day as ``yyyyMMdd`` text."""
    return F.date_format(_c(c), "yyyyMMdd")


def iso_day_key(c: "Column | str") -> Column:
    """Day key whose year part is the ISO week-numbering year.

    This is what a ``%G%m%d`` date format produces: 2021-01-01 gives
    ``20200101``.  Kept as a separate, tested expression; the jobs key days
    by calendar year (``day_key``).
    """
    d = F.to_date(_c(c))
    return F.concat(F.lpad(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), 4, "0"),
                    F.date_format(d, "MMdd"))


def strip_dashes(c: "Column | str") -> Column:
    """``2024-01-15`` -> ``20240115``."""
    return F.translate(_c(c).cast("string"), "-", "")


def entry_key(day: "Column | str", number: "Column | str") -> Column:
    """Record key ``<day>_<number>``; NULL when either part is NULL."""
    return F.concat(_c(day), F.lit("_"), _c(number).cast("string"))


def daily_winner_key(day: "Column | str", winnernumber: "Column | str") -> Column:
    """Key of a daily-winners row whose ``day`` is a date (or dashed text)."""
    return entry_key(strip_dashes(_c(day)), winnernumber)


def epoch_seconds(ts: "Column | str", ntz: bool = True) -> Column:
    """Epoch seconds as a double.

    For ``timestamp_ntz`` columns the difference to the NTZ epoch is used, so
    the result does not depend on the session time zone.
    """
    if ntz:
        micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))
    else:
        micros = F.unix_micros(_c(ts))
    return micros / F.lit(1_000_000.0)


def email_from_name(name: "Column | str", domain: str = "mail.com") -> Column:
    """Mail address from a display name: whitespace removed, lower case."""
    return F.concat(F.lower(F.regexp_replace(_c(name), r"\s", "")), F.lit("@" + domain))


def entry_time_text(c: "Column | str") -> Column:
    """Epoch seconds as plain decimal text (7 places), never exponent form.

    A JSON number parsed straight into a string column comes out as
    ``1.6632432101234567E9``; through ``decimal(20,7)`` it is
    ``1663243210.1234567``.  A value that is no number, or too large for
    the decimal, gives NULL instead of failing the job.
    """
    return _c(c).try_cast("decimal(20,7)").cast("string")
