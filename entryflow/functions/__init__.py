"""Scalar Spark expressions (keys, day formats, text rules)."""

from entryflow.functions.classify import LANGUAGE_RULES, NO_LANGUAGE, classify
from entryflow.functions.keys import (
    daily_winner_key, day_key, email_from_name, entry_key, entry_time_text,
    epoch_seconds, iso_day_key, strip_dashes,
)

__all__ = [
    "LANGUAGE_RULES", "NO_LANGUAGE", "classify", "daily_winner_key", "day_key",
    "email_from_name", "entry_key", "entry_time_text", "epoch_seconds",
    "iso_day_key", "strip_dashes",
]
