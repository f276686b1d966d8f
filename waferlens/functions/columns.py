"""Column-to-Column helpers, all built-ins, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank at the ends of a text.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# day/month/year hour:minute:second with any blanks around, and the same
# for years of less than four digits.
TEST_TIME_PATTERN = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\s*$"
SHORT_YEAR_PATTERN = TEST_TIME_PATTERN.replace(r"\d{4}", r"\d{1,3}")

# Shape of a displayed hit.
SNIPPET_CHARACTERS = 220
SNIPPET_TAIL = "..."


def nan_to_null(value: Column) -> Column:
    """NaN means missing; as a number it would sort above everything and spoil averages."""
    return F.when(~F.isnan(value), value)


def is_sentinel(value: Column, sentinel: float) -> Column:
    """True only for the sentinel itself; NULL and NaN are not flagged."""
    return F.coalesce(value == F.lit(sentinel), F.lit(False))


def nullify_sentinel(value: Column, sentinel: float) -> Column:
    return F.when(value != F.lit(sentinel), value)


def clean_reading(value: Column, sentinel: float) -> Column:
    """Both spellings of a missing reading, NaN and the sentinel, become NULL."""
    number = value.cast("double")
    return F.when(~F.isnan(number), nullify_sentinel(number, sentinel))


def round_half_away(value: Column, digits: int) -> Column:
    """Round the binary double, not its decimal rendering (1.005 -> 1.0)."""
    scale = F.lit(float(10**digits))
    return F.round(value * scale) / scale


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double with two decimals; NULL for an empty whole."""
    return round_half_away(F.try_divide(F.lit(100.0) * part, whole), 2)


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0.0 where the whole is zero."""
    return F.when(whole != 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def map_label(label: Column, mapping: Mapping[int, object], default: object = None) -> Column:
    """Look a raw label up in a small fixed mapping; unmatched labels take the default."""
    branches = F
    for raw, mapped in mapping.items():
        branches = branches.when(label == F.lit(raw), F.lit(mapped))
    return branches.otherwise(F.lit(default))


def parse_test_time(text: Column) -> Column:
    """Zoneless timestamp from a ``d/M/y H:m:s`` text, NULL when it is not one.

    The numbers are put in ISO order and cast without a zone, so the session
    time zone plays no part. Years are padded only where that is needed.
    """
    # A text that does not fit a pattern comes back unchanged.
    usual = F.nullif(F.regexp_replace(text, TEST_TIME_PATTERN, "$3-$2-$1 $4:$5:$6"), text)
    padded = F.nullif(F.regexp_replace(text, SHORT_YEAR_PATTERN, "000$3-$2-$1 $4:$5:$6"), text)
    short = F.regexp_replace(padded, r"^\d+(\d{4}-)", "$1")
    return F.coalesce(usual.try_cast("timestamp_ntz"), short.try_cast("timestamp_ntz"))


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def snippet(text: Column) -> Column:
    return F.concat(F.substring(text, 1, SNIPPET_CHARACTERS), F.lit(SNIPPET_TAIL))
