"""Cell parsers: survey percentages, admin counts, coordinates and flags.

Every flag is two-valued (``coalesce(..., false)``) so sums and ``NOT``
branches never skip a null, and every cast is a ``try_cast`` so ANSI mode
never fails a job on one bad cell.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trustgrid.functions.text import NBSP

# Fixed values (must match the source conventions).
NUMBER_PATTERN = r"[-+]?[0-9]+(?:\.[0-9]+)?"
WHOLE_NUMBER_PATTERN = r"^[-+]?[0-9]+(?:\.[0-9]+)?$"
LOW_SAMPLE_PATTERN = r"^\([-+]?[0-9]+(?:\.[0-9]+)?\)$"
DECIMAL_PATTERN = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
INTEGER_PATTERN = r"^-?[0-9]+$"
UNAVAILABLE_MARKERS = ("", "NA", "N/A", "NULL", "-")
SUPPRESSED_MARKER = "*"


def _false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# --- survey cells ---------------------------------------------------------

def is_suppressed(raw: Column) -> Column:
    return _false_if_null(F.trim(raw) == F.lit(SUPPRESSED_MARKER))


def is_low_sample(raw: Column) -> Column:
    return _false_if_null(F.trim(raw).rlike(LOW_SAMPLE_PATTERN))


def survey_value(raw: Column) -> Column:
    """First signed decimal in the cell (commas dropped); ``*`` and no digits -> null."""
    text = F.regexp_extract(F.replace(F.trim(raw), F.lit(","), F.lit("")), NUMBER_PATTERN, 0)
    return F.when(is_suppressed(raw) | (text == F.lit("")), F.lit(None).cast("double")).otherwise(
        text.try_cast("double")
    )


def is_unparsed(raw: Column) -> Column:
    """Cell had text but was not wholly a number (``n/a``, ``29-30``, ``.5``)."""
    t = F.trim(raw)
    whole = F.replace(t, F.lit(","), F.lit("")).rlike(WHOLE_NUMBER_PATTERN)
    return _false_if_null((t != F.lit("")) & ~is_suppressed(raw) & ~is_low_sample(raw) & ~whole)


# --- admin counts ----------------------------------------------------------

def _count_clean(raw: Column) -> Column:
    return F.trim(F.replace(raw, F.lit(NBSP), F.lit(" ")))


def count_is_unavailable(raw: Column) -> Column:
    return _false_if_null(raw.isNull() | F.upper(_count_clean(raw)).isin(*UNAVAILABLE_MARKERS))


def count_value(raw: Column) -> Column:
    """Integer count; unavailable markers and invalid text -> null, ``0`` stays 0."""
    text = F.replace(_count_clean(raw), F.lit(","), F.lit(""))
    return F.when(~count_is_unavailable(raw) & text.rlike(INTEGER_PATTERN), text.try_cast("bigint"))


def count_is_invalid(raw: Column) -> Column:
    """Neither an unavailable marker nor an integer that fits in a long."""
    return _false_if_null(~count_is_unavailable(raw) & count_value(raw).isNull())


# --- coordinates and presence ------------------------------------------------

def decimal_or_null(raw: Column) -> Column:
    """``NA`` / junk -> null double, strict decimal text -> double."""
    t = F.trim(raw)
    return F.when(t.rlike(DECIMAL_PATTERN), t.try_cast("double"))


def coords_in_range(lat: Column, lon: Column, lat_range=(6.0, 38.0), lon_range=(68.0, 98.0)) -> Column:
    return _false_if_null(lat.between(*lat_range) & lon.between(*lon_range))


def has_text(c: Column) -> Column:
    return _false_if_null(c.isNotNull() & (F.length(c) > 0))


def is_blank_field(c: Column) -> Column:
    """Null, empty, or the literal text ``null``."""
    return _false_if_null(c.isNull() | F.lower(F.trim(c)).isin("", "null"))


def missing_field_count(cols: list[Column]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + F.when(is_blank_field(c), 1).otherwise(0)
    return total
