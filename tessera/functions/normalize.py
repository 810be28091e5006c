"""Column expressions for text-typed records: keys, guarded numbers, tokens.

Everything here returns a ``Column``; nothing runs Python per row, so the
expressions stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE = T.DoubleType()
STRING = T.StringType()

# Fixed values that must equal the reference's rules.
# Missing tokens for coordinates (compared after lower + trim).
MISSING_TOKENS = ("", "na", "n/a", "nan", "null", "none")
# Missing tokens for depth and year: the same plus '<na>'.
MISSING_TOKENS_EXT = ("", "na", "n/a", "nan", "null", "none", "<na>")
# Category normalisation for sex/lifestage: NULL, '' and exact 'NA' become NULL.
CATEGORY_MISSING = ("", "NA")
# Extended normaliser: thirteen case-sensitive spellings that mean "missing"
# (compared after trim).
EXTENDED_MISSING = ("NA", "None", "nan", "NaN", "N/A", "NULL", "null", "<NA>", "#N/A", "#NA",
                    "-NaN", "-nan", "n/a")
# Columns compared as text by the signature rules; every other key column is
# compared as a number.
SIGNATURE_TEXT_COLUMNS = ("scientificname", "lifestage", "sex", "behavior", "eventDate", "country",
                          "countryCode", "locality", "continent", "waterBody", "habitat")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def species_key(c="scientificname") -> Column:
    """The shared species key ``lower(trim(name))``."""
    return F.lower(F.trim(col(c)))


def strip(c) -> Column:
    """Without white space of any kind at either end (names of lists and sheets)."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def to_double(c) -> Column:
    """Text to double with NULL on failure, matching the SQL oracle.

    Spark also accepts a trailing d/D/f/F (``'1d'``); those are rejected so
    that both engines agree.  ``inf``/``nan`` spellings parse in both.
    """
    s = col(c)
    return F.when(s.rlike(r"[0-9.][dDfF]\s*$"), F.lit(None).cast(DOUBLE)).otherwise(s.try_cast(DOUBLE))


def is_finite(x) -> Column:
    x = col(x)
    return ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def finite_or_null(x) -> Column:
    x = col(x)
    return F.when(is_finite(x), x)


def is_missing_token(c, tokens=MISSING_TOKENS) -> Column:
    """NULL or a missing token after lower(trim())."""
    s = col(c)
    return s.isNull() | F.lower(F.trim(s)).isin(list(tokens))


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')``."""
    t = F.trim(col(c))
    return F.when(t != "", t)


def category_clean(c) -> Column:
    """Only NULL, '' and the exact text 'NA' become NULL (no trim, no lower)."""
    s = col(c)
    return F.when(s.isNull() | s.isin(list(CATEGORY_MISSING)), F.lit(None).cast(STRING)).otherwise(s)


def truthy(c) -> Column:
    return F.lower(F.trim(col(c).cast("string"))).isin("true", "1")


def coalesce_false(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))
