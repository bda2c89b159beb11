"""Taxpayer numbers: normalising, validating and masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted formats. The strict one wants 'Z' at position 14.
GSTIN_STRICT = r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]\z"
GSTIN_RELAXED = r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z][0-9A-Z]{2}\z"

#: blanks and control characters, all of which count as padding
_PADDING = "".join(chr(code) for code in range(0x21))


def trim_to_null(text: Column) -> Column:
    """Strip padding; blank text becomes NULL."""
    return F.nullif(F.btrim(text, F.lit(_PADDING)), F.lit(""))


def normalise(text: Column) -> Column:
    """Trimmed upper-case key, NULL if blank."""
    return F.upper(trim_to_null(text))


def is_valid_gstin(gstin: Column, strict: bool = False) -> Column:
    """Whether the text as given has the right format; false for NULL."""
    return F.coalesce(gstin.rlike(GSTIN_STRICT if strict else GSTIN_RELAXED), F.lit(False))


def mask(gstin: Column) -> Column:
    """First two and last four characters; three stars if NULL or shorter than seven."""
    return F.when(
        F.length(gstin) >= 7,
        F.concat(gstin.substr(1, 2), F.lit("*****"), F.right(gstin, F.lit(4))),
    ).otherwise("***")
