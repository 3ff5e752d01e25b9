"""Text cleaning expressions for category levels and numeric text."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's \W is Unicode-aware; Java's needs the (?U) flag to match it.
_NON_WORD_JAVA = r"(?U)\W+"
_NON_WORD_PY = re.compile(r"\W+")
_PLAIN = f"_{string.ascii_letters}{string.digits}"


def clean_category(c: Column) -> Column:
    """Runs of non-word characters become one underscore; NULL stays NULL. Plain words are told by their characters,
    without the regular expression."""
    text = c.cast("string")
    return F.when(F.translate(text, _PLAIN, "") == "", text).otherwise(F.regexp_replace(text, _NON_WORD_JAVA, "_"))


def clean_name(name: str) -> str:
    """The same rule for column names (applied on the driver to names, not data)."""
    return _NON_WORD_PY.sub("_", name)


def clean_numeric(c: Column, digits_only: bool = False) -> Column:
    """Strip separators from numeric text and parse; NULL or unparseable -> 0.

    ``digits_only=True`` keeps only 0-9 (drops the decimal point and the sign, as the
    reference does); the default also keeps '.' and '-'.
    """
    pattern = "[^0-9]" if digits_only else r"[^0-9.\-]"
    cleaned = F.regexp_replace(c, pattern, "")
    # an empty string is tested first: a failed cast is much slower than a comparison
    return F.coalesce(F.when(cleaned == "", F.lit(None)).otherwise(cleaned.try_cast("double")), F.lit(0.0))
