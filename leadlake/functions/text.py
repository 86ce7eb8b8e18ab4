"""Text normalisation as native columns."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every Unicode whitespace character. SQL `trim` alone strips only the space.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def strip(col: Column | str) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column | str) -> Column:
    """True for null, empty and whitespace-only text; never null."""
    return F.coalesce(strip(col) == "", F.lit(True))


def norm_agent(col: Column | str) -> Column:
    """Join key of an agent name."""
    return strip(col)


def norm_status(col: Column | str) -> Column:
    """Join key of a status: `' Invite Sent '` and `invite_sent` are the same."""
    return F.replace(F.lower(strip(col)), F.lit(" "), F.lit("_"))


def lead_id(url: Column | str) -> Column:
    """Stable lead id: 32 hex digits of the SHA-256 of the cleaned URL, null when there is no URL."""
    cleaned = F.lower(strip(url))
    return F.when(cleaned != "", F.substring(F.sha2(cleaned, 256), 1, 32))
