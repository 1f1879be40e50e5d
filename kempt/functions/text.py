"""Text expressions used by the standardize step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import BLANKS

# Tokens that stand for a missing cell, for yes and for no.
MISSING_TOKENS = ("", "na", "n/a", "null", "none", "nan")
YES_TOKENS = ("y", "yes", "true", "1")
NO_TOKENS = ("n", "no", "false", "0")


def trimmed(c: Column) -> Column:
    """Strip blanks, tabs and line ends (plain ``trim`` strips blanks only)."""
    return F.btrim(c, F.lit(BLANKS))


def without_missing_tokens(c: Column) -> Column:
    text = trimmed(c)
    return F.when(~F.lower(text).isin(*MISSING_TOKENS), text)


def is_yes_no(c: Column) -> Column:
    """True or false for a present token, null for a missing one."""
    return F.lower(without_missing_tokens(c)).isin(*YES_TOKENS, *NO_TOKENS)


def as_yes_no(c: Column) -> Column:
    token = F.lower(trimmed(c))
    return F.when(token.isin(*YES_TOKENS), "Yes").when(token.isin(*NO_TOKENS), "No")
