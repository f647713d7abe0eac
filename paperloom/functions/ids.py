"""Identifier normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import number

# Prefixes of source identifiers and of the keys they become.
TEI_PREFIXES = [("B", "BIBREF"), ("TAB", "TABREF"), ("FIG", "FIGREF"), ("FORMULA", "EQREF")]
LATEX_PREFIXES = [("BID", "BIBREF"), ("CID", "SECREF"), ("FORMULA", "EQREF")]
# Order in which a "uid" target is looked up.
UID_PRECEDENCE = ["FIGREF", "TABREF", "EQREF", "FOOTREF", "SECREFU"]


def _swap_prefix(c: Column, prefixes: list[tuple[str, str]]) -> Column:
    out = c
    for old, new in reversed(prefixes):
        out = F.when(c.startswith(old), F.concat(F.lit(new), F.substring(c, F.lit(len(old) + 1), F.length(c)))).otherwise(out)
    return out


def tei_key(c: Column) -> Column:
    """``#b12`` becomes ``BIBREF12``, ``#fig_3`` becomes ``FIGREF3``."""
    return _swap_prefix(F.translate(F.upper(c), "_#", ""), TEI_PREFIXES)


def latex_key(c: Column) -> Column:
    """``bid4`` becomes ``BIBREF4``, ``cid2`` becomes ``SECREF2``."""
    return _swap_prefix(F.replace(F.upper(c), F.lit("_"), F.lit("")), LATEX_PREFIXES)


def ref_number(c: Column) -> Column:
    """Trailing number of a normalised key."""
    return number(F.regexp_extract(c, r"(\d+)$", 1))
