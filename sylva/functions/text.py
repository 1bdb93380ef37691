"""Spelling rules shared by the operators: taxids, accessions, ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at the ends of a field, no-break and ideographic spaces included.
WHITE = r"[\u0009-\u000d\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip_white(col: Column | str) -> Column:
    """Without surrounding white space of any kind; null stays null."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, f"^{WHITE}+|{WHITE}+$", "")


def taxid_number(col: Column | str) -> Column:
    """The number written in a taxid field as BIGINT; null if it holds no digits or a number beyond BIGINT.

    Leading zeros don't count, so ``"0042"``, ``"taxon:42"`` and ``" 42 "`` are the same taxid.
    """
    digits = F.regexp_extract(F.col(col) if isinstance(col, str) else col, r"0*(\d+)", 1)
    return digits.try_cast("bigint")


def accession_key(col: Column | str) -> Column:
    """An accession without letter case, surrounding white space and final version; null if nothing is left."""
    key = F.regexp_replace(F.lower(strip_white(col)), r"\.\d+$", "")
    return F.when(key != "", key)


def rank_key(col: Column | str) -> Column:
    """A rank without letter case and surrounding white space; null and empty are ``unknown``."""
    key = F.lower(strip_white(col))
    return F.when(key.isNull() | (key == ""), F.lit("unknown")).otherwise(key)
