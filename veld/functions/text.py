"""Text expressions (X1-X5).  All are Catalyst expressions: no Python per row.

NULL stays NULL through every function (the pandas original turned missing values into
the text ``nan`` first; we keep them missing so later null rules still see them).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from veld.functions._col import as_col

# Address abbreviations expanded by the normaliser, in the order applied.
# (pattern as plain text, replacement)
ADDRESS_ABBREVIATIONS = [("str.", "straat"), ("ave", "avenue"), ("blvd", "boulevard")]

# A run of letters or a run of anything else; used to rebuild Python-style title case.
_WORD_OR_GAP = r"(\p{L}+|[^\p{L}]+)"


def _cap_piece(x: Column) -> Column:
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def capitalize(c) -> Column:
    """``str.replace('_', ' ').str.capitalize()``: first character upper, rest lower."""
    s = F.replace(as_col(c), F.lit("_"), F.lit(" "))
    return _cap_piece(s)


def title_case(c) -> Column:
    """Python ``str.title``: every run of letters gets an upper first letter.

    Unlike ``initcap`` (which splits on spaces only), ``BRAINE-L'ALLEUD`` becomes
    ``Braine-L'Alleud``.
    """
    pieces = F.regexp_extract_all(as_col(c), F.lit(_WORD_OR_GAP), 1)
    return F.when(as_col(c).isNull(), None).otherwise(
        F.array_join(F.transform(pieces, _cap_piece), ""))


def strip_code(c) -> Column:
    """Remove a parenthesised number and the blanks before it: ``Tielt (8700)`` -> ``Tielt``."""
    return F.regexp_replace(as_col(c), r"\s*\(\d+\)", "")


def collapse_blanks(c) -> Column:
    """``' '.join(s.split())``: trim every kind of whitespace and collapse inner runs."""
    return F.regexp_replace(F.regexp_replace(as_col(c), r"\s+", " "), r"^ | $", "")


def normalize_address(c, literal: bool = False) -> Column:
    """Trim, lower-case, expand abbreviations, collapse blanks.

    ``literal=False`` (default) expands ``ave``/``blvd`` only as whole words and ``str.``
    only after a letter or at a word start; ``literal=True`` replaces substrings exactly
    as the original did (which turns ``avenue`` into ``avenuenue``).
    """
    s = F.lower(F.regexp_replace(as_col(c), r"^\s+|\s+$", ""))
    for pat, rep in ADDRESS_ABBREVIATIONS:
        if literal:
            s = F.replace(s, F.lit(pat), F.lit(rep))
        elif pat.endswith("."):
            # "hoofdstr." -> "hoofdstraat": the dot already marks the abbreviation
            s = F.regexp_replace(s, re.escape(pat), rep)
        else:
            s = F.regexp_replace(s, r"\b" + re.escape(pat) + r"\b", rep)
    return collapse_blanks(s)


def nan_text(c) -> Column:
    """String form used when an address is formatted: NULL renders as ``nan``."""
    return F.coalesce(as_col(c).cast("string"), F.lit("nan"))


def address_candidates(street="street", number="number", postcode="Postal_code",
                       locality="locality_name") -> Column:
    """The four address strings tried in order by the fallback lookup."""
    st, nu, pc, lo = (nan_text(x) for x in (street, number, postcode, locality))
    return F.array(
        F.concat(st, F.lit(" "), nu, F.lit(", "), pc, F.lit(" "), lo),
        F.concat(st, F.lit(" "), nu, F.lit(", "), lo),
        F.concat(lo, F.lit(" "), pc),
        lo,
    )
