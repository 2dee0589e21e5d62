"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the edge of a text
# (controls, information separators, NEL, NBSP and the Unicode spaces).
EDGE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_MARK = "\x01 "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim every kind of space at both ends (``F.trim`` alone removes U+0020 only).

    A character-set trim looks at the edges only; a pattern would walk the whole text.
    """
    return F.btrim(_col(c), F.lit(EDGE_SPACE))


def title_case(c) -> Column:
    """Capitalise each run of letters: a word restarts after *any* non-letter.

    ``initcap`` restarts after a space only, so ``d'água`` would stay ``D'água``. Each other
    non-letter in front of a letter is followed by a marked space for the time of the call; the
    digits of a number need none.
    """
    marked = F.regexp_replace(_col(c), r"([^\p{L} ])(?=\p{L})", "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def concat_key(*cols) -> Column:
    """Plain delimited key. Cheap, for the widest table; the parts must not be null."""
    return F.concat_ws("|", *[_col(c).cast("string") for c in cols])


def sha256_key(*cols) -> Column:
    """Hex SHA-256 of the delimited key."""
    return F.sha2(concat_key(*cols), 256)


def zero_padded(c, width: int) -> Column:
    """Left zero padding that never truncates (``lpad`` cuts longer text)."""
    s = _col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def joined_label(left, right, separator: str = " - ") -> Column:
    """``left - right``; null as soon as one side is null."""
    return F.concat(_col(left), F.lit(separator), _col(right))
