"""Text expressions. All are plain Column builders that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin capitals and the plain letters they fold to.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
FOLDED = "AAAAAACEEEEIIIINOOOOOUUUUY"

# Every character that counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip every kind of leading and trailing whitespace (F.trim strips spaces only)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    """True for null and for text of nothing but spaces; never null."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def text_of(*cols: Column | str) -> Column:
    """Join columns with one space, taking null as the empty string (the separator is always kept)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(" "))
        parts.append(F.coalesce(_col(c), F.lit("")))
    return F.concat(*parts)


def prefix(c: Column | str, n: int = 500) -> Column:
    return F.substring(_col(c), 1, n)


def fold_accents(c: Column | str) -> Column:
    """Upper-case and replace accented Latin letters by their base letter."""
    return F.translate(F.upper(_col(c)), ACCENTED, FOLDED)


def normalize_name(c: Column | str, fold: bool = False) -> Column:
    """Lookup form of a name: upper case, only A-Z 0-9 ' - kept, single spaces, null as ''.

    With ``fold`` accented letters become their base letter; otherwise they turn into spaces.
    """
    c = F.coalesce(_col(c), F.lit(""))
    upper = fold_accents(c) if fold else F.upper(c)
    return F.trim(F.regexp_replace(upper, r"[^A-Z0-9'\-]+", " "))
