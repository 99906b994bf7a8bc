"""String expressions. All are built-in Column expressions, so they stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same as a regular-expression class. Blanks below U+0100 come first, one by one, and the
# others behind a range test: Java then decides on ordinary letters with two lookups.
_WIDE = "".join(c for c in BLANKS if c > "\xff")
WHITESPACE = (
    "[" + "".join(c for c in BLANKS if c <= "\xff") + f"[{_WIDE[0]}-{_WIDE[-1]}&&[{_WIDE}]]]"
)
# Runs that are not already a single space.
_UNEVEN = f"{WHITESPACE}(?:(?<! )|(?={WHITESPACE})){WHITESPACE}*"
_NOT_BLANK = f"(?s)(?!{WHITESPACE})."

# Tokens of the public OpenSMILES grammar (bracket atoms, organic subset, bonds,
# ring closures, branches).
SMILES_TOKEN = (
    r"\[[^\[\]]+\]|Cl|Br|[BCNOPSFIbcnops*]|%[0-9]{2}|[0-9]|[-=#$:/\\.~()]"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace, Unicode spaces included."""
    return F.btrim(as_column(c), F.lit(BLANKS))


def split_literal(c: Column | str, delimiter: str, limit: int = -1) -> Column:
    """Split on the literal delimiter; empty fields are kept. With a limit the last field holds
    the rest."""
    if len(delimiter) == 1:
        # Spelled so that no regular expression has to be compiled for every row.
        quoted = delimiter if delimiter.isalnum() or delimiter.isspace() else "\\" + delimiter
    else:
        quoted = "\\Q" + delimiter.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return F.split(as_column(c), quoted, limit)


def non_empty(c: Column | str) -> Column:
    """The string itself, or NULL when it is empty."""
    c = as_column(c)
    return F.when(F.length(c) > 0, c)


def identity(c: Column | str) -> Column:
    return non_empty(c)


def fold(c: Column | str) -> Column:
    """Strip, collapse whitespace runs to one blank, lower-case; NULL when nothing is left."""
    c = as_column(c)
    even = F.lower(F.regexp_replace(strip(c), _UNEVEN, " "))
    return F.when(c.rlike(_NOT_BLANK), even)


def largest_fragment(c: Column | str) -> Column:
    """Longest part of a dotted string, the first one on ties; NULL when all parts are empty."""
    stripped = strip(c)
    longest = F.reduce(
        split_literal(stripped, "."),
        F.lit(""),
        lambda best, part: F.when(F.length(part) > F.length(best), part).otherwise(best),
    )
    return F.when(stripped.rlike("[^.]"), longest)


def smiles_like(c: Column | str) -> Column:
    """True when the string is made of SMILES tokens only. A lexical test, not chemistry."""
    c = as_column(c)
    return (F.length(c) > 0) & (F.regexp_replace(c, SMILES_TOKEN, "") == "")


def smiles_tokens_only(c: Column | str) -> Column:
    """Normalisation rule: stripped string when :func:`smiles_like`, otherwise NULL."""
    stripped = strip(c)
    return F.when(smiles_like(stripped), stripped)


RULES = {
    "identity": identity,
    "fold": fold,
    "largest_fragment": largest_fragment,
    "smiles_tokens": smiles_tokens_only,
}


def stem(file_name: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(as_column(file_name), r"\.[^.]+$", "")
