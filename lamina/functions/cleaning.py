"""Lenient parsing of all-string raw columns.

Raw columns are never cast directly: a plain cast would fail the job on the
first bad cell, and Spark's parser accepts spellings (surrounding blanks, a
trailing ``d`` or ``f``) that the raw data contract does not. Each parser
checks the spelling first and then uses ``try_cast``.
"""

from __future__ import annotations

# Words that stand for a missing string, compared in upper case.
NULL_WORDS = ("", "NULL", "NULO", "NA", "N/A", "NONE", "NAN")

# The 25 characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

INTEGER_SPELLING = r"^[+-]?[0-9]+\z"
FLOAT_SPELLING = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\z"
DATE_TIME_SPELLING = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?"
    r"(Z|[+-][0-9]{2}:?[0-9]{2})?\z"
)

_BLANKS = "".join(f"\\u{ord(c):04x}" for c in WHITE_SPACE)
_LONGEST_WORD = max(map(len, NULL_WORDS))
_WORD_LIST = ", ".join(f"'{word}'" for word in NULL_WORDS)


def _spelled(value: str, pattern: str, kind: str) -> str:
    return f"if({value} rlike r'{pattern}', try_cast({value} AS {kind}), NULL)"


def strip_blank(value: str) -> str:
    """Remove Unicode white space at both ends (a character set, not a regex)."""
    return f"btrim({value}, '{_BLANKS}')"


def clean_text(value: str) -> str:
    """Strip blanks; a sentinel word in any case becomes NULL.

    The length comes first: a long text is not put into upper case to be compared.
    """
    stripped = strip_blank(value)
    sentinel = f"length({stripped}) <= {_LONGEST_WORD} AND upper({stripped}) IN ({_WORD_LIST})"
    return f"if({sentinel}, NULL, {stripped})"


def parse_float(value: str) -> str:
    """String to double; anything that is not a number becomes NULL."""
    return _spelled(value, FLOAT_SPELLING, "double")


def flag_from_number(value: str) -> str:
    """``"1.0"``/``"0.0"`` to boolean: above one half is true, NULL stays NULL."""
    return f"({parse_float(value)} > 0.5D)"


def flag_from_word(value: str) -> str:
    """``true``/``false`` in any case to boolean; other words become NULL."""
    return f"CASE upper({value}) WHEN 'TRUE' THEN true WHEN 'FALSE' THEN false END"


def strict_count(value: str) -> str:
    """Integer spelling only (``"13.0"`` is not one); NULL and bad cells become 0."""
    return f"coalesce({_spelled(value, INTEGER_SPELLING, 'bigint')}, 0L)"


def lenient_count(value: str) -> str:
    """Count read through a double: NULL and bad cells 0, truncated, not below 0.

    A parsed value that is no 64-bit integer (NaN, infinity, overflow) stays
    NULL, so that the not-null contract rejects it later.
    """
    whole = f"try_cast(coalesce({parse_float(value)}, 0D) AS bigint)"
    return f"if({whole} < 0, 0L, {whole})"


def utc_timestamp(value: str) -> str:
    """ISO-8601 date-time to a UTC timestamp; a bare date or year becomes NULL."""
    return _spelled(value, DATE_TIME_SPELLING, "timestamp")


def zero_fill(value: str, width: int) -> str:
    """Left-fill with zeros after a leading sign; longer values are kept whole."""
    return (
        f"CASE WHEN length({value}) >= {width} THEN {value}"
        f" WHEN left({value}, 1) IN ('+', '-')"
        f" THEN concat(left({value}, 1), lpad(substring({value}, 2), {width - 1}, '0'))"
        f" ELSE lpad({value}, {width}, '0') END"
    )


def leading_year(period: str) -> str:
    """Year from the first four characters of a ``YYYYMM`` period."""
    return _spelled(f"left({period}, 4)", INTEGER_SPELLING, "bigint")


def is_period(x: str) -> str:
    """Six digits and nothing else, not even a line break behind them."""
    return f"{x} RLIKE '^[0-9]{{6}}\\\\z'"


def not_deleted(flag: str) -> str:
    """Only a true flag deletes a row."""
    return f"NOT coalesce({flag}, false)"


def padded(x: str, width: int) -> str:
    """Filled up with zeros from the left; a longer value is cut to the width."""
    return f"lpad({x}, {width}, '0')"
