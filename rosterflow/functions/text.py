"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterflow import schemas as S

# The characters that count as whitespace at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _plain_end(end: Column) -> Column:
    """First character is in the range that holds no whitespace."""
    return F.ascii(end).between(0x21, 0x84)


def strip(c: Column) -> Column:
    """Without whitespace at either end; Spark's own ``trim`` only takes blanks. Texts
    with plain characters at both ends skip the costlier trim by character set."""
    plain = _plain_end(c) & _plain_end(F.substring(c, -1, 1))
    return F.when(plain, c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def strip_or_blank(c: Column) -> Column:
    """Stripped text, null as the empty text, so that predicates never turn null."""
    return F.coalesce(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return strip_or_blank(c) == ""


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros behind a leading sign; ``lpad`` alone would cut longer texts."""
    sign = F.substring(c, 1, 1)
    return (
        F.when(F.length(c) >= width, c)
        .when(sign.isin("+", "-"), F.concat(sign, F.lpad(F.substring(c, 2, width), width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )


def pad_code(c: Column, width: int) -> Column:
    """Stripped code; all-digit codes are padded to ``width``, anything else is kept."""
    s = strip(c)
    return F.when(s.rlike(f"^[0-9]{{1,{width}}}$"), F.lpad(s, width, "0")).otherwise(s)


def check_code(c: Column, width: int) -> Column:
    """Code as validation compares it: null as blank, every short text padded."""
    return zero_fill(strip_or_blank(c), width)


def yes_no(c: Column) -> Column:
    """Y/N text as a three-valued boolean."""
    u = F.upper(strip(c))
    return F.when(u.isin(S.YES_VALUES), True).when(u.isin(S.NO_VALUES), False)


def underscore_name(c: Column) -> Column:
    """Lower-case name with whitespace runs as one underscore."""
    return F.regexp_replace(F.lower(strip(c)), f"[{WHITESPACE}]+", "_")


def snake_case(c: Column) -> Column:
    """``underscore_name`` with other symbols dropped; nothing left is null."""
    return F.nullif(F.regexp_replace(underscore_name(c), "[^a-z0-9_]", ""), F.lit(""))


def shown(c: Column) -> Column:
    """Raw value for a message; null prints as ``None``."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def clip_message(c: Column, length: int = S.ERROR_MESSAGE_LENGTH) -> Column:
    return F.substring(c, 1, length)


def is_npi(c: Column) -> Column:
    """Ten digits, whitespace around them aside."""
    return F.coalesce(c, F.lit("")).rlike(rf"^[{WHITESPACE}]*[0-9]{{10}}[{WHITESPACE}]*\z")


def is_po_box(c: Column) -> Column:
    """The pattern is only tried on texts with a box in them."""
    address = F.coalesce(c, F.lit(""))
    return F.lower(address).contains("box") & address.rlike("(?iU)" + S.PO_BOX_PATTERN)


def is_accuracy_value(c: Column) -> Column:
    """One of the accuracy words in any case, or blank."""
    return F.lower(strip_or_blank(c)).isin("", *S.ACCURACY_VALUES)


def is_yes_flag(c: Column) -> Column:
    """``Y`` in any case, untrimmed; null stays null."""
    return F.upper(c) == "Y"
