"""Column expressions. Each takes and returns a ``Column`` and stays in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnstar.schema import DATE_FORMATS, SUSPICIOUS_AMOUNT, SUSPICIOUS_LOGINS


def to_double(c: Column) -> Column:
    """Number from text; text that is no number gives NULL in any ANSI mode."""
    return c.try_cast("double")


def to_int(c: Column) -> Column:
    """Whole number from text, cutting the fraction: ``'3.7'`` gives 3."""
    return c.try_cast("double").try_cast("int")


def absolute(c: Column) -> Column:
    return F.abs(to_double(c))


# Patterns made of plain numeric fields and separators.
_PLAIN = r"(?:y+|([MdHms])\1?(?!\1)|[-/: .])+"


def _may_match(c: Column, fmt: str) -> Column | None:
    """A cheap test that is true for every text ``fmt`` can parse.

    A failed parse costs an exception per row, so each pattern is tried only on
    text with its separators. Only for patterns made of plain numeric fields;
    for any other (month names, zones, quoted or optional parts) there is none.
    """
    if not re.fullmatch(_PLAIN, fmt):
        return None
    present = [ch for ch in "-/: ." if ch in fmt]
    absent = [ch for ch in "/:" if ch not in fmt]
    test = F.lit(True)
    for ch in present:
        test = test & c.contains(ch)
    for ch in absent:
        test = test & ~c.contains(ch)
    return test


def _subsumes(first: str, later: str) -> bool:
    """Whether ``first`` reads every text that ``later`` reads: alike but for leading zeros.

    One letter for a month, day, hour, minute or second takes one digit or two.
    """
    if not (re.fullmatch(_PLAIN, first) and re.fullmatch(_PLAIN, later)):
        return False
    a, b = (re.findall(r"([A-Za-z])(\1*)|(.)", fmt) for fmt in (first, later))
    return len(a) == len(b) and all(
        x == y or (x[0] == y[0] != "y" and x[2] == y[2] and not x[1]) for x, y in zip(a, b)
    )


def _instant(c: Column, fmt: str) -> Column:
    """The instant written as ``fmt``, taking text that names no zone as UTC."""
    if re.search("[VzOXxZ]", re.sub("'[^']*'", "", fmt)):
        return F.try_to_timestamp(c, F.lit(fmt))
    instant = F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit(fmt + "X"))
    test = _may_match(c, fmt)
    return instant if test is None else F.when(test, instant)


def parse_mixed(c: Column, formats: list[str] = DATE_FORMATS) -> Column:
    """Wall-clock time by the first of ``formats``, in order, that reads the text.

    NULL where none does. A pattern is left out when an earlier one reads all that it reads, as
    that would have come first; each failed attempt costs an exception. The result is
    ``timestamp_ntz``: text is read as UTC and taken back as UTC, so the session's zone, with
    its daylight-saving gaps, plays no part.
    """
    needed: list[str] = []
    for fmt in formats:
        if not any(_subsumes(earlier, fmt) for earlier in needed):
            needed.append(fmt)
    instant = F.coalesce(*[_instant(c, fmt) for fmt in needed])
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def parse_timestamp(c: Column, fmt: str) -> Column:
    return parse_mixed(c, [fmt])


def is_suspicious(
    amount: Column,
    logins: Column,
    amount_gt: float = SUSPICIOUS_AMOUNT,
    login_gt: int = SUSPICIOUS_LOGINS,
) -> Column:
    """Strictly above either threshold. An unknown counts as not above: never NULL."""
    return F.coalesce((amount > amount_gt) | (logins > login_gt), F.lit(False))


def date_key(c: Column) -> Column:
    """``yyyymmdd`` as a number: the same day has the same key in every run."""
    day = F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    return day.cast("bigint")


def timestamp_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, without the fraction of a second."""
    return F.substring_index(c.cast("string"), ".", 1)
