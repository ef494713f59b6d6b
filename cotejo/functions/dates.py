"""Dates: lenient parsing, month ranges, case age. Periods are arguments; nothing reads the clock."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotejo.errors import RegistryError
from cotejo.functions.text import SPACE, _col, strip

# Day first with / . or -, or year first; an optional clock time (fixed patterns).
_DAY_FIRST = r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})"
_ACCEPTED = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,6})?)?)?$"


def parse_lenient(c) -> Column:
    """Text to timestamp, value by value: day first or ISO, anything else null.

    Works without a time zone, so it does not depend on the session's.
    """
    text = F.regexp_replace(strip(c), _DAY_FIRST, "$3-$2-$1")
    text = F.regexp_replace(text, f"[{SPACE}]+", " ")
    return F.when(text.rlike(_ACCEPTED), text.try_cast("timestamp_ntz"))


def as_timestamp(df, name) -> Column:
    """Typed dates are taken as they are; only text is parsed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_lenient(df[name])
    return df[name].cast("timestamp_ntz")


def month_bounds(year: int, month: int):
    """First day of the month and of the next one."""
    if not 1 <= month <= 12:
        raise RegistryError(f"month must be 1-12, got {month}")
    nxt = date(year + 1, 1, 1) if month == 12 else date(year, month + 1, 1)
    return date(year, month, 1), nxt


def in_month(c, year: int, month: int) -> Column:
    """Half-open range, so that the test reaches the Parquet scan (``month(c)`` would not)."""
    first, nxt = (F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in month_bounds(year, month))
    c = _col(c)
    return (c >= first) & (c < nxt)


def case_year(c) -> Column:
    """The id's first four characters as a year, null unless all four are digits."""
    head = F.substring(_col(c), 1, 4)
    return F.when(head.rlike("^[0-9]{4}$"), head.try_cast("int"))


def english_month(c, style="upper") -> Column:
    """English month name of a date; ``style`` is upper or title."""
    name = F.date_format(_col(c), "MMMM")
    return F.upper(name) if style == "upper" else F.initcap(name)


def hours(minutes) -> Column:
    """Minutes as hours, two decimals."""
    return F.round(_col(minutes) / 60, 2)


def clock(c) -> Column:
    return F.date_format(_col(c), "HH:mm:ss")


def iso_second(ts) -> str:
    """A run time as the log prints it."""
    return ts.isoformat(timespec="seconds")
