"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
_LETTER = r"[\p{Lu}\p{Ll}\p{Lt}ªº]"
_NON_LETTER = r"[^\p{Lu}\p{Ll}\p{Lt}ªº]"


def parse_timestamp(c: Column) -> Column:
    """Text to a zone-free timestamp; anything that is not one becomes null."""
    return F.when(c.rlike(_TIMESTAMP_TEXT), c).try_cast("timestamp_ntz")


def elapsed_days(end: Column, start: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, rounded towards minus infinity.

    Counts midnights and takes one off when the last day is not complete, so it is
    exact to the microsecond and does not depend on the session time zone.
    """
    midnights = F.datediff(end.cast("date"), start.cast("date"))
    complete = start + F.make_dt_interval(midnights)
    return F.when(end < complete, midnights - 1).otherwise(midnights).cast("int")


def date_key(c: Column) -> Column:
    """Integer ``yyyymmdd``; null stays null."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_key(c: Column) -> Column:
    """Integer ``yyyymm``."""
    return F.year(c) * 100 + F.month(c)


def strip(c: Column) -> Column:
    """Remove surrounding white space of any kind, including tabs and no-break spaces."""
    return F.regexp_replace(c, _OUTER_SPACE, "")


def title_case(c: Column) -> Column:
    """Strip, then capitalise the first letter of every run of letters.

    ``initcap`` alone only starts a word after white space, which leaves
    ``Mogi-guacu`` and ``D'oeste`` half done.
    """
    runs = F.regexp_extract_all(strip(c), F.lit(f"({_LETTER}+|{_NON_LETTER}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def ratio(numerator: Column, denominator: Column, places: int = 2, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` in decimal arithmetic, null on a zero denominator.

    The operand precisions leave at least 12 digits after the point in the
    quotient, so the final rounding is the only one that matters.
    """
    den = denominator.cast("decimal(22,2)")
    quotient = numerator.cast("decimal(22,2)") * F.lit(factor).cast("decimal(3,0)") / F.when(den != 0, den)
    return F.round(quotient, places).cast(f"decimal(18,{places})")


def share(value: Column, places: int = 2) -> Column:
    """Percentage of the total over all rows, which one task sees: for a bounded number of rows only."""
    return ratio(value, F.sum(value).over(Window.partitionBy()), places, 100)
