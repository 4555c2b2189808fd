"""Date parsing for the two feeds.

Feed A writes days as ``dd/MM/yyyy`` (one- or two-digit day and month are
both accepted). Feed B writes periods as ``YYYY/MM``, ``YYYY`` or ``YYYY/``;
the month defaults to 1 and the result is the first day of that month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day format of feed A (day/month/year, widths 1 or 2).
FEED_A_DATE_FORMAT = "d/M/yyyy"


def day_month_year(c: Column, strict: bool = False) -> Column:
    """``dd/MM/yyyy`` text to DATE. Bad text gives NULL, or fails the job
    when ``strict`` (ANSI ``to_date``)."""
    if strict:
        return F.to_date(c, FEED_A_DATE_FORMAT)
    return F.try_to_date(c, FEED_A_DATE_FORMAT)


def period_start(c: Column) -> Column:
    """Period text to the first day of its month, NULL when malformed.

    Split at the first ``/``: the part before is the year, the part after
    the month (empty or absent means January). Both must be whole numbers,
    the year in 1..9999 and the month in 1..12; anything else (``2026/13``,
    ``2026/Q1``, ``2026/04/05``, blank) is NULL.
    """
    slash = F.instr(c, "/")
    year_txt = F.substring_index(c, "/", 1)
    month_txt = F.when(slash > 0, c.substr(slash + 1, F.length(c))).otherwise(F.lit(""))
    month_txt = F.when(month_txt == "", F.lit("1")).otherwise(month_txt)
    year = year_txt.try_cast("int")
    month = month_txt.try_cast("int")
    ok = year.between(1, 9999) & month.between(1, 12)
    return F.when(ok, F.make_date(year, month, F.lit(1)))
