"""Value rules: missing markers, guarded percent change, exact sums."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# Texts that mean "no observation" in feed A (besides NULL).
FEED_A_MISSING_MARKERS = ["", "N/E"]


def feed_a_missing(value_txt: Column) -> Column:
    """Feed A drops NULL, empty and the exact marker ``N/E``."""
    return value_txt.isNull() | value_txt.isin(*FEED_A_MISSING_MARKERS)


def feed_b_missing(value_txt: Column, period_txt: Column) -> Column:
    """Feed B drops a NULL/empty value or a NULL/empty period. ``N/E`` is
    not a marker there: it is a bad number."""
    return value_txt.isNull() | (value_txt == "") | period_txt.isNull() | (period_txt == "")


def pct_change(value: Column, prev: Column) -> Column:
    """``(value - prev) / prev * 100``; NULL when there is no previous value
    or it is 0. Divides by the signed previous value."""
    return F.when(prev.isNotNull() & (prev != 0), (value - prev) / prev * 100)


def exact_sum(c: Column, scale: int, window: WindowSpec | None = None) -> Column:
    """SUM in fixed point with ``scale`` decimals, returned as DOUBLE.

    A floating sum depends on the order rows meet; this one does not: each
    input is scaled by ``10**scale`` and rounded half away from zero (the
    same IEEE product and rounding in any engine), the integers are summed
    exactly, and the total is divided back once. Exact for inputs with at
    most ``scale`` decimals (money with 2); otherwise inputs are quantised
    at ``10**-scale``."""
    factor = float(10**scale)
    s = F.sum(F.round(c * F.lit(factor)).cast("decimal(38,0)"))
    if window is not None:
        s = s.over(window)
    return s.cast("double") / F.lit(factor)


def exact_sum_sql(expr: str, scale: int, over: str | None = None) -> str:
    """``exact_sum`` as SQL text, for windows the DataFrame API cannot
    spell (RANGE frames with INTERVAL bounds)."""
    factor = float(10**scale)
    win = f" OVER ({over})" if over else ""
    return f"(CAST(sum(CAST(round(({expr}) * {factor}) AS DECIMAL(38,0))){win} AS DOUBLE) / {factor})"


def exact_mean(c: Column, scale: int, window: WindowSpec | None = None) -> Column:
    """AVG as the exact fixed-point SUM over COUNT (see ``exact_sum``)."""
    n = F.count(c) if window is None else F.count(c).over(window)
    return exact_sum(c, scale, window) / n
