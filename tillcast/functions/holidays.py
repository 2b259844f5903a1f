"""US federal holiday test as a column expression (no join, no table).

``is_holiday`` is a boolean expression over a date column, so it stays inside
whole-stage codegen and costs no shuffle or broadcast at any scale.  The same
rule table renders the DuckDB twin (``holiday_sql``).  ``holiday_calendar``
lists the holidays of a date range when a table is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# fixed values: US federal holidays (name, month, kind, day-or-nth, weekday, since)
#   kind "fixed": month/day, also observed on Friday (if Saturday) or Monday (if Sunday)
#   kind "nth":   n-th given weekday of the month (weekday Monday=0)
#   kind "last":  last given weekday of the month
# Pre-1971 variants of the Monday holidays are not modelled.
# ---------------------------------------------------------------------------
HOLIDAY_RULES = (
    ("New Year's Day", 1, "fixed", 1, None, 1871),
    ("Martin Luther King Jr. Day", 1, "nth", 3, 0, 1986),
    ("Washington's Birthday", 2, "nth", 3, 0, 1971),
    ("Memorial Day", 5, "last", None, 0, 1971),
    ("Juneteenth National Independence Day", 6, "fixed", 19, None, 2021),
    ("Independence Day", 7, "fixed", 4, None, 1871),
    ("Labor Day", 9, "nth", 1, 0, 1894),
    ("Columbus Day", 10, "nth", 2, 0, 1971),
    ("Veterans Day", 11, "fixed", 11, None, 1938),
    ("Thanksgiving", 11, "nth", 4, 3, 1871),
    ("Christmas Day", 12, "fixed", 25, None, 1871),
)


def _fixed_on(d: Column, month: int, day: int, since: int) -> Column:
    return (F.month(d) == month) & (F.dayofmonth(d) == day) & (F.year(d) >= since)


def _rule_expr(d: Column, rule) -> Column:
    _, month, kind, num, weekday, since = rule
    if kind == "fixed":
        nxt, prv = F.date_add(d, 1), F.date_sub(d, 1)
        return (
            _fixed_on(d, month, num, since)
            | (_fixed_on(nxt, month, num, since) & (F.weekday(nxt) == 5))
            | (_fixed_on(prv, month, num, since) & (F.weekday(prv) == 6))
        )
    base = (F.month(d) == month) & (F.weekday(d) == weekday) & (F.year(d) >= since)
    if kind == "nth":
        return base & (F.floor((F.dayofmonth(d) - 1) / 7) + 1 == num)
    return base & (F.dayofmonth(d) > F.dayofmonth(F.last_day(d)) - 7)


def is_holiday(date_col: str | Column) -> Column:
    """True when the date is a US federal holiday or its observed day."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    expr = F.lit(False)
    for rule in HOLIDAY_RULES:
        expr = expr | _rule_expr(d, rule)
    return F.coalesce(expr, F.lit(False))


def holiday_sql(d: str, rules=HOLIDAY_RULES) -> str:
    """DuckDB twin of :func:`is_holiday` for a DATE expression ``d``."""

    def fixed_on(x: str, month: int, day: int, since: int) -> str:
        return f"(month({x}) = {month} AND day({x}) = {day} AND year({x}) >= {since})"

    parts = []
    for _, month, kind, num, weekday, since in rules:
        if kind == "fixed":
            nxt, prv = f"({d} + 1)", f"({d} - 1)"
            parts.append(
                f"({fixed_on(d, month, num, since)} OR ({fixed_on(nxt, month, num, since)} AND isodow({nxt}) = 6)"
                f" OR ({fixed_on(prv, month, num, since)} AND isodow({prv}) = 7))"
            )
            continue
        base = f"month({d}) = {month} AND isodow({d}) - 1 = {weekday} AND year({d}) >= {since}"
        if kind == "nth":
            parts.append(f"({base} AND floor((day({d}) - 1) / 7) + 1 = {num})")
        else:
            parts.append(f"({base} AND day({d}) > day(last_day({d})) - 7)")
    return "coalesce(" + " OR ".join(parts) + ", false)"


def holiday_name_sql(d: str) -> str:
    """DuckDB twin of :func:`holiday_name`."""
    whens = []
    for rule in HOLIDAY_RULES:
        name = rule[0].replace("'", "''")
        whens.append(f"WHEN {holiday_sql(d, (rule,))} THEN '{name}'")
    return "CASE " + " ".join(whens) + " END"


def holiday_name(date_col: str | Column) -> Column:
    """Name of the holiday on that date (observed days carry the same name)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    expr = None
    for rule in HOLIDAY_RULES:
        cond = _rule_expr(d, rule)
        expr = F.when(cond, F.lit(rule[0])) if expr is None else expr.when(cond, F.lit(rule[0]))
    return expr


def holiday_calendar(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """All holidays between the first and last date of ``dates``.

    One global min/max aggregate, then a generated day spine filtered by the
    rule expression — no join and no table shipped from the driver.
    """
    span = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return days.where(is_holiday("date")).select("date", holiday_name("date").alias("holiday"))


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """Date of the n-th ``weekday`` (Monday=0) of a month; used by rule tables."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    offset = (F.lit(weekday) - F.weekday(first) + 7) % 7 + 7 * (n - 1)
    return F.date_add(first, offset.cast("int"))
