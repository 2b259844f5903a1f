"""Calendar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.config import CYCLICAL, DATE_FEATURES
from tillcast.functions.holidays import is_holiday


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of_week(d: str | Column) -> Column:
    """Monday=0 … Sunday=6 (``weekday``, not ``dayofweek`` which is Sunday=1)."""
    return F.weekday(_c(d))


def date_feature_columns(date_col: str = "date", features=DATE_FEATURES) -> list[Column]:
    """Calendar parts of a date column, in configuration order."""
    d = F.to_date(_c(date_col))
    exprs = {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "dayofweek": F.weekday(d),
        "quarter": F.quarter(d),
        "weekofyear": F.weekofyear(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_holiday": is_holiday(d).cast("int"),
    }
    return [exprs[name].alias(name) for name in features]


def cyclical_columns(date_col: str = "date") -> list[Column]:
    """sin/cos encodings of month (12), day (31) and weekday (7)."""
    d = F.to_date(_c(date_col))
    parts = {"month": F.month(d), "day": F.dayofmonth(d), "dayofweek": F.weekday(d)}
    out = []
    for name, period in CYCLICAL:
        angle = F.lit(2 * math.pi) * parts[name] / F.lit(float(period))
        out += [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]
    return out


def month_position_columns(date_col: str = "date") -> list[Column]:
    """Day-of-month flags, week of month and quarter progress."""
    d = F.to_date(_c(date_col))
    dom = F.dayofmonth(d)
    qp = (F.month(d) - 1) % 3 + 1
    return [
        dom.alias("day_of_month"),
        (dom <= 5).cast("int").alias("is_month_start"),
        (dom >= 25).cast("int").alias("is_month_end"),
        (F.floor((dom - 1) / 7) + 1).cast("int").alias("week_of_month"),
        qp.alias("quarter_progress"),
        (qp == 3).cast("int").alias("is_quarter_end"),
        dom.alias("days_since_month_start"),
    ]


def promotion_weekend(has_discount: str = "has_discount", date_col: str = "date") -> Column:
    """Promotion flag × weekend flag."""
    return (_c(has_discount) * (F.weekday(F.to_date(_c(date_col))) >= 5).cast("int")).alias("promotion_weekend")
