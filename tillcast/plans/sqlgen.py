"""Small helpers that spell the feature expressions in DuckDB SQL.

They render the same configured lists (lags, windows, functions) as the
Spark operators, so the twins cannot drift from the configuration.
"""

from __future__ import annotations

import math

from tillcast.config import CYCLICAL, LAGS, ROLLING_FUNCS, ROLLING_WINDOWS
from tillcast.functions.holidays import holiday_sql

TWO_PI = f"CAST({2 * math.pi!r} AS DOUBLE)"


def win(part: str | None, order: str, frame: str = "") -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"OVER ({p}ORDER BY {order} {frame})".replace("  ", " ")


def rows(lo: int, hi: int = 0) -> str:
    def b(n: int, side: str) -> str:
        if n == 0:
            return "CURRENT ROW"
        return f"{abs(n)} {side}"

    return f"ROWS BETWEEN {b(lo, 'PRECEDING')} AND {b(hi, 'PRECEDING' if hi < 0 else 'FOLLOWING')}"


def date_features(d: str = "date") -> list[str]:
    return [
        f"year({d}) AS year",
        f"month({d}) AS month",
        f"day({d}) AS day",
        f"isodow({d}) - 1 AS dayofweek",
        f"quarter({d}) AS quarter",
        f"weekofyear({d}) AS weekofyear",
        f"CAST(isodow({d}) - 1 >= 5 AS INTEGER) AS is_weekend",
        f"CAST({holiday_sql(d)} AS INTEGER) AS is_holiday",
    ]


def cyclical(d: str = "date") -> list[str]:
    parts = {"month": f"month({d})", "day": f"day({d})", "dayofweek": f"(isodow({d}) - 1)"}
    out = []
    for name, period in CYCLICAL:
        angle = f"({TWO_PI} * {parts[name]} / CAST({float(period)!r} AS DOUBLE))"
        out += [f"sin({angle}) AS {name}_sin", f"cos({angle}) AS {name}_cos"]
    return out


def lags(target: str, part: str | None, order: str = "date", ks=LAGS) -> list[str]:
    return [f"lag({target}, {k}) {win(part, order)} AS {target}_lag_{k}" for k in ks]


# means are spelled as an in-order list sum / count: DuckDB evaluates long
# window sums with a segment tree, whose addition order differs from a scan
_FUNCS = {
    "mean": "list_sum(list({x}) {w}) / count({x})",
    "std": "stddev_samp({x})",
    "min": "min({x})",
    "max": "max({x})",
    "median": "quantile_cont({x}, 0.5)",
}


def rolling(target: str, part: str | None, order: str = "date", windows=ROLLING_WINDOWS,
            funcs=ROLLING_FUNCS, full: bool = False) -> list[str]:
    out = []
    for k in windows:
        w = win(part, order, rows(-(k - 1)))
        for f in funcs:
            e = f"{_FUNCS[f].format(x=target, w=w)} {w}"
            if full and k > 1:
                e = f"CASE WHEN count({target}) {w} >= {k} THEN {e} END"
            out.append(f"{e} AS {target}_rolling_{k}_{f}")
    return out


def window_mean(x: str, w: str) -> str:
    return f"(list_sum(list({x}) {w}) / count({x}) {w})"


def lag_names(target: str = "total_revenue") -> list[str]:
    return [f"{target}_lag_{k}" for k in LAGS]


def rolling_names(target: str = "total_revenue") -> list[str]:
    return [f"{target}_rolling_{k}_{f}" for k in ROLLING_WINDOWS for f in ROLLING_FUNCS]
