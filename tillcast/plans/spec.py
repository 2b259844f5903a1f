"""Output specs shared by a Spark query and its DuckDB twin.

A spec such as ``"date:date, store_id:string, revenue:double"`` fixes the
column names, order and types of a registered result.  Doubles are rounded
to ``SCALE`` decimals on both engines as ``round(x * 10^s) / 10^s``: the
product is the same IEEE operation in both, so equal inputs round equally
(rounding the decimal string, as Spark's ``round(x, s)`` does, differs from
rounding the binary value at exact halves).  Statistics over many values,
whose last bits depend on summation order, use ``double@2``.  ``+ 0.0``
folds negative zero into zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 4

_SQL_TYPES = {
    "date": "DATE",
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def parse(spec: str) -> list[tuple[str, str, int]]:
    """``name:type`` items; doubles may carry a rounding scale, ``x:double@2``."""
    out = []
    for part in spec.split(","):
        name, typ = part.strip().split(":")
        typ, _, scale = typ.strip().partition("@")
        out.append((name.strip(), typ, int(scale) if scale else SCALE))
    return out


def finalize(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, typ, scale in parse(spec):
        c = F.col(name)
        if typ == "double":
            unit = F.lit(float(10 ** scale))
            c = F.round(c.cast("double") * unit, 0) / unit + F.lit(0.0)
        else:
            c = c.cast(typ)
        cols.append(c.alias(name))
    return df.select(*cols)


def wrap_sql(inner: str, spec: str) -> str:
    cols = []
    for name, typ, scale in parse(spec):
        q = f'"{name}"'
        if typ == "double":
            unit = f"CAST({float(10 ** scale)!r} AS DOUBLE)"
            cols.append(f"round(CAST({q} AS DOUBLE) * {unit}) / {unit} + 0.0 AS {q}")
        else:
            cols.append(f"CAST({q} AS {_SQL_TYPES[typ]}) AS {q}")
    return f"SELECT {', '.join(cols)}\nFROM (\n{inner.strip()}\n) AS q"
