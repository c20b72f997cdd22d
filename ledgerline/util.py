"""Small helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(a: str | Column, b: str | Column) -> Column:
    """Division that yields NULL on a zero or NULL divisor (ANSI-safe)."""
    return F.try_divide(col(a), col(b))


def round_half_away(c: str | Column, digits: int) -> Column:
    """Round by scaling: ``round(x * 10^d) / 10^d``.

    Scaling first makes Spark and other engines agree bit for bit, because
    both round the same binary double half away from zero.
    """
    scale = float(10**digits)
    return F.round(col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    """Sum of a money-like double as an exact decimal sum, returned as double.

    A floating sum depends on the order rows arrive in (partitioning, shuffle
    fetch order, a retried task), so a rerun after an executor loss could
    differ in the last bit.  Values carrying ``scale`` decimals are summed
    exactly in ``DECIMAL(18, scale)`` and converted once at the end.
    """
    return F.sum(col(c).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """Order-independent mean: exact decimal sum / count of non-null values."""
    return exact_sum(c, scale) / F.count(col(c))


def exact_sum_sql(x: str, scale: int = 2) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def exact_avg_sql(x: str, scale: int = 2) -> str:
    return f"({exact_sum_sql(x, scale)} / count({x}))"


def rounded(df: DataFrame, digits: int = 6, only: Iterable[str] | None = None,
            per_col: dict | None = None) -> DataFrame:
    """Round every double (or float) column for presentation / comparison."""
    per_col = per_col or {}
    keep = set(only) if only is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (keep is None or f.name in keep):
            out.append(round_half_away(f.name, per_col.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def symbol_window(by: str | list[str] = "symbol", order: str = "date") -> Window:
    by = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*by).orderBy(order)


def running(w: Window) -> Window:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing(w: Window, n: int) -> Window:
    """Frame of the current row and the ``n - 1`` rows before it."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def full_partition(by: str | list[str]) -> Window:
    by = [by] if isinstance(by, str) else list(by)
    return Window.partitionBy(*by)


def trailing_mean(c: str | Column, w: Window, n: int, strict: bool = True) -> Column:
    """Mean of the last ``n`` rows; NULL until ``n`` rows exist if strict."""
    frame = trailing(w, n)
    m = F.avg(col(c)).over(frame)
    if strict:
        return F.when(F.count(col(c)).over(frame) >= n, m)
    return m


def safe_corr(x: str | Column, y: str | Column, w: Window | None = None) -> Column:
    """Pearson correlation over pairs where both values are present, NULL
    when a side has zero variance (``corr`` would divide by zero under ANSI).
    Works as an aggregate or, with ``w``, as a window function."""
    xc, yc = col(x).cast("double"), col(y).cast("double")
    xm = F.when(yc.isNotNull(), xc)
    ym = F.when(xc.isNotNull(), yc)
    parts = [F.covar_pop(xm, ym), F.stddev_pop(xm), F.stddev_pop(ym)]
    if w is not None:
        parts = [p.over(w) for p in parts]
    cov, sx, sy = parts
    return F.try_divide(cov, sx * sy)


def safe_corr_sql(x: str, y: str, over: str = "") -> str:
    """The same correlation as SQL text (``over`` is an optional window clause)."""
    xm = f"(CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END)"
    ym = f"(CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END)"
    o = f" OVER {over}" if over else ""
    return f"(covar_pop({xm}, {ym}){o} / NULLIF(stddev_pop({xm}){o} * stddev_pop({ym}){o}, 0))"
