"""Extremes and sums of the last ``n`` rows without evaluating each frame anew.

``max(x) OVER (ROWS n - 1 PRECEDING)`` takes n steps a row.  Here a short frame
of about the root of n rows comes first, and the long one is put together
from the short frames that end 0, a, 2a .. rows earlier: about twice the root of n
steps a row.  Both passes are windows on (key, order), so rows that are sorted
by it need no other sort and no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Extreme:
    """``out`` = max (or min) of ``value`` over the current and the ``rows - 1``
    rows before it.  NULLs are skipped; ``strict`` gives NULL until the frame
    has ``rows`` values; ``before`` reads the frame that ends one row earlier."""

    value: str
    rows: int
    out: str
    largest: bool = True
    strict: bool = False
    before: bool = False


@dataclass(frozen=True)
class Moments:
    """``<out><p>`` = sum of (value - mean)^p over the current and the ``rows - 1``
    rows before it, for each p of ``powers``; NULL unless all values are there."""

    value: str
    rows: int
    out: str
    powers: tuple[int, ...] = (2,)


def _back(c: str, rows: int, w) -> Column:
    return F.lag(c, rows).over(w) if rows else F.col(c)


def sliding_extremes(df: DataFrame, specs: list[Extreme], by: str | list[str] = "symbol", order: str | list[str] = "date") -> DataFrame:
    """``df`` with the ``out`` column of each spec; ``order`` is unique within ``by``."""
    by, order = ([x] if isinstance(x, str) else list(x) for x in (by, order))
    w = Window.partitionBy(*by).orderBy(*order)
    short = [math.isqrt(s.rows) for s in specs]
    out = df.select("*", *[
        (F.max if s.largest else F.min)(s.value).over(w.rowsBetween(-(a - 1), Window.currentRow)).alias(f"__short_{i}")
        for i, (s, a) in enumerate(zip(specs, short))], *[
        F.count(s.value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"__n_{i}")
        for i, s in enumerate(specs) if s.strict])
    found = []
    for i, (s, a) in enumerate(zip(specs, short)):
        at = int(s.before)
        # short frames may overlap; the last one ends where the long frame's first rows do
        parts = [_back(f"__short_{i}", k + at, w) for k in sorted({*range(0, s.rows - a, a), s.rows - a})]
        c = (F.greatest if s.largest else F.least)(*parts) if len(parts) > 1 else parts[0]
        if s.strict:
            held = _back(f"__n_{i}", at, w) - F.coalesce(F.lag(f"__n_{i}", s.rows + at).over(w), F.lit(0))
            c = F.when(held >= s.rows, c)
        found.append(c.alias(s.out))
    return out.select(*df.columns, *found)


def sliding_sums(df: DataFrame, sums: dict[str, str], n: int, by: str | list[str] = "symbol", order: str | list[str] = "date") -> DataFrame:
    """``df`` with, per output column of ``sums``, the sum of its value column
    over the current and the ``n - 1`` rows before it (NULLs count nothing).
    Only additions of the frame's own values, so nothing of rows that left it
    remains, as it would in differences of running sums."""
    by, order = ([x] if isinstance(x, str) else list(x) for x in (by, order))
    w = Window.partitionBy(*by).orderBy(*order)
    a = math.isqrt(n)
    rest = n % a  # rows that whole short frames leave over, the oldest ones
    out = df.select("*", *[F.sum(v).over(w.rowsBetween(-(rows - 1), Window.currentRow)).alias(f"__{name}_{k}")
                           for name, rows in (("short", a), ("rest", rest)) if rows for k, v in enumerate(sums.values())])
    zero = F.lit(0.0)
    found = []
    for k, name in enumerate(sums):
        total = zero
        for rows in range(0, n - rest, a):
            total = total + F.coalesce(_back(f"__short_{k}", rows, w), zero)
        found.append((total + F.coalesce(_back(f"__rest_{k}", n - rest, w), zero) if rest else total).alias(name))
    return out.select(*df.columns, *found)


def _power(c: Column, p: int) -> Column:
    return math.prod([c] * (p - 1), start=c)


def _mean(parts: list[Column]) -> Column:
    """Their mean, exact if all are equal."""
    first = parts[0]
    return first + sum((c - first for c in parts[2:]), parts[1] - first) / float(len(parts)) if len(parts) > 1 else first


def sliding_moments(df: DataFrame, specs: list[Moments], by: str | list[str] = "symbol", order: str | list[str] = "date",
                    beside: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with the sums of each spec.  A window's central moments take a
    division per row, frame row and moment.  Here those of a short part of the frame
    are taken about its mean, and the frame's are put together from parts that
    end 0, a, 2a .. rows earlier, again about the mean of their means: no
    difference of large sums, so values that hardly vary keep their digits.
    ``beside`` are other columns of windows in the same order, by name, which
    are found in the second pass."""
    beside = beside or {}
    by, order = ([x] if isinstance(x, str) else list(x) for x in (by, order))
    w = Window.partitionBy(*by).orderBy(*order)
    size = [min((a for a in range(1, s.rows + 1) if s.rows % a == 0), key=lambda a: a + s.rows // a * (max(s.powers))) for s in specs]
    each = list(enumerate(zip(specs, size)))
    out = df.select("*", *[_back(s.value, k, w).cast("double").alias(f"__x{i}_{k}") for i, (s, a) in each for k in range(a)])
    out = out.select("*", *[_mean([F.col(f"__x{i}_{k}") for k in range(a)]).alias(f"__mean_{i}") for i, (s, a) in each])
    out = out.select(*df.columns, *[f"__mean_{i}" for i, _ in each], *[
        (F.col(f"__x{i}_{k}") - F.col(f"__mean_{i}")).alias(f"__d{i}_{k}") for i, (s, a) in each for k in range(a)])
    out = out.select(*df.columns, *[f"__mean_{i}" for i, _ in each], *[
        sum((_power(F.col(f"__d{i}_{k}"), p) for k in range(1, a)), _power(F.col(f"__d{i}_0"), p)).alias(f"__m{p}_{i}")
        for i, (s, a) in each for p in range(2, max(s.powers) + 1)])
    out = out.select("*", *[_back(c, k, w).alias(f"{c}_{k}") for i, (s, a) in each for k in range(a, s.rows, a)
                            for c in (f"__mean_{i}", *[f"__m{p}_{i}" for p in range(2, max(s.powers) + 1)])],
                     *[c.alias(name) for name, c in beside.items()])

    def parts(c: str, s: Moments, a: int) -> list[Column]:
        return [F.col(f"{c}_{k}" if k else c) for k in range(0, s.rows, a)]

    out = out.select("*", *[_mean(parts(f"__mean_{i}", s, a)).alias(f"__all_{i}") for i, (s, a) in each])
    found = []
    for i, (s, a) in each:
        off = [m - F.col(f"__all_{i}") for m in parts(f"__mean_{i}", s, a)]
        own = {p: parts(f"__m{p}_{i}", s, a) for p in range(2, max(s.powers) + 1)}
        for p in s.powers:  # of (deviation in the part + the part's own)^p; the first powers of the former add up to 0
            terms = [_power(d, p) * float(a) + sum((own[q][j] * _power(d, p - q) * float(math.comb(p, q)) for q in range(2, p)), own[p][j])
                     for j, d in enumerate(off)]
            found.append(sum(terms[1:], terms[0]).alias(f"{s.out}{p}"))
    return out.select(*df.columns, *beside, *found)
