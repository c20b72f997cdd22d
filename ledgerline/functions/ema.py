"""Exponential moving averages as native window expressions.

Recursive form (pandas ``ewm(alpha=a, adjust=False)``)::

    E_0 = x_0,   E_k = (1 - a) * E_{k-1} + a * x_k

Closed form with ``q = 1 - a``::

    E_k = q^k * sum_{i<=k} z_i * q^-i,   z_0 = x_0,  z_i = a * x_i

which is one running ``sum`` per symbol.  ``q^-k`` overflows on long series,
so rows are cut into positional blocks of ``B`` rows.  Inside a block the
exponent is relative to the block start (bounded by ``B``); the value at the
end of the previous block is carried in with ``q^(e+1)``.  ``B`` is chosen so
that ``q^B <= 1e-20``: the carry then needs only the two previous block ends
(the third contributes below ``1e-40`` relative), so no sequential fold and
no collection of rows is needed.  Every step is a window over the symbol's
own rows; all windows share one partitioning, so one shuffle serves them all.

Seeding: the recursion starts at the first non-null input row (pandas
behaviour for leading NULLs); ``min_periods`` counts non-null inputs.
Interior NULLs are forward filled first (pandas ``ffill().ewm()``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# q^B must fall below this so that the third block back is negligible.
_CARRY_EPS_LOG = 46.0  # e^-46 ~ 1e-20
_MAX_EXP_LOG = 650.0  # keep q^-e well inside double range (e^709)


@dataclass(frozen=True)
class EmaSpec:
    value: str | Column
    alpha: float
    out: str
    min_periods: int = 1

    @staticmethod
    def span(value, span: int, out: str, min_periods: int | None = None) -> "EmaSpec":
        return EmaSpec(value, 2.0 / (span + 1.0), out, span if min_periods is None else min_periods)

    @staticmethod
    def wilder(value, window: int, out: str, min_periods: int | None = None) -> "EmaSpec":
        return EmaSpec(value, 1.0 / window, out, window if min_periods is None else min_periods)


def _block_size(alphas: list[float]) -> int | None:
    lo = min(-math.log1p(-a) for a in alphas)
    hi = max(-math.log1p(-a) for a in alphas)
    b = math.ceil(_CARRY_EPS_LOG / lo)
    if b * hi > _MAX_EXP_LOG:
        return None
    return max(b, 1)


def with_block(df: DataFrame, specs: list[EmaSpec], out: str, by="symbol", order="date") -> tuple[DataFrame, int | None]:
    """``df`` with the number of a row's block, a block size that serves all
    ``specs``, in ``out`` (and that size, None if none serves all).  Several
    ``ema_many`` calls that get ``block`` and ``blocked`` from it, and windows
    ordered by (``out``, order), which is the same order, share one sort."""
    b = _block_size([s.alpha for s in specs if s.alpha < 1.0] or [0.5])
    by = [by] if isinstance(by, str) else list(by)
    at = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return df.withColumn(out, F.floor(at / b) if b else F.lit(0).cast("long")), b


def ema_many(df: DataFrame, specs: list[EmaSpec], by="symbol", order="date",
             block: int | None = None, blocked: str | None = None) -> DataFrame:
    """Add one EMA column per spec; all specs share the window passes.
    ``blocked`` names a column with the block numbers of ``block`` rows each."""
    for a in (s.alpha for s in specs):
        if not 0.0 < a <= 1.0:
            raise ValueError(f"alpha must be in (0, 1], got {a}")
    if not specs:
        return df
    b = block or _block_size([s.alpha for s in specs if s.alpha < 1.0] or [0.5])
    if block is not None and any(block * -math.log1p(-s.alpha) < _CARRY_EPS_LOG
                                 for s in specs if s.alpha < 1.0):
        raise ValueError("block too small: q^block must be below 1e-20 for every alpha")
    if b is None:  # alphas too far apart for one block size: split the work
        specs = sorted(specs, key=lambda s: s.alpha)
        mid = len(specs) // 2
        return ema_many(ema_many(df, specs[:mid], by, order), specs[mid:], by, order)

    by = [by] if isinstance(by, str) else list(by)
    blocked = blocked if block else None
    w = Window.partitionBy(*by).orderBy(*[blocked] if blocked else [], order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tag = "__ema"
    rn, blk, e = f"{tag}_rn", blocked or f"{tag}_blk", f"{tag}_e"

    # pass 1: position, non-null counts, forward-filled inputs
    cols = [(F.row_number().over(w) - 1).alias(rn)]
    for i, s in enumerate(specs):
        x = F.col(s.value) if isinstance(s.value, str) else s.value
        cols.append(x.cast("double").alias(f"{tag}{i}_x"))
    df = df.select("*", *cols)
    cols = []
    for i, _ in enumerate(specs):
        x = F.col(f"{tag}{i}_x")
        cols += [F.count(x).over(run).alias(f"{tag}{i}_n"),
                 F.last(x, ignorenulls=True).over(run).alias(f"{tag}{i}_xf")]
    df = df.select("*", *cols)
    if not blocked:
        df = df.withColumn(blk, F.floor(F.col(rn) / b))
    df = df.withColumn(e, F.col(rn) - F.col(blk) * b)

    # pass 2: in-block closed form
    wb = Window.partitionBy(*by, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = []
    for i, s in enumerate(specs):
        q = 1.0 - s.alpha
        x, xf, n = F.col(f"{tag}{i}_x"), F.col(f"{tag}{i}_xf"), F.col(f"{tag}{i}_n")
        z = F.when(x.isNotNull() & (n == 1), xf).when(n >= 1, xf * s.alpha)
        if q == 0.0:  # alpha == 1: the EMA is the (filled) value itself
            cols.append(F.when(n >= 1, xf).alias(f"{tag}{i}_in"))
        else:
            s_ = F.sum(z * F.pow(F.lit(q), -F.col(e))).over(wb)
            cols.append((F.pow(F.lit(q), F.col(e)) * s_).alias(f"{tag}{i}_in"))
    df = df.select("*", *cols)

    # pass 3: the two previous block ends, each the one end row of a range of one
    # block.  Rows ordered by (block, order) are ordered by the block, so no re-sort.
    blocks = Window.partitionBy(*by).orderBy(blk)
    is_end = F.col(e) == (b - 1)
    df = df.select("*", *[F.max(F.when(is_end, F.col(f"{tag}{i}_in"))).over(blocks.rangeBetween(-k, -k)).alias(f"{tag}{i}_e{k}")
                          for i, _ in enumerate(specs) for k in (1, 2)])

    outs = []
    for i, s in enumerate(specs):
        q = 1.0 - s.alpha
        carry = F.coalesce(F.col(f"{tag}{i}_e1"), F.lit(0.0)) + \
            F.coalesce(F.col(f"{tag}{i}_e2"), F.lit(0.0)) * F.lit(q ** b)
        val = F.col(f"{tag}{i}_in") + carry * F.pow(F.lit(q), F.col(e) + 1)
        outs.append(F.when(F.col(f"{tag}{i}_n") >= s.min_periods, val).alias(s.out))
    keep = [c for c in df.columns if not c.startswith(tag)]
    return df.select(*keep, *outs)


def ema(df: DataFrame, value, alpha: float, out: str, min_periods: int = 1,
        by="symbol", order="date") -> DataFrame:
    return ema_many(df, [EmaSpec(value, alpha, out, min_periods)], by, order)


def ema_sql(value_sql: str, idx_sql: str, alpha: float, part: str, order: str) -> str:
    """The same closed form as SQL text (used by the oracle queries).

    ``idx_sql`` must already be a column holding the 0-based index of the
    row counted from the seed (first non-null value); ``value_sql`` must be
    NULL before the seed.  No blocks: valid while ``q^-k`` stays in double
    range (the oracle series are a few hundred rows long).
    """
    q = 1.0 - alpha
    w = f"(PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    z = f"(CASE WHEN {idx_sql} = 0 THEN {value_sql} ELSE {alpha!r} * {value_sql} END)"
    return f"(POW({q!r}, {idx_sql}) * SUM({z} * POW({q!r}, -{idx_sql})) OVER {w})"
