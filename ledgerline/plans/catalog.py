"""Registry of named queries: Spark builder + oracle SQL + rounding.

Every query reads the driver tables under ``sf_dir`` (whole tables) and
returns a DataFrame.  Doubles are rounded on both sides by scaling
(``round(x * 10^d) / 10^d``) so the engines agree bit for bit; columns that
come out of the EMA closed form use fewer digits because the two engines
sum the terms in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..util import rounded
from .oracle import rounded_sql


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: dict[str, int] = field(default_factory=dict)


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, doubles: dict[str, int] | list[str] | None = None,
          digits: int = 6):
    """Register ``fn(spark, sf_dir)``; ``doubles`` lists the double columns
    (name -> digits, or names using ``digits``)."""
    if isinstance(doubles, (list, tuple)):
        doubles = {c: digits for c in doubles}
    doubles = dict(doubles or {})

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return rounded(df, digits, per_col=doubles)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, rounded_sql(sql, doubles) if sql else None, doubles)
        return fn

    return deco


def double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
