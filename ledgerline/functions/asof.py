"""As-of joins as a union plus ordered windows (no range join, no UDF).

Both sides are stacked into one frame, ordered by time inside each key, and
the wanted right-side values are carried with ``last`` / ``first`` ignoring
NULLs.  The cost is one shuffle on the key and one sort per key, i.e. the
same as a sort-merge join, and no row pairs are ever enumerated.  Ties: with
``inclusive`` a right row at the same time as a left row matches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _stack(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
           values: list[str], right_first: bool) -> DataFrame:
    lk, rk = (1, 0) if right_first else (0, 1)
    l_cols = [F.col(c) for c in left.columns]
    lpart = left.select(*l_cols, F.col(left_on).alias("__t"), F.lit(lk).alias("__kind"),
                        F.lit(None).cast("struct<" + ",".join(f"`{v}`:{right.schema[v].dataType.simpleString()}"
                                                              for v in values) + ">").alias("__val"))
    rpart = right.select(*[F.col(b) for b in by], F.col(right_on).alias("__t"), F.lit(rk).alias("__kind"),
                         F.struct(*[F.col(v) for v in values]).alias("__val"))
    return lpart.unionByName(rpart, allowMissingColumns=True)


def asof_backward(left: DataFrame, right: DataFrame, by: list[str] | str, left_on: str, right_on: str,
                  values: list[str], inclusive: bool = True) -> DataFrame:
    """Each left row gets ``values`` of the latest right row with
    ``right_on <= left_on`` (``<`` when not inclusive) for the same key."""
    by = [by] if isinstance(by, str) else list(by)
    u = _stack(left, right, by, left_on, right_on, values, right_first=inclusive)
    w = Window.partitionBy(*by).orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.last(F.when(F.col("__kind") == (0 if inclusive else 1), F.col("__val")), ignorenulls=True).over(w)
    out = u.withColumn("__c", carried).filter(F.col("__kind") == (1 if inclusive else 0))
    return out.select(*left.columns, *[F.col(f"__c.{v}").alias(v) for v in values])


def asof_forward(left: DataFrame, right: DataFrame, by: list[str] | str, left_on: str, right_on: str,
                 values: list[str], inclusive: bool = True) -> DataFrame:
    """Each left row gets ``values`` of the earliest right row with
    ``right_on >= left_on`` (``>`` when not inclusive) for the same key."""
    by = [by] if isinstance(by, str) else list(by)
    u = _stack(left, right, by, left_on, right_on, values, right_first=not inclusive)
    # from the newest row back: a frame of the rows that follow is read anew for each row
    w = Window.partitionBy(*by).orderBy(F.desc("__t"), F.desc("__kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    right_kind = 1 if inclusive else 0
    carried = F.last(F.when(F.col("__kind") == right_kind, F.col("__val")), ignorenulls=True).over(w)
    out = u.withColumn("__c", carried).filter(F.col("__kind") == (1 - right_kind))
    return out.select(*left.columns, *[F.col(f"__c.{v}").alias(v) for v in values])


def known_asof(left: DataFrame, reports: DataFrame, by: list[str] | str, left_on: str, effective: str, known: str,
               values: list[str]) -> DataFrame:
    """Point-in-time join over two times: each left row gets ``effective``,
    ``known`` and ``values`` of the report with the latest effective time among
    those known at ``left_on``, in the newest version known by then.

    A correction of an old period that becomes known late does not displace a
    newer period, and a report changes no row before it was known.  The carried
    value is a running maximum in the order of knowledge: one pass, O(1) a row.
    Left rows without a known report get NULLs; of reports equal in both times
    the larger values win."""
    by = [by] if isinstance(by, str) else list(by)
    dated = reports.select(*by, F.col(known).alias("__known"), F.struct(
        F.col(effective).alias("__effective"), F.col(known).alias("__known"), *[F.col(v) for v in values]).alias("__report"))
    u = _stack(left, dated, by, left_on, "__known", ["__report"], right_first=True)
    w = Window.partitionBy(*by).orderBy("__t", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = u.withColumn("__c", F.max("__val.__report").over(w)).filter(F.col("__kind") == 1)
    return out.select(*left.columns, F.col("__c.__effective").alias(effective), F.col("__c.__known").alias(known),
                      *[F.col(f"__c.{v}").alias(v) for v in values])
