"""Exact cross-sectional ranks without a task per group.

``percent_rank() OVER (PARTITION BY date ORDER BY x)`` puts every row of a day
into one task.  Here rows first fold into distinct values with their counts (a
partial aggregate, so a value that most rows share costs one row per task).
The distinct values of a group are dealt into value ranges by the leading bits
of their number, an order-preserving code; counts of the lower ranges plus the
running count inside a range give the rank.  One window task holds one range
of one group, and the ranges of a group are bounded by the code's width, not
by the data.  Ranks return to the rows by a join on (group, value), which
Spark's skew join splits.  Ties share the smallest rank, NULLs get NULL, NaN
ranks above all numbers.

Several columns ranked together (``rank_many``) would pay that join once a
column.  Their rows are written once and counted by group: a group of at most
``GROUP_ROWS`` rows is ranked by windows on one exchange for all columns, and
only larger groups take the way through value ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, written

#: Leading bits of a double that make a range: sign, exponent, 8 of the fraction.
RANGE_BITS = 20
#: Rows of a group that one window task ranks; larger groups are dealt into ranges.
GROUP_ROWS = 200_000


def _range_of(v: Column) -> Column:
    """Value range of a double, in the order of the values (NULL for NULL).

    An IEEE double's bits, read as an integer, order like the value if the
    sign is handled; ``log2`` gives the exponent and the fraction without a
    bit cast: binade * 256 + position in the binade, mirrored below zero."""
    size = F.least(F.abs(v), F.lit(1e300))
    binade = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1000)), F.lit(1000))
    inside = F.floor((size / F.pow(F.lit(2.0), binade) - 1) * (1 << (RANGE_BITS - 12)))
    cell = (binade + 1001) * (1 << (RANGE_BITS - 11)) + inside
    return (F.when(v.isNull(), None).when(F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0))
            .when(v > 0, cell).otherwise(-cell)).cast("long")


def rank_table(values: DataFrame, by: list[str]) -> DataFrame:
    """(by..., __value, __rank, __count, __total) of the distinct non-null
    ``__value`` of each group."""
    values = (values.where("__value is not null")
              .groupBy(*by, "__value").agg(F.count(F.lit(1)).alias("__count"))
              .withColumn("__range", _range_of(F.col("__value"))))
    inner = Window.partitionBy(*by, "__range").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    ranges = values.groupBy(*by, "__range").agg(F.sum("__count").alias("__in"))
    below = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(*by, "__range", F.coalesce(F.sum("__in").over(below), F.lit(0)).alias("__below"),
                           F.sum("__in").over(Window.partitionBy(*by)).alias("__total"))
    keys = [*by, "__range"]
    inside = values.withColumn("__before", F.coalesce(F.sum("__count").over(inner), F.lit(0)))
    j = inside.join(ranges.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__below", "__total"),
                    [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return j.select(*by, "__value", (F.col("__below") + F.col("__before") + 1).alias("__rank"), "__count", "__total")


def _as_value(c: Column) -> Column:
    return c.cast("double") + F.lit(0.0)  # -0.0 and 0.0 are one value


def _share(rank: Column, n: Column, percent: bool) -> Column:
    return F.when(n > 1, (rank - 1) / (n - 1)).when(n == 1, F.lit(0.0)) if percent else rank


def rank_many(df: DataFrame, by: list[str] | str, specs: list[tuple], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rank several columns within ``by``.

    ``specs``: (value column, output column[, descending[, percent]]); the
    percent form is ``percent_rank``'s, 0 for a group of one value row.  With
    several columns ``df`` is written once: select what is needed before."""
    by = [by] if isinstance(by, str) else list(by)
    specs = [tuple(sp) + (False, True)[len(sp) - 2:] for sp in specs]
    if len(specs) == 1:
        return _rank_by_ranges(df, by, specs)
    df = written(df, "ranked")
    large = cut_lineage(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > group_rows)
                        .select(*[F.col(b).alias(f"__g{k}") for k, b in enumerate(by)]))
    if large.isEmpty():
        return _rank_by_windows(df, by, specs)
    on = [F.col(b).eqNullSafe(F.col(f"__g{k}")) for k, b in enumerate(by)]
    return _rank_by_windows(df.join(large, on, "left_anti"), by, specs).unionByName(
        _rank_by_ranges(df.join(large, on, "left_semi"), by, specs))


def _rank_by_windows(df: DataFrame, by: list[str], specs: list[tuple]) -> DataFrame:
    """Ranks of bounded groups: all columns on one exchange by the group."""
    group, out = Window.partitionBy(*by), df
    for i, (value, _, descending, percent) in enumerate(specs):
        x = _as_value(-F.col(value) if descending else F.col(value))
        rank = F.rank().over(group.orderBy(x.asc_nulls_last())).cast("long")
        out = out.withColumn(f"__s{i}", F.when(x.isNotNull(), _share(rank, F.count(x).over(group), percent)))
    return _named(out, specs)


def _named(out: DataFrame, specs: list[tuple]) -> DataFrame:
    for i, sp in enumerate(specs):
        out = out.withColumn(sp[1], F.col(f"__s{i}")).drop(f"__s{i}")
    return out


def _rank_by_ranges(df: DataFrame, by: list[str], specs: list[tuple]) -> DataFrame:
    """Ranks of groups of any size.  The columns are ranked together: one table of
    distinct values, written to the shared folder, serves all joins back."""
    columns = [_as_value(-F.col(v) if descending else F.col(v)) for v, _, descending, _ in specs]
    long = df.select(*by, F.posexplode(F.array(*columns)).alias("__spec", "__value"))
    ranks = rank_table(long, [*by, "__spec"])
    if len(specs) > 1:
        ranks = written(ranks, "ranks")
    out = df
    for i, (value, name, descending, percent) in enumerate(specs):
        own = ranks.where(F.col("__spec") == i).select(
            *[F.col(b).alias(f"__b{k}") for k, b in enumerate(by)], F.col("__value").alias("__rv"), "__rank", "__total")
        on = [F.col(b).eqNullSafe(F.col(f"__b{k}")) for k, b in enumerate(by)] + [columns[i] == F.col("__rv")]
        out = out.join(own, on, "left").withColumn("__score", _share(F.col("__rank"), F.col("__total"), percent)).drop(
            "__rv", "__rank", "__total", *[f"__b{k}" for k in range(len(by))]).withColumnRenamed("__score", f"__s{i}")
    return _named(out, specs)


def rank_within(df: DataFrame, by: list[str] | str, value: str, out: str = "rank", percent: bool = True,
                descending: bool = False) -> DataFrame:
    """Add ``out`` = percent_rank (or rank) of ``value`` within ``by``."""
    return rank_many(df, by, [(value, out, descending, percent)])


def ntile_within(df: DataFrame, by: list[str] | str, value: str, n: int, out: str = "ntile") -> DataFrame:
    """Decile-style tile from the exact rank: tile = floor((rank-1) * n / count) + 1
    (ties share a tile, unlike ``ntile()`` which splits them by position)."""
    by = [by] if isinstance(by, str) else list(by)
    r = rank_within(df, by, value, "__r", percent=False)
    cnt = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("__c"))
    tile = F.floor((F.col("__r") - 1) * n / F.col("__c")) + 1
    return r.join(cnt, by, "left").withColumn(out, F.when(F.col("__r").isNotNull(), tile.cast("int"))).drop("__r", "__c")


def exact_median(df: DataFrame, by: list[str] | str, value: str, out: str = "median") -> DataFrame:
    """Exact median per group (``percentile_cont(0.5)``) from the distinct
    values: the k-th smallest is the largest value whose rank is at most k."""
    by = [by] if isinstance(by, str) else list(by)
    r = rank_table(df.select(*by, _as_value(F.col(value)).alias("__value")), by)
    lo, hi = F.floor((F.col("__total") + 1) / 2), F.ceil((F.col("__total") + 1) / 2)
    g = r.groupBy(*by).agg(F.max(F.when(F.col("__rank") <= lo, F.col("__value"))).alias("__lo"),
                           F.max(F.when(F.col("__rank") <= hi, F.col("__value"))).alias("__hi"))
    return g.select(*by, ((F.col("__lo") + F.col("__hi")) / 2.0).alias(out))
