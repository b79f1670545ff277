"""Tests of independence between categories, with the tail of the chi-square distribution as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

# Terms of the series and of the continued fraction; both are exact to double precision with fewer.
TERMS = 200


def _steps(n: Column | int) -> Column:
    return F.sequence(F.lit(1), n if isinstance(n, Column) else F.lit(n))


def erfc(z: Column) -> Column:
    """Complementary error function of ``z >= 0``: a series of positive terms below 2.5, a continued fraction above."""
    spread = F.exp(-z * z)
    start = F.struct(z.alias("term"), z.alias("sum"))

    def longer(s, n):
        term = s["term"] * 2 * z * z / (2 * n + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    near = 1 - 2 / math.sqrt(math.pi) * spread * F.aggregate(_steps(TERMS), start, longer, lambda s: s["sum"])
    below = F.aggregate(_steps(TERMS), z, lambda s, n: z + (TERMS + 1 - n) / 2.0 / s)
    return F.when(z < 2.5, near).otherwise(spread / math.sqrt(math.pi) / below)


def chi_square_tail(x: Column, freedom: Column) -> Column:
    """P(X > x) for a chi-square variable with ``freedom`` (whole) degrees of freedom; 1 for ``x <= 0``."""
    half = x.cast("double") / 2
    odd = freedom % 2 == 1
    # Terms h^(j) / Gamma(j + 1) for j = 0, 1, .. or 1/2, 3/2, .., scaled by exp(-h) in the exponent: no overflow.
    first = F.when(odd, 0.5 * F.log(half) - math.log(math.sqrt(math.pi) / 2)).otherwise(F.lit(0.0)) - half
    count = F.floor(freedom / 2).cast("int")
    start = F.struct(first.alias("log"), F.lit(0.0).alias("sum"))

    def add(s, n):
        place = n + F.when(odd, 0.5).otherwise(0.0)
        return F.struct((s["log"] + F.log(half) - F.log(place)).alias("log"), (s["sum"] + F.exp(s["log"])).alias("sum"))

    total = F.when(count > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), start, add, lambda s: s["sum"]))
    tail = F.coalesce(total, F.lit(0.0)) + F.when(odd, erfc(F.sqrt(half))).otherwise(0.0)
    return F.when(half > 0, F.least(tail, F.lit(1.0))).otherwise(F.lit(1.0))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, observed, a_total, b_total): the occurring cells with their margins; rows with a null are left out.

    Rows shrink to cells map-side; margins are sums of cells.
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count("*").alias("observed"))
    across = lambda c: F.sum("observed").over(Window.partitionBy(c))
    return cells.select("*", across("a").alias("a_total"), across("b").alias("b_total"))


def chi_square_test(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: (n, degrees_of_freedom, statistic, p_value, cramers_v) for the independence of two columns.

    Cells that never occur count with their expected number: the statistic is n (sum of o^2 / (row * column) - 1).
    With one row or column there is nothing to test: 0 degrees of freedom, p 1.
    """
    cells = contingency(df, a, b)
    o, row, column = (F.col(c).cast("double") for c in ("observed", "a_total", "b_total"))
    summed = cells.agg(F.coalesce(F.sum("observed"), F.lit(0)).alias("n"), F.countDistinct("a").alias("r"), F.countDistinct("b").alias("c"),
                       F.sum(o * o / (row * column)).alias("s"))
    freedom = (F.greatest(F.col("r") - 1, F.lit(0)) * F.greatest(F.col("c") - 1, F.lit(0))).cast("long")
    statistic = F.coalesce(F.greatest(F.col("n") * (F.col("s") - 1), F.lit(0.0)), F.lit(0.0))
    least = F.least(F.col("r"), F.col("c")) - 1
    done = summed.select("n", freedom.alias("degrees_of_freedom"), statistic.alias("statistic"), least.alias("_least"))
    return done.select(
        "n", "degrees_of_freedom", "statistic",
        F.when(F.col("degrees_of_freedom") > 0, chi_square_tail(F.col("statistic"), F.col("degrees_of_freedom"))).otherwise(1.0).alias("p_value"),
        F.sqrt(F.col("statistic") / F.nullif(F.col("n") * F.col("_least"), F.lit(0))).alias("cramers_v"))
