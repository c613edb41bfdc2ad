"""Count, sum and sum of squares per metric, which rows can join and leave again.

All three are whole numbers or decimals, so adding rows and taking the same rows out gives back what
was there, in any order, and a mean or deviation needs no row any more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

_VALUE, _SQUARE = "decimal(28,6)", "decimal(38,6)"


def moments(rows: DataFrame) -> DataFrame:
    """`metric, n, total, squares` of rows `metric, value`; null values are left out."""
    value = F.col("value").cast(_VALUE)
    return rows.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.coalesce(F.sum(value), F.lit(0)).cast(_SQUARE).alias("total"),
        F.coalesce(F.sum((value * value).cast(_SQUARE)), F.lit(0)).cast(_SQUARE).alias("squares"),
    )


def joined(*parts: DataFrame, without: DataFrame | None = None) -> DataFrame:
    """The moments of all rows of the parts, less those of the rows in `without`."""
    signed = list(parts)
    if without is not None:
        signed.append(without.select("metric", *[(-F.col(c)).alias(c) for c in ("n", "total", "squares")]))
    sums = [F.sum(c).cast("long" if c == "n" else _SQUARE).alias(c) for c in ("n", "total", "squares")]
    return reduce(DataFrame.unionByName, signed).groupBy("metric").agg(*sums)


def statistics(found: DataFrame) -> DataFrame:
    """`metric, n, mean, std`: mean and sample deviation, null where there are too few values."""
    n = F.col("n")
    # Both products are exact to six digits; beyond 32 digits there is no deviation rather than a wrong one.
    squares, total = (F.try_multiply(F.col("squares"), n.cast(_SQUARE)), F.try_multiply("total", "total"))
    spread = (squares - total).cast("double") / (n.cast("double") * (n - 1))
    return found.select(
        "metric",
        "n",
        F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("std"),
    )
