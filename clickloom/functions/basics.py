"""Small column helpers used by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def is_blank(value: Column) -> Column:
    """True for a null or empty string."""
    return value.isNull() | (value == "")


def passes(test: Column) -> Column:
    """A predicate under which missing values pass."""
    return F.coalesce(test, F.lit(True))


def not_in(value: Column, allowed: Iterable[str]) -> Column:
    """Not a member of `allowed`; a missing value is not a member either."""
    return F.coalesce(~value.isin(*allowed), F.lit(True))


def ratio(top: Column, bottom: Column) -> Column:
    """`top / bottom`, 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def flag(test: Column) -> Column:
    """1 where `test` holds, else 0: a fixed-width value that hash aggregation can update."""
    return F.when(test, 1).otherwise(0)


def count_if(test: Column) -> Column:
    return F.coalesce(F.sum(flag(test)), F.lit(0))


def decimal_part(money: Column) -> Column:
    """Money as a decimal, null where it is not finite or beyond 1e22."""
    return money.try_cast("decimal(28,6)")


def other_part(money: Column) -> Column:
    """What `decimal_part` leaves out: values beyond it, infinities, NaN, and what lies below its last digit."""
    whole = decimal_part(money)
    return F.when(whole.isNull(), money).otherwise(money - whole.cast("double"))


def whole_sum(decimals: Column, others: Column) -> Column:
    """Both parts of a sum as one double."""
    return F.coalesce(decimals.cast("double"), F.lit(0.0)) + F.coalesce(others, F.lit(0.0))


def exact_sum(money: Column) -> Column:
    """Sum of a double column that does not depend on the order of its rows.

    Decimals add exactly; only values that no decimal holds, and digits beyond the sixth, are added as doubles.
    """
    return whole_sum(F.sum(decimal_part(money)), F.sum(other_part(money)))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def floor_div(value: Column, width: int) -> Column:
    """Whole number of `width` steps at or below `value`, for negative values too."""
    return ((value - F.pmod(value, F.lit(width))) / F.lit(width)).cast("long")


def whole_days(later_us: Column, earlier_us: Column) -> Column:
    """Floor of the elapsed 24-hour periods (not calendar days)."""
    return floor_div(later_us - earlier_us, MICROS_PER_DAY)


def join_path(steps: Column) -> Column:
    return F.array_join(steps, " > ")


def last_items(items: Column, n: int) -> Column:
    """The last `n` elements, all of them when there are fewer."""
    return F.slice(items, F.greatest(F.lit(1), F.size(items) - F.lit(n - 1)), F.lit(n))


def numbered_id(prefix: Column, number: Column) -> Column:
    """`prefix_number`, null when either is missing."""
    return F.concat(prefix, F.lit("_"), number.cast("string"))
