"""Column helpers: trailing calendar windows, guarded ratios, exact quantiles,
exact sums of very large integers, significant digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

TINY = 1e-12
MAD_TO_STD = 1.4826  # of a normal distribution


def epoch_day(date: Column | str) -> Column:
    return F.unix_date(F.to_date(date))


def trailing_days(entity: str, date: str, days: int) -> WindowSpec:
    """The calendar days before a row's own, so gaps shrink the sample."""
    return W.partitionBy(entity).orderBy(epoch_day(date)).rangeBetween(-days, -1)


def only_if(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def standard_score(x: Column, over: WindowSpec) -> Column:
    spread = F.stddev_samp(x).over(over)
    return only_if(spread > TINY, (x - F.avg(x).over(over)) / spread)


def middle(sorted_values: Column) -> Column:
    """Median of a sorted array, null if empty."""
    n = F.size(sorted_values)
    low, high = F.floor((n + 1) / 2).cast("int"), F.ceil((n + 1) / 2).cast("int")
    return only_if(n > 0, (F.try_element_at(sorted_values, low) + F.try_element_at(sorted_values, high)) / 2)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scaled_deviation(values: Column, center: Column) -> Column:
    """Median absolute deviation of an array, in units of a normal deviation."""
    return MAD_TO_STD * middle(F.array_sort(F.transform(values, lambda v: F.abs(v - center))))


def limb_sums(value: Column, limbs: int = 5, digits: int = 18) -> list[Column]:
    """Sums of the digit groups of non-negative decimal strings, lowest first.
    Up to limbs*digits digits are exact over 10^20 rows."""
    padded = F.lpad(value, limbs * digits, "0")
    return [
        F.sum(F.substring(padded, 1 + digits * (limbs - 1 - i), digits).cast("decimal(38,0)")).alias(f"limb{i}")
        for i in range(limbs)
    ]


def join_limbs(sums: list, digits: int = 18) -> str:
    """The exact total of limb_sums as a decimal string."""
    return str(sum(int(s or 0) * 10 ** (digits * i) for i, s in enumerate(sums)))


def scaled_round(x: Column, digits: int) -> Column:
    """x at so many digits after the point, as SQL's engine rounds doubles: scaled
    up, rounded half away from zero, scaled down. F.round goes by the decimal
    digits, which is another number where a double has few binary places left."""
    scaled = x * F.lit(10.0**digits)
    return F.when(F.abs(scaled) < F.lit(float("inf")), F.round(scaled) / F.lit(10.0**digits)).otherwise(x)


def significant(x: Column, digits: int = 5) -> Column:
    """x at so many significant digits; null stays null, infinities become null."""
    finite = x.isNotNull() & (F.abs(x) < F.lit(float("inf")))
    power = F.floor(F.log10(F.abs(x))) - (digits - 1)
    up, down = F.pow(F.lit(10.0), F.greatest(power, F.lit(0))), F.pow(F.lit(10.0), F.greatest(-power, F.lit(0)))
    half_even = F.bround(x / up * down) * up / down
    return only_if(finite, F.when(x == 0, F.lit(0.0)).otherwise(half_even))
