"""Rounding and division with the results the marts are specified by."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# From 2^52 on a double has no fraction left, so rounding returns it unchanged.
_NO_FRACTION = float(2**52)

# Averages add values as this: to 1e-10, below 1e28.
_SUMMED_AS = "decimal(38,10)"


def round_half_up(value: Column, places: int) -> Column:
    """Round a double away from zero on binary ties: 1.005 -> 1.0, 0.125 -> 0.13.

    Spark's own `round` goes through the decimal text of the double and gives
    1.01 for the first. NULL, NaN and infinities come back as they are.
    """
    factor = float(10**places)
    scaled = F.abs(value) * factor
    whole = F.floor(scaled)
    # The remainder is exact; adding a half first would itself round up.
    up = F.when(scaled - whole >= 0.5, 1).otherwise(0)
    magnitude = (whole + up) / factor
    return (
        F.when(scaled >= _NO_FRACTION, value)
        .when(value < 0, -magnitude)
        .otherwise(magnitude)
    )


def stable_avg(value: Column, strict: bool = True) -> Column:
    """Average of doubles that does not depend on the order of the rows.

    Adding doubles rounds at every step, so a plain average changes in its last
    bits with partitioning and retries, and after rounding to cents in a whole
    cent. Here values are added as decimals, which is exact in any order. NaN,
    infinities and values or sums from 1e28 on fail; when not strict such values
    count as NULL and such sums are NULL.
    """
    total, n = exact_sum(value, strict), F.count(exact_term(value, strict))
    return avg_of(total, n)


def exact_term(value: Column, strict: bool = True) -> Column:
    """A double as the decimal that sums add."""
    if not strict:
        return value.try_cast(_SUMMED_AS)
    # A cast to decimal makes them NULL without a word.
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    message = F.lit("an average of values that are no finite numbers")
    return F.when(odd, F.raise_error(message)).otherwise(value.cast(_SUMMED_AS))


def exact_sum(value: Column, strict: bool = True) -> Column:
    term = exact_term(value, strict)
    return F.sum(term) if strict else F.try_sum(term)


def avg_of(total: Column, n: Column) -> Column:
    """Average from an exact sum and a count."""
    return total.cast("double") / F.nullif(n, F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is NULL for a zero or NULL denominator."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def billions(value: Column) -> Column:
    return value / 1e9
