"""Aggregate expressions whose result does not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 27


def exact_mean(column: str | Column, decimals: int = 6) -> Column:
    """Mean from sums that are exact, so that the order in which partial sums meet cannot show.

    Values that are a whole number of units of ``10**-decimals``, of up to 53 bits, are summed as units in two parts of 27 bits,
    which plain integers hold for 2**36 rows. Of all others the nearest integers (38 digits) and the remainders (24 digits behind
    the point) are summed apart. Which of the two is taken depends on each value, never on their number. Only NaN, infinite
    values, and values beyond 10**28 or with digits behind the 24th are averaged as doubles, with the rest of their group.
    """
    x = F.col(column) if isinstance(column, str) else column
    scale = float(10**decimals)
    present = F.count(x)
    rounded = F.rint(x * scale)
    is_units = (rounded / scale == x) & (F.abs(rounded) < float(1 << 53))
    units = F.when(is_units, rounded).cast("long")
    high, low = F.sum(F.shiftright(units, _LOW_BITS)), F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    in_units = (high.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(9,0)") + low.cast("decimal(20,0)")).cast("double")
    odd = F.when(~is_units | x.isNull(), x)
    whole = F.rint(odd)
    rest = (odd - whole).try_cast("decimal(28,24)")
    in_limbs = F.sum(whole.try_cast("decimal(28,0)")).cast("double") + F.sum(rest).cast("double")
    all_units = F.count(odd) == 0
    are_limbs = F.count_if((rest.cast("double") == odd - whole) & whole.try_cast("decimal(28,0)").isNotNull()) == F.count(odd)
    mixed = (F.coalesce(in_units, F.lit(0.0)) / F.lit(scale) + in_limbs) / present
    return F.when(present > 0, F.when(all_units, in_units / (present * F.lit(scale))).when(are_limbs, mixed).otherwise(F.avg(x)))
