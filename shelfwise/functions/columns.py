"""Column-expression helpers shared by all operators.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def rnd(x, k: int) -> Column:
    """Round half up to ``k`` decimals as floor(x*10^k + .5)/10^k.

    Written out so that Spark and any SQL engine give bit-identical results
    (``round`` differs between engines on binary ties such as 1.005).
    """
    scale = float(10 ** k)
    return (F.floor(_c(x) * scale + 0.5) / scale).cast("double")


def r2(x) -> Column:
    return rnd(x, 2)


def r3(x) -> Column:
    return rnd(x, 3)


def r4(x) -> Column:
    return rnd(x, 4)


def r6(x) -> Column:
    return rnd(x, 6)


def safe_div(a, b, default=0.0) -> Column:
    """a / b, ``default`` when b is zero or null (ANSI-safe: never raises)."""
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(default))


def exact_avg(x, decimals: int, cond: Column | None = None) -> Column:
    """Average of values carrying ``decimals`` decimals, independent of summation order.

    The sum is rounded back to the values' own precision before dividing, so the
    result does not depend on how partial aggregates were merged.
    """
    v = _c(x) if cond is None else F.when(cond, _c(x))
    return rnd(F.sum(v), decimals) / F.count(v)


def clip(x, lo, hi) -> Column:
    """x held within [lo, hi]; null stays null (greatest / least alone would skip it)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, _c(lo)), _c(hi)))


# fixed values: Abramowitz-Stegun 7.1.26 coefficients (|error| <= 1.5e-7)
_AS_P = 0.3275911
_AS_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf(x) -> Column:
    """Error function by Abramowitz-Stegun 7.1.26; Spark has no native erf."""
    x = _c(x)
    ax = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_AS_P) * ax)
    a1, a2, a3, a4, a5 = _AS_A
    poly = t * (a1 + t * (a2 + t * (a3 + t * (a4 + t * a5))))
    y = F.lit(1.0) - poly * F.exp(-(ax * ax))
    return F.when(x < 0, -y).otherwise(y)


def normal_cdf(z) -> Column:
    """P(Z <= z) for a standard normal."""
    return F.lit(0.5) * (F.lit(1.0) + erf(_c(z) / math.sqrt(2.0)))

