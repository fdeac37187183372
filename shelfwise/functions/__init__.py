from shelfwise.functions.columns import (  # noqa: F401
    rnd, r2, r3, r4, r6, safe_div, exact_avg, erf, normal_cdf, clip,
)
