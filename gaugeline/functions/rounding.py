"""Rounding that does not depend on the order in which doubles were added."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double mean of two-decimal readings that is mathematically x.xx5 lands a hair above or below
# it depending on summation order, so plain rounding differs from run to run. The nudge, far
# larger than that noise and far smaller than any reported digit, makes every tie round away
# from zero.
TIE_NUDGE = "1e-6D"


def rounded(expression: str, digits: int = 2) -> str:
    """SQL text of ``expression`` rounded half away from zero; the last term turns -0.0 to 0.0."""
    scale = f"{10**digits}.0D"
    return f"rint(({expression}) * {scale} + signum({expression}) * {TIE_NUDGE}) / {scale} + 0.0D"


def round_half_up(column: Column | str, digits: int = 2) -> Column:
    if isinstance(column, str):
        return F.expr(rounded(f"`{column}`", digits))
    scale = F.lit(float(10**digits))
    return F.rint(column * scale + F.signum(column) * F.lit(float(TIE_NUDGE.rstrip("D")))) / scale + F.lit(0.0)
