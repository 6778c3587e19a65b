"""Exact rounding on integer numerators and denominators.

Rates and means that end up rounded are computed from integer sums and counts so the
result does not depend on the order in which partial aggregates were combined.  For a
non-negative ratio s/d:

* half-up (SQL ROUND):       floor((2·10^k·s + d) / (2·d)) / 10^k
* half-even (frame .round):  q = 10^k·s div d, r = 10^k·s mod d; bump q when 2r > d,
                             or when 2r = d and q is odd.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


_WIDE = "decimal(38,0)"  # integer arithmetic that cannot overflow on cent totals × 10^k


def idiv(a, b) -> Column:
    """Exact integral division (SQL ``a div b``), returned as bigint."""
    return F.call_function("div", _c(a).cast(_WIDE), _c(b).cast(_WIDE))


def half_up_units(s, d, k: int) -> Column:
    """round(s/d, k) half-up, returned in units of 10^-k as bigint (NULL when d = 0)."""
    s, d = _c(s).cast(_WIDE), _c(d).cast(_WIDE)
    scale = 10 ** k
    return F.when(d != 0, idiv(F.lit(2 * scale) * s + d, F.lit(2) * d))


def half_up(s, d, k: int) -> Column:
    """round(s/d, k) half-up as double."""
    return (half_up_units(s, d, k) / F.lit(10 ** k)).cast("double")


def half_even_units(s, d, k: int) -> Column:
    s, d = _c(s).cast(_WIDE), _c(d).cast(_WIDE)
    scaled = F.lit(10 ** k) * s
    q = idiv(scaled, d)
    r = scaled - q * d
    bump = (F.lit(2) * r > d) | ((F.lit(2) * r == d) & (F.pmod(q, F.lit(2)) == 1))
    return F.when(d != 0, q + F.when(bump, 1).otherwise(0))


def half_even(s, d, k: int) -> Column:
    """round(s/d, k) half-to-even as double."""
    return (half_even_units(s, d, k) / F.lit(10 ** k)).cast("double")


def cents(decimal_col) -> Column:
    """A 2-dp decimal amount as integer cents."""
    return (_c(decimal_col) * 100).cast("bigint")


def from_cents(c) -> Column:
    """Integer cents back to a 2-dp decimal."""
    return (_c(c).cast("decimal(38,0)") / F.lit(100)).cast("decimal(20,2)")


def mean_score(score, rows, k: int = 4) -> Column:
    """Mean of scores in [0, 1] rounded half-up to k places, from a sum of integers (scores in
    units of 10^-10), so it does not depend on the order of the rows."""
    units = F.sum(F.round(_c(score).cast("double") * F.lit(1e10)).cast("bigint"))
    return half_up(units, rows.cast(_WIDE) * F.lit(10 ** 10).cast(_WIDE), k)
