"""Scalar column expressions shared by the silver, gold and query layers.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: str | Column, digits: int) -> Column:
    """Round like a numpy/pandas ``round``: scale, round half to even, unscale.

    This is the rounding of the silver and gold layers (dataframe code), which
    works on the binary double, not on its decimal text.
    """
    scale = float(10 ** digits)
    return F.rint(_c(c) * F.lit(scale)) / F.lit(scale)


def round_half_up(c: str | Column, digits: int) -> Column:
    """SQL ``ROUND(x, n)`` for the query layer: half away from zero.

    Written as floor(x * 10^n + 0.5) / 10^n for x >= 0 and mirrored for
    negatives, so the same arithmetic can be stated in any SQL engine.
    """
    scale = float(10 ** digits)
    x = _c(c)
    pos = F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    neg = -F.floor(-x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(x >= 0, pos).otherwise(neg)


#: Bands of a sum: values below the first bound to nine decimals, values from there to the second as whole numbers, what
#: the first leaves beyond nine decimals in units of 1e-27. Each is a decimal with ten digits of room for the sum.
_NEAR, _FAR, _UNIT = 1e18, 1e28, 1e27
_LIMBS = ("near", "big", "fine", "far", "n")


def _limbs(c: str | Column) -> dict[str, Column]:
    """A double in bands that are added up apart: ``near``, ``big`` and ``fine`` as decimals; ``far``, a double, has what
    no band covers: values from 1e28 on, what is left below 1e-27, infinities and NaN (0 for all others); ``n`` counts values."""
    x = _c(c).cast("double")
    near, big = F.abs(x) < F.lit(_NEAR), (F.abs(x) >= F.lit(_NEAR)) & (F.abs(x) < F.lit(_FAR))
    head = F.when(near, x).try_cast("decimal(28,9)")
    left = F.when(near, x - head.cast("double"))
    fine = F.when(left != 0, left * F.lit(_UNIT)).try_cast("decimal(28,0)")
    far = F.when(near, left - F.coalesce(fine.cast("double") / F.lit(_UNIT), F.lit(0.0))).when(big, F.lit(0.0)).otherwise(x)
    return {"near": head, "big": F.when(big, x).try_cast("decimal(28,0)"), "fine": fine, "far": far, "n": F.when(x.isNotNull(), F.lit(1).cast("long"))}


def _sum_of(s: dict[str, Column]) -> Column:
    zero = F.lit(0.0)
    total = (F.coalesce(s["near"].cast("double"), zero) + F.coalesce(s["fine"].cast("double") / F.lit(_UNIT), zero)
             + F.coalesce(s["big"].cast("double"), zero) + F.coalesce(s["far"], zero))
    return F.when(s["n"] > 0, total)


def sum_exact(c: str | Column) -> Column:
    """Sum of a double that does not depend on the order rows arrive in, NULL without values.

    Values below 1e18 are added as decimals of nine places, what they have beyond those in units of 1e-27, values from 1e18
    to 1e28 as whole decimals; so the sum of such values is the same to the last bit however rows come. Values from
    1e28 on and what is below 1e-27 are added as doubles apart, without failing; infinities and NaN give what doubles
    give (both infinities: NaN).
    """
    return _sum_of({k: F.sum(v) for k, v in _limbs(c).items()})


def partial_sums(c: str | Column, name: str) -> list[Column]:
    """The bands of ``sum_exact`` as aggregates of their own, to be added up further by ``merged_sums``."""
    return [F.sum(v).alias(f"{name}_{k}") for k, v in _limbs(c).items()]


def merged_sums(name: str) -> list[Column]:
    """Sums of ``partial_sums`` columns, under the same names."""
    kept = {"near": "decimal(38,9)", "big": "decimal(38,0)", "fine": "decimal(38,0)"}
    return [(F.sum(f"{name}_{k}").cast(kept[k]) if k in kept else F.sum(f"{name}_{k}")).alias(f"{name}_{k}") for k in _LIMBS]


def final_sum(name: str) -> Column:
    """``sum_exact`` of what ``partial_sums`` or ``merged_sums`` counted under ``name``."""
    return _sum_of({k: F.sum(f"{name}_{k}") for k in _LIMBS})


def avg_exact(c: str | Column) -> Column:
    """Mean as exact sum / non-null count, returned as double."""
    x = _c(c)
    return sum_exact(x) / F.count(x)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI division error)."""
    return F.try_divide(_c(num).cast("double"), _c(den))


def pct(num: str | Column, den: str | Column) -> Column:
    """num / den * 100 in the order pandas evaluates it."""
    return safe_ratio(num, den) * F.lit(100)


def eq_flag(c: str | Column, value) -> Column:
    """1 when c == value else 0; a NULL input gives 0 (pandas ``==`` on NaN)."""
    return F.coalesce((_c(c) == F.lit(value)).cast("int"), F.lit(0))


def lenient_number(c: str | Column, dtype: str = "double") -> Column:
    """Plain decimal or exponent text to number; anything else (blank, words, NaN, infinities, type suffixes) becomes
    NULL and never fails."""
    text = F.trim(_c(c).cast(StringType()))
    plain = text.rlike(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$")
    number = F.when(plain, text).try_cast(dtype)
    return F.when(F.abs(number) < F.lit(float("inf")), number) if dtype in ("double", "float") else number


def lenient_timestamp(c: str | Column) -> Column:
    """ISO text to timestamp_ntz, bad text becomes NULL.

    Accepts both 'YYYY-MM-DD HH:MM:SS' and the 'T' separator, with or without
    fractional seconds.
    """
    return _c(c).cast(StringType()).try_cast("timestamp_ntz")


def bucketize(c: str | Column, edges: Sequence[float], labels: Sequence[str],
              closed: str = "right", else_label: str | None = None) -> Column:
    """Label a numeric column by bins.

    ``closed="right"``: bins (e0, e1], (e1, e2], ... and values outside (or
    NULL) get ``else_label`` (default NULL), like ``pandas.cut``.
    ``closed="left"``: bins [-inf, e1), [e1, e2), ... as a searched CASE; the
    last label takes everything else, NULL included, like SQL's ELSE.
    """
    x = _c(c)
    if closed == "right":
        if len(edges) != len(labels) + 1:
            raise ValueError("right-closed bins need len(edges) == len(labels) + 1")
        expr = None
        for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
            cond = (x > F.lit(lo)) & (x <= F.lit(hi))
            expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
        return expr.otherwise(F.lit(else_label))
    if closed == "left":
        if len(edges) != len(labels) - 1:
            raise ValueError("left-closed CASE needs len(edges) == len(labels) - 1")
        expr = None
        for hi, lab in zip(edges, labels[:-1]):
            cond = x < F.lit(hi)
            expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
        return expr.otherwise(F.lit(labels[-1]))
    raise ValueError(f"closed must be 'right' or 'left', got {closed!r}")
