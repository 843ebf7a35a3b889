"""Sums of doubles that do not depend on the order of the rows.

Every double of ordinary size is split, without error, into three whole numbers of 63 bits in the units 2^32, 2^-31 and 2^-94. The
three are summed as decimals, so partial sums of any grouping merge to the same totals, and the totals are rounded once, to the nearest double (ties to even).
A state can be stored, and merged again later. Only built-in expressions are used.

The split is exact for 0 and for magnitudes from 2^-42 (2e-13) up to 2^94 (2e28). Other values, NaN and infinities
are added as plain doubles on top.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

#: Fields of a state: whole multiples of 2^32, 2^-31 and 2^-94, and what is added as a double.
STATE = ("high", "middle", "low", "rest")

_LIMB = 2.0**63
_ONE_LIMB = "CAST(9223372036854775808 AS decimal(19,0))"


def _limbs(value: Column) -> list[Column]:
    x = value.cast("double")
    inside = (x == 0) | ((F.abs(x) >= 2.0**-42) & (F.abs(x) < 2.0**94))
    left = F.when(inside | x.isNull(), x).otherwise(0.0) * 2.0**-32
    limbs = []
    for _ in range(3):
        whole = left.cast("bigint")
        limbs.append(whole.cast("decimal(28,0)"))
        left = (left - whole.cast("double")) * _LIMB
    return [*limbs, F.when(~inside, x)]


def sum_state(value: Column) -> Column:
    """An aggregation: the state of the sum of a column of doubles, nulls skipped."""
    return F.struct(*[F.sum(limb).alias(name) for limb, name in zip(_limbs(value), STATE, strict=True)])


def merged_state(state: str) -> Column:
    """An aggregation: the state of the sum of what several states stand for."""
    return F.struct(*[F.sum(f"{state}.{name}").alias(name) for name in STATE])


def with_rounded(df: DataFrame, state: str, name: str) -> DataFrame:
    """``df`` with the column ``state`` replaced by the double ``name`` nearest to the sum; null if no value was added."""
    kept = [f"`{c}`" for c in df.columns if c != state]
    step = df.selectExpr(*kept, *[f"{state}.{field} AS _{field}" for field in STATE])
    # Carry, so that the lower two numbers are from 0 to below 2^63 and the sign is that of the first.
    step = step.selectExpr(*kept, "_rest", "_high", "_middle", "_low", f"pmod(_low, {_ONE_LIMB}) AS _c")
    step = step.selectExpr(*kept, "_rest", "_high", "_c", f"_middle + ((_low - _c) div {_ONE_LIMB}) AS _middle")
    step = step.selectExpr(*kept, "_rest", "_high", "_middle", "_c", f"pmod(_middle, {_ONE_LIMB}) AS _b")
    step = step.selectExpr(
        *kept, "_rest", "CAST(_c AS bigint) AS _c", "CAST(_b AS bigint) AS _b", f"CAST(_high + ((_middle - _b) div {_ONE_LIMB}) AS bigint) AS _a"
    )
    # The magnitude.
    step = step.selectExpr(
        *kept, "_rest", "_a < 0 AS _minus", "_a", "_b", "_c",
        "IF(_c > 0, 1L, 0L) AS _from_c", "IF(_b > 0 OR _c > 0, 1L, 0L) AS _from_b",
    )
    step = step.selectExpr(
        *kept, "_rest", "_minus",
        "IF(_minus, -_a - _from_b, _a) AS _a",
        "IF(_minus AND _from_b = 1, (9223372036854775807 - _b) - _from_c + 1, _b) AS _b",
        "IF(_minus AND _from_c = 1, (9223372036854775807 - _c) + 1, _c) AS _c",
    )
    # The two highest numbers that matter; what is below them is kept as a last bit, which rounds alike.
    step = step.selectExpr(
        *kept, "_rest", "_minus",
        "CASE WHEN _a > 0 THEN _a WHEN _b > 0 THEN _b ELSE 0L END AS _upper",
        "CASE WHEN _a > 0 THEN _b | IF(_c > 0, 1L, 0L) ELSE _c END AS _lower",
        "IF(_a > 0, -31, -94) AS _unit",
    )
    step = step.selectExpr(*kept, "_rest", "_minus", "_upper", "_lower", "_unit", "IF(_upper > 0, length(bin(_upper)), 63) AS _bits")
    step = step.selectExpr(
        *kept, "_rest", "_minus", "_unit", "_bits",
        "IF(_upper > 0, shiftleft(_upper, 63 - _bits) | shiftright(_lower, _bits)"
        " | IF(shiftleft(shiftright(_lower, _bits), _bits) <> _lower, 1L, 0L), _lower) AS _top",
        "IF(_upper > 0, _bits, 0) AS _shift",
    )
    value = "CAST(_top AS double) * power(2D, CAST(_shift + _unit AS double)) * IF(_minus, -1D, 1D)"
    return step.selectExpr(*kept, f"{value} + coalesce(_rest, 0D) AS `{name}`")


def exact_sum_by(df: DataFrame, keys: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """As ``sum_by``; a column of doubles or floats is summed exactly and rounded once. Other types add up exactly anyway."""
    if not isinstance(df.schema[value].dataType, DoubleType | FloatType):
        return df.groupBy(*keys).agg(F.sum(value).alias(name))
    return with_rounded(df.groupBy(*keys).agg(sum_state(F.col(value)).alias("_state")), "_state", name)
