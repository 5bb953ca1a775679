"""Number expressions: rounding, reading, printing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.columns import FLOATS, INTEGERS

# Spark's own cast also reads Java literals such as "1d" or "0x1p3"; this keeps them out.
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def half_even(value: Column, digits: int = 0) -> Column:
    """Round half to even on the scaled double, as numpy does."""
    if digits == 0:
        return F.rint(value)
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def to_double(value: Column, dtype: T.DataType) -> Column:
    """The value as a double; what is no number, and NaN, becomes NULL."""
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(_NUMBER), F.trim(value).try_cast("double"))
    if isinstance(dtype, FLOATS):
        return F.nullif(value.cast("double"), F.lit(float("nan")))
    return value.try_cast("double")


def whole_text(value: Column, dtype: T.DataType, fraction: str = "raise") -> Column:
    """A code as text: 13.0 gives "13".

    ``fraction`` says what a code like 1.5 does: ``raise`` stops the job when such a
    value is met, ``keep`` prints it.
    """
    if isinstance(dtype, FLOATS):
        # Few branches and a constant message: a wide table has dozens of these, and the
        # code generated for one projection has to stay small enough to be compiled well.
        clean = F.nullif(value, F.lit(float("nan")).cast(dtype))
        if fraction == "keep":
            other = number_text(value, dtype)
        else:
            other = F.raise_error(F.lit("code with a fraction")).cast("string")
        whole = F.when(F.abs(value) < F.lit(9.2e18), clean.cast("bigint").cast("string"))
        return F.when(F.rint(value) != value, other).otherwise(
            F.coalesce(whole, number_text(value, dtype))
        )
    if isinstance(dtype, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")


def number_text(value: Column, dtype: T.DataType) -> Column:
    """Print a number in plain digits: no exponent, no ".0" on whole values."""
    if isinstance(dtype, INTEGERS) or not isinstance(dtype, FLOATS):
        return value.cast("string")
    digits = F.regexp_replace(
        value.cast("string").try_cast("decimal(38,18)").cast("string"), r"\.?0+$", ""
    )
    whole = (F.rint(value) == value) & (F.abs(value) < F.lit(9.2e18))
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string"))
        .when(whole, value.try_cast("bigint").cast("string"))
        .otherwise(F.coalesce(digits, value.cast("string")))
    )
