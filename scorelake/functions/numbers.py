"""Scalar number operators: guarded casts and rounding that is exact.

Ratios are rounded in whole numbers, never through DOUBLE, so a mean on a tie
rounds the same way whatever the group size.
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelake.functions.text import strip_text

# Text shapes accepted before a cast. A `$` would also match before a last newline.
DIGITS = r"^\d+\z"
DECIMAL_TEXT = r"^-?\d+([.,]\d+)?\z"
COMMA_DECIMAL = r"^-?\d+,\d+$"
FLOAT_TEXT = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"

# Performance bands, highest first, and the two verdicts.
BANDS = [(Decimal("4.5"), "Excelente (Cuadro de Honor)"), (Decimal("4.0"), "Sobresaliente"), (Decimal("3.0"), "Aceptable")]
LOWEST_BAND = "Bajo / En Riesgo Académico"
APPROVED, FAILED = "APROBADO", "REPROBADO"
PASS_MARK = Decimal("3.0")


def guarded_int(c: Column) -> Column:
    """INT when the trimmed text is digits only, else NULL (also on overflow)."""
    return F.when(F.trim(c).rlike(DIGITS), F.trim(c).try_cast("int"))


def guarded_int_untrimmed(c: Column) -> Column:
    """As guarded_int, but padded text fails the shape test."""
    return F.when(c.rlike(DIGITS), c.try_cast("int"))


def decimal_comma(c: Column, decimal_type: str = "decimal(5,2)") -> Column:
    """Comma or dot decimal text as DECIMAL, half-up; NULL for any other shape."""
    return F.when(c.rlike(DECIMAL_TEXT), F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast(decimal_type))


def float_or_null(c: Column) -> Column:
    """What Python's float() would give for the stripped text, else NULL."""
    return stripped_float(strip_text(c))


def stripped_float(body: Column) -> Column:
    """As float_or_null, for text that is stripped already."""
    return F.when(body.rlike(FLOAT_TEXT), body.try_cast("double"))


def to_double(c: Column) -> Column:
    """Comma or dot number text as DOUBLE, else NULL."""
    return float_or_null(F.replace(c, F.lit(","), F.lit(".")))


def float_text(d: Column) -> Column:
    """A DOUBLE written the way Python prints it: 6.8, 12345678.0, 1e+16, nan."""
    java, size = d.cast("string"), F.abs(d)
    plain = F.rtrim(java.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    exponent = F.split_part(java, F.lit("E"), F.lit(2)).try_cast("int")
    mantissa = F.regexp_replace(F.split_part(java, F.lit("E"), F.lit(1)), r"\.0$", "")
    digits = F.abs(exponent).cast("string")
    digits = F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits)
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    return (
        F.when(F.isnan(d), F.lit("nan"))
        .when(size == float("inf"), F.when(d > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~java.contains("E"), java)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(F.concat(mantissa, sign, digits))
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _scaled(units: Column, places: int, decimal_type: str) -> Column:
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-places))).cast(decimal_type)


def half_up(numerator: Column, denominator: Column, places: int, decimal_type: str) -> Column:
    """numerator / denominator of whole numbers rounded half away from zero.

    NULL when the denominator is NULL or zero.
    """
    num, den = numerator.cast("bigint") * F.lit(2 * 10**places), F.nullif(denominator.cast("bigint"), F.lit(0))
    units = _div(F.abs(num) + den, den * F.lit(2)) * F.sign(num).cast("bigint")
    return _scaled(units, places, decimal_type)


def half_even(numerator: Column, denominator: Column, places: int, decimal_type: str) -> Column:
    """As half_up for non-negative ratios, but a tie goes to the even neighbour."""
    num, den = numerator.cast("bigint") * F.lit(10**places), F.nullif(denominator.cast("bigint"), F.lit(0))
    low = _div(num, den)
    twice = (num - low * den) * F.lit(2)
    up = F.when(twice > den, F.lit(1)).when(twice == den, low % F.lit(2)).otherwise(F.lit(0))
    return _scaled(low + up, places, decimal_type)


def hundredths(c: Column) -> Column:
    """A two-decimal number as a whole number of hundredths."""
    return (c * F.lit(Decimal(100))).cast("bigint")


def mean_2(c: Column, decimal_type: str = "decimal(5,2)") -> Column:
    """Aggregate: mean of a two-decimal column, half-up to two decimals.

    The sum runs over BIGINT hundredths, so it stays in a hash aggregate and
    holds 10**13 scores of up to 999.99 before it could overflow.
    """
    return _scaled_mean(F.sum(hundredths(c)), F.count(c), decimal_type)


def _scaled_mean(total_hundredths: Column, n: Column, decimal_type: str) -> Column:
    den = F.nullif(n, F.lit(0))
    units = _div(F.abs(total_hundredths) * 2 + den, den * F.lit(2)) * F.sign(total_hundredths).cast("bigint")
    return _scaled(units, 2, decimal_type)


def rate_2(part: Column, whole: Column) -> Column:
    """part * 100 / whole, half-up to two decimals, NULL on an empty whole."""
    return half_up(part * F.lit(100), whole, 2, "decimal(5,2)")


def weighted_points(score: Column, weight: Column) -> Column:
    """score * weight / 100, half-up to three decimals."""
    return F.round(score * weight * F.lit(Decimal("0.01")), 3).cast("decimal(6,3)")


def performance_band(average: Column) -> Column:
    out = F.lit(LOWEST_BAND)
    for floor, name in reversed(BANDS):
        out = F.when(average >= F.lit(floor), F.lit(name)).otherwise(out)
    return out


def approval_status(approved: Column) -> Column:
    return F.when(approved, F.lit(APPROVED)).otherwise(F.lit(FAILED))
