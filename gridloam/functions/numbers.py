"""Number parsing, exact rounding and number text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number or an infinity between optional white space, digits optionally grouped by single
# underscores. Rejects suffixes such as "1d" and hex.
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    r"(?U)^[\s\x1c-\x1f]*"
    rf"([+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity)))"
    r"[\s\x1c-\x1f]*$"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(col) -> Column:
    """Text to a double; NULL for NULL, for anything that is not a number, and for NaN."""
    number = F.regexp_extract(_col(col).cast("string"), _NUMBER, 1)
    return F.regexp_replace(number, "_", "").try_cast("double")


def nan_to_null(col) -> Column:
    c = _col(col)
    return F.when(~F.isnan(c), c)


def strict_double(col, name: str) -> Column:
    """A required number: NULL or unparseable fails the run."""
    return _required(to_double(col), name, "double")


def strict_int(col, name: str) -> Column:
    """A required whole number, truncated toward zero: NULL or unparseable fails the run."""
    return _required(to_double(col).cast("int"), name, "int")


def _required(value: Column, name: str, dtype: str) -> Column:
    return F.coalesce(value, F.raise_error(F.lit(f"required field missing or invalid: {name}")).cast(dtype))


# From here on every double is a whole number.
_WHOLE = 2.0**53


def _scaled(x: Column, digits: int, ties: str) -> tuple[Column, Column]:
    """|x| rounded to `digits` decimals by its exact binary value: its whole part, and its decimals as a number
    from 0 to 10**digits. |x| below 2**53.

    Cutting off the whole part is exact. The product of the rest is split without rounding error into its double
    and the remainder, so a value that merely prints like a tie goes to the side it lies on.
    """
    scale = 10.0**digits
    split = 134217729.0  # 2**27 + 1
    whole = F.floor(F.abs(x))
    a = F.abs(x) - whole.cast("double")
    p = a * F.lit(scale)
    ah = a * F.lit(split) - (a * F.lit(split) - a)
    al = a - ah
    bh = scale * split - (scale * split - scale)
    bl = scale - bh
    rest = ((ah * F.lit(bh) - p) + ah * F.lit(bl) + al * F.lit(bh)) + al * F.lit(bl)
    low = F.floor(p)
    half = p - low.cast("double")
    last = low if digits else whole
    at_tie = (F.pmod(last, F.lit(2)) == 1) if ties == "even" else F.lit(True)
    up = (half > 0.5) | ((half == 0.5) & ((rest > 0) | ((rest == 0) & at_tie)))
    return whole, low + up.cast("bigint")


def round_exact(col, digits: int, ties: str = "even") -> Column:
    """Round to `digits` decimals by the exact binary value; real ties go to even (or away with ties="away")."""
    x = _col(col)
    whole, decimals = _scaled(x, digits, ties)
    total = whole.cast("decimal(38,0)") * F.lit(10**digits).cast("decimal(20,0)") + decimals.cast("decimal(38,0)")
    # Small totals divide exactly rounded as doubles; large ones are read as the decimal number they are.
    near = total.cast("double") / F.lit(10.0**digits)
    far = F.concat(total.cast("string"), F.lit(f"E-{digits}")).cast("double")
    rounded = F.when(total < F.lit(2**53).cast("decimal(38,0)"), near).otherwise(far)
    negative = F.substring(x.cast("string"), 1, 1) == "-"
    return F.when(F.abs(x) < _WHOLE, F.when(negative, -rounded).otherwise(rounded)).otherwise(x)


def fixed_text(col, digits: int) -> Column:
    """Exactly `digits` decimals as text; real ties go away from zero."""
    x = _col(col)
    whole, decimals = _scaled(x, digits, "away")
    unit = F.lit(10**digits).cast("bigint")
    carried = (whole + F.floor(decimals / unit)).cast("string")
    fraction = F.lpad(F.pmod(decimals, unit).cast("string"), digits, "0")
    sign = F.when(x < 0, "-").otherwise("")
    text = F.concat(sign, carried, F.lit("."), fraction) if digits else F.concat(sign, carried)
    zeros = F.lit("." + "0" * digits if digits else "")
    exact = F.when(F.abs(x) < 2.0**63, x.cast("bigint").cast("string")).otherwise(x.cast("decimal(38,0)").cast("string"))
    return F.when(F.isnan(x), "NaN").when(F.abs(x) < _WHOLE, text).otherwise(F.concat(exact, zeros))


def _exponent_text(x: Column, width: int) -> Column:
    """Scientific notation of a double with the exponent padded to `width` digits: 1e+16, 1.5e-07."""
    java = x.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(java, r"^(-?[\d.]+)E", 1), r"\.0$", "")
    sign = F.when(java.contains("E-"), "-").otherwise("+")
    power = F.regexp_extract(java, r"E-?(\d+)$", 1)
    power = F.when(F.length(power) < width, F.lpad(power, width, "0")).otherwise(power)
    return F.concat(mantissa, F.lit("e"), sign, power)


def _plain_text(x: Column) -> Column:
    """Positional notation with at least one decimal."""
    java = x.cast("string")
    wide = F.regexp_replace(java.try_cast("decimal(38,18)").cast("string"), r"(?<=\d)0+$", "")
    wide = F.when(wide.endswith("."), F.concat(wide, F.lit("0"))).otherwise(wide)
    return F.when(java.contains("E"), wide).otherwise(java)


def float_text(col) -> Column:
    """A double as Python prints it: 10000000.0, 1e+16, 1e-05, inf."""
    x = _col(col)
    size = F.abs(x)
    return (
        F.when(F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), _exponent_text(x, 2))
        .otherwise(_plain_text(x))
    )


def number_text(col) -> Column:
    """A double as a browser prints it: 500, 12.5, 0.0001, 1e-7."""
    x = _col(col)
    size = F.abs(x)
    return (
        F.when(F.isnan(x), "NaN")
        .when(size == float("inf"), F.when(x > 0, "Infinity").otherwise("-Infinity"))
        .when(x == 0, "0")
        .when((size >= 1e21) | (size < 1e-6), _exponent_text(x, 1))
        .otherwise(F.regexp_replace(_plain_text(x), r"\.0$", ""))
    )
