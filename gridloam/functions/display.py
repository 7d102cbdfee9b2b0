"""Labels, colours, sizes and number formats for shown features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloam.functions import vocabulary as v
from gridloam.functions.numbers import fixed_text, number_text

DASH = "—"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_label(category) -> Column:
    """Label of a category; an unknown one shows as itself."""
    return v.lookup(category, v.CATEGORY_LABEL, _col(category))


def category_short_label(category) -> Column:
    """The part of the label before its dash."""
    return F.get(F.split(category_label(category), f" {DASH} "), F.lit(0))


def status_label(status) -> Column:
    """Label of a status; NULL counts as unknown, an unlisted one shows as itself."""
    s = F.coalesce(_col(status), F.lit("unknown"))
    return v.lookup(s, v.STATUS_LABEL, s)


def category_colour(category) -> Column:
    return v.lookup(category, v.CATEGORY_COLOUR, v.OTHER_CATEGORY_COLOUR)


def status_colour(status) -> Column:
    return v.lookup(status, v.STATUS_COLOUR, v.STATUS_COLOUR["unknown"])


def precision_weight(precision) -> Column:
    return v.lookup(precision, v.PRECISION_WEIGHT, v.OTHER_PRECISION_WEIGHT)


def _shown(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), DASH).otherwise(text)


def format_mw(value) -> Column:
    x = _col(value).cast("double")
    return _shown(x, F.concat(fixed_text(x, 1), F.lit(" MW")))


def format_ratio(value) -> Column:
    x = _col(value).cast("double")
    return _shown(x, fixed_text(x, 2))


def format_power(value) -> Column:
    """Megawatts as they are below a thousand, gigawatts with one decimal from there."""
    x = _col(value).cast("double")
    giga = F.concat(fixed_text(x / 1000, 1), F.lit(" GW"))
    return _shown(x, F.when(x >= 1000, giga).otherwise(F.concat(number_text(x), F.lit(" MW"))))


def format_count(value) -> Column:
    """Thousands grouped, at most three decimals."""
    x = _col(value).cast("double")
    return _shown(x, F.call_function("format_number", F.round(x, 3), F.lit("#,##0.###")))


def format_ops(value) -> Column:
    """Mantissa with one decimal times ten to a raised exponent."""
    x = _col(value).cast("double")
    power = F.floor(F.log10(x))
    mantissa = fixed_text(x / F.pow(F.lit(10.0), power), 1)
    raised = F.translate(power.cast("string"), "0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹")
    shown = F.concat(mantissa, F.lit(" × 10"), raised)
    # Zero and negative amounts have no logarithm; they show as the arithmetic leaves them.
    return _shown(x, F.when(x == 0, "NaN × 10-Infinity").when(x < 0, "NaN × 10NaN").otherwise(shown))


def bubble_size(count, layer: str) -> Column:
    """Size step of a cluster bubble; a step starts at its lower bound."""
    c = _col(count)
    steps = sorted(v.BUBBLE_STEPS[layer], reverse=True)
    out = F.when(c >= steps[0][0], steps[0][1])
    for start, size in steps[1:-1]:
        out = out.when(c >= start, size)
    return out.otherwise(steps[-1][1])


def abbreviated_count(count) -> Column:
    """The number in a bubble: whole below a thousand, thousands with one decimal below ten thousand, then whole ones."""
    c = _col(count).cast("bigint")
    tenths = F.floor((c + 50) / 100).cast("bigint")
    decimal = F.when(tenths % 10 == 0, "").otherwise(F.concat(F.lit("."), (tenths % 10).cast("string")))
    thousands = F.floor((c + 500) / 1000).cast("bigint").cast("string")
    short = F.concat(F.floor(tenths / 10).cast("bigint").cast("string"), decimal, F.lit("k"))
    return F.when(c >= 10_000, F.concat(thousands, F.lit("k"))).when(c >= 1000, short).otherwise(c.cast("string"))
