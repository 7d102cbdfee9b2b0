"""Text cleaning, derived ids, raw property bags and run stamps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloam.functions.numbers import float_text, nan_to_null, round_exact
from gridloam.functions.vocabulary import STATUS_SPELLINGS, lookup

# All Unicode white space, not only blanks, as well as the four separator control characters.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(col) -> Column:
    return F.regexp_replace(_col(col).cast("string"), _OUTER_SPACE, "")


def clean_text(col) -> Column:
    """Stripped text; NULL when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def falsy_to_null(col) -> Column:
    """NULL for the empty string only; white space stays."""
    return F.nullif(_col(col).cast("string"), F.lit(""))


def normalize_status(col) -> Column:
    """Canonical status of a source spelling; empty and unrecognised ones are `unknown`."""
    return lookup(F.lower(strip(col)), STATUS_SPELLINGS, "unknown")


def is_unrecognised_status(col) -> Column:
    """Whether a non-empty status has no canonical form, to be counted beside a load."""
    c = _col(col)
    given = c.isNotNull() & (c != "")
    return given & lookup(F.lower(strip(c)), STATUS_SPELLINGS).isNull()


def _short_hash(*parts: Column) -> Column:
    # concat_ws skips NULLs and would shift the parts, so each becomes an empty string first.
    joined = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, 16)


def entity_id(name, owner, country) -> Column:
    """Stable id of a facility: 16 hex digits over its stripped name, owner and country."""
    return _short_hash(strip(name), strip(owner), strip(country))


def entity_id_indexed(name, owner, country, h100_text, power_text, row_idx) -> Column:
    """As `entity_id`, with the text of two measures rounded to 4 places and the position in the file.

    The measure texts come from `with_measure_text`.
    """
    return _short_hash(strip(name), strip(owner), strip(country), _col(h100_text), _col(power_text), _col(row_idx).cast("string"))


def with_measure_text(df, measures: dict[str, str]):
    """Add text columns of measures rounded to 4 places, given as {new column: measure column}.

    Rounding and formatting name their input many times, so each is a step of its own over a plain column.
    """
    rounded = {f"_{new}": round_exact(source, 4) for new, source in measures.items()}
    texts = {new: float_text(f"_{new}") for new in measures}
    return df.withColumns(rounded).withColumns(texts).drop(*rounded)


def osm_id(osm_type, number, full_id) -> Column:
    """`type/id`, else the full id, else NULL for the reject output."""
    kind, num = falsy_to_null(osm_type), falsy_to_null(number)
    both = kind.isNotNull() & num.isNotNull()
    return F.when(both, F.concat(kind, F.lit("/"), num)).otherwise(falsy_to_null(full_id))


def natural_id(*keys, distinguish: tuple = ()) -> Column:
    """Row id hashed from its natural key, so that reruns give the same id.

    Rows with a NULL in the key are never equal to each other; `distinguish` (run id, row index) keeps
    their ids apart.
    """
    cols = [_col(k).cast("string") for k in keys]
    extra = [_col(d).cast("string") for d in distinguish]
    absent = F.lit(False)
    for c in cols:
        absent = absent | c.isNull()
    key_text = F.to_json(F.array(*cols))
    if not extra:
        return F.sha2(key_text, 256)
    return F.sha2(F.when(absent, F.to_json(F.array(*cols, *extra))).otherwise(key_text), 256)


def raw_attributes(df, columns: list[str]) -> Column:
    """The property columns as one VARIANT: NaN becomes null, dates and timestamps ISO text."""
    fields = []
    for name in columns:
        c, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        elif isinstance(dtype, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            c = F.when(F.date_format(c, "SSSSSS") == "000000", whole).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        fields.append(c.alias(name))
    return F.to_variant_object(F.struct(*fields))


# A JSON string, or a number JSON has no word for standing where a value stands.
_STRING_OR_BARE = r'("(?:[^"\\]|\\.)*+")|(?<![\w.])(?:NaN|[+-]?Infinity|[+-]?INF)(?![\w.])'


def raw_attributes_json(col) -> Column:
    """A property bag that arrives as JSON text, kept as a VARIANT.

    Bare NaN and infinities, which are not JSON, become null; strings and text that parses as it stands are never
    touched. A bag that is no JSON even so fails the run; `is_broken_bag` tells such rows beforehand.
    """
    c = _col(col)
    return F.parse_json(F.when(F.try_parse_json(c).isNotNull(), c).otherwise(_mended(c)))


def _mended(c: Column) -> Column:
    marked = F.regexp_replace(c, _STRING_OR_BARE, "$1\u0000")
    return F.regexp_replace(F.regexp_replace(marked, "\"\u0000", "\""), "\u0000", "null")


def is_broken_bag(col) -> Column:
    """Whether a property bag is given but cannot be read as JSON, bare NaN and infinities apart."""
    c = _col(col)
    return c.isNotNull() & F.try_parse_json(c).isNull() & F.try_parse_json(_mended(c)).isNull()


def version_date(text: str) -> Column:
    """A source version given as an ISO date; anything else is refused before the run starts."""
    return F.lit(date.fromisoformat(text))
