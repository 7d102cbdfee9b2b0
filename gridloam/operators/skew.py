"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloam.session import written

# A key is hot when it holds more than this share of all rows, so there can be fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 1000
# A lookup side within both bounds is broadcast whole; a larger one is joined by a salted shuffle.
SMALL_SIDE_ROWS = 200_000
SMALL_SIDE_BYTES = 64 * 1024 * 1024
# Parts over which rows without a key are spread.
NULL_PARTS = 1000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether `df` has no more than `rows` rows; reading stops just past that."""
    return df.select(F.lit(1).alias("one")).limit(rows + 1).count() <= rows


def fits_broadcast(df: DataFrame, rows: int = SMALL_SIDE_ROWS, size: int = SMALL_SIDE_BYTES) -> bool:
    """Whether `df` is measured to be small in rows and in bytes.

    The rows are counted first; only if they are few are columns of varying width (text, shapes, property
    bags) added up as well.
    """
    if not at_most(df, rows):
        return False
    width, fixed = F.lit(0).cast("bigint"), 0
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.length(f"`{f.name}`"), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            width = width + F.coalesce(F.length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0))
        else:
            fixed += 8
    if fixed == 8 * len(df.schema.fields):
        return rows * fixed <= size
    return df.agg(F.coalesce(F.sum(width + F.lit(fixed)), F.lit(0)).alias("bytes")).first()["bytes"] <= size


def _any_null(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than `share` of the rows, each with the number of parts to split it into.

    Counted exactly, with partial counts before the shuffle. By construction there are fewer than
    1 / share such keys and fewer than 2 / share parts in all, so they fit the driver and a broadcast.
    """
    counts = df.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Written, so that the total and the hot keys come from one pass over the rows.
    counts = written(counts, "key-counts")
    threshold = max((counts.agg(F.sum("_n")).first()[0] or 0) * share, 1.0)
    parts = counts.where(F.col("_n") > threshold).select(*keys, F.ceil(F.col("_n") / F.lit(threshold)).cast("int").alias("_parts"))
    return df.sparkSession.createDataFrame(parts.collect(), parts.schema)


def _row_hash(df: DataFrame, keys: list[str]) -> Column:
    """A hash over the row itself: unlike a random number, it stays the same when a lost task is run again.

    All columns that can be hashed tell rows apart, shapes included. Exact copies of a row stay together and are left
    to adaptive skew splitting.
    """
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{n}`") for n in hashable])


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    small_rows: int = SMALL_SIDE_ROWS,
    share: float = HOT_SHARE,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Join a large table to a lookup side with few rows per key, safely for hot and NULL keys.

    A lookup side measured to be small is broadcast. Otherwise both sides are shuffled on the key and a
    salt: fact rows of a hot key are dealt over several parts by a hash of the row, the lookup rows of just
    those keys are repeated once per part, and rows with a NULL key are dealt over many parts as well.
    `count_on` may name a frame with the same keys that is cheaper to count than `facts`.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(lookup, small_rows):
        return facts.join(F.broadcast(lookup), keys, how)

    hot = hot_keys(count_on if count_on is not None else facts, keys, share)
    row = _row_hash(facts, keys)
    # Rows of ordinary keys get salt 0 without being hashed.
    salt = (
        F.when(_any_null(keys), F.pmod(row, F.lit(NULL_PARTS)).cast("int"))
        .when(F.col("_parts").isNotNull(), F.pmod(row, F.col("_parts")).cast("int"))
        .otherwise(0)
    )
    salted = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_parts")
    salts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    repeated = lookup.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(salts)).drop("_parts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
