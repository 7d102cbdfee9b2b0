"""One large FeatureCollection document read by many tasks.

The files are cut at every closing brace, wherever it stands, so each task reads its own part of a document. Whether a
piece begins inside a string, and how deep, follows from the pieces before it: every piece has the parity of its quotes
and, for both possible starts, what its brackets add to the depth. These are summed within a split and then over the
splits of a file, a row per split. Where the depth falls back to that of the features' array a feature ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloam.operators.skew import lookup_join
from gridloam.session import written
from gridloam.sources.geojson import epsg_code
from gridloam.sources.order import before_blocks, numbered

# Parts of JSON text. Possessive repeats of single characters and escapes keep the matcher from recursing.
_STRING_REST = r'[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\z)'
_KEY = r'"features"\s*+:\s*+\['
_FEATURE = "type string, geometry struct<type:string,coordinates:string>, properties string"
_FRAME = "type string, crs struct<properties:struct<name:string>>"


def _brackets(text: Column) -> Column:
    """The opening and closing brackets of text that begins outside a string."""
    bare = F.regexp_replace(text, '(?s)"' + _STRING_REST, "")
    return F.regexp_replace(bare, r"[^\[\]{]++", "")


def _outside(text: Column) -> Column:
    """What follows the string that text begins in."""
    return F.regexp_replace(text, r"(?s)\A" + _STRING_REST, "")


def _depths(brackets: Column) -> Column:
    """What the brackets add to the depth, and the lowest it falls on the way (at most 0)."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("low"))

    def step(a: Column, c: Column) -> Column:
        now = a["sum"] + F.when(c == "]", -1).otherwise(1)
        return F.struct(now.alias("sum"), F.least(a["low"], now).alias("low"))

    return F.aggregate(F.filter(F.split(brackets, ""), lambda c: c != ""), start, step)


def _measured(pieces: DataFrame) -> DataFrame:
    """Pieces with `odd` (whether they change between inside and outside a string) and, for a start outside (0) and
    inside (1) a string, `d0`, `d1`: the brackets' sum and lowest depth over the piece, over what stands before the key
    of the features (`key`, its place, 0 if none) and over what stands behind it."""
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), r'[^"]++', ""))
    key = F.coalesce(F.regexp_instr("value", F.lit(_KEY)), F.lit(0))
    head = F.when(key > 0, F.expr("substring(value, 1, key - 1)")).otherwise("")
    tail = F.when(key > 0, F.substr("value", F.col("key") + F.length(F.regexp_extract("value", _KEY, 0)))).otherwise("")

    def both(clean) -> Column:
        return F.struct(_depths(_brackets(clean(F.col("value")))).alias("all"), _depths(_brackets(clean(F.col("head")))).alias("head"), _depths(_brackets(F.col("tail"))).alias("tail"))

    split = pieces.withColumn("key", key).withColumn("head", head).withColumn("tail", tail)
    return split.withColumns({"odd": (quotes % 2).cast("int"), "d0": both(lambda c: c), "d1": both(_outside)}).drop("head", "tail")


def _running(pieces: DataFrame) -> DataFrame:
    """Measured pieces with `in0`, `in1` (whether they begin in a string) and `at0`, `at1` (the depth they begin at),
    for a split that begins outside and inside a string, from depth 0."""
    before = Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    out = pieces.withColumns({"in0": flips.cast("int"), "in1": (1 - flips).cast("int")})
    for k in "01":
        out = out.withColumn(f"add{k}", _added(F.col(f"in{k}")))
        out = out.withColumn(f"at{k}", F.coalesce(F.sum(f"add{k}").over(before), F.lit(0)))
    return out


def _added(inside: Column) -> Column:
    """What a piece and the brace that ends it add to the depth. Inside a string the brace is text."""
    return F.when(inside == 0, F.col("d0.all.sum")).otherwise(F.col("d1.all.sum")) - F.when((inside + F.col("odd")) % 2 == 0, 1).otherwise(0)


def _block_starts(pieces: DataFrame) -> DataFrame:
    """Whether each split begins in a string and at which depth: `file, block, inside, depth`."""
    per = pieces.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"), F.sum("add0").alias("add0"), F.sum("add1").alias("add1"))
    per = written(per, "splits")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    known = per.withColumn("inside", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    added = F.when(F.col("inside") == 0, F.col("add0")).otherwise(F.col("add1"))
    return known.withColumn("added", added).withColumn("depth", F.coalesce(F.sum("added").over(before), F.lit(0))).select("file", "block", "inside", "depth")


def read_split_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: `row_idx, geometry, properties, epsg, file`, of documents that any number of tasks read.

    `row_idx` counts from 0 through the features of all documents, in the order of their paths. `epsg` is the code of
    the coordinate system the document names, NULL if none. A document of another type, and an entry of the features
    that is no object, fail the run; a document without features gives no rows. All that stands in a document beside
    its features is put together in one task, as is any single feature.
    """
    pieces = written(_measured(numbered(spark.read.option("lineSep", "}").text(path), "pieces")), "measured")
    narrow = _running(pieces.drop("value"))
    starts = written(_block_starts(narrow), "starts")

    # The same sums with the text at hand, now from what is known of each split's start.
    known = lookup_join(_running(pieces), starts, ["file", "block"], "inner")
    inside = F.when(F.col("inside") == 0, F.col("in0")).otherwise(F.col("in1"))
    depth = F.col("depth") + F.when(F.col("inside") == 0, F.col("at0")).otherwise(F.col("at1"))
    known = known.withColumns({"begins_in": inside, "at": depth}).withColumn("d", F.when(F.col("begins_in") == 0, F.col("d0")).otherwise(F.col("d1")))
    after = F.col("at") + _added(F.col("begins_in"))
    # Text at depth 1 is the document's own. Behind it the features' array is open, or something else is.
    opens = (F.col("key") > 0) & (F.col("at") + F.col("d.head.sum") == 1) & (F.col("d.tail.low") >= 0)
    outer = F.least(F.col("at"), F.col("at") + F.col("d.all.low")) <= 1
    state = F.when(opens, 1).when(outer, 0)
    marked = known.select("file", "block", "place", "value", "key", "at", after.alias("after"), opens.alias("opens"), state.alias("state"), outer.alias("outer"), ((F.col("begins_in") + F.col("odd")) % 2 == 0).alias("closes"))
    marked = written(marked, "marked")
    return _assembled(spark, marked)


def _assembled(spark: SparkSession, marked: DataFrame) -> DataFrame:
    """The features and the rest of each document, put together from marked pieces."""
    ordered = Window.partitionBy("file", "block").orderBy("place")
    upto, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)

    def with_state(pieces: DataFrame) -> DataFrame:
        return pieces.withColumn("now", F.last("state", ignorenulls=True).over(upto))

    # Whether the features' array is open where a split begins: the last word on it in the splits before.
    last = with_state(marked.select("file", "block", "place", "state")).groupBy("file", "block").agg(F.max_by("now", "place").alias("state"))
    last = written(last, "states")
    splits = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("file", "block", F.coalesce(F.last("state", ignorenulls=True).over(splits), F.lit(0)).alias("carried"))

    def in_features(pieces: DataFrame) -> DataFrame:
        known = lookup_join(with_state(pieces), written(carried, "carried"), ["file", "block"], "inner")
        open_now = F.coalesce(F.col("now"), F.col("carried")) == 1
        return known.withColumn("open", open_now).withColumn("ends", (F.col("open") & F.col("closes") & (F.col("after") == 2)).cast("long"))

    counts = in_features(marked.drop("value")).groupBy("file", "block").agg(F.sum("ends").alias("n"))
    firsts = before_blocks(written(counts, "counts"), "n")
    text = in_features(marked).withColumn("seen", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    text = lookup_join(text, written(firsts, "firsts"), ["file", "block"], "inner").withColumn("row_idx", F.col("n") + F.col("seen"))
    # Of the piece in which the array opens, what stands behind the bracket belongs to the first feature.
    head_end = F.col("key") + F.length(F.regexp_extract("value", _KEY, 0))
    own = F.when(F.col("opens"), F.substr("value", head_end)).otherwise(F.col("value"))
    text = written(text.withColumn("own", F.concat(own, F.lit("}"))), "assembled")

    grouped = text.where("open").groupBy("file", "row_idx").agg(F.sort_array(F.collect_list(F.struct("block", "place", "own"))).alias("pieces"), F.max("ends").alias("ended"))
    joined = F.array_join(F.transform("pieces", lambda p: p["own"]), "")
    entries = grouped.where("ended = 1").select("file", "row_idx", joined.alias("text"))
    lead = F.regexp_extract("text", r"\A[^{]*+", 0)
    clean = F.when(F.regexp_like(lead, F.lit(r"\A\s*+,?+\s*+\z")), F.substr("text", F.length(lead) + 1)).otherwise(F.raise_error(F.concat(F.lit("features holds something that is no object: "), F.substring("text", 1, 100))).cast("string"))
    features = entries.select("file", "row_idx", F.from_json(clean, _FEATURE, {"mode": "FAILFAST"}).alias("f"))

    # What is left of a document: its text up to the features, and from the piece that closes them on.
    # What may follow a document is blank and at depth 0.
    rest = text.where("(opens OR NOT open) AND NOT (at <= 0 AND trim(value) RLIKE '^\\\\s*$')").withColumn("kept", F.when(F.col("opens"), F.substr("value", F.lit(1), head_end - 1)).otherwise(F.concat("value", F.lit("}"))))
    frames = rest.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "kept"))), lambda p: p["kept"]), "").alias("frame"))
    frame = F.from_json("frame", _FRAME)
    wrong = F.raise_error(F.concat(F.lit("expected a FeatureCollection: "), "file")).cast("int")
    frames = frames.select("file", F.when(frame["type"] == "FeatureCollection", epsg_code(frame["crs"]["properties"]["name"])).otherwise(wrong).alias("epsg"))
    return lookup_join(features, written(frames, "frames"), ["file"], "inner").select("row_idx", "f.geometry", "f.properties", "epsg", "file")
