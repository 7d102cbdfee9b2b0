"""Chat formatting from reply trees.

Messages name the message they answer. Self-joins that double their reach give every message its root, its depth and
the sum of the scores above it; leaves are ranked within their tree by that sum; the chosen paths are taken apart
again into messages with the same doubled steps, so that a path of n messages costs log2(n) joins either way. Each
path becomes one text. Everything is DataFrame functions.

The template is `### role: text</turn>` and a line end for each turn. In roles and texts a backslash stands before
each backslash, before a `#` that follows a `#` and before a `/` that follows a `<` (in roles also before a blank that
follows a colon), so the marks stand nowhere but between turns and a backslash taken off gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloam.session import written

HEAD, COLON, END = "### ", ": ", "</turn>\n"
#: The role whose texts are learned from.
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=#)#|(?<=<)/", r"\\$0")


def escaped_role(role: Column) -> Column:
    return F.regexp_replace(role, r"\\|(?<=#)#|(?<=<)/|(?<=:) ", r"\\$0")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _doubled(messages: DataFrame) -> list[DataFrame]:
    """Frames of `id, anc, top, dist, total`: in the k-th, a message reaches 2^k messages up, itself included. `top` is
    the last of them, `dist` their number, `total` the sum of their scores, `anc` the message after them, NULL past the
    root. In the last frame only messages on or below a cycle of answers still have one."""
    known = messages.select(F.col("id").alias("_known"))
    answers = F.col("parent").isNotNull() & (F.col("parent") != F.col("id"))
    # Messages that answer nothing stay out of the joins, so that no NULL is a hot key.
    own = messages.where(answers).join(known, F.col("parent") == F.col("_known"), "left")
    own = own.unionByName(messages.where(~answers).withColumn("_known", F.lit(None).cast(messages.schema["id"].dataType)))
    first = own.select("id", F.col("_known").alias("anc"), F.col("id").alias("top"), F.lit(1).cast("long").alias("dist"), F.col("score").alias("total"))
    frames, before = [written(first, "replies")], -1
    while True:
        now = frames[-1]
        open_rows = now.where("anc IS NOT NULL").count()
        if open_rows in (0, before):
            return frames
        before = open_rows
        up = now.select(F.col("id").alias("_id"), F.col("anc").alias("_anc"), F.col("top").alias("_top"), F.col("dist").alias("_dist"), F.col("total").alias("_total"))
        moved = now.where("anc IS NOT NULL").join(up, F.col("anc") == F.col("_id"))
        moved = moved.select("id", F.col("_anc").alias("anc"), F.col("_top").alias("top"), (F.col("dist") + F.col("_dist")).alias("dist"), (F.col("total") + F.col("_total")).alias("total"))
        frames.append(written(now.where("anc IS NULL").unionByName(moved), "replies"))


def reply_paths(messages: DataFrame, id: str = "id", parent: str = "parent", score: str | None = "score", branches: int = 1) -> DataFrame:
    """The chosen root-to-leaf paths of all reply trees: `root, leaf, rank, total, position, id`, one row per message.

    Of each tree the `branches` leaves with the greatest sum of scores over their path are chosen (ties: the smaller
    leaf), `rank` from 1; `position` counts from 0 at the root. A missing score counts 0. A message without a parent,
    answering itself or one that is not there is a root. Of rows with the same id the one with the smallest parent and
    then score stands. Rows without an id, and messages on or below a cycle of answers, are on no path.
    """
    value = F.coalesce(F.col(f"`{score}`").cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = messages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{parent}`").alias("parent"), value.alias("score")).where("id IS NOT NULL")
    one = rows.groupBy("id").agg(F.min(F.struct("parent", "score")).alias("m")).select("id", "m.parent", "m.score")
    jumps = _doubled(one)
    whole = jumps[-1].where("anc IS NULL")
    answered = jumps[0].select(F.col("anc").alias("id")).where("id IS NOT NULL").distinct()
    best = Window.partitionBy("top").orderBy(F.desc("total"), "id")
    leaves = whole.join(answered, "id", "left_anti").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    parts = leaves.select(F.col("top").alias("root"), F.col("id").alias("leaf"), "rank", "total", F.col("dist").alias("count"), F.col("dist").alias("end"), "id")
    # A part is `count` messages upward from `id`, which is the `end`-th of its path. Long ones are cut in two.
    for k in reversed(range(len(jumps) - 1)):
        reach = F.lit(1 << k).cast("long")
        parts = written(parts, "paths")
        step = jumps[k].select("id", "anc").where("anc IS NOT NULL")
        halves = F.array(F.struct(reach.alias("count"), F.col("end"), F.col("id")), F.struct((F.col("count") - reach).alias("count"), (F.col("end") - reach).alias("end"), F.col("anc").alias("id")))
        cut = parts.where(F.col("count") > reach).join(step, "id").select("root", "leaf", "rank", "total", F.inline(halves))
        parts = parts.where(F.col("count") <= reach).unionByName(cut)
    return parts.select("root", "leaf", "rank", "total", (F.col("end") - 1).alias("position"), "id")


def formatted_paths(paths: DataFrame, messages: DataFrame, id: str = "id", role: str = "role", text: str = "text") -> DataFrame:
    """One row per path: `root, leaf, rank, n_turns, formatted, loss_spans`.

    `loss_spans` says where the texts of the assistant stand in `formatted`: `start` (code points, from 0), `length`.
    A NULL role or text is empty. `messages` has one row per id. A path is one text in one cell, which Spark holds up
    to 2 GB; its rows are put together by one task, the running sum of lengths spilling to disk where it must.
    """
    said = messages.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("_role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    head = F.concat(F.lit(HEAD), escaped_role(F.col("_role")), F.lit(COLON))
    turns = paths.join(said, "id").select("root", "leaf", "rank", "position", (F.col("_role") == LEARNED).alias("learned"), head.alias("head"), escaped(F.col("_text")).alias("body"))
    turn = F.concat("head", "body", F.lit(END))
    before = Window.partitionBy("root", "leaf", "rank").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("turn", turn).withColumn("start", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("learned"), F.struct(F.col("start").cast("long").alias("start"), F.length("body").cast("long").alias("length")))
    whole = placed.groupBy("root", "leaf", "rank").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "turn"))), lambda x: x["turn"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
    )
    return whole.select("root", "leaf", "rank", "n_turns", "formatted", "loss_spans")


def turns_of(formatted: Column) -> Column:
    """The turns read back from a formatted conversation, as an array of `role, text`."""

    def one(turn: Column) -> Column:
        body = F.substr(turn, F.lit(len(HEAD) + 1))
        role = F.substring_index(body, COLON, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substr(body, F.length(role) + len(COLON) + 1)).alias("text"))

    return F.transform(F.filter(F.split(formatted, END), lambda turn: F.length(turn) > 0), one)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, end to end."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """`rows` with a long `place` that grows in the given order, written once. Ranges of the order go to tasks of about
    the same size, so no group of rows has to meet in one task."""
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "ordered")


def replies_of_turns(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as reply trees: `conv_id, id, parent, role, text`, each turn the answer to the one before it.

    Rows go by turn, missing turns first, then by role and text; equal rows are one turn each. Rows without a
    conversation are one conversation together.
    """
    rows = conversations.select(F.col(f"`{conversation}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    placed = in_order(rows, *(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text"))).withColumn("part", F.shiftright("place", 33))
    # The row before: within a task's rows by a window over them, between tasks from each task's last row.
    here = Window.partitionBy("part").orderBy("place")
    # Spark's own limit keeps a window over partitions, one row each, small.
    ends = placed.groupBy("part").agg(F.max(F.struct("place", "conv_id")).alias("last"))
    over = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("carried"))
    near = placed.withColumn("near", F.lag(F.struct("place", "conv_id")).over(here)).join(F.broadcast(over), "part", "left")
    before = F.coalesce("near", "carried")
    parent = F.when(before["conv_id"].eqNullSafe(F.col("conv_id")), before["place"])
    return near.select("conv_id", F.col("place").alias("id"), parent.alias("parent"), "role", "text")
