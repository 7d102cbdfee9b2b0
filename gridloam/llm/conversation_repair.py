"""Conversation structure repair by lightest derivations.

A conversation is repaired by edits, one letter each in its audit: K(eep), R(erole to user or assistant), D(elete),
and I(nsert an empty user or assistant turn). The roles that stay must read `(system? (user assistant)+)?`.

An item (i, q) says that rows i to the end can be made right when what stands before them leaves the grammar in state
q; its weight is the pair (cost, audit). A deduction puts one edit before an item. Knuth's agenda pops items by cost,
then by how few rows they cover, then by audit: every deduction adds cost or covers one row more, and a letter put
before two audits keeps their order, so the functions are monotone and superior and an item popped first is final.

Rows are cut into blocks of 2^`BLOCK_BITS`, so no conversation has to meet in one task. Of a block the agenda finds the
lightest derivation between each pair of states; over blocks a second agenda has deductions with two antecedents, a
block and the item behind it. A state and an edit's letter name the next state, and every audit of a block ends with
the letter of its last row, so of two audits of a block none begins the other: comparing blocks one by one compares
whole audits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridloam.llm.chat_trees import in_order
from gridloam.session import written

# Rows of a conversation worked on at once, as a power of two.
BLOCK_BITS = 8
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: From a state, by a role's initial, to a state. Anything else is against the grammar.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that may be put in a state, by rerole or insert.
PUT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
RIGHT_PAIRS = {"su", "ua", "au"}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
#: What the end of a conversation costs in each state: it may end empty or after an assistant.
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: Codes of a row: the initial of its role (anything but s, u, a is o) in lower case, in upper case if truncated, or a
#: digit if it must go.
MUST_GO = {"s": "1", "u": "2", "a": "3", "o": "4"}
INITIAL = {c: i for i in "suao" for c in (i, i.upper(), MUST_GO[i])}
SPACES = r"\x20\x09-\x0D"

ENTRY = T.StructType([T.StructField("cost", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("audit", T.StringType())])
BLOCK_TYPE = T.StructType([T.StructField("illegal", T.LongType()), T.StructField("entries", T.ArrayType(ENTRY))])
LINK = T.StructType([T.StructField("block", T.LongType()), T.StructField("way", T.IntegerType())])
CHAIN_TYPE = T.StructType([T.StructField("cost", T.LongType()), T.StructField("illegal", T.LongType()), T.StructField("tail", T.StringType()), T.StructField("links", T.ArrayType(LINK))])

ARROW_BLOCK, ARROW_CHAIN = to_arrow_type(BLOCK_TYPE), to_arrow_type(CHAIN_TYPE)


def _edits(code: str, after: int) -> Iterator[tuple[int, str, int]]:
    """The edits of a row that leave the grammar in state `after`: (state before, letter, cost)."""
    yield after, "D", DELETE_COST
    if code.isdigit():
        return
    extra = TRUNCATED_COST if code.isupper() else 0
    for before in STATES:
        if NEXT.get((before, code.lower())) == after:
            yield before, "K", KEEP_COST + extra
        if NEXT[before, PUT[before][0]] == after:
            yield before, "R", REROLE_COST + extra


def lightest(codes: str, after: int) -> dict[int, tuple[int, str]]:
    """The least (cost, audit) of a block's rows for each state before it, given the state after it. Inserts stand
    before a row, so none ends the audit."""
    n = len(codes)
    agenda: list[tuple[int, int, str, int]] = [(0, 0, "", after)]
    done: set[tuple[int, int]] = set()
    goals: dict[int, tuple[int, str]] = {}
    while agenda and len(goals) < len(STATES):
        cost, covered, audit, state = heappop(agenda)
        if (covered, state) in done:
            continue
        done.add((covered, state))
        if covered == n:
            goals[state] = (cost, audit)
        if covered:
            for before in STATES:
                if NEXT[before, PUT[before][0]] == state:
                    heappush(agenda, (cost + INSERT_COST, covered, "I" + audit, before))
        if covered < n:
            for before, letter, more in _edits(codes[n - 1 - covered], state):
                heappush(agenda, (cost + more, covered + 1, letter + audit, before))
    return goals


@lru_cache(maxsize=4096)
def _block(codes: str) -> dict:
    """Pairs of roles against the grammar inside a block, and the lightest audit from each state to each."""
    illegal = sum(INITIAL[a] + INITIAL[b] not in RIGHT_PAIRS for a, b in zip(codes, codes[1:]))
    found = [lightest(codes, after) for after in STATES]
    entries = []
    for before in STATES:
        audits = sorted(found[after][before][1] for after in STATES if before in found[after])
        for after in STATES:
            cost, audit = found[after].get(before, (None, None))
            entries.append({"cost": cost, "rank": None if audit is None else audits.index(audit), "audit": audit})
    return {"illegal": illegal, "entries": entries}


@F.arrow_udf(BLOCK_TYPE)
def solved_block(codes: pa.Array) -> pa.Array:
    return pa.array([_block(c) for c in codes.to_pylist()], ARROW_BLOCK)


def chained(blocks: list[dict]) -> dict:
    """The lightest derivation over a conversation's blocks (`block`, `first`, `last`, `illegal`, `ways`) in their
    order. `ways` holds cost and rank from each state to each. An item (k, q) is made from the way of block k from q
    to some state and the item (k + 1, that state)."""
    n = len(blocks)
    illegal = sum(b["illegal"] for b in blocks) + sum(a["last"] + b["first"] not in RIGHT_PAIRS for a, b in zip(blocks, blocks[1:]))
    agenda = [(INSERT_COST * len(TAIL[q]), 0, 0, q, q) for q in STATES]
    agenda.sort()
    best: dict[tuple[int, int], tuple[int, int]] = {}
    while (n, START) not in best:
        cost, covered, _, state, after = heappop(agenda)
        if (covered, state) in best:
            continue
        best[covered, state] = (cost, after)
        if covered < n:
            ways = blocks[n - 1 - covered]["ways"]
            for before in STATES:
                way = ways[before * 4 + state]
                if way["cost"] is not None:
                    heappush(agenda, (cost + way["cost"], covered + 1, way["rank"], before, state))
    links, state = [], START
    for k, b in enumerate(blocks):
        after = best[n - k, state][1]
        links.append({"block": b["block"], "way": state * 4 + after})
        state = after
    return {"cost": best[n, START][0], "illegal": illegal, "tail": TAIL[state], "links": links}


@F.arrow_udf(CHAIN_TYPE)
def solved_chain(conversations: pa.Array) -> pa.Array:
    return pa.array([chained(c) for c in conversations.to_pylist()], ARROW_CHAIN)


def with_faults(rows: DataFrame) -> DataFrame:
    """Placed rows (`conv_id, place, role, text`) with `fault`, the first of blank, duplicate and truncated that holds,
    NULL if none, and `code`."""
    # One row per (conversation, role, text), counted before the shuffle; rows held many times are split by adaptive
    # execution, and only texts said twice are looked up.
    first = rows.groupBy("conv_id", "role", "text").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = first.select(*(F.col(c).alias(f"_{c}") for c in ("conv_id", "role", "text")), "first")
    known = rows["conv_id"].eqNullSafe(F.col("_conv_id")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    seen = rows.join(first, known, "left")
    last = F.regexp_extract("text", rf"([^{SPACES}])[{SPACES}]*\z", 1)
    fault = F.when(last == "", "blank").when(F.col("place") > F.col("first"), "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    gone = F.translate(initial, "suao", "".join(MUST_GO[i] for i in "suao"))
    code = F.when(F.col("fault").isin("blank", "duplicate"), gone).when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    return seen.select("conv_id", "place", "role", "text", "turn", fault.alias("fault")).withColumn("code", code)


def _turns_after(role: str, text: str, letters: str, state: int) -> tuple[list[tuple[str, str]], int]:
    """What one row becomes by its letters (inserts, then its own edit) as (role, text), and the state after it."""
    out = []
    for letter in letters:
        if letter == "D":
            continue
        said = role if letter == "K" else PUT[state]
        state = NEXT[state, said[0]]
        out.append((said, "" if letter == "I" else text))
    return out, state


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DataType, list[tuple[object, list[tuple[str, str]]]]]]:
    """Per batch of rows sorted by conversation and place: the type of its ids, and in their order (conversation,
    repaired turns) as rows pass by. A conversation's last entry is followed by (conversation, None)."""
    now, state, begun, kind = None, START, False, None

    def ended() -> list:
        turns, _ = _turns_after("", "", TAIL[state], state)
        return [(now, turns), (now, None)]

    for batch in batches:
        kind, out = batch.schema.field("conv_id").type, []
        for conv, role, text, letters in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "letters"))):
            if not begun or conv != now:
                out += ended() if begun else []
                now, state, begun = conv, START, True
            turns, state = _turns_after(role, text, letters, state)
            out.append((conv, turns))
        yield kind, out
    if begun:
        yield kind, ended()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each conversation's repaired turns, hashed as they pass by, however many there are."""
    digest, n = hashlib.sha256(), 0
    for kind, passed in _walked(batches):
        ids, digests = [], []
        for conv, turns in passed:
            if turns is None:
                ids.append(conv)
                digests.append(digest.hexdigest())
                digest, n = hashlib.sha256(), 0
                continue
            for role, text in turns:
                digest.update(f"{chr(10) * (n > 0)}{role}:{text}".encode())
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns, a row each."""
    n = 0
    for kind, passed in _walked(batches):
        rows = []
        for conv, turns in passed:
            for role, text in turns or ():
                rows.append((conv, n, role, text))
                n += 1
            n = 0 if turns is None else n
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.string()))], ["conv_id", "turn", "role", "text"])


class Repairs:
    """What was found and mended. `reports` has a row per conversation that has rows; `turns()` gives the repaired
    conversations."""

    def __init__(self, reports: DataFrame, edits: DataFrame):
        self.reports, self._edits = reports, edits

    def turns(self) -> DataFrame:
        """`conv_id, turn` (from 0), `role, text` of the repaired conversations; one that is empty has no rows."""
        kind = self._edits.schema["conv_id"].dataType
        schema = T.StructType([T.StructField("conv_id", kind), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
        return _by_conversation(self._edits).mapInArrow(_texts, schema)


def _by_conversation(edits: DataFrame) -> DataFrame:
    return edits.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text", "letters")


def repaired(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repairs:
    """Faults and cheapest repairs of all conversations; see the module.

    Rows go by turn, missing turns first, then by role and text; a NULL role or text is one space, rows without a
    conversation are one conversation together, and a row whose role does not begin with s, u or a cannot stay under it.
    Reports: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`. `gaps` is NULL where
    the turns span more than a long holds. Any number of rows per conversation is worked on in blocks; one digest is one
    task's work, which holds a batch of rows at a time, and an audit has a letter per row.
    """
    named = [F.col(f"`{conversation}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), *(F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text")))]
    placed = in_order(conversations.select(*named), *(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")))
    rows = written(with_faults(placed), "faults")

    block = F.shiftright("place", BLOCK_BITS)
    blocks = rows.groupBy("conv_id", block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", "code"))).alias("rows"))
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    solved = blocks.select("conv_id", F.transform("rows", lambda r: r["place"]).alias("places"), codes.alias("codes")).withColumn("solved", solved_block("codes"))
    solved = written(solved.withColumn("block", F.col("places")[0]), "blocks")

    same = F.translate(F.col("codes"), "".join(INITIAL), "".join(INITIAL.values()))
    ways = F.transform("solved.entries", lambda e: F.struct(e["cost"].alias("cost"), e["rank"].alias("rank")))
    summary = F.struct("block", F.substring(same, 1, 1).alias("first"), F.substring(same, -1, 1).alias("last"), F.col("solved.illegal").alias("illegal"), ways.alias("ways"))
    chains = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(summary)).alias("blocks")).withColumn("chain", solved_chain("blocks"))
    chains = written(chains.select("conv_id", "chain"), "chains")

    links = chains.select(F.inline("chain.links"))
    audits = links.join(solved, "block").select("conv_id", "block", "places", F.expr("solved.entries[way].audit").alias("audit"))
    audits = written(audits, "audits")
    letters = F.regexp_extract_all("audit", F.lit("I*[KRD]"), F.lit(0))
    tokens = audits.select(F.inline(F.arrays_zip(F.col("places").alias("place"), letters.alias("letters"))))
    edits = rows.select("conv_id", "place", "role", "text").join(tokens, "place")
    kind = rows.schema["conv_id"].dataType
    digests = _by_conversation(edits).mapInArrow(_digests, T.StructType([T.StructField("conv_id", kind), T.StructField("repaired_sha256", T.StringType())]))

    span = (F.max("turn").cast("decimal(38,0)") - F.min("turn").cast("decimal(38,0)") + 1 - F.count_distinct("turn")).try_cast("long")
    counts = rows.groupBy("conv_id").agg(F.when(F.max("turn").isNull(), F.lit(0)).otherwise(span).alias("gaps"), *(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    whole = audits.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda b: b["audit"]), "").alias("audit"))
    parts = [counts, chains.select("conv_id", "chain.illegal", "chain.cost", "chain.tail"), whole, digests]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    wanted = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "tail", "repaired_sha256"]
    reports = union.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in wanted))
    return Repairs(reports.withColumn("audit", F.concat("audit", "tail")).drop("tail"), edits)


def damaged(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32 of `conversation:turn` (NULLs as one space) modulo 20: 0 drops the row, 1 empties its text,
    2 takes `.`, `!` and `?` out of it, 3 repeats the row, 4 makes it a user's. Columns `conv_id, turn, role, text`."""
    c, t, r, x = (F.col(f"`{n}`") for n in (conversation, turn, role, text))
    blank = F.lit(" ")
    key = F.concat(F.coalesce(c.cast("string"), blank), F.lit(":"), F.coalesce(t.cast("string"), blank))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = conversations.select(c.alias("conv_id"), t.alias("turn"), F.coalesce(r, blank).alias("role"), F.coalesce(x, blank).alias("text"), kind.alias("_kind")).where("_kind <> 0")
    words = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    said = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", said.alias("role"), words.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")
