"""Chat formatting from reply trees, conversation repair, periodic runs."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloam.llm import conversation_repair as repair
from gridloam.llm import periodic_runs, queries
from gridloam.llm.chat_trees import formatted_paths, learned_text, replies_of_turns, reply_paths, turns_of

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- reply trees


def plain_paths(rows, branches):
    """{(root, rank): (leaf, ids)} of rows (id, parent, score)."""
    parent = {i: p for i, p, _ in rows}
    score = {i: s or 0.0 for i, _, s in rows}
    above = {i: p for i, p in parent.items() if p in parent and p != i}
    trees = {}
    for leaf in set(parent) - set(above.values()):
        path = [leaf]
        while path[-1] in above and len(path) <= len(rows):
            path.append(above[path[-1]])
        if path[-1] not in above:
            trees.setdefault(path[-1], []).append((-sum(score[i] for i in path), leaf, path[::-1]))
    return {(root, k + 1): (leaf, path) for root, found in trees.items() for k, (_, leaf, path) in enumerate(sorted(found)[:branches])}


@pytest.mark.parametrize("branches", [1, 3])
def test_best_branches_of_random_trees(spark, branches):
    rng = random.Random(branches)
    rows = [(i, rng.choice([None, i, 5000 + i, *[rng.randrange(i)] * 12]) if i else None, rng.choice([None, *map(float, range(9))])) for i in range(300)]
    rows += [(400 + i, 400 + i - 1 if i else None, 1.0) for i in range(70)] + [(500, 501, 1.0), (501, 500, 1.0), (502, 501, 1.0)]
    df = spark.createDataFrame(rows, "id long, parent long, score double")
    got = {}
    for r in reply_paths(df, branches=branches).orderBy("root", "rank", "position").collect():
        assert r["position"] == len(got.setdefault((r["root"], r["rank"]), (r["leaf"], []))[1])
        got[r["root"], r["rank"]][1].append(r["id"])
    assert got == plain_paths(rows, branches)


def test_a_message_with_very_many_replies(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") > 0, 0).cast("long").alias("parent"), (F.col("id") % 97).cast("double").alias("score"))
    got = reply_paths(df, branches=2).orderBy("rank", "position").collect()
    assert [(r["rank"], r["id"]) for r in got] == [(1, 0), (1, 96), (2, 0), (2, 193)]


CHATS = [
    (1, 0, "system", "a"), (1, 1, "user", ""), (1, 2, "assistant", None), (1, 3, "assistant", "x\n### user: y</turn>\n"),
    (2, None, "a: b", "####\\#</</turn>"), (2, None, None, "\\\\n"), (2, 5, "assistant", "b" * 100_000), (2, 5, "assistant", "b" * 100_000),
    (None, 1, "user", "é日😀"), (None, 2, "assistant", "### Assistant: "), (3, 9, "x:", ": : "), (3, 10, "assistant</turn>", "<"),
]


def test_formatted_chats_read_back(spark):
    names = ["id", "parent", "root", "leaf", "rank", "position", "place", "part", "near", "carried", "turn_", "_role", "_text", "formatted"]
    chats = spark.createDataFrame([(*r, *range(14)) for r in CHATS], "conv_id long, turn long, role string, text string, " + ", ".join(f"`{n}` int" for n in names))
    replies = replies_of_turns(chats)
    paths = formatted_paths(reply_paths(replies, score=None), replies)
    roots = replies.where("parent IS NULL").select("conv_id", F.col("id").alias("root"))
    rows = roots.join(paths, "root").select("conv_id", "n_turns", "formatted", "loss_spans", turns_of(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    assert sorted(str(r["conv_id"]) for r in rows) == ["1", "2", "3", "None"]
    for r in rows:
        own = sorted((x for x in CHATS if x[0] == r["conv_id"]), key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", x[3] is not None, x[3] or ""))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert r["learned"] == "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r["n_turns"] == r["formatted"].count("</turn>\n") == len(own)
        assert len(r["loss_spans"]) == sum(x[2] == "assistant" for x in own)
    empty = replies_of_turns(chats.limit(0))
    assert formatted_paths(reply_paths(empty, score=None), empty).count() == 0


def test_chat_query(spark):
    got = {r["conv_id"]: r for r in queries.QUERIES["op11_chat_formatting"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    mark = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", mark), (-7, 1, "assistant", mark)]
    assert set(got) == {r[0] for r in rows}
    for c, r in got.items():
        own = sorted(x for x in rows if x[0] == c)
        learned = "".join(x[3] for x in own if x[2] == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha("".join(f"{x[2]}\n{x[3]}\n" for x in own)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha(learned))


def test_chat_plan_has_no_python(spark):
    plan = queries.QUERIES["op11_chat_formatting"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# ---------------------------------------------------------------- conversation repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def plain_faults(rows):
    out, seen = [], set()
    for role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, audit, repaired) by trying all edits, with up to two inserts in a gap."""
    faults = plain_faults(rows)
    inserts = [[("I", 5, f"{r}:", r[0]) for r in p] for n in range(3) for p in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 3:
            continue
        choices = []
        for (role, text), fault in zip(rows, faults):
            own = [("D", 2, None, "")]
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                own += [("K", more, f"{role}:{text}", role[:1] or "?")] + [("R", 1 + more, f"{r}:{text}", r[0]) for r in ("user", "assistant")]
            choices.append(own)
        for edits in itertools.product(*choices):
            steps = [*gaps[0]]
            for e, g in zip(edits, gaps[1:]):
                steps += [e, *g]
            if GRAMMAR.fullmatch("".join(s[3] for s in steps)):
                found = (sum(s[1] for s in steps), "".join(s[0] for s in steps), "\n".join(s[2] for s in steps if s[2] is not None))
                best = min(best or found, found, key=lambda x: x[:2])
    return best


def code_of(role, fault):
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return {"": initial, "truncated": initial.upper()}.get(fault) or repair.MUST_GO[initial]


def solved(codes, size):
    """(cost, audit) of codes cut into blocks of `size`."""
    parts = [codes[i : i + size] for i in range(0, len(codes), size)]
    blocks = [repair._block(p) for p in parts]
    chain = repair.chained([{"block": k, "first": repair.INITIAL[p[0]], "last": repair.INITIAL[p[-1]], "illegal": b["illegal"], "ways": b["entries"]} for k, (p, b) in enumerate(zip(parts, blocks))])
    return chain["cost"], "".join(blocks[x["block"]]["entries"][x["way"]]["audit"] for x in chain["links"]) + chain["tail"]


def test_cheapest_edits_equal_all_edits_tried():
    rng = random.Random(4)
    for _ in range(120):
        rows = [(rng.choice(["system", "user", "assistant", "assistant", "tool", ""]), rng.choice(["a.", "b?", "c!", "d", " ", "e.\n"])) for _ in range(rng.randint(1, 4))]
        codes = "".join(code_of(r, f) for (r, _), f in zip(rows, plain_faults(rows)))
        assert solved(codes, 256) == plain_repair(rows)[:2], rows


def test_blocks_do_not_change_the_repair():
    rng = random.Random(5)
    for _ in range(300):
        codes = "".join(rng.choice("suauauaoSUAO1234") for _ in range(rng.randint(1, 40)))
        assert len({solved(codes, size) for size in (1, 2, 3, 7, 256)}) == 1, codes


def plain_report(rows):
    """The report of a conversation's rows (turn, role, text) in their order."""
    faults = plain_faults([r[1:] for r in rows])
    codes = "".join(code_of(r[1], f) for r, f in zip(rows, faults))
    cost, audit = solved(codes, 256)
    state, out, left = repair.START, [], list(rows)
    for letter in audit:
        role, text = (None, "") if letter == "I" else left.pop(0)[1:]
        if letter != "D":
            role = role if letter == "K" else repair.PUT[state]
            state = repair.NEXT[state, role[0]]
            out.append(f"{role}:{text}")
    assert state in (repair.START, repair.ASSISTANT) and not left
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(out)))


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_BITS", 2)
    rng = random.Random(6)
    rows = [(1, None, None, None), (1, None, "user", "u."), (2, 3, "user", "x" * 300_000 + "."), (None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, 9, "assistant", "b.")]
    rows += [(7, i, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["a.", "b", f"{i}.", f"{i}!", " "])) for i in range(100)]
    rows += [(8, 2**62, "user", "a."), (8, -(2**62) - 5, "assistant", "\t\x0b"), (9, 1, "user", "same."), (9, 1, "user", "same.")]
    names = ["place", "fault", "code", "block", "first", "n", "codes", "solved", "letters", "audit", "_kind"]
    df = spark.createDataFrame([(*r, *range(11)) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"`{n}` int" for n in names))
    found = repair.repaired(df)
    got = {r["conv_id"]: tuple(r[c] for c in REPORT) for r in found.reports.collect()}
    filled = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
    want = {}
    for c in {r[0] for r in rows}:
        want[c] = plain_report([r[1:] for r in sorted((r for r in filled if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))])
    assert got.pop(8)[1:] == want.pop(8)[1:]
    assert got == want
    texts = {}
    for r in found.turns().orderBy("conv_id", "turn").collect():
        texts.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: sha("\n".join(texts.get(c, []))) for c in want} == {c: r[-1] for c, r in want.items()}
    assert repair.repaired(df.limit(0)).reports.count() == 0


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = {}
    for c, t, role, text in sorted(rows):
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        row = (t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        after.setdefault(c, []).extend([row] * (0 if kind == 0 else 2 if kind == 3 else 1))
    got = {r["conv_id"]: tuple(r[c] for c in REPORT) for r in queries.QUERIES["op12_conversation_repair"](spark, SF).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert got == {c: plain_report(own) if own else nothing for c, own in after.items()}


# ---------------------------------------------------------------- periodic runs


def plain_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(all(words[i + k] == words[i + k + d] for k in range(size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def random_text(rng):
    words, kinds = [], rng.choice([2, 3, 9, 200])
    while len(words) < rng.randint(0, 90):
        unit = [rng.choice(["a", "A", "é", "日"]) + str(rng.randrange(kinds)) for _ in range(rng.randint(1, 6))]
        words += unit * (rng.randint(1, 7) if rng.random() < 0.5 else 1)
    return rng.choice(["", " ", "\n"]) + rng.choice([" ", "  ", "\n\t\x0b", "  "]).join(words) + rng.choice(["", "\r "])


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_equal_plain_ones():
    rng = random.Random(7)
    for _ in range(600):
        words = [rng.randrange(2) for _ in range(rng.randint(0, 60))]
        assert periodic_runs.runs_of(words) == plain_runs(words)
    texts = [None, "", " ", *(random_text(rng) for _ in range(400)), "x " * 5, "x " * 6, "x y " * 3, "x y " * 4]
    runs, left = periodic_runs.found_in(pa.array(texts))
    for text, found, collapsed in zip(texts, runs, left.to_pylist()):
        words = words_of(text)
        assert sorted(found) == plain_runs(words)
        assert collapsed == plain_collapsed(words, found)


def test_runs_of_long_periods_and_one_endless_word():
    words = [*range(50), *(1000 + i % 700 for i in range(3000)), *range(50)]
    assert periodic_runs.runs_of(words) == [(50, 3000, 700)]
    text = " ".join(map(str, words)) + " " + "é" * 3_000_000
    runs, left = periodic_runs.found_in(pa.array([text, "a a a a a a"]))
    assert runs == [[(50, 3000, 700)], [(0, 6, 1)]] and left.to_pylist()[1] == "a"
    assert left.to_pylist()[0] == " ".join([*map(str, words[:750]), *map(str, words[3050:]), "é" * 3_000_000])


def test_runs_of_odd_rows(spark, odd_documents):
    rows = odd_documents.withColumn("found", periodic_runs.periodic_runs(F.col("text"))).collect()
    assert len(rows) == 10
    for r in rows:
        words = words_of(r["text"])
        assert [tuple(x) for x in r["found"]["runs"]] == [] and r["found"]["collapsed"] == " ".join(words)
    assert odd_documents.limit(0).select(periodic_runs.periodic_runs(F.col("text"))).count() == 0


def test_run_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words = words_of(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        r, runs = got[doc_id], [] if len(words) > 3000 else plain_runs(words)
        if len(words) <= 3000:
            best = max(runs, key=lambda x: (1000 * x[1] * 10**9 // x[2], -x[0], -x[2]), default=(None, None, None))
            assert (r["start"], r["length"], r["period"]) == best
            assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
            assert (r["n_runs"], r["runs_sha256"]) == (len(runs), sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)))
            assert r["collapsed_sha256"] == sha(plain_collapsed(words, runs))
