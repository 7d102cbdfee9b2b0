"""The queries of the ten operators over the given tables, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloam.llm.ann_forest import nearest
from gridloam.llm.chat_trees import formatted_paths, learned_text, replies_of_turns, reply_paths, turns_of
from gridloam.llm.conversation_repair import damaged, repaired
from gridloam.llm.decontaminate import items_hit, with_matches, words_hit
from gridloam.llm.html_text import with_page_text
from gridloam.llm.jaccard_join import linked_documents
from gridloam.llm.language_id import fit_languages, with_language
from gridloam.llm.packing import packed_documents
from gridloam.llm.periodic_runs import periodic_runs, strongest
from gridloam.llm.quality import fit_quality, with_quality
from gridloam.llm.shipping import ship
from gridloam.llm.suffix_dedup import without_repeats
from gridloam.llm.token_count import Vocabulary, with_token_count
from gridloam.llm.url_filter import judged, path_rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BPE_VOCABULARY = "byte_bpe_50k.json"
UNIGRAM_VOCABULARY = "piece_bpe_32k.model"
QUALITY_THRESHOLD = 0.3
PATH_RULES = [
    path_rule("com/en/", "block"),
    path_rule("example.com/en/7", "allow"),
    path_rule("net/de/", "allow"),
    path_rule("example.net/de/8", "block"),
    path_rule("org/es/", "block"),
]


def registered(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo `divisor`; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(divisor))


def held_out(column: str, divisor: int, value: int) -> Column:
    return F.coalesce(remainder(column, divisor) == value, F.lit(False))


@registered
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(~held_out("doc_id", 3, 1)))
    got = with_language(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


@registered
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_page_text(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", "text", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text"), 256).alias("text_sha256"))


@registered
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, PATH_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op5_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block'
    WHEN rule IN ('example.com/en/7', 'net/de/') THEN 'allow'
    WHEN regexp_matches(lower(coalesce(url, '')), '(^|[^a-z0-9])(casino|poker|pills|viagra|adult|porn|xxx|warez|torrent)([^a-z0-9]|$)') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@registered
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 5, 0))
    got = with_quality(docs, fit_quality(docs, labels), threshold=QUALITY_THRESHOLD)
    return got.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@registered
def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.from_file(public_tokenizers.path(UNIGRAM_VOCABULARY))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_count(docs, vocabulary).select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), "n_tokens")


@registered
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"))
    items = items_hit(F.col("matches"))
    return found.select(
        "doc_id",
        "n_words",
        words_hit(F.col("matches")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


ORACLES["op8_decontamination"] = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), probe AS (
  SELECT item_id, n, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS i FROM item WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM probe
), place AS (
  SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM doc WHERE len(w) > 0
), hit AS (
  SELECT p.doc_id, p.i, s.n, b.item_id
  FROM place p JOIN sizes s ON p.i + s.n <= len(p.w)
  JOIN probe b ON b.n = s.n AND b.win = array_to_string(p.w[p.i + 1 : p.i + s.n], ' ')
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@registered
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = packed_documents(docs, public_tokenizers.path(BPE_VOCABULARY))
    return got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@registered
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"), 20)


@registered
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@registered
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return got.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: A conversation whose texts hold the template's own marks.
MARKED = r"\### Assistant: </turn> ok"


@registered
def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"))
    replies = replies_of_turns(given.unionByName(marked))
    paths = formatted_paths(reply_paths(replies, score=None), replies)
    turns = turns_of(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = learned_text(F.col("formatted"), F.col("loss_spans"))
    roots = replies.where("parent IS NULL").select("conv_id", F.col("id").alias("root"))
    return roots.join(paths, "root").select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op11_chat_formatting"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(0, 2) AS r(i)
), sized AS (
  SELECT *, length(x) + length(regexp_replace(x, '[^\\]', '', 'g')) + length(regexp_replace(x, '[^#]', '', 'g')) - len(regexp_extract_all(x, '#+'))
            + len(regexp_extract_all(x, '</')) + len(regexp_extract_all(role, ': ')) + 14 AS chars
  FROM (SELECT *, role || chr(10) || text AS x FROM said)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars - 1)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@registered
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    reports = repaired(damaged(given)).reports
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # Conversations without a row left are unioned in with NULLs; max over one report passes by them, NULL ids included.
    both = reports.unionByName(given.select("conv_id").distinct(), allowMissingColumns=True).groupBy("conv_id")
    whole = both.agg(F.count("cost").alias("found"), *(F.max(c).alias(c) for c in [*numbers, "audit", "repaired_sha256"]))
    empty = F.col("found") == 0
    return whole.select(
        "conv_id",
        *(F.when(empty, F.lit(0)).otherwise(F.col(c)).cast("long").alias(c) for c in numbers),
        F.when(empty, "").otherwise(F.col("audit")).alias("audit"),
        F.when(empty, F.sha2(F.lit(""), 256)).otherwise(F.col("repaired_sha256")).alias("repaired_sha256"),
    )


def with_planted_run(text: Column, doc_id: Column) -> Column:
    """The text, of every tenth document (by crc32 of its id, h) with the words from the a-th on repeating p words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    repeats = g % 8 + 3
    p = F.floor((n - a) / repeats).cast("long") + 1
    one, head, rest = F.lit(1).cast("int"), a.cast("int"), (n - a).cast("int")
    period = F.slice(words, head + 1, p.cast("int"))
    # (n - a) / p is below g % 8 + 3, so as many periods reach the end.
    planted = F.concat(F.slice(words, one, head), F.slice(F.flatten(F.array_repeat(period, repeats.cast("int"))), one, rest))
    return F.when((h % 10 == 0) & (bare != ""), F.array_join(planted, " ")).otherwise(text)


@registered
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", with_planted_run(F.col("text"), F.col("doc_id")).alias("text"))
    found = docs.select("doc_id", periodic_runs(F.col("text")).alias("found")).select("doc_id", "found.runs", "found.collapsed")
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    best = strongest(F.col("runs"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
