"""URL filters: pattern rules found through their rarest literal token, then tested by regular expression.

A rule is text with `*` for any run of characters and `^` for a separator (anything but a letter or digit, or an
end). A path rule, host plus path such as `example.com/en/`, fits the host and its subdomains and every path that
starts so. Each rule has literal tokens that a URL must hold as whole tokens to fit; it is listed under the one
that the fewest URLs hold. A URL's tokens fetch its candidate rules, and only those are tested.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloam.operators.skew import lookup_join
from gridloam.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rules are given as a list on the driver; with this many their index (some 200 bytes a rule) still fits a broadcast.
MOST_RULES = 200_000
# Any URL holds this token; rules without a literal token of their own are listed under it.
ANY = ""

# The default rules of the method: spam words standing alone in a URL.
SPAM_WORDS = ("casino", "poker", "pills", "viagra", "adult", "porn", "xxx", "warez", "torrent")


@dataclass(frozen=True)
class Rule:
    """`text` as shown in results, the regular expression it stands for, its tokens, and what it decides."""

    text: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    by_path: bool


def path_rule(text: str, verdict: str) -> Rule:
    """A rule on host and path, tested on host and path put together."""
    host, slash, path = text.partition("/")
    whole = re.findall("[a-z0-9]+(?=[^a-z0-9])", (host + slash + path).lower()) if slash else re.findall("[a-z0-9]+", host.lower())
    pattern = r"\A(?:[^/]*\.)?" + re.escape(host + slash + path) + ("" if slash else r"(?:/|\z)")
    return Rule(text, pattern, tuple(dict.fromkeys(whole)), verdict, True)


def pattern_rule(text: str, verdict: str = "block") -> Rule:
    """A rule on the whole URL, upper and lower case alike."""
    parts, tokens = [], []
    for k, literal in enumerate(pieces := re.split(r"([*^])", text.lower())):
        if literal == "*":
            parts.append("(?s:.*)")
        elif literal == "^":
            parts.append(r"(?:[^a-z0-9]|\A|\z)")
        elif literal:
            parts.append(re.escape(literal))
            for m in re.finditer("[a-z0-9]+", literal):
                left = m.start() > 0 or (k > 0 and pieces[k - 1] == "^")
                right = m.end() < len(literal) or (k + 1 < len(pieces) and pieces[k + 1] == "^")
                if left and right:
                    tokens.append(m[0])
    return Rule(text, "".join(parts), tuple(dict.fromkeys(tokens)), verdict, False)


DEFAULT_RULES = tuple(pattern_rule(f"^{w}^") for w in SPAM_WORDS)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z as a-z) and path of a URL; both empty for NULL and without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(F.lit(""), url), "://", 1)).otherwise(None)
    after = F.coalesce(F.substr(url, F.length(rest) + 4), F.lit(""))
    host = F.regexp_extract(after, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"\A[^?#]*", 0)
    return ascii_lower(host), path


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, and the one that any URL holds."""
    return F.concat(F.array_distinct(F.regexp_extract_all(ascii_lower(url), F.lit("[a-z0-9]+"), 0)), F.array(F.lit(ANY)))


def indexed(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rules, each under its token that the fewest of `urls` (column `url`) hold, ties to the first by name."""
    spark = urls.sparkSession
    literal = sorted({t for r in rules for t in r.tokens})
    held: dict[str, int] = {}
    if literal:
        wanted = spark.createDataFrame([(t,) for t in literal], "token string")
        counts = urls.select(F.explode(tokens_of(F.col("url"))).alias("token")).join(F.broadcast(wanted), "token").groupBy("token").count()
        held = {r["token"]: r["count"] for r in counts.collect()}
    rows = [(min(r.tokens, key=lambda t: (held.get(t, 0), t), default=ANY), r.text, r.pattern, r.verdict, r.by_path) for r in rules]
    return spark.createDataFrame(rows, "token string, rule string, pattern string, rule_verdict string, by_path boolean")


def judged(urls: DataFrame, path_rules: list[Rule], pattern_rules: list[Rule] = DEFAULT_RULES, url: str = "url") -> DataFrame:
    """`urls` with `host`, `path`, `rule` and `verdict` added or put in place.

    Of the path rules that fit, the longest decides (ties: the last by text). Where none fits, `rule` is NULL and the
    verdict is `block` if a pattern rule fits, else `allow`. Equal URLs are judged once. A NULL URL is allowed.
    """
    rules = [*path_rules, *pattern_rules]
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit the broadcast index")
    distinct = urls.select(F.col(f"`{url}`").alias("url")).where("url IS NOT NULL").distinct()
    host, path = host_and_path(F.col("url"))
    index = indexed(distinct, rules)
    candidates = distinct.select("url", F.concat(host, path).alias("place"), ascii_lower(F.col("url")).alias("low"), F.explode(tokens_of(F.col("url"))).alias("token")).join(F.broadcast(index), "token")
    fitting = candidates.where(F.expr("regexp_like(CASE WHEN by_path THEN place ELSE low END, pattern)"))
    by_path = F.when(F.col("by_path"), F.struct(F.length("rule").alias("n"), "rule", "rule_verdict"))
    found = fitting.groupBy("url").agg(F.max(by_path).alias("_llm_best"), F.max(F.when(~F.col("by_path"), F.col("rule_verdict"))).alias("_llm_method"))
    found = written(found.select(F.col("url").alias("_llm_url"), "_llm_best", "_llm_method"), "url-verdicts")
    host, path = host_and_path(F.col(f"`{url}`"))
    # Rows without a URL and copies of a frequent one are dealt over many tasks, or meet the verdicts where they are.
    joined = lookup_join(urls.withColumns({"host": host, "path": path, "_llm_url": F.col(f"`{url}`")}), found, ["_llm_url"], "left")
    out = joined.withColumns({"rule": F.col("_llm_best.rule"), "verdict": F.coalesce(F.col("_llm_best.rule_verdict"), F.col("_llm_method"), F.lit("allow"))})
    return out.drop("_llm_url", "_llm_best", "_llm_method")
