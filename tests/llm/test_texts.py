"""Language, quality, HTML, URL filters and token counts."""

import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloam.llm import html_text, queries
from gridloam.llm.language_id import LETTERS, fit_languages, identified, runs_of_letters, with_language
from gridloam.llm.quality import fit_quality, trained, with_quality
from gridloam.llm.token_count import Vocabulary, with_token_count
from gridloam.llm.url_filter import judged, path_rule, pattern_rule

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    got = queries.QUERIES["op1_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    share = got.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_of_odd_texts(spark, odd_documents):
    model = fit_languages(odd_documents)
    rows = with_language(odd_documents, model).collect()
    assert len(rows) == 10 and rows[0].asDict().keys() >= {"key", "rank", "lang_pred"}
    for r in rows:
        none = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"], r["score"]) == (("und", 0.0) if none else ("de", 1.0))
    nothing = fit_languages(odd_documents.limit(0))
    assert {r["lang_pred"] for r in with_language(odd_documents, nothing).collect()} == {"und"}
    assert with_language(odd_documents.limit(0), model).count() == 0


def test_unknown_words_back_off_to_pieces(spark):
    rows = [("the cat sat", "en"), ("die katze sitzt", "de")] * 5
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    got = with_language(spark.createDataFrame([("katzen",), ("cats",), ("日本",)], "text string"), model)
    assert [r["lang_pred"] for r in got.collect()] == ["de", "en", "de"]


def test_languages_of_unequal_size(spark):
    """3,000 texts against 3 over one alphabet: rare and new words do not go to the small language for being unknown."""
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(3, 8)))
    rows = [(" ".join(word("abcdefgh") for _ in range(20)), "large") for _ in range(3000)]
    rows += [(" ".join(word("efghijkl") for _ in range(20)), "small") for _ in range(3)]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    kept = {}
    for letters, lang, least in (("abcdefgh", "large", 98), ("ijkl", "small", 90)):
        new = [" ".join(word(letters) for _ in range(10)) for _ in range(100)]
        assert sum(identified(model, t, kept)[0] == lang for t in new) >= least
    assert all(identified(model, t, kept)[0] == lang for t, lang in rows[:300] + rows[-3:])


def test_every_language_is_learned(spark):
    rows = [("one and only text", "copied")] * 10_000 + [(f"wort{chr(97 + i % 26)} {i}", "many") for i in range(6000)] + [("²", "mute")] + [(f"x{chr(97 + i // 26)}{chr(97 + i % 26)}", f"l{i}") for i in range(300)]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.languages) == 302 and "mute" not in model.languages
    assert identified(model, "one text only", {})[0] == "copied"
    assert identified(model, "xkq", {})[0] == "l276"
    assert identified(model, "² ½ Ⅳ 7", {}) == ("und", 0.0)


def test_runs_of_letters_equal_the_pattern():
    every = "".join(map(chr, range(0x110000)))
    assert runs_of_letters(every) == LETTERS.findall(every)
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("aé²½_ 1中Ⅷ٣-\u0301") for _ in range(rng.randrange(60)))
        assert runs_of_letters(text) == LETTERS.findall(text)
    for text in ("", "two words", "x²y _z9 ٣ab"):
        assert runs_of_letters(text) == LETTERS.findall(text)


def test_language_model_equals_a_plain_one(spark):
    rows = [("ab ab cd", "x"), ("cd ef", "y"), ("cd ef", "y")]
    model = fit_languages(spark.createDataFrame(rows, "text string, lang string"))
    n = {"x": {"ab": 2, "cd": 1}, "y": {"cd": 1, "ef": 1}}
    for word in ("ab", "cd", "ef"):
        every = sum(c.get(word, 0) for c in n.values()) / 5
        want = [math.log(0.9 * n[k].get(word, 0) / sum(n[k].values()) + 0.1 * every) for k in "xy"]
        assert model.known[word] == pytest.approx(want)
    assert model.prior == pytest.approx([math.log(1 / 3), math.log(2 / 3)])
    total = model.prior + 2 * model.known["ab"] + model.known["ef"]
    lang, score = identified(model, "AB ab ef", {})
    assert (lang, score) == ("xy"[int(total.argmax())], pytest.approx(1 / sum(math.exp(t - max(total)) for t in total)))


def test_quality_trains_as_a_plain_loop_does():
    """Follow the regularised leader, place by place, against `trained`."""
    rng = np.random.default_rng(3)
    rows = [(rng.choice(16, 5, replace=False), rng.random(5), int(rng.integers(2))) for _ in range(400)]
    alpha, beta, l1, l2 = 0.3, 1.0, 0.02, 0.1
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(60):
        for place, value, label in rows:
            at = [*map(int, place), 16]
            x = [*value, 1.0]
            w = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
            for i, v, wi in zip(at, x, w):
                g = (p - label) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * wi
                n[i] += g * g
    got, bias = trained(rows, 4, 60, alpha, beta, l1, l2)
    assert got == pytest.approx([weight(i) for i in range(16)]) and bias == pytest.approx(weight(16))


def test_quality_of_held_out_documents(spark):
    got = queries.QUERIES["op6_quality"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = got.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in seen) / len(seen) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in seen)


def test_quality_of_odd_texts(spark, odd_documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (4, 1), (7, 0), (None, 1), (6, None)], "doc_id long, quality int")
    model = fit_quality(odd_documents, labels)
    rows = with_quality(odd_documents, model).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    untaught = fit_quality(odd_documents, labels.limit(0))
    assert {r["score"] for r in with_quality(odd_documents, untaught).collect()} == {0.5}


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<title>no</title><h1>A</h1><p>one<p>two<br>three", "A\n\none\n\ntwo\nthree"),
        ("<div>a</div><div>b<span hidden>c</span></div><div style='display:none'>d</div>", "a\nb"),
        ("<script>if (a<b) '</p>'</script>x<!-- y --><style>z</style>", "x"),
        ("<ul><li>a<li>b<ol><li>c</li><li>d</ol></ul>", "- a\n- b\n  1. c\n  2. d"),
        ("<table><tr><th>name<th>n<tr><td>long name<td>1</table>", "name      | n\nlong name | 1"),
        ("<table><td>a</td><td><p>b<p>c</table>after", "a | b\n  |\n  | c\n\nafter"),
        ("<pre>a  b\n  c</pre>", "a  b\n  c"),
        ("<p>a &amp; b &lt;c&gt;</p></div>d", "a & b <c>\n\nd"),
        ("<a href=\"x>y\">in</a> < 3 <b", "in < 3 <b"),
        ("<dl><dt>t<dd>d</dl>", "t\nd"),
        ("<select><option>a<option>b</select>", "a\nb"),
    ],
)
def test_page_text(page, text):
    assert html_text.text_of(page) == text


@pytest.mark.parametrize(
    ("attributes", "shown"),
    [
        (' href="/hidden/page"', True),
        (' title="the hidden truth"', True),
        (' class="nav hidden md:block"', True),
        (" title='x style=display:none'", True),
        (' data-style="display:none"', True),
        (' style="backface-visibility:hidden"', True),
        (' style="display:none;display:block"', True),
        (" href=/a/hidden", True),
        (" hidden", False),
        (" a=b HIDDEN=''", False),
        (' title="hidden"hidden', False),
        (" style = 'color:red; Display : None !important; display:block'", False),
        (" style=visibility:hidden", False),
    ],
)
def test_only_a_hidden_attribute_or_style_hides(attributes, shown):
    assert html_text.text_of(f"<div{attributes}>in<b>side</b></div>") == "inside" * shown


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds", "so x= 1 2 holds"),
        ("<math><semantics><mi>x</mi><annotation>no</annotation><annotation-xml encoding='text/html'><p>no</p></annotation-xml></semantics></math>y", "xy"),
        ("<p>a<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><g><text x=1>Jan</text><text>Feb</text></g></svg>b", "a Jan Feb b"),
        ("<svg><defs/><path d='M0'/><text><tspan x=0>one</tspan><tspan x=0 dy=9>two</tspan></text></svg>after", "one two after"),
        ("<svg>no<title>no</svg>yes", "yes"),
        ("<svg><foreignObject><p>in</p></foreignObject><text><![CDATA[a<b]]></text></svg>", "in\n\na<b"),
        ("<svg style='display:none'><text>no</text></svg><svg><g display=none><text>no</text></g></svg><svg><defs><p>out", "out"),
        ("<head><title>T</title>Hello<p>x", "Hello\n\nx"),
        ("<head> <title>T</title> <meta charset=x> <style>s</style></head>Hello<p>x", "Hello\n\nx"),
        ("<html><head>\n<script>no</script>\n&lt;Hello", "<Hello"),
    ],
)
def test_formulas_labels_and_text_after_an_open_head_show(page, text):
    assert html_text.text_of(page) == text


def test_page_text_holds_all_visible_words_in_order():
    rng = random.Random(3)
    tags = "p div ul li b table tr td h2 span ol br section".split()
    for _ in range(200):
        words, parts = [], []
        for k in range(60):
            roll = rng.random()
            if roll < 0.4:
                words.append(f"w{k}")
                parts.append(f" {words[-1]} ")
            elif roll < 0.75:
                parts.append(f"<{rng.choice(tags)}>")
            else:
                parts.append(f"</{rng.choice(tags)}>")
        got = re.findall(r"w\d+", html_text.text_of("".join(parts)))
        assert sorted(got) == sorted(words)


def test_deep_pages_do_not_recurse():
    assert html_text.text_of("<div>" * 50_000 + "x") == "x"
    assert html_text.text_of("<b>" * 50_000 + "x").strip() == "x"


def test_page_query(spark):
    got = queries.QUERIES["op4_html_text"](spark, "/root/testdata/sf0.001")
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    rows = got.collect()
    assert {r["page_id"]: r["text"] for r in rows} == {i: html_text.text_of(p) for i, p in pages.items()}
    assert not any("track(" in r["text"] or "margin:0" in r["text"] for r in rows)


URLS = [
    None, "", "no scheme/en/", "http://A.Example.COM/en/7", "http://com/en/", "https://xcom/en/", "http://example.com/en/7?x#y", "http://example.net/de/8", "http://a.net/de/",
    "http://b.org/es", "http://b.org/es/1", "http://b.org?/es/", "http://x.casino-win.example.com/fr/", "http://casinos.example.com/", "http://a.fr/poker", "://com/en/", "http://É.com/en/É",
]


def plain_verdict(url, path_rules, pattern_rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in path_rules if (h := r.text.partition("/")) and (host == h[0] or host.endswith("." + h[0])) and path.startswith(h[1] + h[2])]
    if fits:
        best = max(fits, key=lambda r: (len(r.text), r.text))
        return host, path, best.text, best.verdict
    bad = url and any(re.search(r.pattern.replace(r"\z", r"\Z"), url.lower()) for r in pattern_rules)
    return host, path, None, "block" if bad else "allow"


def test_url_rules_match_plain_ones(spark):
    patterns = [pattern_rule("^casino^"), pattern_rule("^poker^"), pattern_rule("fr/*"), pattern_rule("b.org?")]
    urls = spark.createDataFrame([(i, u, i, "x") for i, u in enumerate(URLS + URLS[3:6])], "page_id int, url string, token int, pattern string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judged(urls, queries.PATH_RULES, patterns).collect()}
    assert got == {i: plain_verdict(u, queries.PATH_RULES, patterns) for i, u in enumerate(URLS + URLS[3:6])}
    assert judged(urls.limit(0), queries.PATH_RULES).count() == 0
    assert {r["verdict"] for r in judged(urls, [], []).collect()} == {"allow"}


def test_rules_without_tokens_still_apply(spark):
    urls = spark.createDataFrame([("http://q/abc",)], "url string")
    assert judged(urls, [], [pattern_rule("ab")]).first()["verdict"] == "block"
    assert judged(urls, [path_rule("q", "block")], []).first()["rule"] == "q"


def test_url_plan_has_no_python(spark):
    plan = queries.QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def unigram():
    import public_tokenizers
    from tokenizers import Tokenizer, models, normalizers

    vocabulary = Vocabulary.from_file(public_tokenizers.path(queries.UNIGRAM_VOCABULARY))
    library = Tokenizer(models.Unigram(vocabulary.pieces, unk_id=vocabulary.unknown, byte_fallback=True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return vocabulary, library


def test_token_counts_equal_the_library(spark, unigram, odd_documents):
    vocabulary, library = unigram
    texts = [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet' limit 200").fetchall()]
    texts += ["a  b", " ", "日本語 テ<0x0A>\n\n\t", "😀😀 x😀", "▁▁ a▁b", "\u0000 a", "aaaa" * 50]
    kept = {}
    assert [vocabulary.counted(t, kept) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    rows = with_token_count(odd_documents, vocabulary).collect()
    assert [r["n_tokens"] for r in rows] == [len(library.encode(r["text"], add_special_tokens=False).ids) if r["text"] else 0 for r in rows]


def test_ties_and_unknown_runs_follow_the_library():
    from tokenizers import Tokenizer, models

    rng = random.Random(5)
    for _ in range(300):
        pieces = [("<unk>", 0.0), *{"".join(rng.choices("abc", k=rng.randint(1, 4))): float(-rng.randint(1, 4)) for _ in range(8)}.items()]
        own, library = Vocabulary(pieces), Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
        text = "".join(rng.choices("abcd", k=30))
        assert own.count(text)[1] == len(library.encode(text).ids), (pieces, text)
