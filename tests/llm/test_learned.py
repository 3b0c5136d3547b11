"""Classifiers by held-out accuracy, the page extractor by cases, the pipeline by parts."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldtally.llm import html, language, mixing, quality, samples, toxicity
from fieldtally.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import bare, plain_fingerprint, roots, rows_of, word_number
from tests.oracle_check import differences, open_tables

SMALL, FOLDER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels", "pages")}


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", [SMALL, FOLDER])
def test_query_matches_sql(spark, name, folder):
    assert differences(QUERIES[name](spark, folder), open_tables(folder), ORACLES[name]) == []


@pytest.mark.parametrize("name,label,floor", [
    ("op2_attention_quality", "quality", 0.93), ("op7_unlabelled_toxicity", "toxic", 0.88)])
def test_held_out_labels(spark, tables, name, label, floor):
    found = QUERIES[name](spark, FOLDER)
    assert found.count() == tables["documents"].count()
    assert found.where("score < 0 or score > 1 or score is null").count() == 0
    told = found.where("held_out").join(tables["labels"], "doc_id").select("predicted", label).collect()
    assert np.mean([a == b for a, b in told]) >= floor
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found.collect()} == {True}


def test_held_out_languages(spark, tables):
    found = QUERIES["op9_segmented_language"](spark, FOLDER).where("held_out")
    told = found.join(tables["documents"], "doc_id").select("lang_pred", "lang").collect()
    assert np.mean([a == b for a, b in told]) >= 0.97


def test_segmentations_are_all_summed():
    model = language.fit({"x": ["abab ab abc"], "y": ["cab bca"]})
    pieces = language.vocabulary(language.vocabulary_path())
    number = {p: i for i, p in enumerate(pieces)}
    for word in ("abc", "cabab", "a", "ß漢"):
        marked = language.START + word
        for column in range(2):
            total = 0.0
            for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
                ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
                parts = [marked[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                chance = 1.0
                for p in parts:
                    own = model.chances[number[p], column] if p in number else 0.0
                    chance *= max(own, language.ODD_LETTER) if len(p) == 1 else own
                total += chance
            assert model.log_chances([word])[0, column] == pytest.approx(np.log(total), rel=1e-9)


def test_long_words_are_summed_whole(monkeypatch):
    words = ["abab", "ab", "abc", "internationalisation", "an" * 70 + "c"]
    texts = {"x": [" ".join(words)], "y": ["cab bca nation"]}
    model = language.fit(texts)
    number = {p: i for i, p in enumerate(language.vocabulary(language.vocabulary_path()))}
    most = max(map(len, number))
    assert most > 7 and model.lattice.most == most
    for word in ("abc" * 40, "internationalisation" * 6, "ß漢" * 60, "a" * 300):
        marked = language.START + word
        for column in range(2):
            sums = [Fraction(1)]
            for end in range(1, len(marked) + 1):
                total = Fraction(0)
                for begin in range(max(0, end - most), end):
                    piece = marked[begin:end]
                    own = float(model.chances[number[piece], column]) if piece in number else 0.0
                    total += sums[begin] * Fraction(max(own, language.ODD_LETTER) if len(piece) == 1 else own)
                sums.append(total)
            log = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
            assert model.log_chances([word])[0, column] == pytest.approx(log, rel=1e-9)
    whole = model.log_chances(words)
    monkeypatch.setattr(language, "PART", 7)
    monkeypatch.setattr(language, "LONG", 1)
    one_by_one = language.fit(texts)
    assert one_by_one.chances == pytest.approx(model.chances, rel=1e-9)
    assert one_by_one.log_chances(words) == pytest.approx(whole, rel=1e-9)


def test_odd_texts_have_scores_and_languages(odd):
    quick = quality.fit(["good words here", "|| ||"], np.array([1, 0]))
    toxic = toxicity.fit(["vile thing"] * 5, ["nice thing"] * 9, 0.1)
    tongue = language.fit({"en": ["the word and"], "de": ["das wort und"]})
    for scored in (quality.score(odd, quick), toxicity.score(odd, toxic)):
        rows = rows_of(scored)
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert scored.limit(0).count() == 0
    rows = rows_of(language.identify(odd, tongue))
    assert Counter(r["lang_pred"] for r in rows if r["doc_id"] in (200, 201, 202, 203)) == {"und": 4}
    assert {r["lang_pred"] for r in rows} <= {"und", "en", "de"}
    passed = toxicity.score(odd, toxic, odd.columns)
    assert set(passed.columns) == set(odd.columns) and passed.count() == odd.count()


def test_classifiers_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    everything = F.lit(True)
    assert {r["score"] < 0.5 for r in toxicity.score(
        documents, toxicity.train(documents, none, everything)).collect()} == {True}
    assert {r["score"] for r in quality.score(
        documents, quality.train(documents, none, everything)).collect()} == {0.5}
    lone = language.train(documents.where("false"), everything)
    assert {r["lang_pred"] for r in language.identify(documents, lone).collect()} == {"und"}


def test_samples_are_bounded(documents):
    rows = samples.sizes(documents, F.col("source").alias("kind"))
    taken = samples.bounded_texts(documents, rows, most_rows=5, most_bytes=10 ** 6)
    assert taken.groupby("kind").size().max() == 5 and taken["kind"].nunique() > 5
    short = samples.bounded_texts(documents, rows, most_rows=50, most_bytes=400)
    assert (short.groupby("kind")["text"].apply(lambda t: sum(len(x.encode()) for x in t)) <= 400).all()
    few = samples.bounded_rows(documents, rows, 5, 10 ** 6, most_kinds=2)
    assert few.select("kind").distinct().count() == 2


@pytest.mark.parametrize("hot", [lambda: F.lit(1).cast("bigint"), lambda: F.lit(None).cast("bigint")])
def test_samples_of_one_id_on_many_rows(spark, hot):
    many = spark.range(50_000).select(hot().alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 30_000).alias("text"))
    huge = spark.range(1).select(F.lit(2).cast("bigint").alias("doc_id"), F.repeat(F.lit("x"), 100_000).alias("text"))
    docs = many.union(huge)
    rows = samples.sizes(docs, F.lit(0).alias("kind"))
    taken = samples.bounded_texts(docs, rows, most_rows=100, most_bytes=50_000)
    assert len(taken) == 100 and taken["text"].nunique() == 100
    same = spark.range(50_000).select(F.lit(1).alias("doc_id"), F.lit("one text").alias("text")).union(
        spark.createDataFrame([(n, f"other {n}") for n in range(2, 12)], "doc_id int, text string"))
    taken = samples.bounded_texts(same, samples.sizes(same, F.lit(0).alias("kind")), most_rows=100)
    assert sorted(taken["text"])[:2] == ["one text", "other 10"] and len(taken) == 11


def test_toxicity_of_words_summed_plainly():
    model = toxicity.fit(["vile thing", "vile words"] * 4, ["nice thing", "kind words"] * 6, 0.2)
    for text in ("a vile thing", "nice, NICE words", "", None, "vile " * 50):
        known = {w for w in (text or "").lower().replace(",", " ").split()}
        total = model.bias
        for word in known:
            marked = f"<{word}>"
            for n in (4, 5):
                for i in range(len(marked) - n + 1):
                    total += model.weights.get(zlib.crc32(marked[i:i + n].encode()), 0.0)
            total += model.weights.get(zlib.crc32(marked.encode()), 0.0)
        assert model.score(text) == pytest.approx(1 / (1 + np.exp(-np.clip(total, -30, 30))), abs=1e-12)
    assert model.score("vile") > 0.5 > model.score("nice")


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></ul></nav>
<div class="cookie-notice">We use cookies.</div>%s<aside>Other news, and more.</aside>
<div id="comments"><p>First! I, too, was here.</p></div><form><p>Subscribe now.</p></form>
<script>var t="</p><p>no</p>";</script><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("inner,text", [
    ("<article><h1>A&amp;B</h1><p>One,\n two.<br>three <b>bo</b>ld.<p>Four &eacute; five.</article>",
     "A&B\n\nOne, two. three bold.\n\nFour é five."),
    ("<div class=content><h2>Head</h2><p>Some words, in a row.</p><ul><li>a<li>b</ul></div>",
     "Head\n\nSome words, in a row.\n\na\n\nb"),
    ("<article></article>", ""), ("", ""),
    ("<article><div class='ad'>Buy!</div><p>Text &#8212; <i>x</i>.</p><!-- no --></article>", "Text — x.")])
def test_main_text(inner, text):
    assert html.main_text(PAGE % inner) == text


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>un<b>closed", "unclosed"),
    ("<script>x", ""), ("<", "<"), ("a < b", "a < b"), ("<p>a</b></p></div><p>b", "a\n\nb")])
def test_broken_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<div style='overflow: hidden' data-id=menu><p>One, two.</p></div>", "One, two."),
    ("<p title=it's>one</p><p>it's two</p>", "one\n\nit's two"),
    ("<a " * 100_000, ("<a " * 100_000).strip()),
    ("<div>" * 50_000 + "deep", "deep"),
    ("<p>a</p> b <!-- no end", "a\n\nb"),
])
def test_quotes_depth_and_missing_ends(page, text):
    assert html.main_text(page) == text


ARTICLE = ("<h1>Head</h1><p>" + "This is a sentence, with some words in it. " * 6
           + "</p><p>Another, shorter one of the text.</p>")
ARTICLE_TEXT = ("Head\n\n" + ("This is a sentence, with some words in it. " * 6).strip()
                + "\n\nAnother, shorter one of the text.")
COMMENTS = "<div class=comment><p>" + "I, too, think so; it is right. " * 40 + "</p></div>"


@pytest.mark.parametrize("page, more", [
    (f"<body><ul><li><a href=/>Home</a></ul><div class='elementor-widget-text-editor'>{ARTICLE}</div>", ""),
    (f"<body><form id=page><div>{ARTICLE}</div><div>(c) 2024 Example.</div></form>", ""),
    (f"<article>{ARTICLE}<p class='flip-side'>Real words, here.</p><div class='foot-note'>A note, to the text, "
     "long enough to be one.</div></article>",
     "\n\nReal words, here.\n\nA note, to the text, long enough to be one."),
    (f"<article>{ARTICLE}<div class='social-science'>More words, of the text.</div></article>",
     "\n\nMore words, of the text."),
    (f"<main>{ARTICLE}<div><a href=/a>One</a> <a href=/b>Two</a></div><div>Buy now! 50% off</div></main>", ""),
    (f"<div><a href=/>Home</a> | <a href=/x>News</a></div><div>{ARTICLE}<h2>Next</h2><ul><li>milk<li>eggs</ul>"
     "</div><div>(c) 2024 Example.</div>", "\n\nNext\n\nmilk\n\neggs"),
    (f"<body><div>{ARTICLE}</div><div class='post-comments-list'>{COMMENTS * 9}</div>", ""),
    (f"<body class='with-sidebar'><div class='has-sidebar'>{ARTICLE}</div><div id=adSlot><p>Buy, now.</p></div>", "")])
def test_pages_without_telling_parts(page, more):
    assert html.main_text(page) == ARTICLE_TEXT + more


def test_text_in_links_alone_is_not_lost():
    assert html.main_text("<body><ul><li><a href=/>Home</a></ul></body>") == "Home"


def test_names_decide_little(monkeypatch):
    page = f"<body><nav>Menu</nav><div class=ad>Buy now.</div><article>{ARTICLE}</article><div>&copy; us</div>"
    assert html.main_text(page) == ARTICLE_TEXT
    monkeypatch.setattr(html, "ASIDE_NAMES", set())
    assert html.main_text(page) == ARTICLE_TEXT


def plain_scores(page):
    """Scores by loops over all blocks for each block, as the docstring states them."""
    blocks = [b for b in page.blocks if not b.aside]

    def above(element):
        found = [element]
        while found[-1]:
            found.append(page.holder[found[-1]])
        return found

    def size(element, weight):
        return sum(weight(b) for b in blocks if element in above(b.element))

    everything = size(0, lambda b: len(b.text))
    framed = any(t == "form" and 2 * size(e, lambda b: len(b.text)) >= everything for e, t in enumerate(page.tags))

    def factor(b):
        path = page.paths[b.path]
        return 0.01 ** (path.marks + (0 if framed else path.forms))

    sizes = {e: size(e, lambda b: len(b.text) * factor(b)) for e, t in enumerate(page.tags) if t in ("article", "main")}
    most = max(sizes.values(), default=0)
    root = min(e for e, n in sizes.items() if n == most) if most else None

    def own(path):
        texts = [b.text for b in blocks if b.path == path]
        marks = sum(t.count(m) for t in texts for m in ".,;:!?")
        return sum(map(len, texts)) / len(texts) * (1 + marks / len(texts))

    found = {}
    for b in blocks:
        part = [c for c in blocks if c.part == b.part]
        free = sum(len(c.text) - c.linked for c in part)
        mean = sum((len(c.text) - c.linked) * own(c.path) for c in part) / free if free else 0
        alike = [c for c in part if c.path == b.path]
        linked = sum(c.linked for c in alike) / sum(len(c.text) for c in alike)
        beside = 0.01 if root is not None and root not in above(b.part) else 1
        found[b.path, b.part] = (own(b.path) + mean) / 2 * (1 - linked) ** 2 * factor(b) * beside
    return found


@pytest.mark.parametrize("page", [
    PAGE % f"<article>{ARTICLE}</article>", PAGE % f"<div>{ARTICLE}<p><a href=/>All</a> of it.</div>",
    f"<form><div>{ARTICLE}</div><fieldset>Name</fieldset></form><p class=notice>Old, now.</p>",
    f"<main><article>{ARTICLE}</article><article class=x><p>Short.</p></article></main><div class=ad>Buy.</div>"])
def test_path_scores_are_the_plain_ones(page):
    found = html.page_of(page)
    assert html.path_scores(found)[1] == pytest.approx(plain_scores(found))


def test_fractions_and_raised_digits_are_no_letters():
    assert language.words_of("½ ² Ⅷ 12") == []
    assert language.words_of("Ab c½") == ["ab", "c½"]


def test_long_and_odd_pages(spark):
    long = "<article>" + "<p>Words, words.</p>" * 20000 + "</article>"
    rows = [(1, "u", long), (None, None, None), (2, "u", "x"), (2, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = rows_of(html.extract(pages))
    assert len(got) == 4 and got[0]["text"].count("\n\n") == 19999
    assert html.extract(pages.limit(0)).count() == 0


# Pipeline -------------------------------------------------------------------------------

def test_stages_that_remove_and_repeat(spark, odd, tmp_path):
    """Exact and near dedup and the mix, each against a plain version, over odd rows."""
    docs = odd
    one = rows_of(corpus_pipeline.unique(spark, docs, FOLDER))
    assert Counter(bare(r["text"]) for r in one) == Counter({bare(r["text"]): 1 for r in rows_of(docs)})
    longest = {}
    for r in rows_of(docs):
        key = bare(r["text"])
        longest[key] = max(longest.get(key, 0), len(r["text"] or ""))
    assert all(len(r["text"] or "") == longest[bare(r["text"])] for r in one)
    kept = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in one], docs.schema)
    two = rows_of(corpus_pipeline.different(spark, kept.where("doc_id is not null"), FOLDER))
    texts = {r["doc_id"]: plain_fingerprint(r["text"]) for r in one if r["doc_id"] is not None}
    root = roots(sorted(texts), [(a, b) for a in texts for b in texts
                                 if a < b and (texts[a] ^ texts[b]).bit_count() <= 4])
    assert sorted(r["doc_id"] for r in two) == sorted({root[i] for i in texts})
    mixed = corpus_pipeline.mixed(spark, kept, FOLDER)
    assert mixed.columns == docs.columns
    sources, spans = mixing.mix(kept)
    times = Counter()
    for r in spans.groupBy("doc_id", "epoch", "size").agg(F.sum("length").alias("n")).collect():
        times[r["doc_id"]] += (r["n"] or 0) * 2 >= r["size"] and r["n"] is not None
    assert Counter(r["doc_id"] for r in mixed.collect()) == +times


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_and_take_empty_tables(spark, odd, name, stage):
    of_all, of_none = stage(spark, odd, FOLDER), stage(spark, odd.limit(0), FOLDER)
    assert of_none.count() == 0 and of_none.columns == of_all.columns
    if name != "packing":
        assert of_all.columns == odd.columns
        rows = Counter(map(str, odd.collect()))
        assert set(map(str, of_all.collect())) <= set(rows)


def test_rows_without_words_are_not_in_the_mix(spark, odd):
    mixed = corpus_pipeline.mixed(spark, odd, FOLDER)
    assert all(word_number(r["text"]) for r in mixed.collect())


def test_pipeline_runs_over_whole_tables(spark):
    pieces = rows_of(corpus_pipeline.run(spark, SMALL))
    assert pieces and sum(r["length"] for r in pieces if r["start"] == 0) > 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_toxic_documents_go_and_clean_ones_stay(spark, tables):
    docs = tables["documents"]
    left = {r["doc_id"] for r in corpus_pipeline.clean(spark, docs, FOLDER).select("doc_id").collect()}
    marked = {r["doc_id"]: r["toxic"] for r in tables["labels"].collect()}
    assert np.mean([i in left for i, t in marked.items() if t == 0]) > 0.95
    assert np.mean([i not in left for i, t in marked.items() if t == 1]) > 0.8


def test_words_are_counted_as_the_contract_says(documents):
    got = {r["doc_id"]: r["n"] for r in documents.select(
        "doc_id", mixing.word_count(F.col("text")).alias("n")).collect()}
    assert got == {r["doc_id"]: word_number(r["text"]) for r in documents.collect()}
