"""Classifier, quality rules, HTML extraction, preference pairs and the pipeline."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from barstream.llm import queries
from barstream.llm.html_extraction import extract, main_text, minimum_cut
from barstream.llm.preferences import preference_format, swapped_answers
from barstream.llm.quality_classifier import ByteNetwork, score, train
from barstream.llm.quality_rules import quality_rules
from tests.llm.conftest import words


def test_gradients_are_those_of_the_loss():
    network = ByteNetwork.start(3)
    for name in ("embed", "filters", "bias", "weights", "shift"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    texts = [np.frombuffer(words(n, n).encode(), np.uint8) for n in (3, 150, 400)]
    labels = np.array([1, 0, 1.0])

    def loss():
        z = network.logits(texts).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(np.where(labels == 1, -z, z)))))

    gradients = network._gradients(texts, labels)
    for part, gradient, place in zip((network.embed, network.filters, network.bias, network.weights, network.shift), gradients,
                                     [(ord("e"), 1), (5, 2), (2,), (3,), (0,)]):
        before, step = part[place], 1e-3
        part[place] = before + step
        high = loss()
        part[place] = before - step
        low = loss()
        part[place] = before
        assert abs((high - low) / (2 * step) - gradient[place]) < 2e-3


def test_every_byte_is_in_a_chunk_and_every_filter_place_in_one():
    network = ByteNetwork.start()
    for n in (0, 1, 8, 511, 512, 513, 1018, 1019, 5000):
        text = np.arange(n, dtype=np.int64).astype(np.uint8)
        chunks = network.chunks(text)
        places = {(i * 506 + j) for i in range(len(chunks)) for j in range(0, 505, 2)}
        assert {p for p in range(0, n - 7, 2)} <= places and max([*places, 0]) + 8 >= n


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    right = Counter((r.quality, r.predicted) for r in rows)
    assert (right[0, 0] + right[1, 1]) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_scores_of_odd_rows(spark, documents, no_documents, texts):
    network = ByteNetwork.start()
    rows = score(documents, network).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert score(no_documents, network).count() == 0
    none = spark.createDataFrame([(None, 1), (1, None), (999, 1)], "doc_id long, quality int")
    assert score(documents, train(documents, none)).where("score <> 0.5").count() == 0
    one = spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, quality int")
    assert score(documents, train(documents, one)).where("score < 0.9").count() == 0


def test_quality_rules(spark, documents, no_documents, texts):
    for r in quality_rules(documents).collect():
        pass
    odd = [(1, None), (2, ""), (3, "a b c a b c a b c"), (4, "One line here.\nOne line here.\n\n  \nhome\nclick here now.\nx | y | z | w\nno end"),
           (5, "\x0bword\x0cword\rword " * 60), (6, "# * $ % & | < >"), (7, words(60, 1) + "."), (8, (words(30, 2) + ".\n") * 2), (9, "日本 語。 " * 40)]
    rows = {r.doc_id: r for r in quality_rules(spark.createDataFrame(odd, "doc_id long, text string")).collect()}
    for i, t in odd:
        t, r = t or "", rows[i]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        counts = Counter(grams)
        hit = {j + k for j, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
    assert rows[4].cleaned == "One line here.\nOne line here." and rows[7].kept and not rows[1].kept
    assert quality_rules(no_documents).count() == 0


@given(st.lists(st.integers(-5, 5), min_size=1, max_size=7), st.data())
@settings(max_examples=80, deadline=None)
def test_minimum_cut(scores, data):
    pairs = list(itertools.combinations(range(len(scores)), 2))
    edges = [(*p, data.draw(st.integers(0, 3))) for p in pairs if data.draw(st.booleans())]

    def cost(labels):
        return (sum(-s for s, x in zip(scores, labels) if s < 0 and x) + sum(s for s, x in zip(scores, labels) if s > 0 and not x)
                + sum(w for a, b, w in edges if labels[a] != labels[b]))

    assert cost(minimum_cut(scores, edges)) == min(cost(x) for x in itertools.product([False, True], repeat=len(scores)))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><h1>Site</h1></header>
<ul id="menu"><li><a href="/">Home</a><li><a href="/x">News</a></ul><div class="cookie-notice">We use cookies to improve our site.</div>
<article><h1>The   title</h1><p>First &amp; best<br>line.<p>Second <b>bold</b> line&nbsp;here.<div class="ad">Buy now, today only, a lot.</div>
<script>var x = "<p>no</p>";</script><p>End.</article><aside><p>Other things to read, with many words in it, really.</p></aside>
<section class="comments"><p>I liked it, thank you for all this work you put in.</p></section><footer>&copy; all of us</footer>"""


def test_main_text():
    assert main_text(PAGE) == "The title\nFirst & best line.\nSecond bold line here.\nEnd."
    assert main_text(PAGE.replace("article>", "div>").replace("<div><h1>The", '<div class="post-content"><h1>The')) == main_text(PAGE)
    assert main_text("") == main_text("<nav><a href=x>y</a></nav>") == main_text("<<<>>> & <p") == ""
    assert main_text("<div>" * 3000 + "<p>deep and long enough to count as text, so it stays.</p>").startswith("deep")


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar">{}</div>', '<div class="overflow-hidden">{}</div>', '<form id="page">{}</form>',
    '<div class="more"><div class="row">{}</div></div>', '<form class="search"><div class="sidebar"><div>{}</div></div></form>'])
@pytest.mark.parametrize("holder", ["<article>{}</article>", "<main>{}</main>", '<div role="main">{}</div>', "<div>{}</div>"])
def test_a_name_far_above_does_not_remove_the_article(wrap, holder):
    paragraphs = [" ".join(f"word{i}" for i in range(30)) + f" number {k}." for k in range(3)]
    article = "<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    around = ('<ul class="menu"><li><a href="/">Home</a></ul>{}<aside class="related"><div class="x"><p>Other things to read, with many words in it, '
              'really.</p></div></aside><section class="comments"><p>I liked it, thank you for all this work you put in.</p></section>')
    assert main_text("<body>" + wrap.format(around.format(holder.format(article)))) == "\n".join(["Title", *paragraphs])


def test_nearest_names_count_and_firm_elements_stay():
    long = " ".join(f"word{i}" for i in range(30)) + "."
    assert main_text(f"<article><p>{long}</p><div class='ad'><p>{long}</p></div></article><footer><div class='x'><p>{long}</p></div></footer>") == long
    assert main_text(f"<div style='display:none'><article><h1>No</h1><p>{long}</p><p>{long}</p></article></div>") == ""
    assert main_text(f"<aside><article class='card'><h1>No</h1><p>{long}</p><p>{long}</p></article></aside>") == ""


def test_elements_end_where_they_are_closed():
    long = "This paragraph is long enough to be text, and it has to stay."
    page = "<article><h1>Title</h1><svg class='icon' aria-hidden='true' />{}<p>" + long + "</p></article>"
    for between in ("", "<svg/>", "<title-bar></title-bar>", "<select-box>", "<svg viewBox='0 0 9 9'><path d='M0'/><text>no</text></svg>", "<iframe src=x>",
                    "<script>var a = '<p>no';</script >", "<template><p>no</p></template>", "<svg><title>no</title></svg>", "<STYLE>no</style>"):
        assert main_text(page.format(between)) == "Title\n" + long
    assert main_text(page.format("<p>" + long + "</p><svg></svg>")) == "Title\n" + long + "\n" + long
    assert main_text(page.format("<script>never closed")) == "Title"


def test_extract_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [
        (1, "u", main_text(PAGE), len(main_text(PAGE)))] * 2 + [(None, None, "", 0), (2, "v", "", 0)]))
    assert extract(pages.limit(0)).count() == 0


def test_pages_give_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    import html
    for r in queries.op9_html_extraction(spark, "/root/testdata/sf0.001").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_preference_format(spark):
    turns = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "good"), (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "bad"),
        (1, "rejected", 1, "assistant", "bad"), (2, "chosen", 0, "user", "only"), (3, "chosen", 0, None, None), (3, "rejected", 0, "", ""),
        (4, "chosen", 5, "system", "s"), (4, "chosen", 7, "user", "a"), (4, "rejected", 1, "system", "s"), (4, "rejected", 2, "user", "b"),
        (4, "rejected", 3, "assistant", "c"), (None, "chosen", 0, "user", "x"), (None, "rejected", 0, "user", "x"), (5, "other", 0, "user", "x"), (5, None, None, None, None)]
    frame = spark.createDataFrame([(*t, 9) for t in turns], "pair_id long, side string, turn long, role string, text string, prompt int")
    rows = {r.pair_id: r for r in preference_format(frame).collect()}
    assert set(rows) == {1, 3, 4}
    assert rows[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and rows[1].chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    assert rows[1].rejected_mask == "0:22,1:14" and rows[1].n_prefix_turns == 1
    assert rows[3].n_prefix_turns == 1 and rows[3].chosen == rows[3].rejected == rows[3].chosen_mask == ""
    assert rows[4].n_prefix_turns == 1 and rows[4].rejected.count("<|im_end|>") == 2 and rows[4].chosen_mask == "0:17,0:12"
    assert preference_format(frame.limit(0)).count() == 0


def test_swapped_answers(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a2"), (2, 2, "user", "more"), (3, 0, "user", "q3"), (3, 1, "assistant", "a3"),
            (4, 0, "user", "alone"), (5, None, "assistant", "x"), (None, 0, "assistant", "y"), (6, 1, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.pair_id, r.turn, r.text) for r in swapped_answers(frame).where("side = 'rejected'").collect()}
    assert got == {(2, 0, "q"), (2, 1, "a3"), (3, 0, "q3"), (3, 1, "a2")}


def test_pipeline_stages(spark, sf):
    """Every stage on what the one before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    from barstream.llm.tables import stored
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "stage")
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[1] < counts[0] and counts[-1] < counts[2]
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_columns_of_contract(spark, sf, name):
    wanted = {
        "op2_quality_classifier": {"doc_id", "held_out", "score", "predicted"}, "op5_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
        "op6_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}, "op9_html_extraction": {"page_id", "url", "text", "n_chars"},
        "op4_substring_dedup": {"doc_id", "class_id"}}
    assert wanted[name] <= set(queries.QUERIES[name](spark, sf).columns)


@pytest.mark.parametrize("page, kept", [
    ("<a" * 100_000, False), ("a<b " * 100_000, True), ("a<b " * 50_000 + ">", False), ("<a \">x'" * 50_000, False), ("<a '\"> " * 50_001, False),
    ("<x y='" * 50_000 + ">", False), ("<div>x" * 20_000, False), ("<nav>x" * 20_000, False), ("<b>" * 20_000 + "<div>y</div>" * 20_000, False),
    ("<div>" * 20_000 + "</p>" * 20_000 + "x", False), ("<p>one two three. " * 20_000, True), ("<!--" * 100_000, False), ("<svg>" * 50_000, False),
    ("<" * 200_000 + ">", False)])
def test_broken_pages_take_linear_time(page, kept):
    from time import perf_counter

    begin = perf_counter()
    assert bool(main_text(page)) == kept
    assert perf_counter() - begin < 8  # a second or so on an idle machine


def test_deep_elements_keep_their_holders():
    """A block under many inline elements keeps its element; an article in a nav does not count as the page's main one,
    however many bad elements lie between (the nav's cost itself falls with the distance)."""
    from barstream.llm.html_extraction import blocks_of

    (block,) = blocks_of("<section><blockquote>" + "<b>" * 50 + "words")
    assert block.tag == "blockquote" and block.parent == 1 and block.above == 0
    long = "A sentence that is long enough to be the text of some article, with many words in it, and more of them. " * 2
    for between in (3, 40):
        page = ("<nav>" + "<div class='menu'>" * between + f"<article><h1>No</h1><p>{long}</p></article>" + "</div>" * between
                + f"</nav><article><p>{long}</p></article>")
        assert [(b.inside, len(b.hints)) for b in blocks_of(page)] == [(False, 1), (False, 1), (True, 0)]


def test_stages_keep_columns_named_like_helpers(spark):
    """Columns called as the stages' helper columns come out as they went in."""
    from barstream.llm.decontamination import decontaminate
    from barstream.llm.jaccard_join import near_copies_removed
    from barstream.llm.suffix_dedup import without_repeats

    shared = " ".join(f"word{i}" for i in range(90))
    names = ["_row", "_ID", "_k1", "_k2", "_kept", "_score", "row", "id"]
    docs = spark.createDataFrame([(i, f"text {i} {'x' * i} " + (shared if i > 2 else "short"), *[f"{n}{i}" for n in names]) for i in range(5)],
                                 "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, "no such words")], "item_id long, text string")
    for result in (without_repeats(docs), decontaminate(docs, items), near_copies_removed(docs)):
        assert result.columns == docs.columns
        rows = result.collect()
        assert len(rows) >= 3 and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
