"""Operators that learn: held-out accuracy and edge cases."""

import numpy as np
import pytest

from foliograph.llm import decision_list, html_text, language_id, rule_ensemble, trees
from foliograph.llm._common import components

SF = "/root/testdata/sf0.01"


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = language_id.op3_language_id(spark, SF).join(docs, "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97 and got["score"].between(0, 1).all()


def test_language_id_edges(docs, empty):
    learned = language_id.learn(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, learned, "doc_id").collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[7].lang_pred == "und" and got[3].rejected and got[3].score == 0
    many = docs.sparkSession.createDataFrame([(k, f"wort{k % 90} und noch {k} mehr davon", f"l{k % 90}") for k in range(900)] + [(7, "immer das gleiche", "l1")] * 500, "doc_id long, text string, lang string")
    assert len(language_id.learn(many)) == 90  # every language, however many
    long = docs.sparkSession.createDataFrame([(1, "anfang " * 3000 + "zwischendrin " * 3000 + "schluss " * 3000, "de")], "doc_id long, text string, lang string")
    assert {b"anfang", b"zwischendrin", b"schluss"} <= set(language_id.learn(long)["de"].split())  # not a prefix
    twice = {(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs.union(docs), learned, "doc_id").collect()}
    assert len(twice) == len({(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, learned, "doc_id").collect()})
    assert language_id.learn(empty) == {} and language_id.identify(docs, {}, "doc_id").where("lang_pred <> 'und'").count() == 0


def test_quality_rules(spark, docs, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = decision_list.op8_quality_rules(spark, SF).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert (got["kept"] == (got["quality"] == 1)).mean() > 0.97
    few = labels.where("false")
    assert decision_list.fit(docs, few) == [] and decision_list.fit(empty, labels) == []
    rows = {r.doc_id: r for r in decision_list.judge(docs, []).collect()}
    assert rows[3].base_failed and not rows[3].kept and rows[5].kept and rows[5].n_words == 6000
    assert decision_list.judge(empty, []).count() == 0


def test_rules_grow_and_prune():
    draw = np.random.default_rng(0)
    x = draw.random((1500, 12))
    bad = (x[:, 3] > 0.7) & (x[:, 5] <= 0.5) | (x[:, 1] > 0.9)
    rules = decision_list.learn(x, 1.0 - bad)
    got = np.any([trees.holds(x, t) for t in rules], axis=0)
    assert (got == bad).mean() > 0.95 and len(rules) >= 2


def test_quality_scores(spark, docs, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = rule_ensemble.op9_quality_scores(spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95 and got["score"].between(0, 1).all()
    plain = rule_ensemble.fit(docs, labels.where("false"))
    assert {r.score for r in rule_ensemble.score(docs, plain).collect()} == {0.5}
    assert rule_ensemble.score(empty, plain).count() == 0


PAGES = [
    ('<body class="no-thing"><div id=nav><a href=x>Home</a> <a>About</a></div><div class="content"><h1>Title here</h1><p>Text &amp; more <a>link</a> of it all.<p>Second &lt;b&gt;<br>line<div class="cookie-notice">We use cookies</div>'
     '<div id="comments"><p>Great article</p></div></div><form><label>Name</label><input></form>', ["Title here", "Text & more link of it all.", "Second <b> line"]),
    ("<html><head><title>t</title><script>var t='</p>';</script></head><nav><ul><li><a>The</a></li></ul></nav><article><h1>H</h1><p><b>open<br><p>a</p><p>b  c</p></article><footer>&copy; x</footer>", ["H", "open", "a", "b c"]),
    ("<p>Just text</p>", ["Just text"]), ("plain a < b", ["plain a < b"]), ("", []), (None, []), ("<article><p>cut", ["cut"]),
]


@pytest.mark.parametrize("page,blocks", PAGES)
def test_main_text(page, blocks):
    assert html_text.main_blocks(page) == blocks


def test_extract(spark):
    pages = spark.createDataFrame([(i, "u", p, "clash") for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text.extract(pages, "page_id", "url").collect()}
    assert all(got[i].text == "\n\n".join(b) and got[i].n_chars == len(got[i].text) for i, (_, b) in enumerate(PAGES))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7), (200, 201), (200, 202)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[100] == 99 and got[202] == got[201] == got[200] == 200


def test_article_inside_named_layout():
    text = " ".join(f"word{k}" for k in range(60)) + "."
    body = f"<h1>The title of it</h1><p>{text}</p><p>{text}</p>"
    for wrapper in ("class='layout has-sidebar'", "id='content-with-sidebar'", "class='sidebar-layout'"):
        assert html_text.main_blocks(f"<body><div {wrapper}><article>{body}</article></div></body>") == ["The title of it", text, text]
    assert html_text.main_blocks(f"<article class='post tag-x has-comments tags'><header><h1>The title of it</h1><div>By someone</div></header><p>{text}</p></article>") == ["The title of it", text]
    assert html_text.main_blocks(f"<article>{body}</article><div class='comments'><article><p>{text}</p></article></div>") == ["The title of it", text, text]
    assert html_text.main_blocks(f"<article><p>{text} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></article>") == [f"{text} x=1"]


def test_links_beside_main_text_and_names_that_only_hint():
    text = " ".join(f"word{k}" for k in range(40)) + "."
    end = "The last paragraph is short."
    got = html_text.main_blocks(f"<article><h1>Title</h1><p>{text}</p><p>{end}</p></article><footer><a href=/>Home page</a></footer>")
    assert got == ["Title", text, end]
    assert html_text.main_blocks(f"<article><h1>Title</h1><p>{text}</p><p>{end}</p></article><div><a href=/>Home page</a></div>") == ["Title", text, end]
    assert html_text.main_blocks(f"<article><p>{text}</p><p><a href=/x>Read this other piece</a></p><p>{end}</p></article>") == [text, "Read this other piece", end]
    hints = f'<article><p>{text}</p><div class="share-price">The share price rose</div><p class="sponsored-by-none">Nobody paid for this.</p><div class="share-buttons">Share this</div></article>'
    assert html_text.main_blocks(hints) == [text, "The share price rose", "Nobody paid for this."]
    for at in range(5):  # links at every place of an article, and around it
        blocks = [f"<p>{text} {k}</p>" for k in range(4)]
        blocks.insert(at, "<p><a href=/y>a linked line</a></p>")
        page = f"<nav><a href=/>Home</a></nav><a href=/>top</a><article>{''.join(blocks)}</article><div><a href=/>next</a></div>"
        got = html_text.main_blocks(page)
        assert len(got) == 5 and got[at] == "a linked line"


def test_tree_uses_words_and_neighbours():
    used, todo = set(), [html_text.tree()]
    while todo:
        node = todo.pop()
        if node.low is not None:
            used.add(html_text.FEATURES[node.column])
            todo += [node.low, node.high]
    assert {"density", "furniture", "main"} <= used and used & {"words", "words_before", "words_after"} and used & {"density_before", "density_after", "words_before", "words_after"}
