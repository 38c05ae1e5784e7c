from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pytest
from conftest_rows import rows_by

from wattsift.llm.html_text import MARK, BlockLabeller, extract_main_text, make_page, page_blocks, trained_labeller


@pytest.fixture(scope="module")
def model():
    return trained_labeller()


def texts(page: str) -> list[str]:
    return [b.text for b in page_blocks(page)]


def test_blocks():
    assert texts("<p>a <b>b</b>c<br>d &amp; &#233;&nbsp;e</p>tail") == ["a bc d & é e", "tail"]
    assert texts("<div>one<p>two<p>three</div>four") == ["one", "two", "three", "four"]
    assert texts("<script>var t='</p>x';</script><style>p{}</style>y<!-- z --><noscript>n</noscript>") == ["y"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts('<p title="a > b">x</p><p class=\'"\'>y') == ["x", "y"]
    assert texts("1 < 2 and <3 & &unknown; <p") == ["1 < 2 and <3 & &unknown; <p"]
    assert texts(None) == texts("") == texts("  <p> </p>") == []
    assert texts("<script>never closed <p>x") == [] and texts("<!-- never closed <p>x") == []
    assert page_blocks('<div id="main"><p class="intro lead">x')[0].path == ("div", "main", "p", "intro", "lead")
    assert [b.path for b in page_blocks("<table><tr><td>a<td>b<tr><td>c</table>")] == [("table", "tr", "td")] * 3


def test_elements_without_text_take_no_more_than_their_own():
    for tag in ("video-player", "svg-icon", "title-bar", "select-box", "script-x", "x"):
        assert texts(f"<article><p>a</p><{tag} src=x></{tag}><p>rest</p></article>") == ["a", "rest"], tag
    for tag in ("<svg class=i/>", "<svg/>", "<MATH />", '<svg viewBox="0 > 1"/>'):
        assert texts(f"<p>one {tag} two</p><p>three</p><svg><path/>gone</svg>") == ["one two", "three"], tag
    for tag in ("template", "select", "svg", "math", "object", "canvas", "video", "audio"):
        assert texts(f"<p>one <{tag} class=i> two</p><p>three</p>") == ["one two", "three"], tag
        assert texts(f"<p>one <{tag}> two</p><p>three</p><{tag}>gone</{tag} ><p>four") == ["one two", "three", "four"], tag
        assert texts(f"<p>a<{tag}>x<{tag}>y</{tag}><i>z</i></{tag}>b</p></{tag}>c") == ["ab", "c"], tag
    assert texts("<p>one <!-- x --!> two</p><p>three<!--> four<!---> five") == ["one two", "three four five"]
    for tag in ("script", "style", "textarea", "title", "iframe", "noscript"):
        assert texts(f"a<{tag}>b</{tag}x><p>c</{tag} x>d") == ["ad"] and texts(f"a<{tag}>b<p>c") == ["a"], tag
        assert texts(f"a<svg><{tag}/></svg><p>rest") == ["a", "rest"], tag
    assert texts("a<svg><style>p > q {}</style><foreignObject><p>x</p></foreignObject><title/></svg><p>rest") == ["a", "rest"]
    assert texts("<svg class=i><p>a</p><script>'<p>'</script>b") == ["a", "b"]
    assert texts("<template><script>'</template>'</script>x</template>y") == ["y"]


def test_many_open_elements_are_read_in_one_pass():
    assert texts("<video>" * 20_000 + "<svg>" * 20_000 + "<p>rest") == ["rest"]


def test_gradients_are_slopes_of_the_loss():
    rng = np.random.default_rng(0)
    net = BlockLabeller(3)
    for k in net.weights:
        net.weights[k] = net.weights[k].astype(np.float64)
    x, mask = rng.normal(size=(4, 2, net.weights["fx"].shape[0])), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    x[2:, 1] = 0
    wanted = rng.integers(0, 2, (4, 2)).astype(float)
    _, slopes = net.gradients(x, mask, wanted)
    for k, w in net.weights.items():
        spot = tuple(rng.integers(0, n) for n in w.shape)
        old, step = w[spot], 1e-3
        w[spot] = old + step
        up = net.gradients(x, mask, wanted)[0]
        w[spot] = old - step
        down = net.gradients(x, mask, wanted)[0]
        w[spot] = old
        assert abs((up - down) / (2 * step) - slopes[k][spot]) < 1e-4, k


def test_labels_do_not_depend_on_the_other_pages(model):
    pages = [page_blocks(make_page(random.Random(i)).replace(MARK, "")) for i in range(30)]
    together = model.main_blocks(pages)
    assert all(np.array_equal(model.main_blocks([p])[0], t) for p, t in zip(pages, together, strict=True))


def test_held_out_accuracy_on_composed_pages(model):
    right = total = 0
    rng = random.Random(4_711)
    for _ in range(200):
        blocks = page_blocks(make_page(rng))
        labels = np.array([b.text.startswith(MARK) for b in blocks])
        for b in blocks:
            b.text = b.text.removeprefix(MARK).strip() or "-"
        right, total = right + int((model.main_blocks([blocks])[0] == labels).sum()), total + len(blocks)
    assert right / total > 0.985


def article(page: str) -> str:
    inner = page[page.find("<article>") :].partition("</article>")[0]
    parts = (re.sub(r"<[^>]*>", "", p) for p in re.split(r"</?(?:p|h1|article|br)>", inner))
    return " ".join(filter(None, (" ".join(entities.unescape(p).split()) for p in parts)))


def test_pages_of_the_table(spark):
    from __spark_entry__ import queries

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    rows = rows_by(queries()["op5_html_text"](spark, "/root/testdata/sf0.001"), "page_id")
    same = [rows[p.page_id][0].text == article(p.html) for p in pages if "</article>" in p.html]
    assert np.mean(same) > 0.97
    assert all(r.n_chars == len(r.text) and r.url for rs in rows.values() for r in rs)


def test_edge_rows(spark, model):
    long = "<article>" + "<p>word and more words here.</p>" * 3_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>x"), (3, "u", "<p>x"), (None, "u", "plain text only"), (4, "u", "<" * 5_000), (5, "u", long)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string").repartition(2)
    found = rows_by(extract_main_text(frame, model=model), "page_id")
    assert sum(map(len, found.values())) == len(rows)
    assert found[1][0].text == found[2][0].text == "" and found[2][0].url is None and found[3][0] == found[3][1]
    assert found[5][0].n_main > 2_900
    assert extract_main_text(frame.where("false"), model=model).count() == 0
