import numpy as np
import pytest

from bluelines.llm import html_text
from bluelines.llm.bilstm import BiLSTM, pad
from bluelines.llm.blocks import blocks
from bluelines.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(table(spark, SF, "pages"))


def frame(spark, rows):
    return spark.createDataFrame([(i, "u", h, "x", 1) for i, h in rows], "page_id long, url string, html string, text string, n_chars long")


def test_gradients_against_differences():
    rng = np.random.default_rng(3)
    net = BiLSTM(3, hidden=4, seed=5)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = pad([rng.normal(size=(n, 3)) for n in (5, 2, 4)])
    x, mask = x.astype(np.float64), mask.astype(np.float64)
    y = (rng.random((5, 3)) < 0.5).astype(float)

    def loss():
        p = net.forward(x, mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask[:, :, 0]).sum() / mask.sum()

    for name, g in net.gradients(x, mask, y).items():
        flat = net.p[name].reshape(-1)
        for k in rng.integers(0, flat.size, 4):
            old = flat[k]
            flat[k] = old + 1e-3
            up = loss()
            flat[k] = old - 1e-3
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-3 - g.reshape(-1)[k]) < 1e-3


def test_uses_context_of_both_sides():
    rng = np.random.default_rng(1)
    x = [rng.integers(0, 2, (rng.integers(3, 9), 1)).astype(np.float32) for _ in range(600)]
    y = [np.array([s[max(0, k - 1), 0] * s[min(len(s) - 1, k + 1), 0] for k in range(len(s))], np.float32) for s in x]
    net = BiLSTM(1, hidden=12).fit(x, y, epochs=25, rate=0.02)
    assert np.mean(np.concatenate([(p >= 0.5) == t for p, t in zip(net.predict(x), y)])) > 0.97


def test_blocks():
    got = blocks("""<!doctype html><head><title>T &amp; t</title><script>var x="<p>no</p>";</script><style>p{}</style></head><body class="a-b c">
      <p>one<b>bold</b> two<br>three<p id=x>four&nbsp;&lt;<a href="q>r">link</a> <ul><li>five<li>six</ul><!-- <p>not</p> --> tail 3 < 4 <td>seven</td>""")
    assert [b.text for b in got] == ["T & t", "onebold two", "three", "four <link", "five", "six", "tail 3 < 4", "seven"]
    assert got[1].path == ("body", ".a", ".b", ".c", "p") and got[3].path == ("body", ".a", ".b", ".c", "p", ".x") and got[3].linked == 4
    assert blocks(None) == blocks("") == blocks("<!-- open") == blocks("<script>open") == []
    assert [b.text for b in blocks("<p>a</div>b<p class='x")] == ["a", "b"]
    assert len(blocks("<div>" * 5000 + "deep" + "</div>" * 5000)) == 1
    assert [b.text for b in blocks("x &#233; &eacute; &bogus; &#x41;")] == ["x é é &bogus; A"]



def test_skipped_elements_end_where_they_end():
    main, rest = "<article>main</article>", ["a", "main", "b"]
    for odd in ('<svg class="i"/>', "<svg-icon src=x></svg-icon>", "<select>", "<object data=x>", "<svg>", "<iframe src=x>", "<template>", "<noscript>",
                "<svg>no<svg/>no<svg>no</svg>no</svg>", "<SELECT><option>no</SELECT >", "<object>no<object>no</object>no</object>", "<style-guide></style-guide>"):
        assert [b.text for b in blocks(f"<p>a</p>{odd}{main}<p>b</p>")] == rest, odd
    # an element that is never closed does not end with a later one of its name
    assert [b.text for b in blocks(f"<p>a</p><select>{main}<p>b</p><select><option>no</select>")] == rest
    assert [b.text for b in blocks(f"<p>a</p><script>no</script x>{main}<p>b</p><style>no")] == rest


def test_given_pages_give_the_article(spark, model):
    for r in table(spark, SF, "pages").collect():
        want = " ".join(b.text for b in blocks(r.html) if "article" in b.path)
        assert html_text.texts(model, [r.html]) == [want] and want


def test_other_templates(model):
    prose = ["Onre thble in the and erinon thatly, of and the. Nd with to the erti onen anreing hein.", "Thtion reed and of the inly. Eran thedes, stth in a the ofreat inonan.", "The as thion onin erst, and re the. It inti erre on the ndes thleing."]
    body = "".join(f"<p>{p}</p>" for p in prose)
    for opening, closing in (("<div class='content'>", "</div>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ("<div class='entry-content'>", "</div>")):
        page = (f"<html><head><title>Site</title></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></nav>"
                f"<div class='cookie-notice'>We use cookies</div>{opening}{body}{closing}<aside><p>Most read</p></aside>"
                f"<section class='comments'><p>Great read, thanks.</p></section><form><label>Mail</label></form><footer>(c) Site</footer></body></html>")
        assert html_text.texts(model, [page]) == [" ".join(prose)], opening


def test_made_pages(spark, model):
    import random

    r, right, total = random.Random(4), 0, 0
    for row in table(spark, SF, "pages").limit(200).collect():
        found = blocks(row.html)
        made = html_text._variant([b for b in found if html_text.weak_label(b.path)], [b for b in found if not html_text.weak_label(b.path)], r)
        if made:
            p, = model.predict([np.stack([html_text.vector(b) for b, _ in made])])
            right += ((p >= 0.5) == np.array([y for _, y in made])).sum()
            total += len(made)
    assert right / total > 0.97


def test_edge_cases(spark):
    pages = [(i, f"<html><body><nav><a>Menu {i}</a></nav><article><p>Text of page {i}, which is long enough to be read. " + "word " * i + "</p></article></body></html>") for i in range(60)]
    odd = [(100, None), (101, ""), (102, "   "), (103, "<nav>Menu</nav>"), (104, "<article><p>" + "long " * 60000 + "</p></article>"), (105, "<article>" + "<p>many blocks</p>" * 3000), (None, pages[0][1]), (0, pages[0][1])]
    got = html_text.extract(frame(spark, pages + odd))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = [tuple(r) for r in got.collect()]
    by = {r[0]: r for r in rows}
    assert len(rows) == 68 and all(by[i][2:] == ("", 0) for i in (100, 101, 102)) and all(len(r[2]) == r[3] for r in rows)
    assert by[104][3] == 5 * 60000 - 1 and by[105][3] == 12 * 3000 - 1 and by[None][2] == by[0][2] == "Text of page 0, which is long enough to be read."
    assert html_text.extract(frame(spark, [])).count() == 0
    assert [tuple(r)[2:] for r in html_text.extract(frame(spark, [(1, None)])).collect()] == [("", 0)]


def test_long_attributes_are_no_text():
    long = "a > b < c " * 20_000
    got = blocks(f"""<article><p data-x="{long}" class=one>first</p><p title='{long}"' id="two">second</p><p title=it's>third</p><a href="x'>4</a></article>""")
    assert [b.text for b in got] == ["first", "second", "third", "4"]
    assert got[0].path == ("article", "p", ".one") and got[1].path == ("article", "p", ".two")


def test_unclosed_quotes_take_linear_time():
    import time

    start = time.time()
    for odd in ('<a "', "<a x='", '<a x="<a y=\'', "<a =", '<a x="y" z="'):
        assert blocks(odd * 20_000 + "<p>end</p>") is not None
    assert time.time() - start < 20


@pytest.mark.parametrize("depth", [150, 199, 200, 230, 5000])
def test_end_tags_below_deep_elements_close_their_own(depth):
    for outer in ('<div class="page"><article>', '<div class="content">'):
        got = blocks("<body>" + outer + "<div>" * depth + "deep" + "</div>" * depth + "<p>after</p>")
        path = blocks("<body>" + outer + "<p>after</p>")[0].path
        assert [b.text for b in got] == ["deep", "after"] and got[1].path == path
        assert len(got[0].path) <= 210
