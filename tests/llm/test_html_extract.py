"""Main text of pages: literal pages, the best run against all runs, whole tables."""
import html
import random
import re

from bitext.llm import html_extract as hx

W = hx.DEFAULT_WEIGHTS
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head>
<body><nav><ul><li><a href="/x">Menu</a></li><li><a href="/y">Other</a></li></ul></nav><!-- note <p>x</p> -->
<div class="ad">Buy this now</div><article><h1>A  title</h1><p>First &amp; <b>bold</b>\n text&#33;<p>Second<br>line
<form><input value="x">Name</form><div class="comments"><p>I disagree</p></div><p>caf&eacute; &nbsp; au lait</p>
</article><footer>&copy; someone</footer></body></html>"""


def test_literal_page():
    expected = "A title\nFirst & bold text!\nSecond\nline\ncafé au lait"
    found = hx.tokens(PAGE)
    lo, hi = hx.marked_region(found)
    assert hx.region_text(found[lo:hi]) == expected


def test_best_run_equals_all_runs():
    rnd = random.Random(2)
    for _ in range(300):
        x = [rnd.choice([-3, -1, 0, 1, 2]) for _ in range(rnd.randrange(0, 12))]
        best = max([sum(x[i:j]) for i in range(len(x)) for j in range(i + 1, len(x) + 1)], default=0)
        lo, hi = hx.best_run(x)
        assert sum(x[lo:hi]) == max(0, best)


def test_weights_sign_and_fallback():
    counts = [("word", 900, 100), ("link word", 1, 300), ("p", 50, 0), ("nav", 0, 20), ("odd", 0, 1)]
    w = hx.learn_weights(counts)
    assert w["word"] > 0 > w["nav"] and w["link word"] < 0 < w["p"] and "odd" not in w
    assert hx.learn_weights([]) == hx.DEFAULT_WEIGHTS


def test_odd_pages():
    assert hx.main_text(None, W) == hx.main_text("", W) == hx.main_text("<p></p><br>", W) == ""
    assert hx.main_text("just text &lt;b&gt;", W) == "just text <b>"
    assert hx.main_text("<p>one two <a href='x>y'>three", W).startswith("one two")
    assert hx.main_text("<p>cut off <b cla", W) == "cut off"
    assert hx.main_text("<p>" + "w " * 50_000 + "</p>", W) == ("w " * 50_000).strip()


def test_whole_table(spark):
    from bitext.llm.queries import QUERIES

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op4_html_text"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", inner))
        assert got[p.page_id].text == "\n".join(b for b in blocks if b)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_rows(spark):
    table = spark.createDataFrame([(1, None, None, "a"), (None, "u", PAGE, "b"), (None, "u", PAGE, "b")],
                                  "page_id long, url string, html string, text string")
    got = hx.extract_main_text(table).collect()
    assert sorted((r.page_id is None, bool(r.text)) for r in got) == [(False, False), (True, True), (True, True)]
    assert hx.extract_main_text(table.limit(0)).count() == 0


def learned(spark):
    return hx.page_weights(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_label_tags_do_not_decide(spark):
    """Pages without their <article> tags give the same text, all of them."""
    weights = learned(spark)
    assert not {"article", "/article", "main", "/main"} & set(weights)
    for p in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        bare = re.sub("</?article>", "", p.html)
        assert hx.main_text(bare, weights) == hx.main_text(p.html, weights) != ""


ADVERT, COMMENTS = '<div class="ad">Buy this very nice thing right now</div>', '<ul class="comments"><li>I disagree</li></ul>'
FRAME = "<html><body><nav><ul><li><a href=x>Menu</a></li></ul></nav>%s<footer>&copy; us</footer></body></html>"
FIRST, SECOND = "one two three four five six seven eight nine ten", "eleven twelve thirteen fourteen fifteen sixteen"


def test_never_elements_around_and_inside_the_text(spark):
    for weights in (learned(spark), W):
        for own in (ADVERT, COMMENTS, "<form>Your name <input></form>", "<aside><p>More of this</p></aside>"):
            body = f"{own}<h1>Title</h1><p>{FIRST}</p>{own}<p>{SECOND}{own}"
            for opened, closed in (("", ""), ("<article>", "</article>"), ("<div class=x>", "</div>")):
                got = hx.main_text(FRAME % (opened + body + closed), weights)
                assert got == f"Title\n{FIRST}\n{SECOND}"


def test_scan_alone_leaves_out_frames_with_neutral_names(spark):
    weights = learned(spark)
    short = '<div class="q7"><p>Buy this now</p></div>'
    page = f"<html><body>{short}<h1>Title</h1><p>{FIRST}</p><p>{SECOND}</p>{short}</body></html>"
    assert hx.main_text(page, weights) == f"Title\n{FIRST}\n{SECOND}"
    assert "Buy" in hx.region_text(hx.tokens(page))


def test_whole_class_names_only():
    for name in ("section-header", "entry-header", "social-history", "price-notice", "download", "thread-ad-free"):
        assert hx.main_text(f'<div class="{name}">{FIRST}</div>', W) == FIRST
        assert hx.main_text(f'<p data-id="ad" title="hidden menu" class="{name}">{FIRST}</p>', W) == FIRST
    for attributes in ('class="x ad y"', "id=sidebar", "hidden", "role=navigation", 'aria-hidden="true"'):
        assert hx.main_text(f"<p>{FIRST}</p><div {attributes}>gone</div>", W) == FIRST


def test_ends_of_never_elements():
    assert hx.main_text(f"<div><form>gone <b>too</div><p>{FIRST}", W) == FIRST  # ends with its parent
    assert hx.main_text(f'<p class="ad">gone<p>{FIRST}', W) == FIRST
    listed = hx.tokens(f'<ul><li class="ad">gone<li>{SECOND}</ul>')  # the next item ends it
    assert hx.region_text(listed) == SECOND and hx.never_elements(listed) == [0, 1, 2, 0, 0, 0]
    assert hx.main_text(f"<head><title>t</title><p>{FIRST}", W) == FIRST
    assert hx.main_text(f"<nav>gone</b></nav></nav></i><p>{FIRST}</section>", W) == FIRST
    assert hx.main_text("<div>" * 20_000 + "<p>" + FIRST, W) == FIRST
