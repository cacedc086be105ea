import html
import json
import random
import re

from sedimenta.llm import wrappers

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id=cookie-notice>We use</div><div class="wrap sidebar-left"><nav>m</nav>
<main><article class="post comments-open"><header><h1>T&eacute;</h1></header><p>One <b>two</b>
 three<p>Four<ul><li>a<li>b</ul><div class="ad-slot">buy</div><form><input>f</form><section class="comments"><article class=comment>c1</article></section><footer>by</footer></article></main>
<aside>s</aside></div><footer>f</footer></body></html>"""


def plain(page):
    """What the given pages hold: headings and paragraphs of their article."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in wrappers.extracted(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(plain(r.html)) and got[r.page_id].url == r.url


def test_boilerplate_goes_and_content_stays():
    assert wrappers.main_text(PAGE) == "Té\nOne two three\nFour\na\nb"
    assert wrappers.main_text("<body><div class=menu>m</div><div><div><p>Long text of the page</p>tail &lt;b&gt;<br>x</div></div><div>short</div></body>") == "Long text of the page\ntail <b> x\nshort"
    layout = "<body><div class='layout with-sidebar'><div class=content><p>Body text</p></div><div class=sidebar>s</div></div><div id=comments><div class=content>much more text than there is in the body of it</div></div>"
    assert wrappers.main_text(layout) == "Body text"
    assert wrappers.main_text("<body><div class='wrap sidebar-left'><article class='post comments-open'><p>Body</p></article></div>") == "Body"
    assert wrappers.main_text("<!-- <p>no</p> --><script>a='<p>no</p>'</script>plain &amp;amp; text") == "plain &amp; text"
    assert wrappers.main_text(None) == "" and wrappers.main_text("<p></p>") == ""
    assert wrappers.main_text("<div>" * 5000 + "deep") == "deep"
    assert wrappers.main_text("<article>" + "".join(f"<p>p {i}</p>" for i in range(3000)) + "</article>").count("\n") == 2999


def test_expressions():
    one = wrappers.folded(wrappers.tree("<ul><li>a</ul><p>x"))
    many = wrappers.folded(wrappers.tree("<ul><li>a<li>b<li>c</ul><hr><p>x"))
    assert wrappers.expression(wrappers.aligned(one, many)) == "<><ul>(<li>#</>)+</>(<hr></>)?<p>=</></>"
    pairs = wrappers.folded(wrappers.tree("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))
    assert wrappers.expression(pairs) == "<><dl>((<dt>=</><dd>=</>))+</></>"


def test_choices_dont_depend_on_order():
    parts = [wrappers.folded(wrappers.tree(p)) for p in (PAGE, PAGE.replace("<aside>s</aside>", ""), "<body><main><article><p>q</article></main></body>", "<body><p>x</p></body>")]
    found = set()
    for shift in range(4):
        order = parts[shift:] + parts[:shift]
        out = order[0]
        for p in order[1:]:
            out = wrappers.aligned(out, p)
        found.add(str(wrappers.choices(out)))
    assert len(found) == 1


def test_a_host_decides_for_its_pages(spark):
    side = "<div class=a><p>{}</p></div><div class=b><p>{}</p></div>"
    rows = [(i, "http://h/x", side.format("long text of the page " * 20, f"side {i}"), "t") for i in range(20)]
    rows += [(100, "http://h/y", side.format("short", "this side is longer than it"), "t"), (101, None, None, "t"), (None, "bad url", "<article>x y</article>", "t"), (100, "http://h/y", side.format("short", "this side is longer than it"), "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = wrappers.extracted(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[100] == "short\nthis side is longer than it" and by[101] == "" and by[None] == "x y"
    assert wrappers.extracted(pages.where("false")).count() == 0


def test_text_beside_the_densest_part_stays():
    quote = "a quote that holds most of the text of this page " * 3
    assert wrappers.main_text(f"<body><h1>T</h1><p>lead<blockquote>{quote}</blockquote><p>end") == f"T\nlead\n{quote.strip()}\nend"
    assert wrappers.main_text(f"<body><h1>T</h1><div>{quote}</div><p>end") == f"T\n{quote.strip()}\nend"
    assert wrappers.main_text(f"<body><div class=post-intro>intro</div><div class=post-body>{quote}</div>") == f"intro\n{quote.strip()}"
    assert wrappers.main_text(f"<main><h1>T</h1><p>lead</p><article>{quote}</article></main>") == f"T\nlead\n{quote.strip()}"


def test_deep_elements_count():
    for depth in (90, 99, 100, 101, 150, 30000):
        deep = "<div>" * depth + "<p>a</p><p>b</p><nav>n</nav><form>f</form><div class=comments>c</div><div class='wrap sidebar-left'><article><p>d</p></article></div>" + "</div>" * depth
        text = wrappers.main_text(f"<article>{deep}<p>behind</p></article>")
        assert text == "a\nb\nd\nbehind", depth


MEANINGLESS = """<body><div class=q1><a href=/>Home</a> <a href=/n>News</a><ul><li>All<li>Old<li>New</ul></div>{top}<div class=q2><h1>{title}</h1><p>{text}</p><p>{more}</p></div><div class=q3><span>Read our terms before you use this site, all rights are reserved for all of it.</span></div></body>"""


def meaningless(i):
    return MEANINGLESS.format(top="<div class=q4>A note that stands on most pages.</div>" if i % 3 else "", title=f"Title {i}", text=f"Text of page {i} " * (3 + i % 5), more=f"More words, {i * i}")


def wrapper_of(pages):
    out = None
    for page in pages:
        own = wrappers.folded(wrappers.tree(page))
        out = own if out is None else wrappers.aligned(out, own)
    return out


def test_what_repeats_on_a_host_goes_whatever_its_name(spark):
    pages = spark.createDataFrame([(i, "http://h/x", meaningless(i)) for i in range(40)], "page_id bigint, url string, html string")
    want = {i: f"Title {i}\n{(f'Text of page {i} ' * (3 + i % 5)).strip()}\nMore words, {i * i}" for i in range(40)}
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == want
    # Only the wrapper knows: a page by itself keeps what repeats.
    assert all(s in wrappers.main_text(meaningless(4)) for s in ("Home News", "A note", "Read our terms"))


def test_string_mismatches_become_slots():
    own = wrappers.expression(wrapper_of(["<p>same</p><div>a</div><ul><li>x<li>y</ul>", "<p>same</p><div>b</div><ul><li>x<li>y</ul>"]))
    assert own == "<><p>=</><div>#</><ul>(<li>=</>)+</></>"


def test_same_text_stays_where_it_is_content():
    article = "<body><div class=a>Menu of it</div><article><p>Same in all.</p><p>{}</p></article></body>"
    chosen = wrappers.choices(wrapper_of([article.format(i) for i in range(5)]))
    assert wrappers.main_text(article.format(3), chosen) == "Same in all.\n3"
    # One page again and again has no template, nor have two pages.
    page = meaningless(4)
    assert wrappers.main_text(page, wrappers.choices(wrapper_of([page] * 5))) == wrappers.main_text(page)
    assert wrappers.main_text(page, wrappers.choices(wrapper_of([page, meaningless(5)]))) == wrappers.main_text(page)


def test_long_lists_of_many_kinds_align():
    rng = random.Random(4)
    pages = ["<article>" + "".join(f"<{(t := rng.choice(['p', 'h2', 'div', 'section', 'pre']))}>{k}</{t}>" for k in range(4000)) + "</article>" for _ in range(3)]
    found = wrapper_of(pages)
    assert wrappers.main_text(pages[0], wrappers.choices(found)).count("\n") == 3999


def test_a_hot_host_is_merged_by_levels(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    pages = spark.createDataFrame([(i, "http://h/x", meaningless(i % 7)) for i in range(120)], "page_id bigint, url string, html string").repartition(12)
    (row,) = wrappers.wrappers(pages).collect()
    assert row.host == "h" and json.loads(row.wrapper)[5] == 120


def test_no_text_goes_for_its_size_beside_another():
    big, small = "word " * 83 + "x", "text " * 39 + "y"
    assert wrappers.main_text(f"<body><div class=a><p>{big}</p></div><div class=b><p>{small}</p></div>") == f"{big}\n{small}"


def test_headings_and_quotes_between_texts_that_differ_stay(spark):
    page = "<body><div class=x1><a href=/>Home</a> <a href=/n>News</a></div><div class=x2><p>Opening {0} {0}</p><h2>Summary</h2><p>Middle {0}</p><blockquote>Quoted refrain</blockquote><p>Closing {0}</p></div>"
    pages = spark.createDataFrame([(i, "http://h/x", page.format(i)) for i in range(5)], "page_id bigint, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extracted(pages).collect()} == {i: f"Opening {i} {i}\nSummary\nMiddle {i}\nQuoted refrain\nClosing {i}" for i in range(5)}


def test_names_within_content_need_other_evidence(spark):
    assert wrappers.main_text("<div class=story><p>One</p><div class='related-story'><p>Two</p></div></div>") == "One\nTwo"
    assert wrappers.main_text("<div id=main><p>One</p><div class='social-history'>Two</div><div class='widget-guide'>Three</div></div>") == "One\nTwo\nThree"
    assert wrappers.main_text("<article><p>One</p><div class='share'>Share of votes</div></article>") == "One\nShare of votes"
    assert wrappers.main_text("<article><p>One</p><div class='share'><a href=x>Tweet</a> <a href=y>Post</a></div><div class=ad-slot>Buy</div><div id=comments>c</div></article>") == "One"
    page = "<article><p>Text {0}</p><div class=newsletter>Subscribe to our letter</div></article>"
    pages = spark.createDataFrame([(i, "http://h/x", page.format(i)) for i in range(4)], "page_id bigint, url string, html string")
    assert {r.text for r in wrappers.extracted(pages).collect()} == {f"Text {i}" for i in range(4)}
    assert wrappers.main_text(page.format(1)) == "Text 1\nSubscribe to our letter"


def test_lists_of_links_go_where_nothing_is_named():
    assert wrappers.main_text("<body><div class=k1><a href=1>First story</a><br><a href=2>Second story</a></div><div class=k2><p>The text, with <a href=3>one link</a>.</p></div>") == "The text, with one link."


def test_depth_is_no_switch():
    for n in (0, 3, 99, 100, 101, 5000):
        page = "<div>" * n + "<p>side note</p><article><p>Body text of it</p></article><div><p>tail</p></div>" + "</div>" * n
        assert wrappers.main_text(page) == "Body text of it", n


def made_up(rng, host):
    """Seven pages of a host of meaningless names, where parts come, go, swap and repeat."""
    kinds = [f"{rng.choice(['div', 'section', 'ul', 'p', 'h2', 'span', 'td'])} class=z{rng.randrange(9)}" for _ in range(8)]

    def block(depth):
        k = rng.choice(kinds)
        inner = "".join(block(depth + 1) for _ in range(rng.randrange(4))) if depth < 3 else ""
        text = rng.choice(["", "same words", "other words", f"own {rng.random()}"])
        return f"<{k}>{text}{inner}</{k.split()[0]}>"

    blocks = [block(0) for _ in range(6)]
    return ["<body>" + "".join(rng.choice([b, b, block(0), ""]) for b in rng.sample(blocks, len(blocks))) + "</body>" for _ in range(7)]


def test_one_result_whatever_the_order(spark):
    rng = random.Random(11)
    rows = [(7 * h + k, f"http://h{h}/x", page) for h in range(300) for k, page in enumerate(made_up(rng, h))]
    found = []
    for parts in (1, 3, 16):
        rng.shuffle(rows)
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
        found.append({r.page_id: r.text for r in wrappers.extracted(pages).collect()})
    assert len(found[0]) == 2100 and found[0] == found[1] == found[2]


def test_wrappers_stay_small(spark):
    page = "<body><div class=top><a href=/>Home</a></div><div class=s{0}><h1>T {0}</h1><div class=t{0}><p>Words of {0}</p></div><div class=u{0}><p>More of {0}</p></div></div><div class=foot>All rights reserved, everywhere.</div></body>"
    pages = spark.range(10_000).selectExpr("id page_id", "'http://h/x' url", f"replace('{page}', '{{0}}', cast(id as string)) html")
    (row,) = wrappers.wrappers(pages).collect()
    assert len(row.wrapper) < 100 * wrappers.MOST_PARTS and json.loads(row.wrapper)[5] == 10_000
    for r in wrappers.extracted(pages.where("page_id % 500 = 3 or page_id < 60")).collect():
        assert r.text == f"T {r.page_id}\nWords of {r.page_id}\nMore of {r.page_id}"
    chosen = wrappers.choices(json.loads(row.wrapper))
    assert chosen[2] and wrappers.main_text(page.replace("{0}", "77"), chosen) == "T 77\nWords of 77\nMore of 77"


def test_clashing_columns_and_copies(spark):
    rows = [(1, "http://h/x", "<p>a</p>", 1, "w", "n")] * 3 + [(2, "http://h/y", None, 1, "w", "n"), (None, None, "", 1, "w", "n")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, at bigint, wrapper string, host string")
    assert sorted((r.text for r in wrappers.extracted(pages).collect())) == ["", "", "a", "a", "a"]
