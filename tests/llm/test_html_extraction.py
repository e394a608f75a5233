import json

import pytest

from marlstone.llm import html_extraction as extraction
from tests.llm.conftest import by_row


def page(n, paragraphs, extra=""):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>T{n}</title><style>p{{}}</style>"
        f'<script>var t="</p>{n}";</script></head><body><nav><ul>'
        + "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(n % 3 + 1))
        + f'</ul></nav><!-- ad {n} --><div class="ad">Buy {n}</div>{extra}<div class="story">'
        f"<h1>Title {n}</h1>{body}</div>"
        f'<div id="comments"><p>reader {n} says a lot of words here</p></div>'
        f'<form><input name="q"><button>Go</button></form><footer>&copy; {n}</footer></body></html>'
    )


def texts(spark, rows):
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    return {r.page_id: r.text for r in extraction.extract_main_text(df).collect()}


def test_main_text_of_a_host(spark):
    paragraphs = {n: [f"Para {n} {k} with words enough." for k in range(n % 4 + 1)] for n in range(12)}
    rows = [
        (n, f"https://a.example/p/{n}", page(n, p, '<div class="notice">We use cookies</div>' * (n % 2)))
        for n, p in paragraphs.items()
    ]
    found = texts(spark, rows)
    assert found == {n: "\n\n".join([f"Title {n}", *p]) for n, p in paragraphs.items()}


def test_blocks_are_plain_text(spark):
    html = (
        "<html><body><article><h1>A &amp; B</h1><p>one\n  <b>two</b>&nbsp;<i>th</i>ree<br>four"
        "<p>unclosed <a href='x>y'>link</a><ul><li>x<li>y</ul>tail &lt;b&gt; &#233;"
        "<blockquote>quote</blockquote></article></body>"
    )
    found = texts(spark, [(1, "http://b.example/", html)])
    assert found[1] == "A & B\n\none two three four\n\nunclosed link\n\nx\n\ny\n\ntail <b> é\n\nquote"


def test_wrapper_has_groups_options_and_slots():
    nodes = [extraction.skeleton(extraction.parse(page(n, ["a", "b"][: n % 2 + 1]))) for n in (1, 2, 4)]
    one = nodes[0]
    for node in nodes[1:]:
        one = extraction.align(one, node)
    with_notice = extraction.skeleton(extraction.parse(page(5, ["x"], "<section><p>hi</p></section>")))
    one = extraction.align(one, with_notice)
    body = one[4][0][4][1]
    kinds = {n[0]: n[1] for n in body[4]}
    assert kinds["section"] == "?" and kinds["nav"] == "1"
    lists = body[4][0][4][0]
    assert lists[4][0][:2] == ["li", "+"]
    story = next(n for n in body[4] if n[0] == "div.story")
    assert [(n[0], n[1]) for n in story[4]] == [("h1", "1"), ("p", "+")]
    assert story[4][0][4][0][3] is None


def test_longer_periods_become_groups():
    html = "<dl>" + "".join(f"<h2>t{k}</h2><p>a</p><ul><li>b</li></ul>" for k in range(5)) + "</dl>"
    node = extraction.skeleton(extraction.parse(html))[4][0]
    assert [(n[0], n[1]) for n in node[4]] == [("()", "+")]
    assert [n[0] for n in node[4][0][4]] == ["h2", "p", "ul"]


def test_long_irregular_lists_stay_small():
    tags = ["p", "div", "ul", "table", "pre"]
    html = "".join(f"<{tags[k * k % 7 % 5]}>x</{tags[k * k % 7 % 5]}><{tags[k % 3]}>y</{tags[k % 3]}>"
                   for k in range(400))
    node = extraction.skeleton(extraction.parse(html))
    assert len(node[4]) <= extraction.MOST_CHILDREN


def test_constant_text_is_told_from_slots():
    a, b = (extraction.skeleton(extraction.parse(f"<p>same</p><div>{x}</div>")) for x in "uv")
    both = extraction.align(a, b)
    assert both[4][0][4][0][3] == "same" and both[4][1][4][0][3] is None


def test_edge_cases(spark):
    rows = [
        (1, "http://c.example/1", None), (2, "http://c.example/2", ""), (3, None, "<p>no host</p>"),
        (4, "http://d.example", "plain text only"), (5, "http://e.example", "<div>" * 5000 + "deep"),
        (6, "http://f.example", "<p>cut <b"), (7, "http://g.example", "<script>never closed"),
        (8, "http://h.example", "<p>" + "word " * 50000 + "</p>"), (None, "http://i.example", "<p>x</p>"),
        (4, "http://d.example", "plain text only"), (9, "odd", "</div></p><p>a</p><!-- open"),
    ]
    found = texts(spark, rows)
    assert found[1] == found[2] == found[7] == ""
    assert found[3] == "no host" and found[4] == "plain text only" and found[5] == "deep"
    assert found[6] == "cut" and found[None] == "x" and found[9] == "a"
    assert found[8] == " ".join(["word"] * 50000)


def test_empty_table_and_clashing_names(spark):
    schema = "page_id bigint, url string, html string, host string, text string, wrapper string"
    empty = extraction.extract_main_text(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "host", "text"]
    rows = [(1, "http://a.example", "<p>x</p>", "h", "t", "w")]
    found = extraction.extract_main_text(spark.createDataFrame(rows, schema))
    assert by_row(found) == [(1, "http://a.example", "a.example", "x")]


def test_wrappers_do_not_depend_on_how_pages_are_dealt(spark):
    rows = [(n, "https://a.example/", page(n, ["some words here"] * (n % 5 + 1))) for n in range(40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    paths = [
        extraction.main_path(json.loads(extraction.infer_wrappers(df.repartition(k)).first().wrapper))
        for k in (1, 7)
    ]
    assert paths == [["html", "body", "div.story"]] * 2


def test_siblings_of_one_key_are_all_read(spark):
    rows = [
        (n, "https://a.example/", f"<body><div>Site name</div><nav>menu</nav><div><p>First {n} of the "
         f"article</p><h2>Part</h2><p>Second {n} of the article</p></div></body>")
        for n in range(4)
    ]
    found = texts(spark, rows)
    for n in range(4):
        assert f"First {n} of the article" in found[n] and f"Second {n} of the article" in found[n]


def test_kinds_of_long_lists_and_groups_are_repeated(spark):
    tags = ["div", "section", "ul", "table", "pre"]
    kinds = [tags[k * k % 7 % 5] for k in range(120)]
    long = "".join(
        f"<{t}><p>{t} {k} has words</p></{t}>" if t == "div" else f"<{t}></{t}>"
        for k, t in enumerate(kinds)
    )
    pairs = "".join(f"<div><p>text {k}</p><h2>x</h2></div><hr>" for k in range(3))
    found = texts(spark, [(1, "https://a.example/", long), (2, "https://b.example/", pairs)])
    expected = [f"div {k} has words" for k, t in enumerate(kinds) if t == "div"]
    assert found[1].split("\n\n") == expected
    assert [b for b in found[2].split("\n\n") if b != "x"] == ["text 0", "text 1", "text 2"]


def test_text_beside_the_largest_part_stays(spark):
    body = "<p>The body has most of the words.</p><p>And it goes on for long, page {n}.</p>" * 4
    html = f"<article><h1>Title {{n}}</h1><div class=lead>Lead {{n}}.</div><div class=body>{body}</div></article>"
    rows = [(n, "https://a.example/", html.format(n=n)) for n in range(5)]
    rows.append((5, "https://a.example/", "<article><h1>Title 5</h1><div class=lead>Only a lead.</div></article>"))
    found = texts(spark, rows)
    assert all(found[n].startswith(f"Title {n}\n\nLead {n}.\n\nThe body") for n in range(5))
    assert found[5] == "Title 5\n\nOnly a lead."


def test_words_do_not_rule_out_what_holds_the_text(spark):
    inner = "<h1>Title {n}</h1><p>Para {n} with enough words in it.</p><div class=sidebar>Side {n}</div>"
    wraps = [
        f"<div class='content-sidebar-wrap'><article>{inner}</article></div><div id=comments>No {{n}}</div>",
        f"<div id=page class='has-sidebar'>{inner}</div><div class=ad>Buy</div>",
        f"<div class='post share-enabled'>{inner}</div>",
        f"<section class='widget article-body'>{inner}</section><section class=widget>Most read</section>",
        # A plain article: long comments stay out.
        f"<article>{inner}</article><div class=comments><article>{'Many words of readers. ' * 20}</article></div>",
    ]
    rows = [
        (10 * k + n, f"https://h{k}.example/", f"<body>{wrap.format(n=n)}</body>")
        for k, wrap in enumerate(wraps) for n in range(4)
    ]
    assert texts(spark, rows) == {
        10 * k + n: f"Title {n}\n\nPara {n} with enough words in it."
        for k in range(len(wraps)) for n in range(4)
    }


def test_blocks_of_the_template_are_left_out(spark):
    def html(n, notice="<p>Read our other stories.</p>"):
        return (
            f"<article><h1>Title {n}</h1><p>Para {n} with words enough for a page.</p>{notice}"
            f"<p>More of {n} after it.</p><div class=x7>Call this number.</div></article>"
        )

    rows = [(n, "https://a.example/", html(n)) for n in range(9)]
    rows += [(9, "https://a.example/", None)]
    rows += [(10 + n, "https://two.example/", html(n)) for n in range(2)]
    rows += [(20 + n, "https://copies.example/", html(0)) for n in range(4)]
    rows += [(30 + n, "https://some.example/", html(n, "" if n else "<p>Only here.</p>")) for n in range(4)]
    found = texts(spark, rows)
    own = "Title {0}\n\nPara {0} with words enough for a page.\n\n{1}More of {0} after it."
    every = "Title {0}\n\nPara {0} with words enough for a page.\n\nRead our other stories.\n\n" \
        "More of {0} after it.\n\nCall this number."
    assert [found[n] for n in range(9)] == [own.format(n, "") for n in range(9)] and found[9] == ""
    assert [found[10 + n] for n in range(2)] == [every.format(n) for n in range(2)]
    assert [found[20 + n] for n in range(4)] == [every.format(0)] * 4
    assert [found[30 + n] for n in range(4)] == [
        own.format(n, "" if n else "Only here.\n\n") for n in range(4)
    ]


def site(pages):
    wrapper = None
    for page in pages:
        node = extraction.page_wrapper(page)
        wrapper = node if wrapper is None else extraction.join_wrappers(wrapper, node)
    found = extraction.reading(wrapper)
    return [extraction.main_text(page, *found) for page in pages]


def paragraphs(n):
    return f"<p>Paragraph {n} has several words in it.</p><p>Another, number {n * 7}, ends here.</p>"


PLAIN = [f"Paragraph {n} has several words in it.\n\nAnother, number {n * 7}, ends here." for n in range(4)]
KEPT = {
    "form around an article": (
        "<body><form action=x><div>Find</div><nav>MENU</nav><article>{0}</article></form></body>", "{0}"),
    "form around the page": (
        "<body><form action=x><nav>MENU</nav><div class=c>{0}</div></form></body>", "{0}"),
    "form for searching": (
        "<body><form><p>Search this site</p></form><div class=c>{0}</div></body>", "{0}"),
    "header of an article": (
        "<body><header>Site</header><article><header><h1>T{1}</h1></header>{0}</article></body>",
        "T{1}\n\n{0}"),
    "sidebar of articles": (
        "<body><main>{0}</main><aside><article>Old {1}</article></aside></body>", "{0}"),
    "formula and drawing": (
        "<body><article><p>Sum <math><mi>x</mi><mo>+</mo><mn>{1}</mn><annotation>TeX</annotation></math> "
        "of <svg><text>no</text></svg>0.</p>{0}</article></body>", "Sum x+{1} of 0.\n\n{0}"),
    "shared heading": (
        "<body><article><h1>T{1}</h1><p>By Jane Doe</p>{0}<h2>Summary</h2><p>In short {1}.</p></article>"
        "</body>", "T{1}\n\nBy Jane Doe\n\n{0}\n\nSummary\n\nIn short {1}."),
    "shared frame": (
        "<body><article><p>Welcome, all of you!</p>{0}<p>Come again.</p></article></body>", "{0}"),
    "deep menu": (
        "<body>" + "<div>" * 130 + "<nav>MENU <b>A</b></nav>{0}" + "</div>" * 130 + "</body>", "{0}"),
}


@pytest.mark.parametrize("name", sorted(KEPT))
def test_no_article_text_is_lost(name):
    page, text = KEPT[name]
    pages = [page.format(paragraphs(n), n) for n in range(4)]
    assert site(pages) == [text.format(PLAIN[n], n) for n in range(4)]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_kept_text_alike_for_any_partitions(spark, parts):
    rows, wanted = [], {}
    for h, (page, text) in enumerate(KEPT.values()):
        for n in range(4):
            rows.append((len(rows), f"http://h{h}.org/{n}", page.format(paragraphs(n), n)))
            wanted[len(rows) - 1] = text.format(PLAIN[n], n)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    found = extraction.extract_main_text(df)
    assert {r.page_id: r.text for r in found.collect()} == wanted
