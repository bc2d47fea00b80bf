"""G1-G3, F15, F18 on hand-written pages (FIXTURES §4)."""

from pyspark.sql import functions as F

from crawlstats.functions.text import page_token_count, page_tokens
from crawlstats.operators.links import page_links
from crawlstats.sources.pages import responses

BASE = "https://a.example.com/en/1"
PAGES = [
    (1, BASE, None),
    (2, BASE, ""),
    (3, BASE, "<p>no links here</p>"),
    (4, BASE, '<a href="/x">x</a><a href="/x">again</a><A HREF="/y">y</A>'),
    (5, BASE, '<p>unclosed <a href="/u">u'),
    (6, BASE, '<script>var t="</p><a href=/s>";</script><p>after</p>'),
    (7, BASE, '<!-- <a href="/c">c</a> --><a href=\'/q\'>q</a><a href=/bare>b</a>'),
    (8, BASE, '<a href="/e?a=1&amp;b=2">e</a><a href="/p?do=edit">d</a>'),
    (9, BASE, "<title>T&amp;lt;x</title><p>éclair e-mail 2021 0 end. don't</p>"),
    (10, BASE, '<a data-href="/no" href="/yes">y</a>'),
]


def _resp(spark):
    return responses(spark.createDataFrame(PAGES, "page_id long, url string, html string"))


def test_links(spark):
    got = {}
    for r in page_links(_resp(spark)).collect():
        got.setdefault(r.page_id, set()).add(r.link)
    assert 1 not in got and 2 not in got and 3 not in got
    assert got[4] == {"https://a.example.com/x", "https://a.example.com/y"}
    assert got[5] == {"https://a.example.com/u"}
    assert 6 not in got  # the anchor sits inside a script string
    assert got[7] == {"https://a.example.com/q", "https://a.example.com/bare"}
    assert got[8] == {"https://a.example.com/e?a=1&b=2"}  # do= dropped, entity decoded
    assert got[10] == {"https://a.example.com/yes"}
    assert page_links(_resp(spark)).groupBy("page_id", "link").count().where("count > 1").count() == 0


def test_tokens(spark):
    df = _resp(spark).where("page_id = 9").select(page_tokens("html").alias("t"), page_token_count("html").alias("n"))
    row = df.first()
    # &amp;lt; decodes once; éclair is dropped whole; n't is a token
    assert row.t == ["t", "lt", "x", "e-mail", "2021", "0", "end", "do", "n't"]
    assert row.n == len(row.t)


def test_token_count_null_and_empty(spark):
    got = {r.page_id: r.n for r in _resp(spark).select("page_id", page_token_count("html").alias("n")).collect()}
    assert got[1] == 0 and got[2] == 0 and got[3] == 3


HARD = [
    (1, BASE, '<a class="b"href="/x1">1</a><a title="a>b" href="/x2">2</a><a title="see href=/bad" href="/x4">4</a>'),
    (2, BASE, "<a href='/one' href='/two'>x</a><a\nhref = /three>y</a><a/href=/four>z</a><abbr href=/no>n</abbr>"),
    (3, BASE, '<a title=don\'t href="/q">it\'s</a><a href>none</a><a name=x>none</a><a href="">empty</a>'),
    (4, BASE, '<a href="/&eacute;?a=1&amp;b=&#50;">e</a>'),
]


def test_anchors_on_ordinary_html(spark):
    resp = responses(spark.createDataFrame(HARD, "page_id long, url string, html string"))
    got = {}
    for r in page_links(resp).collect():
        got.setdefault(r.page_id, set()).add(r.link.replace("https://a.example.com", ""))
    assert got == {1: {"/x1", "/x2", "/x4"}, 2: {"/one", "/three", "/four"}, 3: {"/q", ""}, 4: {"/\u00e9?a=1&b=2"}}


HARD_TEXTS = [
    ("don&rsquo;t &#8217; caf&eacute; a&ndash;b &#x41;&#66;", ["don", "t", "caf\u00e9", "a\u2013b", "ab"]),
    ("\u201chello\u201d he said", ["hello", "he", "said"]),
    ("foo\u00a0bar&nbsp;baz\u2003qux", ["foo", "bar", "baz", "qux"]),
    ("1,000 at 10:30, a,b: c", ["1,000", "at", "10:30", "a", "b", "c"]),
    ("don't John's they're I'll dogs' end.", ["do", "n't", "john", "they", "i", "dogs", "end"]),
    ("&amp;lt;x &#38;lt;y &unknown;z &#0;&#x110000;&#146;k &#55296;", ["lt", "x", "lt", "y", "unknown", "z", "k"]),
    ('<p title="a>b" id=x>in</p> 1 < 2 <b>out', ["in", "1", "2", "out"]),
]


def test_tokens_of_ordinary_html(spark):
    from crawlstats.functions.text import page_token_count

    df = spark.createDataFrame(list(enumerate(t for t, _ in HARD_TEXTS)), "i long, html string")
    rows = {r.i: r for r in df.select("i", page_tokens("html").alias("t"), page_token_count("html").alias("n")).collect()}
    for i, (text, exp) in enumerate(HARD_TEXTS):
        assert rows[i].t == exp, text
        assert rows[i].n == len(exp), text


def test_entities_match_the_standard_library(spark):
    from html import unescape

    from crawlstats.functions.text import ENTITY_NAMES, decode_entities

    texts = [f"x{e}y" for e in ENTITY_NAMES if e != "&nbsp;"] + [f"&#{n};" for n in (33, 65, 130, 146, 160, 8364, 128512)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", decode_entities("t").alias("d")).collect():
        assert r.d == unescape(r.t), r.t


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

TEXT = st.text(alphabet="ab1É.,'; \n\t-é?#&<>\"*()", max_size=40)


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_token_count_equals_token_array_size(spark, texts):
    from crawlstats.functions.text import token_count, tokens

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", token_count("t").alias("n"), F.size(tokens("t")).alias("m")).collect():
        assert r.n == r.m, r.t


def test_separators_are_these_characters(spark):
    from crawlstats.functions.text import SEPARATOR

    points = [i for i in range(1, 0x11000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string").where(F.col("c").rlike(rf"^{SEPARATOR}$"))
    wide = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xAB, 0xBB, *range(0x2018, 0x2020), 0x2039, 0x203A]
    assert {r.i for r in df.collect()} == {*map(ord, "\t\n\x0b\f\r ;@#$%&?!()[]{}<>\"*"), *wide}


# --- the markup scan ----------------------------------------------------------

SPACE = " \t\n\f\r"


def scanned(html):
    """(text with markup as spaces, insides of closed anchors) by a scan, character by character."""
    out, anchors, i, n = [], [], 0, len(html)

    def tag_end(j):
        """Where the tag whose inside starts at j ends: behind its '>', or at the end of the page."""
        while j < n and html[j] != ">":
            if html[j] == "=":
                k = j + 1
                while k < n and html[k] in SPACE:
                    k += 1
                if k < n and html[k] in "\"'" and (close := html.find(html[k], k + 1)) >= 0:
                    j = close
            j += 1
        return (j + 1, True) if j < n else (n, False)

    while i < n:
        low = html[i : i + 8].lower()
        if html.startswith("<!--", i):
            rest = html[i + 4 :]
            if rest.startswith((">", "->")):
                i += 4 + rest.index(">") + 1
            else:
                ends = [e + len(m) for m in ("-->", "--!>") if (e := rest.find(m)) >= 0]
                i = min(i + 4 + min(ends), n) if ends else n
            out.append(" ")
        elif (name := next((e for e in ("script", "style") if low.startswith("<" + e) and html[i + 1 + len(e) : i + 2 + len(e)] in (*SPACE, "/", ">")), None)):
            i, closed = tag_end(i + 1 + len(name))
            while closed and i < n:
                at = html.lower().find("</" + name, i)
                if at < 0:
                    i = n
                    break
                i = at + 2 + len(name)
                if html[i : i + 1] in (*SPACE, "/", ">") and i < n:
                    end = html.find(">", i)
                    i = end + 1 if end >= 0 else n
                    break
            out.append(" ")
        elif html[i] == "<" and i + 1 < n and (html[i + 1] in "/!?" or html[i + 1].isascii() and html[i + 1].isalpha()):
            end, closed = tag_end(i + 2)
            if closed and low[1] == "a" and html[i + 2] in SPACE + "/":
                anchors.append(html[i + 3 : end - 1])
            out.append(" ")
            i = end
        else:
            out.append(html[i])
            i += 1
    return "".join(out), [a for a in anchors if a]


PIECES = st.sampled_from(
    ["<", ">", "<a ", "<a/", "</a>", "<p", "<!--", "-->", "--!>", "->", "-", "<script", "</script", "</script>", "<STYLE>", "</style >", "=", "= ", '"', "'", "a", "b=", "href=", "/", "!", " ", "\n", "x", "<!", "<?", "1 < 2", "scripts"]
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=14).map("".join), min_size=1, max_size=60))
def test_markup_scan_equals_a_scan_by_character(spark, pages):
    from crawlstats.functions.text import MARKUP
    from crawlstats.operators.links import ANCHORS

    df = spark.createDataFrame([(h,) for h in pages], "h string")
    anchors = F.filter(F.regexp_extract_all("h", F.lit(ANCHORS), 1), lambda t: t != "")
    for r in df.select("h", F.regexp_replace("h", MARKUP, " ").alias("t"), anchors.alias("a")).collect():
        assert (r.t, r.a) == scanned(r.h), r.h


def test_pages_with_huge_and_unclosed_markup(spark):
    wide = " a=b" * 50_000 + ' c="d>e"' * 50_000
    rows = [
        (1, f'<a{wide} href="/in">text</a><p>end'),
        (2, f'<p>one</p><a href="/one">1</a><a href="/two"{wide}'),
        (3, "<p>two <!-- " + "<a href=/no>x</a>" * 3000),
        (4, "<p>three <script> " + "<a b=c " * 3000),
        (5, "four " + "<a b=c " * 100_000),
        (6, f'<a href="/six">five</a><p{wide}> six <a href="/in-a-tag" <!-- <script>'),
        (7, "<!--" * 50_000),
        (8, "nine " + ",:" * 100_000 + "1 ten"),
        (9, "=\"" * 100_000 + "<b =\" x>eleven"),
        (10, "<script>" * 50_000 + "</script>twelve"),
        (11, f"<a{' ' * 200_000}href='/spaces'>thirteen</a>"),
    ]
    df = spark.createDataFrame([(i, BASE, h) for i, h in rows], "page_id long, url string, html string")
    links = {(r.page_id, r.link[len("https://a.example.com") :]) for r in page_links(responses(df)).collect()}
    assert links == {(1, "/in"), (2, "/one"), (6, "/six"), (6, "/in-a-tag"), (11, "/spaces")}
    got = {r.page_id: r.t for r in df.select("page_id", page_tokens("html").alias("t")).collect()}
    assert {i: got[i] for i in (1, 2, 3, 4, 5, 6, 7, 10, 11)} == {
        1: ["text", "end"], 2: ["one", "1"], 3: ["two"], 4: ["three"], 5: ["four"], 6: ["five", "six"], 7: [], 10: ["twelve"], 11: ["thirteen"]
    }
    assert got[8][0] == "nine" and got[8][-1] == "ten" and got[9][-1] == "eleven"
