"""A user's page function as an extractor."""

from pyspark.sql import functions as F

from conftest import SF0001
from crawlstats.config import TEST_PARAMS as P
from crawlstats.operators import crawl as C
from crawlstats.operators import links as L
from crawlstats.operators import page_function as PF
from crawlstats.sources.pages import responses, seed_urls


def parser_function():
    """The default extraction rules over the standard library's parser."""

    def extract(url, resp):
        from html.parser import HTMLParser
        from urllib.parse import urljoin

        found = []

        class Anchors(HTMLParser):
            def handle_starttag(self, tag, attrs):
                href = dict(reversed(attrs)).get("href") if tag == "a" else None
                if href is not None:
                    found.append(href)

        if resp.status != 200 or resp.raw_response is None:
            return []
        Anchors(convert_charrefs=True).feed(resp.raw_response.content.decode("utf-8"))
        out = []
        for h in found:
            h = h[2:] if h.startswith("//") else h
            h = urljoin(url, h) if h.startswith("/") else h
            h = "https://" + h if h.startswith("www.") else h
            if "do=" not in h:
                out.append(h)
        return out

    return extract


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_the_default_extractor_as_a_function(spark):
    resp = responses(spark.read.parquet(f"{SF0001}/pages.parquet"))
    assert rows(PF.page_function(parser_function())(resp)) == rows(L.page_links(resp))


def test_an_exception_marks_its_page(spark):
    html = [(1, "https://a.example.com/1", "x"), (2, "https://a.example.com/2", None), (3, "https://a.example.com/3", "y"), (4, None, "z")]
    resp = responses(spark.createDataFrame(html, "page_id long, url string, html string").withColumn("status", F.when(F.col("page_id") == 3, 404).otherwise(200)))

    def odd(url, resp):
        if resp.raw_response is None:
            raise ValueError("no body")
        if resp.status == 404:
            return None
        assert resp.raw_response.url == url and isinstance(resp.raw_response.content, bytes)
        yield "https://a.example.com/x"
        yield None
        yield "https://a.example.com/x"
        if url is None:
            raise KeyError("late")

    assert rows(PF.call_pages(resp, odd)) == [
        (1, "https://a.example.com/1", "https://a.example.com/x", None),
        (2, "https://a.example.com/2", None, "ValueError: no body"),
        (4, None, None, "KeyError: 'late'"),
    ]
    assert [r.page_id for r in PF.failed_pages(resp, odd).collect()] == [2, 4]


def test_a_crawl_with_a_page_function(spark):
    pages = [(1, "https://a.example.com/1", "/2 /3"), (2, "https://a.example.com/2", "/1"), (3, "https://a.example.com/3", "boom")]
    resp = responses(spark.createDataFrame(pages, "page_id long, url string, html string"))

    def words(url, resp):
        text = resp.raw_response.content.decode()
        if text == "boom":
            raise RuntimeError(text)
        return ["https://a.example.com" + w for w in text.split()]

    state = C.crawl(resp, seed_urls(spark, "https://a.example.com/1"), P, extractor=PF.page_function(words))
    assert {r.url: r.completed for r in state.collect()} == {f"https://a.example.com/{i}": True for i in (1, 2, 3)}
    audit = L.scrape(resp, P.domains, extractor=PF.page_function(words))
    assert audit.where("is_valid").count() == 3
