"""A user's page function ``f(url, resp) -> links`` as an extractor.

``resp`` is what a crawler's page function gets: ``url``, ``status``,
``error`` and ``raw_response`` with ``url`` and ``content`` (bytes), or None
without a body. The function runs as an Arrow UDTF in a lateral join, on
batches of pages in the tasks that read them; nothing is shuffled. An
exception in it marks its page with a failure and leaves the job alone.

The function travels with the query. What it imports must be on the executors;
a function defined inside another one is sent whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlstats.operators.links import Extractor

PageFunction = Callable[[str, Any], Iterable[str]]


def call_pages(resp: DataFrame, f: PageFunction) -> DataFrame:
    """(page_id, src, link, failure): each distinct link that ``f`` returns for a response, in its order.

    A response for which ``f`` raises is one row with the exception as
    ``failure`` and no link, whatever it had returned by then. Responses of
    any status are given; nulls among the links are left out.
    """

    @F.udtf(returnType="link: string, failure: string", useArrow=True)
    class Call:
        def eval(self, url: str, status: int, error: str, html: str):
            from types import SimpleNamespace

            raw = None if html is None else SimpleNamespace(url=url, content=html.encode("utf-8"))
            try:
                links = dict.fromkeys(f(url, SimpleNamespace(url=url, status=status, error=error, raw_response=raw)) or ())
            except Exception as e:  # noqa: BLE001 - the user's function; its failure is the page's
                yield None, f"{type(e).__name__}: {e}"
                return
            for link in links:
                if link is not None:
                    yield str(link), None

    columns = [F.col(c).outer() for c in ("url", "status", "error", "html")]
    called = resp.select("page_id", "url", "status", "error", "html").lateralJoin(Call(*columns))
    return called.select("page_id", F.col("url").alias("src"), "link", "failure")


def page_function(f: PageFunction) -> Extractor:
    """``f`` as an extractor for ``links.scrape`` and ``crawl.crawl``: (page_id, src, link) of the pages it succeeds on."""
    return lambda resp: call_pages(resp, f).where("link is not null").select("page_id", "src", "link")


def failed_pages(resp: DataFrame, f: PageFunction) -> DataFrame:
    """(page_id, src, failure): the pages that ``f`` raises on."""
    return call_pages(resp, f).where("failure is not null").select("page_id", "src", "failure")
