"""A hit and a near miss per rule, the derived variants, and F11's
equivalence with the back-reference pattern it replaces."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlstats.functions.scope import reject_reason, repeating_directory

DOMAINS = ["example.com", "example.net"]
B = "https://a.example.com"

RULE_TABLE = [
    (B + "/x", None),
    ("ftp://a.example.com/x", "scheme"),
    (B + "/x.PDF", "path_extension"),
    (B + "/x.pdfx", None),
    (B + "/x?f=a.zip", "query_extension"),
    ("https://a.example.org/x", "domain"),
    ("https://example.com/x", None),  # the slash of // counts
    ("https://xexample.com/x", "domain"),  # needs [./] before the domain
    ("https://a.example.com", "domain"),  # needs the '/' after it
    ("https://evil.test/?u=.example.com/", None),  # match-anywhere kept
    (B + "/2024-01-31/x", "date"),
    (B + "/2024-1-31/x", None),
    (B + "/events/category/x", "event_category"),
    (B + "/x#top", "fragment"),
    (B + "/" + "a" * 250, "length"),
    (B + "/x?a=1&filter%5Bk%5D=2", "filter"),
    (B + "/x?a=1&filter=2", None),
    (B + "/q/x/q/y", "repeating_directory"),
    (B + "/q/q/y", "repeating_directory"),
    (B + "/q/x/q", None),
    (B + "/sites/all/themes/x", "cms_directories"),
    (B + "/sites/all/x", None),
    (B + "/calendar/x", "calendar"),
    (B + "/Calendar/x", None),
    (B + "/x?ical=1", "ical"),
    (B + "/x?historical=1", "ical"),
    ("https://[a.example.com/x", "malformed"),
    (None, "malformed"),
]


def test_rule_table(spark):
    df = spark.createDataFrame(RULE_TABLE, "url string, expected string")
    got = df.select("url", "expected", reject_reason("url", DOMAINS).alias("r")).collect()
    for row in got:
        assert row.r == row.expected, (row.url, row.r)


def test_basic_profile(spark):
    rows = [(B + "/x?f=a.zip", None), ("https://xexample.com/x", None), (B + "/x#f", "fragment")]
    df = spark.createDataFrame(rows, "url string, expected string")
    got = df.select("expected", reject_reason("url", DOMAINS, profile="basic").alias("r")).collect()
    assert [r.r for r in got] == [r[1] for r in rows]


def test_extra_rules(spark):
    rule = ("no_login", lambda u, p: p["path"].contains("/login"))
    df = spark.createDataFrame([(B + "/login",), (B + "/x",)], "url string")
    got = [r.r for r in df.select(reject_reason("url", DOMAINS, extra_rules=[rule]).alias("r")).collect()]
    assert got == ["no_login", None]


# Fixed value: the original back-reference pattern of the repeating-directory rule.
BACKREF = re.compile(r"^.*?(/.+?/).*?\1.*$|^.*?/(.+?/)\2.*$")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab/", min_size=1, max_size=14), min_size=5, max_size=40))
def test_repeating_directory_equals_backref(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.hit for r in df.select("url", repeating_directory(F.col("url")).alias("hit")).collect()}
    for u in urls:
        assert got[u] == bool(BACKREF.match(u)), u


def test_derived_variants_hit_expected_rule(spark):
    from crawlstats.plans import fixtures as X
    from conftest import SF0001

    v = X.url_variants(spark.read.parquet(f"{SF0001}/pages.parquet"))
    # Out-of-scope hosts fail the domain rule first, before the later rules.
    before_domain = F.col("expected").isin("malformed", "scheme", "path_extension", "query_extension")
    checked = v.where(F.col("expected").isNotNull() & (before_domain | ~F.col("url").contains(".example.org")))
    bad = checked.select("url", "expected", reject_reason("url", DOMAINS).alias("r")).where(
        ~F.col("r").eqNullSafe(F.col("expected"))
    )
    assert checked.count() > 0 and bad.count() == 0
