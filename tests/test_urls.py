"""U1-U8 against Python's own URL functions and the fixture cases."""

from urllib.parse import urljoin, urlparse

from hypothesis import given, settings
from hypothesis import strategies as st

from crawlstats.functions import urls as U

ODD_URLS = [
    "http://a.example.com/x/y;p?q=1#f",
    "HTTPS://A.Example.com:8080/P/Q?x#",
    "https://a.example.com",
    "https://a.example.com/",
    "//no.scheme/path",
    "www.x.example.com/p",
    "mailto:a@b",
    "page.html",
    "?q=1",
    "#top",
    "http://h/a;b/c;d;e?x=1;y",
    "http://h/a b|c?q=[1]%zz",
    "http://exa_mple.com/x",
    "ftp://h/f.txt",
    "http://h/p?a#b#c",
    "http://h/p#x?y",
    "",
]


def _parts(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return {r.url: r.p for r in df.select("url", U.url_parts("url").alias("p")).collect()}


def test_url_parts_match_urlparse(spark):
    got = _parts(spark, ODD_URLS)
    for u in ODD_URLS:
        exp = urlparse(u)
        assert tuple(got[u]) == tuple(exp), u


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abc/:;?#.%@[]xy1 \t\n\r\x00\x1f", max_size=20), min_size=1, max_size=20))
def test_url_parts_property(spark, urls):
    got = _parts(spark, urls)
    for u in urls:
        try:
            exp = urlparse(u)
        except ValueError:
            continue  # malformed in Python; our rules name it 'malformed'
        assert tuple(got[u]) == tuple(exp), u


def test_normalize_idempotent_and_hash_scheme_free(spark):
    from hashlib import sha256

    urls = ["http://a.example.com/x//", "https://a.example.com/x", "http://a.example.com/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = df.select(
        "url",
        U.normalize("url").alias("n"),
        U.normalize(U.normalize("url")).alias("nn"),
        U.url_hash("url").alias("h"),
    ).collect()
    assert all(r.n == r.nn for r in rows)
    assert len({r.h for r in rows}) == 1
    p = urlparse("http://a.example.com/x")
    expect = sha256(f"{p.netloc}/{p.path}/{p.params}/{p.query}/{p.fragment}".encode()).hexdigest()
    assert rows[0].h == expect


ROOTED = st.text(alphabet="ab./;?#=", max_size=14).map(lambda s: "/" + s)


@settings(max_examples=25, deadline=None)
@given(st.lists(ROOTED, min_size=1, max_size=20))
def test_join_rooted_matches_urljoin(spark, refs):
    bases = [
        "http://h.example.com/en/1?z",
        "http://h.example.com",
        "https://h.example.com/a/b/c;p?q=1#f",
        "http://h.example.com:8080/",
    ]
    rows = [(b, r) for b in bases for r in refs + ["//", "//?x", "//#f", "///a"]]
    df = spark.createDataFrame(rows, "base string, ref string")
    got = df.select("base", "ref", U.join_rooted("base", "ref").alias("j")).collect()
    for r in got:
        assert r.j == urljoin(r.base, r.ref), (r.base, r.ref)


def test_resolve_href_rules(spark):
    base = "https://a.example.com/en/1"
    cases = {
        "/a/b": "https://a.example.com/a/b",
        "/a/../b": "https://a.example.com/b",
        "//www.x.example.com/p": "https://www.x.example.com/p",
        "//cdn.example.com/p": "cdn.example.com/p",
        "www.x.example.com/p": "https://www.x.example.com/p",
        "page.html": "page.html",
        "#top": "#top",
        "mailto:a@b": "mailto:a@b",
        "////x.example.com/p": "https://x.example.com/p",
    }
    df = spark.createDataFrame([(base, h) for h in cases], "base string, href string")
    got = {r.href: r.link for r in df.select("href", U.resolve_href("base", "href").alias("link")).collect()}
    assert got == cases


def test_subdomain_cases(spark):
    cases = {
        "www.example.com": None,
        "example.com": None,
        "a.example.com": "a",
        "www.a.example.com": "a",
        "b.a.example.com": "a",
        "A.example.com": "A",
        "WWW.a.example.com": "a",
        "other.test": None,
        "a.example.com:8080": "a",
    }
    df = spark.createDataFrame([(n,) for n in cases], "netloc string")
    got = {r.netloc: r.s for r in df.select("netloc", U.subdomain("netloc", "example").alias("s")).collect()}
    assert got == cases


def test_domain_bucket_order(spark):
    df = spark.createDataFrame(
        [("http://informatics.x/",), ("http://ics.x/",), ("http://none/",)], "url string"
    )
    got = [r.b for r in df.select(U.domain_bucket("url", ["informatics.x", "ics.x"]).alias("b")).collect()]
    assert got == [0, 1, None]


def _subdomain_spec(netloc: str, anchor: str):
    """U5 as SURVEY §2 states it: drop a leading www label (any case), then the
    label just before the first label equal to the anchor, if any."""
    labels = netloc.split(".")
    if labels[0].lower() == "www":
        labels = labels[1:]
    for i, label in enumerate(labels):
        if label == anchor:
            return labels[i - 1] if i >= 1 else None
    return None


LABELS = st.sampled_from(["www", "WWW", "a", "b-c", "example", "Example", "com", "com:8080", ""])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(LABELS, min_size=1, max_size=5).map(".".join), min_size=1, max_size=30))
def test_subdomain_matches_spec(spark, netlocs):
    df = spark.createDataFrame([(n,) for n in netlocs], "netloc string")
    got = {r.netloc: r.s for r in df.select("netloc", U.subdomain("netloc", "example").alias("s")).collect()}
    for n in netlocs:
        assert got[n] == _subdomain_spec(n, "example"), n


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab/:;?#.%=x1", min_size=1, max_size=24).map(lambda s: "http://" + s), min_size=1, max_size=30))
def test_normalize_and_hash_match_stdlib(spark, urls):
    from hashlib import sha256

    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.n, r.h) for r in df.select("url", U.normalize("url").alias("n"), U.url_hash("url").alias("h")).collect()}
    for u in urls:
        n = u.rstrip("/") if u.endswith("/") else u
        try:
            p = urlparse(n)
        except ValueError:
            continue
        expect = sha256(f"{p.netloc}/{p.path}/{p.params}/{p.query}/{p.fragment}".encode()).hexdigest()
        assert got[u] == (n, expect), u


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz.:/", min_size=0, max_size=16), min_size=1, max_size=30))
def test_domain_bucket_is_first_contained(spark, urls):
    buckets = ["b.c", "c", "xy"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.b for r in df.select("url", U.domain_bucket("url", buckets).alias("b")).collect()}
    for u in urls:
        assert got[u] == next((i for i, b in enumerate(buckets) if b in u), None), u
