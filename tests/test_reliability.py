import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapewire import schemas
from tapewire.functions import urls
from tapewire.operators import reliability
from tapewire.plans.source_reliability import rate_article_sources
from tests.conftest import rows

AS_OF = dt.date(2024, 2, 1)


def probe(spark, *values):
    """(source, status, elapsed, age in days, text length, polarity[, html])"""
    out = []
    for source, status, elapsed, age, chars, polarity, *html in values:
        created = None if age is None else AS_OF - dt.timedelta(days=age)
        text = None if chars is None else "x" * chars
        out.append((source, status, elapsed, html[0] if html else "", created, text, polarity))
    return spark.createDataFrame(out, schemas.SOURCE_PROBE)


def scores(spark, *values, exact=False):
    observed = reliability.summarise_probe(probe(spark, *values))
    scored = reliability.source_scores(reliability.source_features(observed, AS_OF), exact)
    rating = reliability.rating("reliability_score")
    return {r[0]: (r[1], r[2]) for r in scored.select("source_id", "reliability_score", rating).collect()}


def test_known_scores(spark):
    got = scores(
        spark,
        ("reuters.com", 200, 0.5, 9125, 2500, 0.05),
        ("example.org", 200, 1.0, None, 100, 0.0),
        ("microsoft.com", 404, 4.0, 9125, 1150, -0.5),
        ("plain.com", None, None, None, None, None),
        ("wikipedia.org", 200, 1.0, 9125, 100, 0.0),
        ("reddit.com", 200, 0.5, 9125, 100, 0.0),
        ("slow.example.xyz", None, None, None, None, None),
    )
    assert got == {
        "reuters.com": (100.0, "A"),
        "example.org": (96.0, "A"),
        "microsoft.com": (85.5, "B"),
        "plain.com": (85.0, "B"),
        "wikipedia.org": (75.0, "B"),
        "reddit.com": (66.0, "B"),
        "slow.example.xyz": (18.0, "C"),
    }


def test_trust_by_substring_or_by_domain(spark):
    row = ("microsoft.com", 404, 4.0, 9125, 1150, -0.5)
    # Without the bonus of 15 the floor for old domains applies.
    assert scores(spark, row, exact=True)["microsoft.com"] == (85.0, "B")
    named = ("www.ft.com", 404, 4.0, 9125, 1150, -0.5)
    assert scores(spark, named, exact=True) == scores(spark, named)


def test_page_phrases_count_only_when_the_page_was_read(spark):
    def ugc(status, html, source="plain.xyz"):
        observed = reliability.summarise_probe(probe(spark, (source, status, 1.0, 0, 0, 0.0, html)))
        return reliability.source_features(observed, AS_OF).first()["ugc_score"]

    assert ugc(200, "<a>EDIT THIS PAGE</a>") == pytest.approx(0.3)
    assert ugc(200, "<a>other</a>") == 0.0
    assert ugc(None, "<a>edit this page</a>") == 0.0
    assert ugc(200, None) == 0.0
    assert ugc(200, "talk: here", "en.wikipedia.org") == pytest.approx(1.0)
    assert ugc(None, None, "old.reddit.com") == pytest.approx(0.7)


def test_features_of_age_text_and_status(spark):
    def features(*row):
        observed = reliability.summarise_probe(probe(spark, row))
        return reliability.source_features(observed, AS_OF).first()

    assert features("a.xyz", 200, 9.0, 0, 300, 0.9)["response_time"] == 0.0
    assert features("a.xyz", 200, 9.0, 0, 300, 0.9)["domain_age"] == 0.0
    assert features("a.xyz", 200, 9.0, -10, 300, 0.9)["domain_age"] == 0.0
    assert features("a.xyz", 200, 0.0, 99999, 300, 0.9)["domain_age"] == 1.0
    assert features("a.xyz", 200, 0.0, 1, 300, 0.9)["neutrality"] == 0.7
    assert features("a.xyz", 200, 0.0, 1, 300, 0.9)["text_len"] == 0.0
    assert features("a.xyz", 200, 0.0, 1, 299, 0.9)["text_len"] == 0.8
    assert features("a.xyz", 200, 0.0, 1, 299, 0.9)["neutrality"] == 0.8
    assert features("a.xyz", 200, 0.0, 1, 1150, 0.1)["text_len"] == 0.5
    assert features("x.gov.sg", 200, 0.0, 1, 1150, 0.1)["domain_age"] == 1.0
    assert features("x.net", 200, 0.0, 1, 1150, 0.1)["domain_age"] == 0.9
    statuses = [features("a.xyz", s, 0.0, 1, 1, 0.0)["status"] for s in (200, 301, 302, 403, 500, None)]
    assert statuses == [1.0, 1.0, 1.0, 1.0, 0.5, 0.0]
    assert features("localhost", 200, 0.0, 1, 1, 0.0)["domain_valid"] == 0.0


@pytest.mark.parametrize(
    ("value", "rating"), [(86.0, "A"), (85.99, "B"), (55.01, "B"), (55.0, "C"), (0.0, "C")]
)
def test_rating_edges(spark, value, rating):
    assert spark.range(1).select(reliability.rating(F.lit(value))).first()[0] == rating


def test_clamp(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (2.5,), (5.0,), (9.0,)], "v double")
    got = [r[0] for r in df.select(reliability.clamp_scale("v", 0, 5)).collect()]
    assert got == [0.0, 0.0, 0.0, 0.5, 1.0, 1.0]


def test_sources_of_articles(spark):
    articles = spark.createDataFrame(
        [
            ("https://www.reuters.com/a",),
            ("reuters.com/b",),
            ("http://www.reuters.com:80/c",),
            ("https://never.probed.xyz/",),
            (None,),
            ("",),
        ],
        "source_url string",
    )
    seen = probe(
        spark,
        ("www.reuters.com", 200, 0.5, 9125, 2500, 0.05),
        ("www.reuters.com", None, None, None, None, None),
        ("unrelated.com", 200, 0.5, 9125, 2500, 0.05),
    )
    rated = rate_article_sources(articles, seen, AS_OF)
    assert rated.schema.fieldNames() == schemas.SOURCES.fieldNames()
    got = {r.source_id: (r.credibility_score, r.rating) for r in rated.collect()}
    # The mean of a good and a failed visit; the failed one alone gives floor plus nothing.
    failed = scores(spark, ("www.reuters.com", None, None, None, None, None))["www.reuters.com"][0]
    assert got["www.reuters.com"][0] == round((100.0 + failed) / 2, 2)
    assert got["never.probed.xyz"] == (18.0, "C")
    assert set(got) == {"www.reuters.com", "reuters.com", "never.probed.xyz"}
    with pytest.raises(ValueError, match="source_url"):
        rate_article_sources(articles.toDF("url"), seen, AS_OF)


def test_summaries(spark):
    sources = spark.createDataFrame(
        [("a", 90.0, "A"), ("b", 60.0, "B"), ("c", 60.5, "B")],
        "source_id string, credibility_score double, rating string",
    )
    assert dict(rows(reliability.rating_distribution(sources))) == {"A": 1, "B": 2}
    assert rows(reliability.credibility_stats(sources)) == [(3, 70.17, 60.0, 90.0)]


@pytest.mark.parametrize(
    ("url", "host"),
    [
        ("https://www.reddit.com/r/finance/article", "www.reddit.com"),
        ("https://bbc.com/news/article?ref=123", "bbc.com"),
        ("http://u:p@Host.org:8080/x", "host.org"),
        ("bbc.com/x", "bbc.com"),
        ("  https://bbc.com  ", "bbc.com"),
        ("https://a_b.example.com?x=1", "a_b.example.com"),
        ("https://example.com#top", "example.com"),
        ("http://[2001:db8::1]:80/", "[2001:db8::1]"),
        (None, ""),
        ("", ""),
    ],
)
def test_hosts(spark, url, host):
    df = spark.createDataFrame([(url,)], "u string")
    assert rows(df.select(urls.host("u"), urls.source_id("u"))) == [(host, host or None)]


@pytest.mark.parametrize(
    ("host", "registered", "valid"),
    [
        ("www.reddit.com", "reddit.com", True),
        ("news.bbc.co.uk", "bbc.co.uk", True),
        ("www.mom.gov.sg", "mom.gov.sg", True),
        ("gov.sg", "gov.sg", True),
        ("a.b.example.xyz", "example.xyz", True),
        ("example.com.", "example.com", True),
        ("localhost", "localhost", False),
        ("192.168.0.1", "192.168.0.1", False),
        ("bad_host", "bad_host", False),
        ("", "", False),
    ],
)
def test_registered_domains(spark, host, registered, valid):
    df = spark.createDataFrame([(host,)], "h string")
    domain = urls.registered_domain("h")
    assert rows(df.select(domain, urls.is_valid_domain(domain))) == [(registered, valid)]


def test_longest_suffix_wins(spark):
    df = spark.createDataFrame([("x.city.kawasaki.jp",), ("a.co.jp",)], "h string")
    got = df.select(urls.registered_domain("h", ["co.jp", "kawasaki.jp", "city.kawasaki.jp"]))
    assert rows(got) == [("x.city.kawasaki.jp",), ("a.co.jp",)]


@pytest.mark.parametrize("value", [float("nan"), float("inf"), float("-inf")])
def test_numbers_that_are_none_count_as_missing(spark, value):
    def score(elapsed, polarity):
        row = ("a.com", 404, elapsed, "", None, "x" * 2500, polarity)
        probe = spark.createDataFrame([row], schemas.SOURCE_PROBE)
        observed = reliability.summarise_probe(probe)
        return reliability.source_scores(reliability.source_features(observed, "2024-02-01")).first()

    assert score(value, 0.0).response_time == 0.0
    assert score(1.0, value).reliability_score == score(1.0, None).reliability_score
    assert score(value, value).reliability_score < 100


def test_domains_of_any_script(spark):
    hosts = spark.createDataFrame([("m\u00fcnchen.de",), ("xn--mnchen-3ya.de",), ("-a.de",), ("a_b.de",)], "h string")
    assert [r[0] for r in hosts.select(urls.is_valid_domain("h")).collect()] == [True, True, False, False]
