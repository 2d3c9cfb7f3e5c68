"""Alias edges of relative targets and of several tags in a page."""

from urllib.parse import urljoin

from tidewatch.llm import urlfilter

PAGE = "http://a.example.org/x/y/z.html?k=1#f"
TARGETS = ["next.html", "../de/x", "./q", "..", "../../../up", "?id=3", "/r/../s/./t?u=/../v", "//h.net/a", "//h.net/a/../b", "http://b.net/c/../d?e", "g/", "a/b/..", "n?u=http://o.net/"]


def test_targets_resolve_as_in_the_standard_library(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(PAGE, t) for t in [*TARGETS, "mailto:x@y"]], "url string, to string")
    got = {r["to"]: r["whole"] for r in df.withColumn("whole", urlfilter.resolve(F.col("url"), F.col("to"))).collect()}
    absolute = {"//h.net/a/../b": "http://h.net/b", "http://b.net/c/../d?e": "http://b.net/d?e"}  # RFC 3986; urljoin leaves their dots
    assert got == {t: urljoin(PAGE, t) for t in TARGETS} | absolute | {"mailto:x@y": None}


def test_every_tag_and_relative_targets_make_aliases(spark):
    rows = [
        (1, "http://c.example.com/en/a", "<meta http-equiv=refresh content='0; url=../de/x'>"),
        (2, "http://c.example.com/en/a2", "<link rel=canonical href='/none'><link rel=canonical href='http://b.net/'>"),
        (3, "http://c.example.com/fr/q", "<meta http-equiv=refresh content='0; url=?id=3'>"),
        (4, "http://c.example.com/fr/q?id=3", "<meta http-equiv=refresh content='0; url=/n'><meta http-equiv=refresh content='0; url=http://b.net/2'>"),
    ]
    df = spark.createDataFrame([(n, u.replace("c.example.com", "c.site.test"), h) for n, u, h in rows] + [(5, "http://c.site.test/de/x", "<link rel=canonical href='http://b.net/3'>")], "page_id int, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in urlfilter.judge(df).collect()} == dict.fromkeys(range(1, 6), "block")
