import re

import pytest
from pyspark.sql import functions as F

from filehaul.llm import url_filter
from filehaul.llm.queries import URL_RULES, op1_url_filter

from .conftest import DATA


def plain(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("(?s)[^/?#]*", rest)[0]
    path = re.match("(?s)[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule, verdict in URL_RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            fits.append((len(rule), rule, verdict))
    return host, path, max(fits)[1:] if fits else None


def test_query(spark):
    urls = {row["page_id"]: row["url"] for row in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = op1_url_filter(spark, DATA).collect()
    assert len(rows) == len(urls)
    for row in rows:
        host, path, rule = plain(urls[row["page_id"]])
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule[0])
        assert row["verdict"] in ("allow", "block") and (not rule or row["verdict"] == rule[1])


@pytest.mark.parametrize("url", [
    None, "", "x", "http://A.com?x/y", "HTTP://É.Net/es/", "a://http://q/w", "://x.com/", "http://WWW.example.com/en/\n?", "h://notcom/en/",
])
def test_parts_and_rules(spark, url):
    host, path = url_filter.url_parts(F.col("url"))
    rows = spark.createDataFrame([(url,)], "url string").select(host.alias("host"), path.alias("path"))
    row = rows.select("*", url_filter.match_rule(F.col("host"), F.col("path"), URL_RULES).alias("fit")).first()
    assert (row["host"], row["path"], row["fit"] and tuple(row["fit"])) == plain(url)


def test_tree_merges_alike_branches_and_rejects_bad_ones(spark):
    pages, labels = [], []
    for i in range(400):
        branch = ["en", "de", "spam"][i % 3]
        pages.append((i, f"http://h.org/{branch}/{i}.html"))
        labels.append((i, 0 if branch == "spam" and i % 30 else 1))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = url_filter.judge_urls(frame, known).collect()
    verdicts = {row["host"] + row["path"].rsplit("/", 1)[0]: row["verdict"] for row in rows}
    assert verdicts == {"h.org/en": "allow", "h.org/de": "allow", "h.org/spam": "block"}
    templates = {row["template"] for row in rows}
    assert "/spam/{0}.{a}" in templates and len(templates) <= 3
    # Without a difference in labels all branches are one.
    same = url_filter.judge_urls(frame, known.withColumn("quality", F.lit(1))).select("template").distinct()
    assert [row["template"] for row in same.collect()] == ["/*/{0}.{a}"]


def test_odd_rows(spark):
    rows = [(1, None), (None, "http://a.b/1//?"), (4, "http://a.b/1//?"), (4, "http://a.b/1//?"), (7, "http://" + "a/" * 40)]
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as n", "'y' as template")
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, 0), (None, 1), (7, None)], "doc_id long, quality int")
    assert url_filter.judge_urls(frame, labels).count() == 5
    assert url_filter.judge_urls(frame.limit(0), labels.limit(0)).count() == 0
    assert {row["purity"] for row in url_filter.judge_urls(frame, labels.limit(0)).collect()} == {1.0}
