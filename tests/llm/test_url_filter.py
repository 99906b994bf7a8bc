"""URL filter: against SQL, against plain sets, and its edge rows."""

import re

from pyspark.sql import functions as F

from compare import difference, duck, duck_rows, spark_rows, type_difference
from nestmeans.llm import url_filter
from nestmeans.llm.queries import LISTED_LABELS, ORACLES, QUERIES, URL_RULES

DATA = "/root/testdata/sf0.01"


def test_query_matches_sql(spark):
    con = duck(DATA)
    df, sql = QUERIES["op1_url_filter"](spark, DATA), ORACLES["op1_url_filter"]
    assert type_difference(df, con, sql) is None
    assert difference(spark_rows(df), duck_rows(con, sql)) is None


def cascade_answers(spark, listed, universe, **settings):
    a = spark.createDataFrame([(x,) for x in listed], "k string")
    b = spark.createDataFrame([(x,) for x in universe], "k string")
    cascade = url_filter.build_cascade(a, b, **settings)
    rows = cascade.mark(b, "k", "hit").collect()
    return cascade, {r["k"]: r["hit"] for r in rows}


def test_cascade_is_exact_over_its_universe(spark):
    universe = [f"host{i}.example.org" for i in range(4000)]
    listed = universe[::7] + universe[:3]
    cascade, got = cascade_answers(spark, listed, universe, later_rate=0.5)
    assert len(cascade.levels) >= 3
    assert got == {k: k in set(listed) for k in universe}
    # a filter of one level alone would err
    assert cascade.keys.where(cascade.levels[0].passes(F.col("key")) & ~F.col("listed")).count() > 0


def test_large_lists_are_joined(spark):
    universe = [f"h{i}" for i in range(300)]
    cascade, got = cascade_answers(spark, universe[:100], universe, max_bits=64)
    assert cascade.exact_by_join and got == {k: int(k[1:]) < 100 for k in universe}


def test_lists_at_the_edges(spark):
    _, got = cascade_answers(spark, [], ["a", None, "", "a"])
    assert got == {"a": False, None: False, "": False}
    _, got = cascade_answers(spark, [None, "a", "a"], ["a", None, "", "b"])
    assert got == {"a": True, None: True, "": True, "b": False}
    _, got = cascade_answers(spark, ["a"], ["a"])
    assert got == {"a": True}


URLS = {
    None: ("", ""), "": ("", ""), "example.com/en/": ("", ""), "HTTP://Ex.COM": ("ex.com", ""), "a://b://c/d": ("b:", "//c/d"),
    "x://h?q/p": ("h", ""), "x://h/p?q#f": ("h", "/p"), "x://h#f": ("h", ""), "x://h/p#f?q": ("h", "/p"), "://": ("", ""),
    "x://ÄB.de/É": ("Äb.de", "/É"), "x://h/a\nb?c": ("h", "/a\nb"), "x://" + "h" * 100000 + "/p": ("h" * 100000, "/p"),
}


def test_urls_and_rules(spark):
    urls = [*URLS, "http://www.example.com/en/1", "http://example.com/en/1", "http://a.example.com/en/x", "http://example.com/es/",
            "http://com/", "http://xcom/", "http://m.net/es/1", "http://net/fr/", "http://m.net/es", "http://example.com"]
    rows = [(i, u, "p") for i, u in enumerate(urls)] + [(0, urls[0], "again")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    listed = spark.createDataFrame([("h",), ("m.net",)], "host string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, listed, URL_RULES).collect()}
    for i, u in enumerate(URLS):
        assert (got[i]["host"], got[i]["path"]) == URLS[u], u
    tail = [(got[len(URLS) + k]["rule"], got[len(URLS) + k]["verdict"]) for k in range(10)]
    assert tail == [
        ("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("example.com/en/", "block"), ("com/", "allow"),
        ("com/", "allow"), (None, "allow"), ("net/es/", "block"), ("net/fr/", "block"), (None, "block"), (None, "allow"),
    ]
    assert got[5]["verdict"] == "block"  # host "h" is listed
    assert url_filter.judge_urls(pages.limit(0), listed, URL_RULES).count() == 0


def test_listed_labels_occur(spark):
    urls = [r["url"] for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    hosts = [re.sub(r"^[^:]*://([^/?#]*).*", r"\1", u) for u in urls]
    assert any(set(h.split(".")) & set(LISTED_LABELS) for h in hosts)

