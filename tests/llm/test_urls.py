from pyspark.sql import functions as F

from poilake.llm import urls
from poilake.llm.queries import RULES
from poilake.llm.scratch import Scratch


def judged(spark, rows, outcomes=(), rules=RULES):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("bound", F.lit(1))
    known = spark.createDataFrame(list(outcomes), "url string, bad int")
    return urls.judge(pages, known, rules).collect()


def test_parts_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/x?y": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "x://h.net/es/#f": ("h.net", "/es/", "net/es/", "block"),
        "x://h.net/ES/": ("h.net", "/ES/", None, "allow"),
        "x://com": ("com", "", None, "allow"),
        "x://com/": ("com", "/", "com/", "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "://?q": ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://ÄÉ.COM/\nen": ("ÄÉ.com", "/\nen", "com/", "allow"),
        "http://" + "x" * 100_000 + ".org/y": ("x" * 100_000 + ".org", "/y", None, "allow"),
    }
    rows = list(enumerate(cases))
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, rows)}
    assert got == {i: cases[u] for i, u in rows}


def test_levels(spark):
    hosts = ["a.b.example.com", "x.co.uk", "a.x.co.uk", "com", "", "10.0.0.1:80", "u@h.org:8080"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [tuple(r) for r in df.select(urls.domain_of(F.col("h")), urls.suffix_of(F.col("h"))).collect()]
    assert got == [("example.com", "com"), ("x.co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("com", "com"), ("", ""), ("10.0.0.1", "10.0.0.1"), ("h.org", "org")]


def test_reputation_blocks_by_its_bound(spark):
    bad = [(f"http://spam.bad.org/{i}", 1) for i in range(60)] + [("http://spam.bad.org/z", 0)]
    good = [(f"http://fine{j}.ok.org/{i}", int(i == 0)) for j in range(5) for i in range(30)]
    few = [("http://new.ok.org/1", 1)]
    none = [("http://null.ok.org/1", None)]
    rows = [(1, "http://spam.bad.org/q"), (1, "http://spam.bad.org/q"), (2, "http://fine1.ok.org/q"), (3, "http://new.ok.org/q"), (4, "http://unseen.ok.org/"), (5, "http://other.bad.org/"), (None, "http://null.ok.org/")]
    got = {}
    for r in judged(spark, rows, bad + good + few + none):
        got.setdefault(r.id, []).append(r)
    assert [r.verdict for r in got[1]] == ["block", "block"]
    # One bad page is no proof, and hosts without labels have their domain's rate.
    assert got[2][0].verdict == got[3][0].verdict == got[4][0].verdict == got[None][0].verdict == "allow"
    assert got[4][0].mean < got[3][0].mean < got[1][0].mean and got[4][0].mean < got[5][0].mean


def test_empty_tables(spark):
    assert judged(spark, []) == []
    pages = spark.createDataFrame([], "host string")
    assert urls.reputation(spark.createDataFrame([], "host string, bad long"), pages, Scratch(spark, "t")).collect() == []
