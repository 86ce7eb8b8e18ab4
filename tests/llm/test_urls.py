import re

from leadlake.llm import host_reputation as rep
from leadlake.llm.host_reputation import Rule

URLS = [
    (1, "HTTP://WWW.Example.COM/en/a?x=/es/#y"),
    (2, "https://blog.example.com/en/"),
    (3, "https://notexample.com/en/"),
    (4, "https://a.net/es/x"),
    (5, "https://a.net"),
    (6, "https://a.net?x=/es/"),
    (7, "no scheme"),
    (8, None),
    (9, ""),
    (10, "https://x.org/a://b.net/es/"),
    (11, "https://É.Example.Org/Fr/"),
    (None, "https://a.net/fr/"),
    (12, "https://user@host.co.uk:80/p"),
    (12, "https://user@host.co.uk:80/p"),
]
RULES = (
    Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)


def pages(spark, urls):
    frame = spark.createDataFrame(urls, "page_id long, url string")
    return frame.selectExpr("*", "'x' as host", "'y' as path", "'z' as verdict", "1 as good", "2 as n")


def test_hosts_paths_and_rules(spark):
    outcomes = spark.createDataFrame([], "page_id long, good int")
    got = {r.page_id: tuple(r)[1:] for r in rep.judge_urls(pages(spark, URLS), outcomes, RULES).collect() if r.page_id}
    assert got[1] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[2] == ("blog.example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("notexample.com", "/en/", "com/", "allow")
    assert got[4] == ("a.net", "/es/x", "net/es/", "block")
    assert got[5][:3] == ("a.net", "", None) and got[6][:3] == ("a.net", "", None)
    assert got[7][:3] == got[8][:3] == got[9][:3] == ("", "", None)
    assert got[10][:3] == ("x.org", "/a://b.net/es/", None)
    assert got[11][:2] == ("É.example.org", "/Fr/")
    assert rep.judge_urls(pages(spark, URLS), outcomes, RULES).count() == len(URLS)


def test_bad_hosts_are_blocked_and_unknown_ones_lean_on_their_domain(spark):
    urls, outcomes, n = [], [], 0
    for host, good, bad in [("bad.shop.org", 1, 60), ("fine.shop.org", 60, 1), ("a.good.org", 80, 0), ("b.good.org", 70, 1)]:
        for k in range(good + bad):
            n += 1
            urls.append((n, f"http://{host}/{k}"))
            outcomes.append((n, int(k < good)))
    urls += [(n + 1, "http://new.good.org/"), (n + 2, "http://bad.shop.org/unlabelled")]
    labels = spark.createDataFrame([*outcomes, (n + 2, None)], "page_id long, good int")
    verdicts = {r.page_id: r.verdict for r in rep.judge_urls(pages(spark, urls), labels).collect()}
    hosts = {u.split("/")[2]: verdicts[i] for i, u in urls}
    assert hosts["bad.shop.org"] == "block" and hosts["fine.shop.org"] == hosts["a.good.org"] == "allow"
    table = {r.host: r for r in rep.reputation(spark.createDataFrame([("bad.shop.org", 0)] * 9 + [("x.good.org", None)], "host string, good int")).collect()}
    assert table["bad.shop.org"].mean < 0.2 and table["x.good.org"].n == 0


def test_shrinkage_pulls_small_hosts_to_their_domain(spark):
    rows = [(f"h{i}.d.org", int(k < 9)) for i in range(20) for k in range(10)] + [("one.d.org", 0)]
    table = {r.host: r for r in rep.reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert 0.7 < table["one.d.org"].mean < 0.9


def test_empty_tables_and_plan(spark):
    none = spark.createDataFrame([], "page_id long, good int")
    assert rep.judge_urls(pages(spark, []), none, RULES).collect() == []
    plan = rep.judge_urls(pages(spark, URLS), none, RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", plan)
