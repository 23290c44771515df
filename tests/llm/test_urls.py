from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from wardmill.llm import urls


def plain(url, rules, default="allow"):
    match = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), match[2]) if match else ("", "")
    best = None
    for rule, verdict in rules:
        rule_host, _, rest = rule.partition("/")
        rule_path = rule[len(rule_host):]
        rule_host = rule_host.lower()
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            best = max(best or (0,), (len(rule), len(rule_host), verdict == "allow", rule, verdict))
    return host, path, best and best[3], best[4] if best else default


def check(spark, addresses, rules):
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(addresses)], "page_id long, url string, host string, entry string, block int")
    table = spark.createDataFrame(rules, "rule string, verdict string")
    got = Counter(tuple(r) for r in urls.judge_urls(pages.repartition(4), table).collect())
    assert got == Counter((i, u, *plain(u, rules)) for i, u in enumerate(addresses))


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def test_contract_rules(spark):
    check(spark, [
        None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y", "http://example.net/en/1",
        "http://m.example.net/en/1#z", "http://badexample.net/en/1", "http://m.EXAMPLE.com/de/", "http://example.com/den",
        "https://x.org/fr/a://b/c", "http://.net/", "http://a..net/", "http://net./", "http://a\x01net/q", "http://net:80/a",
        "http://u@x.net/\nline", "ftp://é.Ünet/", "http://x.net?/a", "a://b://c.net/",
    ] * 2, RULES)


def test_random_nested_rules(spark):
    pick = random.Random(4)
    labels = ["a", "b", "c", "a-b", "net", "org", "x1"]
    host = lambda n: ".".join(pick.choice(labels) for _ in range(pick.randint(1, n)))
    path = lambda: "/" + "/".join(pick.choice("pqr") for _ in range(pick.randint(0, 3)))
    rules = list({(host(4) + pick.choice(["", path(), path() + "/"]), pick.choice(["allow", "block"])) for _ in range(150)})
    rules += [("/only/path", "block"), ("a/p", "allow"), ("a/p", "block")]
    check(spark, ["http://" + host(6) + pick.choice(["", path()]) for _ in range(1500)] + ["http://hot.net/p"] * 500, rules)


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "rule string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in urls.judge_urls(pages, none).collect()] == [(1, "http://a.net/", "a.net", "/", None, "allow")]
    assert urls.judge_urls(pages.filter(F.lit(False)), spark.createDataFrame(RULES, "rule string, verdict string")).collect() == []
