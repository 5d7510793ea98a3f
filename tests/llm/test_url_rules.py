from __future__ import annotations

import random

import duckdb

from rainloom.llm import url_rules
from tests.llm.conftest import SF


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:at], rest[at:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, None, "allow")
    return host, path, best[2], best[3]


def check(spark, urls, rules):
    frame = spark.createDataFrame(urls, "page_id long, url string, key string, stack string")
    result = url_rules.judge(frame, url_rules.rule_frame(spark, rules) if rules else url_rules.rule_frame(spark).limit(0))
    assert sorted((tuple(r) for r in result.collect()), key=str) == sorted(((i, *brute(u, rules)) for i, u, *_ in urls), key=str)


def test_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = con.execute(url_rules.SQL).fetchall()
    result = url_rules.judge(spark.read.parquet(f"{SF}/pages.parquet"), url_rules.rule_frame(spark))
    assert sorted(map(tuple, result.collect())) == sorted(want)


def test_hard_urls_and_no_rules(spark):
    urls = [None, "", "no scheme", "http://", "http:///es/1", "HTTP://Example.ORG/es/1", "http://a.b.example.org/en/1?x", "http://org/",
            "http://org", "http://xorg/", "http://example.org.", "http://example.org#/es/", "x://y://z.org/", "http://a.com/fr/\n/b",
            "http://a.com/fr", "http://com/de/x", "http://u:p@example.org:80/es/", "http://é.org/es/", "http://" + "a." * 3000 + "com/fr/" + "x" * 50000]
    rows = [(i, u, "a", "b") for i, u in enumerate(urls)] + [(5, urls[5], "a", "b"), (None, urls[6], "a", "b")]
    check(spark, rows, url_rules.RULES)
    check(spark, rows, ())
    check(spark, rows[:0], url_rules.RULES)


def test_random_nested_rules(spark):
    rng = random.Random(3)
    labels, parts = ["a", "b", "ab", "c"], ["x", "y", "xy", "/", ""]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    def path(n):
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))

    rules = list({(host(), "/" + path(3)): rng.choice(["allow", "block"]) for _ in range(120)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    check(spark, [(i, f"http://{host()}/{path(5)}", "a", "b") for i in range(1500)], rules)
