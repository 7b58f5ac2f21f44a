"""Operator 9: every kind of link carries a block, and a recursive SQL twin over a table with links."""

import random

import duckdb

from farebox.llm import urls

BLOCKED = "http://shop.net/es/x"


def verdicts(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.verdict for r in urls.judge_urls(df).collect()}


def test_links_that_carry_a_block(spark):
    pages = [
        "<meta http-equiv=refresh content=300><META HTTP-EQUIV='Refresh' content='0; url=http://shop.net/es/x'>",
        '<link rel="nofollow canonical" href="http://shop.net/es/x">',
        "<link rel=canonical href=//shop.net/a/b/../../es/./x>",
        '<link href="http://shop.net/es/x" rel="canonical">',
        "<link rel='stylesheet' href='http://shop.net/es/x'>",
        '<link rel="canonicals" href="http://shop.net/es/x"><meta name="refresh" content="0;url=http://shop.net/es/x">',
        '<link rel="canonical" href="http://other.org/"><link rel="canonical" href="http://shop.net/es/x">',
        None, "", "canonical refresh"]
    got = verdicts(spark, [(i, f"http://p{i}.org/", h) for i, h in enumerate(pages)] + [(100, BLOCKED, None)])
    assert [got[i] for i in range(10)] == ["block", "block", "block", "block", "allow", "allow", "block", "allow", "allow", "allow"]
    assert got[100] == "block"


def test_dot_segments(spark):
    rows = [(0, "http://shop.net/a/b/c.html", '<link rel="canonical" href="../f">'),
            (1, "http://shop.net/a/f", '<link rel="canonical" href="./../es/">'), (2, "http://shop.net/es/", ""),
            (3, "http://q.org/x/", '<link rel="canonical" href="../../..//up">'), (4, "http://q.org//up", "")]
    assert verdicts(spark, rows) == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "allow"}
    paths = ["/a/./b", "/a/../b", "/a/b/..", "/a/b/.", "/../x", "/", "/a/...", "/a//..", "/.x/..y"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(urls._resolved(df["p"])).collect()]
    assert got == ["/a/b", "/b", "/a/", "/a/b/", "/x", "/", "/a/...", "/a/", "/.x/..y"]


TWIN = """
    WITH RECURSIVE edges AS (
        SELECT regexp_extract(url, '://(.*)$', 1) AS a, regexp_extract(html, 'href="[a-z]+://([^"]*)"', 1) AS b
        FROM pages WHERE html LIKE '%canonical%'),
    ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach(a, b) AS (SELECT a, a FROM ways UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
    bad AS (SELECT DISTINCT a FROM reach WHERE regexp_matches(b, '(^|\\.)net/(es|fr)/') OR (regexp_matches(b, '(^|\\.)example\\.com/en/')
            AND NOT regexp_matches(b, '(^|\\.)www\\.example\\.com/en/')))
    SELECT page_id, CASE WHEN regexp_matches(u, '(^|\\.)www\\.example\\.com/en/') THEN 'allow'
        WHEN regexp_matches(u, '(^|\\.)net/(es|fr)/') OR regexp_matches(u, '(^|\\.)example\\.com/en/') THEN 'block'
        WHEN regexp_matches(u, '^[^/]*(\\.|^)com/') THEN 'allow'
        WHEN u IN (SELECT a FROM bad) THEN 'block' ELSE 'allow' END AS verdict
    FROM (SELECT page_id, regexp_extract(url, '://(.*)$', 1) AS u FROM pages)"""


def test_aliases_equal_a_recursive_twin(spark):
    rnd = random.Random(6)
    hosts = ["a.org", "b.net", "example.com", "www.example.com", "x.example.com", "c.io"]
    address = lambda: f"http://{rnd.choice(hosts)}/{rnd.choice(['en', 'es', 'fr', 'de'])}/{rnd.randint(0, 12)}"
    rows = [(i, address(), f'<link rel="canonical" href="{address()}">' if rnd.random() < 0.25 else "<p>") for i in range(250)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = dict(con.execute(TWIN).fetchall())
    got = verdicts(spark, rows)
    assert got == want and 20 < sum(v == "block" for v in want.values()) < 240
