import pytest
from pyspark.sql import functions as F

from compare import compare
from helpers import with_clashes
from tidewatch.llm import url_filter as U

PAGES = "page_id long, url string, html string"
LINK = '<head><link rel="canonical" href="{}"></head>'
HOP = "<META HTTP-EQUIV='refresh' content='0; URL={}'>"

CASES = [
    (1, "http://a.net/x", LINK.format("https://shop.com/de/item")),       # alias of a blocked URL
    (2, "http://b.net/x#frag", "<link href='http://a.net/x' rel=canonical>"),  # chain of aliases
    (3, "http://b.net/x?q=1", ""),
    (4, "http://c.net/", LINK.format("//shop.com/de/other")),
    (5, "https://shop.com/fr/item", LINK.format("/de/own")),              # own rule wins
    (6, "http://d.net/", LINK.format("https://www.example.org/en/2")),    # explicit allow
    (7, "http://d.net/", LINK.format("http://example.org/en/1zz")),       # allow beats block
    (8, "http://e.net/dir/page", HOP.format("other")),
    (9, "http://e.net/dir/other", LINK.format("HTTPS://SHOP.com/de/q&amp;r")),
    (10, "http://e.net/dir/page?a#b", HOP.format("?a")),
    (11, "http://f.net/", "<!--" + LINK.format("https://shop.com/de/") + "--><p>"),
    (12, "http://g.net/", "<script>" + LINK.format("https://shop.com/de/") + "</script>"),
    (13, None, LINK.format("https://shop.com/de/")), (14, "no scheme/de/", None),
    (15, "ftp://EXAMPLE.org/es/", "x"), (16, "http://notexample.org/es/", "x"),
    (17, "http://sub.example.org:80/es/", "x"), (18, "http://example.org?/es/", "x"),
    (19, "http://h.net/", LINK.format("mailto:x@shop.com")), (None, "http://x.com/de/", ""),
    (20, "a://b://c.org/es/", ""), (21, "", ""), (1, "http://a.net/x", None),
    (22, "http://i.net/", LINK.format("#top") + LINK.format("https://shop.com/de/")),
    (23, "http://j.net/", "<link rel=canonical>" + LINK.format("https://shop.com/de/j")),
    (24, "http://k.net/", LINK.format("http://other.net/") + LINK.format("https://shop.com/de/k")),
    (25, "http://l.net/", HOP.format("/away") + HOP.format("https://shop.com/de/l")),
    (26, "http://m.net/" + "p/" * 20_000, "<p>" * 100_000 + LINK.format("https://shop.com/de/m")),
]


@pytest.fixture(scope="module")
def found(spark):
    df = with_clashes(spark.createDataFrame(CASES, PAGES))
    return {(r.page_id, r.url): r for r in
            U.judge(df).join(df.select("page_id", "url").distinct(), "page_id").collect()}


def test_same_as_sql_on_planted_links(spark):
    import duckdb
    con = duckdb.connect()
    pages = spark.createDataFrame(CASES, PAGES).toPandas()  # noqa: F841  read by name below
    con.execute("CREATE TABLE pages AS SELECT CAST(page_id AS BIGINT) AS page_id, url, html FROM pages")
    assert compare(U.judge(spark.createDataFrame(CASES, PAGES)), con, U.oracle()) == []


def test_verdicts(found):
    verdict = {k[0]: (r.rule, r.verdict, r.by) for k, r in found.items()}
    blocked_alias, free = (None, "block", "alias"), (None, "allow", "default")
    assert verdict[1] == verdict[2] == verdict[4] == verdict[8] == verdict[9] == blocked_alias
    assert verdict[22] == verdict[23] == verdict[24] == verdict[25] == verdict[26] == blocked_alias
    assert verdict[3] == verdict[10] == verdict[11] == verdict[12] == verdict[14] == verdict[19] == free
    assert verdict[5] == ("com/fr/", "allow", "rule")
    assert verdict[6] == (None, "allow", "alias")
    assert verdict[15][0] == "example.org/es/" and verdict[17] == free  # a port is part of the host
    assert verdict[16] == ("org/", "allow", "rule") and verdict[18] == free


def test_longest_rule_wins_and_allow_wins_ties(spark):
    rules = (U.Rule("block", "a.b", "/x"), U.Rule("allow", "b", "/x12"), U.Rule("block", "b", "/x1"),
             U.Rule("block", "c", "/t"), U.Rule("allow", "c", "/t"))
    df = spark.createDataFrame([("a.b", "/x123"), ("a.b", "/x1"), ("c", "/t"), ("q", "/")],
                               "h string, p string")
    got = [r[0] and r[0].verdict for r in
           df.select(U.fitting_rule(F.col("h"), F.col("p"), rules)).collect()]
    assert got == ["allow", "block", "allow", None]
    assert df.select(U.fitting_rule(F.col("h"), F.col("p"), ())).collect()[0][0] is None
    with pytest.raises(ValueError):
        U.fitting_rule(F.col("h"), F.col("p"), rules * 500)


def test_edges_from_elsewhere_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://z.net/a", "")], PAGES)
    hop = spark.createDataFrame([("http://z.net/a", "http://x.com/de/1")], "a string, b string")
    assert U.judge(df, edges=hop).first().verdict == "block"
    assert U.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_no_python_in_the_plan(spark):
    df = U.judge(spark.createDataFrame(CASES, PAGES))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
