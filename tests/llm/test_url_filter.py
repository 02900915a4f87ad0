from tickloom.llm.url_filter import judge_urls

PAGE = "page_id long, url string, html string"


def verdicts(spark, rows, **options):
    out = judge_urls(spark.createDataFrame(rows, PAGE), **options).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}


def test_rules_hosts_and_paths(spark):
    got = verdicts(spark, [
        (1, "http://WWW.Example.com/en/x?q#f", None), (2, "https://a.example.com/en/", ""),
        (3, "http://notexample.com/en/", ""), (4, "x://www.example.com/EN/", ""), (5, "ftp://a.net/es/1", ""),
        (6, "http://net/fr/", ""), (7, "http://a.com", ""), (8, "http://b.org?x://y", ""), (9, None, None),
        (10, "no scheme/en/", ""), (11, "", ""), (12, "http://H.org#/en/", ""), (13, "http://com/", ""),
    ])
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/", "example.com/en/", "block")
    assert got[3] == ("notexample.com", "/en/", "com/", "allow")
    assert got[4] == ("www.example.com", "/EN/", "com/", "allow")
    assert got[5] == ("a.net", "/es/1", "net/es/", "block")
    assert got[6] == ("net", "/fr/", "net/fr/", "block")
    assert got[7] == ("a.com", "", None, "allow")
    assert got[8] == ("b.org", "", None, "allow")
    assert got[9] == got[10] == got[11] == ("", "", None, "allow")
    assert got[12] == ("h.org", "", None, "allow") and got[13] == ("com", "/", "com/", "allow")


def test_decisions_reach_aliases_and_allow_wins(spark):
    def canonical(url):
        return f'<head><LINK href="{url}" rel="canonical"></head>'

    got = verdicts(spark, [
        (1, "http://a.org/1", canonical("http://x.net/es/1")),  # blocked through its target
        (2, "http://a.org/2", '<meta http-equiv="refresh" content="0; url=/1">'),  # through page 1
        (3, "http://b.org/1", canonical("//x.net/fr/9")),
        (4, "http://b.org/2", canonical("http://b.org/1")),
        (5, "http://x.com/ok", canonical("http://b.org/2")),  # its rule allows the group of 3 and 4
        (6, "http://y.net/es/2", canonical("http://x.com/ok")),  # its own rule still blocks it
        (7, "http://c.org/d/e", '<link rel=canonical href=f>'), (8, "http://c.org/d/f", None),
        (9, "http://z.org/", "<link rel=canonical href=" * 1000), (10, "http://a.org/1", None),
    ], redirects=spark.createDataFrame([("http://c.org/d/f", "http://q.net/fr/"), (None, "x")], "from_url string, to_url string"))
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "block",
        9: "allow", 10: "block",
    }


def test_no_rows_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/", "")] * 2, PAGE)
    assert judge_urls(df.limit(0)).count() == 0
    extra = df.selectExpr("*", "1 AS host", "2 AS rule", "3 AS key", "4 AS found", "5 AS verdict")
    assert [r.verdict for r in judge_urls(extra).collect()] == ["block", "block"]
