from cohortlens.llm.url_filter import alias_edges, url_verdicts

KIND = "page_id long, url string, html string, host string, node string, component string"


def page(i, url, html=""):
    return (i, url, html, "x", "x", "x")


def link(url):
    return f"<head><LINK href='{url}' rel=canonical></head>"


def verdicts(spark, rows, **more):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(spark.createDataFrame(rows, KIND), **more).collect()}


def test_rules_and_aliases(spark):
    rows = [
        page(1, "http://A.Example.NET/en/x?q#f"), page(2, "https://example.net/de"), page(3, "https://example.net"),
        page(4, "http://example.com/de/1"), page(5, "http://notexample.com/de/1"), page(6, "ftp://x.org/fr/"),
        page(7, None), page(8, "no scheme"), page(9, ""),
        # an alias of a blocked page, one two steps away, and one that an allow saves
        page(10, "http://a.test/1", link("http://example.com/de/1")),
        page(11, "http://a.test/2#x", '<meta http-equiv="refresh" content="0; url=/1">'),
        page(12, "http://b.test/1", link("//example.com/de/7")), page(13, "http://b.test/2", link("http://B.test/1")),
        page(14, "http://x.org/fr/9", link("http://b.test/2")),
        page(15, "http://c.test/", link("relative.html")), page(16, "http://c.test/", None), page(16, "http://c.test/", None),
    ]
    got = verdicts(spark, rows)
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2][2:] == ("net/", "block") and got[3] == ("example.net", "", None, "allow")
    assert got[4][2:] == ("example.com/de/", "block") and got[5][2:] == (None, "allow") and got[6][2:] == ("org/fr/", "allow")
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10][2:] == got[11][2:] == (None, "block")
    assert got[12][2:] == got[13][2:] == (None, "allow") and got[14][3] == "allow"
    assert got[15][3] == got[16][3] == "allow"


def test_redirect_table_and_default(spark):
    redirects = spark.createDataFrame([("http://s.test/a", "http://s.test/b"), ("http://s.test/b", "http://example.com/de/"),
                                       (None, "http://x/"), ("http://s.test/a", "http://s.test/a")], "source string, target string")
    rows = [page(1, "http://s.test/a"), page(2, "http://s.test/c")]
    got = verdicts(spark, rows, redirects=redirects, default="block")
    assert got[1][3] == "block" and got[2][3] == "block"
    assert verdicts(spark, rows, redirects=redirects)[2][3] == "allow"


def test_empty_table(spark):
    assert verdicts(spark, []) == {}


def test_relative_targets(spark):
    from cohortlens.llm.url_filter import alias_edges
    base = "http://c.test/a/b/page?x=1#y"
    want = {"page.html": "/a/b/page.html", "./q": "/a/b/q", "../x": "/a/x", "../../../z/": "/z/", "..": "/a/", ".": "/a/b/",
            "?id=3": "/a/b/page?id=3", "d/./e/../f?p=../g": "/a/b/d/f?p=../g", "go?u=http://o.test/": "/a/b/go?u=http://o.test/"}
    edges = alias_edges(spark.createDataFrame([page(i, base, link(x)) for i, x in enumerate([*want, "mailto:a@b", "#top"])], KIND))
    assert sorted(r.target for r in edges.collect()) == sorted("http://c.test" + x for x in want.values())
    rows = [page(1, "http://example.com/fr/1", link("../de/1")), page(2, "http://example.com", link("de/2")),
            page(3, "http://c.test/blog", link("?id=3")), page(4, "http://c.test/blog?id=3", link("http://example.com/de/1")),
            page(5, "http://c.test/other", link("mailto:x@example.com"))]
    assert {i: v[3] for i, v in verdicts(spark, rows).items()} == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow"}


def targets(spark, html, url="http://h.a/x/y.html?q"):
    pages = spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")
    return sorted(r.target for r in alias_edges(pages).collect())


def test_all_links_of_a_page_count(spark):
    html = ('<link rel="canonical" href="http://one.a/"><LINK href=http://two.a/ rel=canonical>'
            "<link rel='shortcut canonical' href='http://three.a/'><link rel=\"x canonical\ty\" href=\"http://four.a/\">"
            '<meta http-equiv="refresh" content="0; url=http://five.a/"><meta content="0;URL=\'http://six.a/\'" http-equiv=Refresh>')
    assert targets(spark, html) == [f"http://{x}.a/" for x in sorted(("one", "two", "three", "four", "five", "six"))]


def test_comments_other_rels_and_attributes_do_not_count(spark):
    html = ('<!-- <link rel="canonical" href="http://no.a/"> --><link rel="canonical-x" href="http://no.a/">'
            '<link data-rel="canonical" rel="icon" href="http://no.a/"><link rel="canonical" data-href="http://no.a/">'
            '<!-- open <meta http-equiv="refresh" content="0; url=http://no.a/">')
    assert targets(spark, html) == []


def test_base_of_relative_targets(spark):
    link = '<link rel="canonical" href="../z/./w.html?p=1">'
    assert targets(spark, link) == ["http://h.a/z/w.html?p=1"]
    assert targets(spark, '<base target=x><base href="http://b.a/p/q/"><base href="/no/">' + link) == ["http://b.a/p/z/w.html?p=1"]
    assert targets(spark, '<base href="/r/s/t">' + link) == ["http://h.a/r/z/w.html?p=1"]
    assert targets(spark, "<link " + 'x="" ' * 60_000 + 'rel=canonical href="/long">') == ["http://h.a/long"]


def test_sql_agrees_on_links_of_every_form(spark):
    import duckdb

    from cohortlens.llm.queries import ORACLE, QUERIES  # noqa: F401
    from cohortlens.llm.url_filter import url_verdicts
    forms = ["http://b{i}.net/", "//b{i}.net/p", "/root{i}", "p{i}.html", "../up/./d{i}/..", "?id={i}", "#f", "mailto:a@b", "./", "..", "x&amp;y={i}"]
    rows = []
    for i in range(120):
        link = forms[i % len(forms)].format(i=i % 7)
        tag = (f'<link rel="canonical" href="{link}">' if i % 3 else f'<meta http-equiv=refresh content="1; url={link}">')
        base = f'<base href="/base{i % 4}/sub/x">' if i % 5 == 0 else ""
        hide = f"<!--{tag}-->" if i % 11 == 0 else tag
        rows.append((i, [f"http://h{i % 9}.com/d/e{i % 13}", f"http://b{i % 7}.net/p", None, "no scheme", f"HTTP://Ex.org/fr/{i}?x#y"][i % 5],
                     None if i % 29 == 0 else base + hide))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = url_verdicts(pages)
    con = duckdb.connect()
    con.register("frame", pages.toPandas())
    con.execute("CREATE VIEW pages AS SELECT * FROM frame")
    want = con.execute(ORACLE["op4_url_filter"]).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[names.index("component")] is not None for r in want) > 20
