from clickmarts.llm.components import components
from clickmarts.llm.url_filter import judge

PAGES = "page_id long, url string, html string"


def test_rules(spark):
    urls = [(None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"),
            ("http://WWW.Example.com/en/a?q#f", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
            ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
            ("https://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
            ("https://example.com/EN/x", "example.com", "/EN/x", "com/", "allow"),
            ("x://a.net/fr/1://z", "a.net", "/fr/1:", None, "x"), ("ftp://net/es/", "net", "/es/", "net/es/", "block"),
            ("http://com", "com", "", None, "allow"), ("http://a.org/fr/", "a.org", "/fr/", None, "allow")]
    urls[6] = ("x://a.net/fr/1://z", "a.net", "/fr/1://z", "net/fr/", "block")
    df = spark.createDataFrame([(i, u[0], None) for i, u in enumerate(urls)], PAGES)
    got = {r["page_id"]: tuple(r)[1:] for r in judge(df).collect()}
    assert got == {i: u[1:] for i, u in enumerate(urls)}


def test_aliases(spark):
    def link(u):
        return f'<head><LINK href="{u}" rel="canonical"></head>'

    rows = [(1, "http://a.org/x", link("https://b.org/y/")), (2, "http://b.org/y", '<meta http-equiv="refresh" content="0; url=//c.net/fr/1">'),
            (3, "http://c.net/fr/1#top", ""), (4, "http://www.example.com/en/z", link("http://a.org/x")), (5, "http://d.org/x", link("/w")),
            (6, "http://d.org/w", None), (7, "http://a.org/x/", None), (8, "http://a.org/x?q=1", None), (9, "nothing", link("http://c.net/fr/1"))]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow", 9: "allow"}


def test_targets_without_rows_and_further_links(spark):
    def link(*urls):
        return "".join(f'<link rel="canonical" href="{u}">' for u in urls)

    def refresh(*urls):
        return "".join(f'<meta http-equiv="refresh" content="0; url={u}">' for u in urls)

    rows = [(1, "http://a.org/x", link("http://c.net/fr/1")), (2, "http://b.org/y", link("http://a.org/x")),
            (3, "http://d.org/1", link("http://d.org/2", "http://c.net/es/2")), (4, "http://d.org/2", None),
            (5, "http://e.org/1", refresh("http://e.org/2", "http://c.net/es/3")), (6, "http://e.org/2", ""),
            (7, "http://www.example.com/en/z", link("http://c.net/fr/1")), (8, "http://f.org/", refresh("http://g.org/fr/")),
            (9, "nothing", link("http://c.net/fr")), (10, "http://c.net/fr", None), (11, "http://h.net/es", link("/es/")),
            (12, "http://i.org/", link("http://www.example.com/en/q")), (13, "http://i.org/1", link("http://j.org/1")),
            (14, "http://i.org/2", refresh("http://j.org/1")), (15, "http://i.org/3", link("http://j.org/1", "http://c.net/fr/9"))]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(rows, PAGES)).collect()}
    blocked = {1, 2, 3, 4, 5, 6, 11, 13, 14, 15}
    assert got == {i: "block" if i in blocked else "allow" for i in range(1, 16)}


def test_dot_segments_and_comments(spark):
    def link(u):
        return f'<link rel="canonical" href="{u}">'

    rows = [(1, "http://c.net/a/b/c", link("../../fr/1")), (2, "http://c.net/a/b", link("/x/../es/./2")),
            (3, "http://c.net/a/b/d", link("./x")), (4, "http://k.org/1", "<!-- " + link("http://c.net/fr/9") + " -->" + link("/2")),
            (5, "http://k.org/2", None), (6, "http://k.org/3", "<!--" + link("http://c.net/fr/9")),
            (7, "http://k.org/4", "<!-- a --><!-- b -->" + link("http://c.net/fr/9")), (8, "http://k.org/x/../5", link("http://c.net/es/")),
            (9, "http://k.org/5", ""), (10, "http://c.net/p", link("../../../fr/..")), (11, "http://c.net/p/q", link("http://c.net/fr/..?a=/../fr/"))]
    got = {r["page_id"]: r["verdict"] for r in judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: "block" if i in (1, 2, 7, 8, 9) else "allow" for i in range(1, 12)}


def test_paths_without_dot_segments(spark):
    from clickmarts.llm.url_filter import resolved
    paths = {"": "", "/": "/", "/a/b": "/a/b", "/a/./b": "/a/b", "/a/../b": "/b", "/..": "/", "/../../x": "/x", "/a/..": "/", "/a/b/..": "/a/",
             "/a/.": "/a/", "/a//../b": "/a/b", "/...": "/...", "/a/..b": "/a/..b", "/./": "/", "/a/b/../../c/./d/": "/c/d/"}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r["p"]: r["r"] for r in df.select("p", resolved(df["p"]).alias("r")).collect()} == paths


def test_empty_and_columns(spark):
    df = spark.createDataFrame([(1, "http://a.net/es/", "x", 1, 2)], PAGES + ", host int, component int")
    assert judge(df).collect()[0]["verdict"] == "block"
    assert judge(df.limit(0)).count() == 0


def test_components(spark):
    import random
    r = random.Random(0)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [
        (2000, 2000 + i) for i in range(300)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {tuple(x) for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(x, root(x)) for x in list(parent)}
