from ledgerlake.llm import urls

PAGES = "page_id long, url string"


def judged(spark, rows, labels=(), **options):
    pages = spark.createDataFrame(rows, PAGES)
    marks = spark.createDataFrame(list(labels), "_page long, _bad boolean")
    return {r.page_id: r for r in urls.judge_urls(pages, marks, **options).collect()}


CASES = [
    ("http://a.org/x", "a.org", "/x", "org/", "allow"),
    ("http://a.org", "a.org", "", None, "allow"),  # an empty path does not start with /
    ("https://WWW.Example.ORG/es/1?q=/en/", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("x://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("x://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("x://a.com/de/x#y", "a.com", "/de/x", "com/de/", "block"),
    ("x://a.com/fr/?u=http://b.org/", "a.com", "/fr/", "com/fr/", "allow"),
    ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("x://a.com?u=b/fr/", "a.com", "", None, "allow"),
    ("a.com/fr/", "", "", None, "allow"),
    ("x:///de/", "", "/de/", None, "allow"),
    ("x://a.com/x\n/de://y", "a.com", "/x\n/de://y", None, "allow"),
    ("x://ÀB.net/É", "Àb.net", "/É", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_rules(spark):
    out = judged(spark, [(i, x[0]) for i, x in enumerate(CASES)])
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(len(CASES))] == [x[1:] for x in CASES]


def test_labels_block_a_template_and_spare_the_others(spark):
    rows, labels = [], []
    for i in range(400):
        section = ("bad", "good", "news", "blog")[i % 4]
        rows.append((i, f"http://h.net/{section}/{i}.html"))
        if i % 2 == 0 or section in ("news", "blog"):
            labels.append((i, section == "bad" or i % 40 == 2))
    out = judged(spark, rows, labels)
    by = {s: {out[i].verdict for i, u in rows if f"/{s}/" in u} for s in ("bad", "good", "news", "blog")}
    assert by == {"bad": {"block"}, "good": {"allow"}, "news": {"allow"}, "blog": {"allow"}}
    assert out[0].template == "/bad/*"


def test_similar_branches_merge_and_variable_segments_generalise(spark):
    rows = [(i, f"http://h.net/{'abcd'[i % 4]}/slug-{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 7 % 26)}") for i in range(2000)]
    out = judged(spark, rows, [(i, i // 4 % 10 == 0) for i in range(2000)])
    assert {r.template for r in out.values()} == {"/*/*"}


def test_a_bad_section_is_blocked_beside_any_number_of_good_ones(spark):
    for good in (5, 49, 50, 120):
        rows = [(40 * s + i, f"http://h.net/section-{chr(97 + s // 26)}{chr(97 + s % 26)}/{i}") for s in range(good + 1) for i in range(40)]
        out = judged(spark, rows, [(i, i < 40) for i, _ in rows])
        assert {out[i].verdict for i in range(40)} == {"block"}
        assert {out[i].verdict for i, _ in rows[40:]} == {"allow"}


def test_labels_are_followed_however_deep(spark):
    rows = [(i, f"http://h.net/a/b/c/d/e/f/{'spam' if i < 200 else 'good'}/{i}/more") for i in range(400)]
    out = judged(spark, rows, [(i, i < 200) for i, _ in rows])
    assert {out[i].verdict for i in range(200)} == {"block"} and {out[i].verdict for i in range(200, 400)} == {"allow"}
    assert out[0].template == "/*/*/*/*/*/*/spam/*/*"


def test_the_tree_rejects_pages_of_the_given_shape(spark):
    """Urls as the given pages have them: language and number; one language all bad."""
    hosts = ("site1.example.net", "blog.example.com")
    rows = [(i, f"https://{hosts[i % 2]}/{('en', 'it', 'es')[i // 2 % 3]}/{i}") for i in range(600)]
    out = judged(spark, rows, [(i, i // 2 % 3 == 1 or i % 30 == 0) for i in range(600) if i % 5])
    blocked = {u.split("/")[3] for i, u in rows if out[i].verdict == "block" and out[i].rule is None}
    assert blocked == {"it"} and all(out[i].verdict == "block" for i, u in rows if "/it/" in u)


def test_a_star_in_a_path_is_no_wildcard(spark):
    rows = [(i, f"http://h.net/{'**' if i % 2 else '7'}/x") for i in range(100)]
    out = judged(spark, rows, [(i, bool(i % 2)) for i, _ in rows])
    assert {out[i].verdict for i, _ in rows if i % 2} == {"block"} and {out[i].verdict for i, _ in rows if not i % 2} == {"allow"}


def test_columns_of_any_name_come_back(spark):
    clash = ["_shape", "_rule", "_vh", "_vs", "_verdict", "_id", "_page", "_bad", "carried 0", "url_shapes"]
    rows = [(1, "http://h.net/a/1", *clash)]
    pages = spark.createDataFrame(rows, ["page_id", "url", *clash])
    out = urls.judge_urls(pages, spark.createDataFrame([(1, True)], "_page long, _bad boolean")).first()
    assert [out[c] for c in clash] == clash


def test_purity_is_smoothed(spark):
    rows = [(i, f"http://big.net/p/{i}") for i in range(100)] + [(1000, "http://tiny.net/x/1")]
    out = judged(spark, rows, [(i, False) for i in range(100)] + [(1000, True)])
    assert out[1000].verdict == "allow"  # one bad page does not condemn a host
    all_bad = judged(spark, rows, [(i, True) for i in range(100)] + [(1000, True)])
    assert {r.verdict for r in all_bad.values()} == {"block"}


def test_edges(spark):
    pages = spark.createDataFrame(
        [(1, None, "a", 1), (1, None, "a", 1), (None, "http://h.net/a/b/c/d/e/f", "b", 2), (2, "http://h.net//a//", "c", 3)],
        PAGES + ", verdict string, _shape int",
    ).withColumnRenamed("_shape", "clash")
    marks = spark.createDataFrame([(1, True), (1, True), (77, False)], "_page long, _bad boolean")
    out = urls.judge_urls(pages, marks).collect()
    assert len(out) == 4 and all(r.verdict in ("allow", "block") for r in out)
    assert {r.template for r in out if r.page_id is None} == {"/**"}  # no labels: nothing to tell apart
    none = spark.createDataFrame([], PAGES)
    assert urls.judge_urls(none, marks).count() == 0
    assert urls.labels_by_document_number(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_no_python_and_no_cross_join(spark):
    pages = spark.createDataFrame([(1, "http://h.net/a/1")], PAGES)
    df = urls.judge_urls(pages, spark.createDataFrame([(1, True)], "_page long, _bad boolean"))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
