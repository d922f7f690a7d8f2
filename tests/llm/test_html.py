import re

from ledgerlake.llm.html_text import extract_text, main_text

PROSE = "The house that stands on the hill was built by the people of the town, and it is one of the oldest in the land."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_main_text_of_given_pages_is_the_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in extract_text(pages).collect():
        lines = [" ".join(x.split()) for x in docs[int(re.search(r"/(\d+)", r.url)[1])].split("\n")]
        assert r.text.split("\n")[1:] == [x for x in lines if x], r.page_id  # below the headline
        assert r.n_chars == len(r.text)


def test_boilerplate_goes():
    body = f"""
    <header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href=/a>{PROSE}</a></ul></nav>
    <div class="cookie-notice">{PROSE}</div><div id='sidebar'><p>{PROSE}</p></div><aside>{PROSE}</aside>
    <article><header><h1>Headline</h1></header><p>{PROSE} One.</p><p>Short.</p>
      <div class="ad-banner">{PROSE}</div><form><p>{PROSE}</p><input></form>
      <script>var x = "<p>{PROSE}</p>";</script><noscript>{PROSE}</noscript><!-- <p>{PROSE}</p> -->
      <p>{PROSE}<br>Two &amp; three&nbsp;&eacute; &#x41;</p><p><a href=/r>Read</a> <a href=/s>more here</a></p>
      <p>End.</p></article>
    <section class="comments"><p>{PROSE}</p></section><div role="dialog">{PROSE}</div>
    <footer>{PROSE}</footer>"""
    assert main_text(page(body)).split("\n") == [
        "Headline", f"{PROSE} One.", "Short.", f"{PROSE} Two & three é A", "Read more here", "End.",
    ]


def test_pages_without_an_article():
    body = f"<div>Menu</div><div><a href=/>One</a> | <a href=/>Two</a></div><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p><div class=footer>c</div>"
    text = main_text(page(body)).split("\n")
    assert text[-3:] == [PROSE, "Short.", PROSE]
    assert "One | Two" not in text and "c" not in text


def test_unclosed_and_stray_tags():
    assert main_text(f"<article><h1>H<p><b>{PROSE}<br><p>Two</div></p></em><p>Three") == f"H\n{PROSE}\nTwo\nThree"
    assert main_text(f"<article><p>{PROSE}<script>never closed <p>x") == PROSE
    assert main_text("<p>a < b and c > d &lt;p&gt;</p>") == "a < b and c > d <p>"
    assert main_text("just text") == "just text"
    assert main_text("<p>only short</p>") == "only short"
    assert main_text(f"<article><p>{PROSE}</p></article><!-- never closed <p>x") == PROSE


def test_names_of_states_mark_nothing():
    for start in ("<article class='post comment-open'>", "<article id=comments>", "<div class='content has-sidebar'>",
                  "<div class='no-sidebar comments-closed'>", "<div class='page-with-sidebar widget'><article>", "<div class=widget>"):
        assert main_text(f"{start}<p>{PROSE} One.</p><p>{PROSE} Two.</p>") == f"{PROSE} One.\n{PROSE} Two.", start
    # beside an article the same names mark again
    assert main_text(f"<div class=widget><p>{PROSE}</p></div><article><p>{PROSE} One.</p></article>") == f"{PROSE} One."
    assert main_text(f"<article><p>{PROSE} One.</p><div class=comments><p>{PROSE}</p></div></article>") == f"{PROSE} One."


def test_a_linked_paragraph_of_the_article_stays():
    body = f"<article><p>{PROSE} One.</p><p><a href=/x>{PROSE}</a></p><p>{PROSE} Two.</p><p><math>x + y</math></p></article>"
    assert main_text(page(body)) == f"{PROSE} One.\n{PROSE}\n{PROSE} Two.\nx + y"


def test_work_is_linear_in_the_page():
    import time

    for piece in ('<p "x ', "<p a='x ", "<p a=\"x '", "</script ", "<script></scrip", "<!-- ", "<", "<a b=\" >", "<p a= \"", "&amp"):
        start = time.time()
        main_text(piece * (1_000_000 // len(piece)))
        main_text("<p>t" + piece * (300_000 // len(piece)) + ">")
        assert time.time() - start < 5, piece


def brute_inherited(labels, region_of, outside, i):
    """Nearest decided block by trying every distance."""
    own = region_of[i]
    decided = [j for j, x in enumerate(labels) if x is not None and (not own or region_of[j] == own and not outside[j])]
    if own and any(labels[j] for j in decided):
        decided = [j for j in decided if labels[j]]
    for gap in range(1, len(labels)):
        near = [labels[j] for j in (i - gap, i + gap) if j in decided]
        if near:
            return any(near)
    return True


def test_open_blocks_by_brute_force():
    import random

    from ledgerlake.llm import html_text as ht

    rng = random.Random(4)
    for _ in range(200):
        parts = []
        for k in range(rng.randint(1, 12)):
            kind = rng.choice(["<p>{}</p>", "<div><a href=/>{}</a></div>", "<nav>{}</nav>", "<article><p>{}</p></article>"])
            parts.append(kind.format(rng.choice([f"short {k}", f"{PROSE} {k}", "zq " * 60 + str(k)])))
        blocks = ht.blocks_of("".join(parts))
        labels = [ht.decide(b) for b in blocks]
        marked = any(b.region and not b.outside for b in blocks)
        want = []
        for i, b in enumerate(blocks):
            label = labels[i]
            if label is None:
                label = brute_inherited(labels, [x.region for x in blocks], [x.outside for x in blocks], i)
            if label and not (marked and not b.region):
                want.append(b.text)
        assert main_text("".join(parts)).split("\n") == (want or [""])


def test_edges(spark):
    long = "<article>" + "".join(f"<p>{PROSE} {i}</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", long, "x"), (3, "u", long, "x"), (None, "u", "<nav>a</nav>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    out = extract_text(df).collect()
    assert len(out) == 5 and extract_text(df.limit(0)).count() == 0
    by = {r.page_id: r for r in out}
    assert by[1].text == by[2].text == by[None].text == "" and by[1].n_chars == 0
    assert by[3].text.count("\n") == 4999
