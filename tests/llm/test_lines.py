from ledgerlake.llm import lines
from tests.llm import edge


def brute(rows, min_sites):
    def bare(line):
        return line.strip(" \t\r\x0b\x0c")

    sites = {}
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            if bare(line):
                sites.setdefault(bare(line), set()).add(source)
    spread = {x for x, s in sites.items() if len(s - {None}) >= min_sites}
    held = {}  # line -> for each distinct text, whether it is mostly spread lines
    for text in {t for _, t, _ in rows if t}:
        own = [bare(x) for x in text.split("\n") if bare(x) in spread]
        for x in set(own):
            held.setdefault(x, []).append(2 * sum(map(len, own)) > len(text))
    gone = {x for x, mostly in held.items() if not 2 * sum(mostly) > len(mostly)}
    out = []
    for i, text, _ in rows:
        kept = None if text is None else [x for x in text.split("\n") if bare(x) not in gone]
        out.append((i, text, 0) if text is None else (i, "\n".join(kept), text.count("\n") + 1 - len(kept)))
    return sorted(out, key=repr)


def run(spark, rows, min_sites):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = lines.remove_boilerplate(df, min_sites=min_sites).collect()
    return sorted(((r.doc_id, r.text, r._removed_lines) for r in got), key=repr)


def test_by_brute_force_around_the_threshold(spark):
    rows = []
    for n in range(1, 30):  # line n stands on n sites
        for s in range(n):
            rows.append((1000 * n + s, f"own text of document {n} {s}, long enough to stay\n\n line number {n} \nmore own words {s} {n}", f"s{s}"))
    rows += [(i, "line number 20", "s1") for i in range(3)]  # nothing else: cut as well
    rows += [(90_000 + i, "same site only\nand some other words here", "s1") for i in range(40)]
    got = run(spark, rows, 8)
    assert got == brute(rows, 8)
    assert [x for x in got if x[0] < 3] == [(i, "", 1) for i in range(3)]


def test_copies_on_many_sites_are_no_boilerplate(spark):
    """Exact and near copies of an article keep their lines, and lose the notice that unrelated texts hold too."""
    notice = "This work is licensed under the terms of the public licence."
    article = [f"line {k} of the article that was copied to many sites" for k in range(12)]
    rows = []
    for i in range(40):
        own = [f"changed in copy {i}" if i % 3 and k == i % 12 else x for k, x in enumerate(article)]
        rows.append((i, "\n".join([*own, notice]), f"s{i % 20}"))
    rows += [(100 + i, f"page {i} has words of its own and says a good deal more than its notice does, at length\n{notice}", f"s{i}") for i in range(60)]
    rows.append((999, f"short page\n{notice}", "s3"))  # mostly notice, and cut all the same
    got = run(spark, rows, 8)
    assert got == brute(rows, 8)
    texts = {i: t for i, t, _ in got}
    assert all(notice not in t for t in texts.values()) and texts[999] == "short page"
    assert all(texts[i].count("\n") == 11 for i in range(40))


def test_random_texts_by_brute_force(spark):
    import random

    rng = random.Random(6)
    pool = [f"{'long ' * (k % 4)}line {k}" for k in range(25)]
    rows = [(i, rng.choice([None, ""]) if i % 50 == 0 else "\n".join(rng.choice([*pool, f" own {i} ", "", f"words of text {i} that stand in no other one"]) for _ in range(rng.randint(1, 9))),
             rng.choice([None, *(f"s{k}" for k in range(9))])) for i in range(400)]
    for min_sites in (1, 3, 8):
        assert run(spark, rows, min_sites) == brute(rows, min_sites)


def test_columns_of_any_name_come_back(spark):
    clash = ["_ta", "_tb", "_cut", "_gone", "_ra", "_rb", "_la", "_lb", "_at", "_line", "_size", "_held", "carried 0", "_n_lines"]
    df = spark.createDataFrame([(i, f"notice\nown words of this page number {i}", f"s{i}", *clash) for i in range(9)], ["doc_id", "text", "source", *clash])
    for r in lines.remove_boilerplate(df, min_sites=2).collect():
        assert [r[c] for c in clash] == clash and r._removed_lines == 1


def test_edges(spark):
    df = edge.docs(spark)
    out = lines.remove_boilerplate(df, min_sites=1)
    assert out.columns == [*edge.DOCS.names, "_removed_lines"]
    got = sorted(((r.doc_id, r.text, r._removed_lines) for r in out.collect()), key=repr)
    assert got == brute([(r[0], r[1], r[3]) for r in edge.rows()], 1)
    assert lines.remove_boilerplate(edge.no_docs(spark)).count() == 0
    digest = {r.doc_id: r for r in lines.line_digest(df).collect()}
    assert digest[0].n_lines == 0 and digest[1].n_lines == 1


def test_a_line_on_most_rows_is_one_row_a_task(spark):
    rows = [(i, f"hot line of the corpus\nwords of document {i} and a few more of them", f"s{i % 3}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = lines.boilerplate_lines(df, min_sites=3)
    assert found.count() == 1
    assert lines.boilerplate_lines(df, min_sites=4).count() == 0
