import random
from itertools import combinations

from ledgerlake.llm import decontaminate
from tests.llm import edge

ITEMS = "item_id long, text string"
DOCS = "doc_id long, text string"


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def found(spark, docs, items, **options):
    rows = decontaminate.find_contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options
    ).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_substitutions_are_tolerated(spark):
    item = words(1, 40)
    noise = words(2, 400)
    changed = [w if i % 7 else "zzzzzz" for i, w in enumerate(item)]  # every 7th word
    ruined = [w if i % 2 else f"q{i}" for i, w in enumerate(item)]  # every second word
    docs = [
        (1, " ".join(noise[:100] + item + noise[100:])),
        (2, " ".join(noise[:50] + changed + noise[50:])),
        (3, " ".join(noise[:50] + ruined + noise[50:])),
        (4, " ".join(noise)),
        (5, "-- ".join(w.upper() for w in item[10:30])),  # half of it, other case and marks
        (6, " ".join(item[:9] + noise[:300])),  # too little
    ]
    out = found(spark, docs, [(7, " ".join(item)), (8, "short one"), (9, None), (10, "")])
    assert set(out) == {(1, 7), (2, 7), (5, 7)}
    assert out[1, 7].start == 100 and out[1, 7].matched == 40 and out[1, 7].best_overlap == 13
    assert out[5, 7].start == -10


def test_every_placement_of_the_substitutions_is_found(spark):
    # By the rule itself, without masks: one more substitution than it allows is not found.
    items, docs, want = [], [], set()
    for n in (*range(1, 14), 15):
        item = words(100 + n, n)
        items.append((n, " ".join(item)))
        width = min(n, 13)
        allowed = width - -(-10 * width // 13)
        for many in range(allowed + 2):
            for gone in combinations(range(n), many):
                if many > allowed and len(docs) % 5:
                    docs.append((None, ""))
                    continue
                text = [f"z{i}" if i in gone else w for i, w in enumerate(item)]
                same = [w == x for w, x in zip(item, text)]
                if any(13 * sum(same[i : i + width]) >= 10 * width for i in range(n - width + 1)):
                    want.add((len(docs), n))
                docs.append((len(docs), " ".join(["before", "it", *text, "after", "it"])))
    assert len(want) > 1000
    assert set(found(spark, docs, items)) == want


def test_blocks_give_the_same(spark):
    docs = [(i, " ".join(words(i, 60) + words(1000 + i % 5, 30))) for i in range(20)]
    items = [(i, " ".join(words(1000 + i, 30))) for i in range(5)]
    assert set(found(spark, docs, items)) == set(found(spark, docs, items, block_rows=40)) == {(i, i % 5) for i in range(20)}


def test_edges(spark):
    items = spark.createDataFrame([(1, edge.PROSE), (1, edge.PROSE), (None, "a b c d e f g h i j k l m n")], ITEMS)
    df = edge.docs(spark)
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_contamination(df, items).collect())
    assert got == [(5, 1), (6, 1), (7, 1)]
    kept = decontaminate.decontaminate(df, items)
    assert kept.columns == edge.DOCS.names
    want = [r for r in edge.rows() if r[0] not in (5, 6, 7)]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, spark.createDataFrame(want, edge.DOCS).collect()))
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find_contamination(df, none).count() == 0
    assert decontaminate.decontaminate(df, none).count() == len(edge.rows())
    assert decontaminate.find_contamination(edge.no_docs(spark), items).count() == 0


def test_a_text_goes_by_its_own_passage_whatever_its_id(spark):
    leak, clean, other = (" ".join(words(k, 40)) for k in (50, 51, 52))
    rows = [(None, leak), (None, clean), (None, None), (3, leak), (3, clean), (4, other)]
    kept = decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(1, leak)], ITEMS))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([r for r in rows if r[1] != leak], key=repr)


def test_no_python_in_the_plan(spark):
    df = decontaminate.find_contamination(edge.docs(spark), spark.createDataFrame([(1, edge.PROSE)], ITEMS))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_columns_of_any_name_come_back(spark):
    clash = ["_leak", "_leak_a", "_leak_b", "_doc", "_ta", "_h", "carried 0"]
    rows = [(1, " ".join(words(50, 40)), *clash), (2, " ".join(words(51, 40)), *clash)]
    kept = decontaminate.decontaminate(
        spark.createDataFrame(rows, ["doc_id", "text", *clash]), spark.createDataFrame([(1, rows[0][1])], ITEMS)
    ).collect()
    assert [tuple(r) for r in kept] == [rows[1]]
