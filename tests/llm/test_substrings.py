import hashlib
import random

import pytest

from ledgerlake.llm import substrings
from tests.llm import edge


def digest(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.repeat_digest(df).collect()}


@pytest.mark.parametrize("letters,n,length", [("ab", 30, 40), ("abcdefgh", 60, 60)])
def test_by_brute_force(spark, letters, n, length):
    rng = random.Random(n)
    passages = [[rng.choice(letters) for _ in range(rng.randint(5, 30))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = [w for _ in range(3) for w in [*rng.choice(passages), *[rng.choice(letters) for _ in range(rng.randint(0, length // 4))]]]
        rows.append((i * 3 % 101, " ".join(words)))
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, "x y"), (203, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = substrings.brute_force(rows)
    assert digest(substrings.remove_repeats(df)) == want
    assert digest(substrings.remove_repeats(df, bucket_entries=50)) == want
    assert sum(x[1] for x in want.values()) > 100


def test_another_cover(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(25))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = digest(substrings.remove_repeats(df, window=9, period=3, cover=(0, 1)))
    assert got == substrings.brute_force(rows, 9)
    with pytest.raises(ValueError):
        substrings.remove_repeats(df, period=7, cover=(1, 2))


def test_edges(spark):
    out = substrings.remove_repeats(edge.docs(spark)).collect()
    assert len(out) == len(edge.rows())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    n = len(edge.PROSE.split())
    assert [(r.n_words, r.n_removed) for r in by[5]] == [(n, 0), (n, 0)]  # equal rows of one id
    assert by[6][0].n_removed == n and by[6][0].kept_text == ""
    assert by[7][0].n_removed == n and by[7][0].kept_text == "end"
    assert by[0][0].n_words == 0 and by[8][0].n_words == 60_000 and by[8][0].n_removed == 0
    assert sorted(r.kept_text for r in by[4]) == ["another text under one id", "one two three"]
    assert sorted(r.kept_text for r in by[None]) == ["", "no id here"]
    assert substrings.remove_repeats(edge.no_docs(spark)).count() == 0


def test_texts_of_one_id_do_not_mix(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (5, a), (5, b), (5, b + " " + a), (None, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((r.doc_id or -1, r.kept_text) for r in substrings.remove_repeats(df).collect())
    assert got == sorted([(1, a), (5, ""), (5, ""), (5, ""), (-1, b)])


def test_a_passage_in_most_documents(spark):
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join([f"d{i}_{k}" for k in range(20)] + (shared if i % 3 == 0 else []))) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert digest(substrings.remove_repeats(df)) == substrings.brute_force(rows)


def test_digest_of_kept_words(spark):
    df = spark.createDataFrame([(1, "é  b\tc")], "doc_id long, text string")
    assert digest(substrings.remove_repeats(df))[1] == (3, 0, hashlib.sha256("é b c".encode()).hexdigest())


def test_an_equal_hash_of_other_words_removes_nothing():
    """Two windows with one 64-bit hash: told apart by the check, found if that is equal too."""
    import numpy as np

    keys, docs = np.array([7, 7, 7], dtype=np.uint64), np.array([1, 2, 3], dtype=np.int64)
    places, checks = np.array([10, 20, 30], dtype=np.int64), np.array([5, 6, 5], dtype="<u4")

    def found(order):
        rows = []
        for part in order:  # each from a slice of its own
            rows += substrings._send(keys[part], docs[part], places[part], 1, False, checks[part])
        rows.sort(key=lambda r: r[0])
        batches = list(substrings._batches(iter(rows), substrings.SENT))
        out = []
        for _, packed_docs, packed_places in substrings._settle(iter(batches), False, 1):
            out += zip(substrings._docs([packed_docs]).tolist(), substrings._wide(packed_places, packed_docs).tolist())
        return sorted(out)

    assert found([[0, 1, 2]]) == found([[0], [1], [2]]) == [(3, 30)]
