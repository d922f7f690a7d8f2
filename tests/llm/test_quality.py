import random
import re

import numpy as np
import pytest

from ledgerlake.llm import quality
from tests.llm import edge


def brute_repeats(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            k = 0
            while i != j and i + k < len(words) and j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def brute(text, rules):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    repeats = brute_repeats(words)

    def covered(least):
        return len({p for i, n in enumerate(repeats) if n >= least for p in range(i, i + n)})

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n, again, cover, longest = len(words), covered(3), covered(rules.min_repeat), max(repeats, default=0)
    failed = n < rules.min_words or 100 * again > rules.max_repeat_percent * n
    kept = not failed and 100 * cover <= rules.max_covered_percent * n and longest <= rules.max_longest_repeat
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, again, cover, longest, failed, kept


@pytest.mark.parametrize("letters", ["ab", "abcdefghij"])
def test_longest_repeats_by_brute_force(letters):
    rng = random.Random(3)
    for _ in range(60):
        docs = [[rng.choice(letters) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(0, 6))]
        words = np.array([ord(w) - 97 for d in docs for w in d], dtype=np.int64)
        got = quality.longest_repeats(words, np.array([len(d) for d in docs], dtype=np.int64))
        assert got.tolist() == [x for d in docs for x in brute_repeats(d)]


def test_documents_by_brute_force(spark):
    rules = quality.QualityRules(min_words=5, min_repeat=4, max_longest_repeat=6)
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefg") + rng.choice("#x ") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["a b c d e f g h\n" * 4, "x y z", "\x0bq\x0c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in quality.judge_quality(df, rules).collect()}
    assert got == {i: brute(t, rules) for i, t in enumerate(texts)}
    kept = {r.doc_id for r in quality.quality_filter(df, rules).collect()}
    assert kept == {i for i, x in got.items() if x[-1]}


def test_edges(spark):
    out = {r.doc_id: r for r in quality.judge_quality(edge.docs(spark)).collect()}
    assert out[0].n_words == 0 and out[0].base_failed and not out[0].kept
    assert out[8].n_words == 60_000 and out[8].kept
    kept = quality.quality_filter(edge.docs(spark))
    assert kept.columns == edge.DOCS.names
    assert sorted(r.doc_id for r in kept.collect()) == [5, 5, 6, 7, 8]
    assert quality.judge_quality(edge.no_docs(spark)).count() == 0
    assert quality.quality_filter(edge.no_docs(spark)).count() == 0


def test_a_long_verbatim_repeat_is_rejected(spark):
    clean = " ".join(f"u{i}" for i in range(900))
    twice = clean + " " + " ".join(f"u{i}" for i in range(120))
    df = spark.createDataFrame([(1, clean), (2, twice)], "doc_id long, text string")
    out = {r.doc_id: r for r in quality.judge_quality(df).collect()}
    assert out[1].kept and not out[2].kept and out[2].longest_repeat == 120
