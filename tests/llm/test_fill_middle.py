import hashlib
import random
import re

import numpy as np
import pytest

from ledgerlake.llm import fill_middle as fm
from tests.llm import edge

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rules=fm.FillRules()):
    """Units by regular expression, parts by joining them."""
    text = text or ""
    units = UNIT.findall(text) if rules.units == "words" else list(text)
    hexed = hashlib.sha256(f"{rules.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= rules.rate_percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < rules.spm_percent:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("kind", ["array", "bitmap", "run"])
def test_containers_select_every_member(kind):
    rng = np.random.default_rng(1)
    if kind == "array":
        low = np.sort(rng.choice(fm.BLOCK, 3000, replace=False))
    elif kind == "bitmap":
        low = np.sort(rng.choice(fm.BLOCK, 20_000, replace=False))
    else:
        low = np.concatenate([np.arange(5, 900), np.arange(2000, 2003), np.arange(65_000, 65_536)])
    found = fm.container_of(low)
    assert type(found).__name__.lower().startswith(kind)
    assert [found.select(i) for i in range(len(low))] == low.tolist()


def test_boundary_set_over_blocks():
    bounds = fm.BoundarySet()
    want = []
    for block, low in ((0, np.arange(10)), (3, np.array([0, 7, 65_535])), (4, np.arange(0, 65_536, 3))):
        bounds.add(block, low)
        want += (block * fm.BLOCK + low).tolist()
    assert len(bounds) == len(want)
    assert all(bounds.select(i) == x for i, x in enumerate(want))
    with pytest.raises(IndexError):
        bounds.select(len(want))


@pytest.mark.parametrize("units", ["words", "characters"])
def test_unit_ends_by_regular_expression(units):
    rng = random.Random(2)
    texts = ["", " ", "a", "a ", " a", "\t\na b\r\n", "é漢 😀 x  y", "a" * 65_536, "a" * 65_535 + " ",
             "a" * 65_535 + " b", " " * 65_536 + "b", "ab " * 70_000, "x" * 65_536 + " "]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for text in texts:
        bounds = fm.unit_boundaries(text, units)
        ends = [m.end() for m in UNIT.finditer(text)] if units == "words" else list(range(1, len(text) + 1))
        assert len(bounds) == len(ends) + 1
        picks = range(len(bounds)) if len(bounds) < 200 else [0, 1, len(bounds) // 2, len(bounds) - 2, len(bounds) - 1]
        assert [bounds.select(i) for i in picks] == [[0, *ends][i] for i in picks]


@pytest.mark.parametrize("units", ["words", "characters"])
def test_documents_by_brute_force(spark, units):
    rules = fm.FillRules(units=units)
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["ab", " ", "\n", "é", "<", "P>", "S", " "]) for _ in range(rng.randint(0, 40))))
            for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = fm.fill_in_middle(df, rules).collect()
    assert sorted(tuple(r) for r in out) == sorted(brute(i, x, rules) for i, x in rows)
    forms = {r.form for r in out}
    assert forms == {"plain", "psm", "spm"}
    texts = dict(rows)
    for r in fm.fill_digest(fm.fill_in_middle(df, rules)).collect():
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_edges(spark):
    want = sorted((brute(r[0], r[1]) for r in edge.rows()), key=str)
    assert sorted((tuple(r) for r in fm.fill_in_middle(edge.docs(spark)).collect()), key=str) == want
    assert fm.fill_in_middle(edge.no_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        fm.FillRules(units="lines")
