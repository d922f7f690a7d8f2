import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import packing
from tests.llm import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)  # as it comes: the strings of special tokens are special


def check(rows, docs, tokenizer):
    """Exact round trip: every id of every document in one piece, offsets gapless."""
    want = sorted(
        np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes() for _, t in docs
    )
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and r.length > 0
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    got = []
    for pieces in by_doc.values():
        pieces.sort(key=lambda r: r.start)
        copies = sum(r.start == 0 for r in pieces)
        if copies == 1:
            assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
            assert sum(r.length for r in pieces) == pieces[0].doc_tokens
            got.append(b"".join(r.ids for r in pieces))
    total = sum(r.length for r in rows)
    assert total * 4 == sum(map(len, want))
    return got, want, 1 - total / (1024 * len(by_sequence))


def packed(df):
    rows = packing.pack_documents(df, PATH)
    return rows.withColumn("ids_crc32", packing.F.crc32("ids"))


def test_round_trip_and_padding(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got, want, padding = check(packed(df).collect(), [tuple(r) for r in df.collect()], tokenizer)
    assert sorted(got) == want
    assert padding < 0.02


def test_edges(spark, tokenizer):
    df = edge.docs(spark)
    got, want, _ = check(packed(df).collect(), [(r.doc_id, r.text) for r in df.collect()], tokenizer)
    assert set(got) <= set(want)
    assert packing.pack_documents(edge.no_docs(spark), PATH).count() == 0


def test_classes_hold_a_fixed_number_of_pieces():
    docs = [(i, b"\0\0\0\0" * (1 + i * 37 % 3000)) for i in range(400)]
    rows = list(packing._pack(iter(docs), 3, 1024))
    assert min(r[5] for r in rows) == 3 << 40
    by = defaultdict(int)
    for r in rows:
        by[r[5]] += r[2]
    assert max(by.values()) <= 1024
    assert 1 - sum(by.values()) / (1024 * len(by)) < 0.02


def test_cut_plan():
    plan = packing.cut_plan()
    for rest, pieces in enumerate(plan):
        assert sum(n for _, n in pieces) == rest
        assert all(n <= 1024 // k for k, n in pieces)
    assert plan[1024] == ((1, 1024),) and plan[512] == ((2, 512),)


def test_remembered_ids_equal_the_tokenizers(tokenizer):
    import random

    rng = random.Random(1)
    letters = "ab,.'s \n\té漢 　#12<|endoftext|>  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", "\n", " ", "a\n", "<|endoftext|>", "x <|endoftext|> y", "don't it's a.b, c,.", "漢字, é."]
    ids = packing.TokenIds(PATH, limit=50)  # forgets often
    got = [x for i in range(0, len(texts), 100) for x in ids.of(texts[i : i + 100])]
    assert got == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def test_special_strings_are_the_tokenizers(tokenizer):
    ids = np.frombuffer(packing.TokenIds(PATH).of(["ab <|endoftext|> cd"])[0], dtype="<u4").tolist()
    assert 50256 in ids and ids == tokenizer.encode("ab <|endoftext|> cd", add_special_tokens=False).ids


def test_sequences_are_padded_but_at_powers_of_two(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "word " * 2000)], "doc_id long, text string").coalesce(1)
    pieces = packing.pack_documents(df, PATH)
    for r in packing.sequences(pieces).collect():
        n = len(r.ids) // 4
        assert n == 1024 or (n == r.length and n & (n - 1) == 0)
