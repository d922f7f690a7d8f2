import zlib
from collections import Counter

import numpy as np

from ledgerlake.llm import sharding
from tests.llm import edge


def test_law_slots_and_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    runs = []
    for n in (1, 4):  # the layout of the input does not matter
        out = sharding.shuffle_into_shards(docs.repartition(n), bucket_bytes=20_000)
        runs.append(sorted(map(tuple, sharding.shard_digest(sharding.write_shards(out)).collect())))
    assert runs[0] == runs[1]
    assert {r[0]: (r[1], r[2]) for r in runs[0]} == {
        k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()
    }
    shards = {}
    for doc_id, _, _, law, shard, slot, grown in runs[0]:
        assert law == "key" and grown in (shard, 8)
        shards.setdefault(shard, []).append((slot, doc_id))
    for rows in shards.values():
        assert sorted(s for s, _ in rows) == list(range(len(rows)))
        by_slot = [d for _, d in sorted(rows)]
        assert by_slot != sorted(by_slot)
    grown_rows = Counter(g for *_, g in runs[0])
    assert set(grown_rows) == set(range(9))


def test_the_shard_depends_on_the_id_alone(spark):
    one = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id long, text string")
    two = spark.createDataFrame([(i, "other") for i in range(250, 500)], "doc_id long, text string")
    of = lambda df: {r.doc_id: r.shard for r in sharding.shuffle_into_shards(df).collect()}
    first, second = of(one), of(two)
    assert all(first[k] == v for k, v in second.items())
    assert max(Counter(first.values()).values()) < 2 * 500 / 8


def test_fisher_yates_is_uniform():
    rng = np.random.default_rng(1)
    seen = Counter(tuple(sharding.fisher_yates(3, rng)) for _ in range(6000))
    assert len(seen) == 6 and max(seen.values()) < 1150 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, rng).tolist() == [] and sharding.fisher_yates(1, rng).tolist() == [0]


def test_edges(spark):
    out = sharding.shuffle_into_shards(edge.docs(spark), bucket_bytes=100).collect()
    assert sorted((r.text or "") for r in out) == sorted((r[1] or "") for r in edge.rows())
    assert {r._clash for r in out} == {"d"}
    slots = Counter((r.shard, r.slot) for r in out)
    assert max(slots.values()) == 1
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    got = [r for r in sharding.shard_digest(sharding.shuffle_into_shards(edge.docs(spark))).collect() if r.doc_id == 0]
    assert got[0].size == 1 and got[0].text_crc32 == 0
    assert sharding.shuffle_into_shards(edge.no_docs(spark)).count() == 0


def rank_correlation(values):
    order = np.argsort(np.argsort(values))
    return abs(np.corrcoef(order, np.arange(len(order)))[0, 1])


def test_rows_of_one_id_spread_and_shuffle_evenly(spark):
    rows = [(7, f"text {i}") for i in range(6000)] + [(i, "x") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = sharding.shuffle_into_shards(df, bucket_bytes=4_000).collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted(rows)
    shard = next(r.shard for r in out if r.doc_id == 7)
    own = sorted((r for r in out if r.shard == shard), key=lambda r: r.slot)
    assert [r.slot for r in own] == list(range(len(own)))
    # No order of texts or hashes shows in the slots, nor in those of the first tenth.
    numbers = [int(r.text.split()[1]) for r in own if r.doc_id == 7]
    assert rank_correlation(numbers) < 0.06 and abs(np.mean(numbers[:600]) - 3000) < 300


def test_equal_rows_are_all_kept(spark):
    rows = [(7, "the same text")] * 4000 + [(i, f"other {i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = sharding.shuffle_into_shards(df, n_shards=1, bucket_bytes=4_000).collect()
    assert sorted(r.slot for r in out) == list(range(6000)) and sorted((r.doc_id, r.text) for r in out) == sorted(rows)


def test_one_bucket_by_brute_force(spark):
    """Sort by the hashes, then the textbook exchange: from the last place, with one at or before it."""
    rows = [(i, f"text {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.slot) for r in sharding.shuffle_into_shards(df, n_shards=1, seed=17).collect()]
    key = sharding.F.xxhash64(sharding.F.lit(19), "doc_id", "text")
    order = [r[0] for r in df.select("doc_id", key.alias("k")).orderBy("k").collect()]
    draws = np.random.default_rng([17, 0, 0]).random(300)
    for i in range(299, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    assert sorted(got, key=lambda x: x[1]) == [(d, s) for s, d in enumerate(order)]


def test_columns_of_any_name_come_back(spark):
    clash = ["_size", "_bucket", "_order", "_pos", "_b", "_start", "carried 0"]
    df = spark.createDataFrame([(i, f"t{i}", *clash) for i in range(5)], ["doc_id", "text", *clash])
    assert all([r[c] for c in clash] == clash for r in sharding.shuffle_into_shards(df).collect())
