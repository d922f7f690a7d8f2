r"""Benchmark decontamination by spaced-seed hashing.

A spaced seed is a fixed mask over consecutive tokens: the tokens under a 1
are hashed, those under a 0 ignored, so a hit survives substitutions at the
ignored places. Every mask is laid at every token of every benchmark item and
of every document; equal hashes join. A hit names a diagonal (place in the
document minus place in the item). Around it the item's tokens are compared
with the document's: the pair counts if some ``overlap`` consecutive tokens
agree in all but ``substitutions`` places (a shorter item: in the same share
of its tokens).

The masks hit every such run: of 13 and more tokens with up to 3 substitutions,
of 11 and 12 with up to 2, wherever these lie. A shorter item, where they could
miss, is cut into one block more than it may have substitutions, so that one
block is whole; the blocks' first tokens, equally many of each, are its seeds.
Other values of ``overlap`` and ``substitutions`` are held to the same rule
below ``overlap`` tokens; a longer run must suit the masks.

Tokens are runs of letters and digits, lower-cased. The distinct seeds of the
benchmark are counted and joined in blocks of about ``block_rows`` by
broadcast, so documents are never shuffled by seed, whatever the benchmark's
size (a block that turns out twice as large is joined without a broadcast).
Only Spark's own expressions run.

Cases: null and empty texts have no tokens and no hits; an item of four tokens
or fewer is found wherever it stands as a whole; repeated rows of one id
count as one document, whose texts are each compared; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import put_back, set_aside
from ledgerlake.session import write_scratch_table

#: Three pairs of tokens each; spans of 6 to 12. Together they hit all 286 ways
#: to put 3 substitutions into 13 tokens (the first four: 265).
MASKS = ("111111", "11011011", "1100110011", "111100011", "110110000011", "110001100011", "11000001111")
OVERLAP = 13
SUBSTITUTIONS = 3
#: Seeds of one broadcast: about 32 bytes each.
BLOCK_ROWS = 500_000


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda w: F.xxhash64(w))


def misses(tokens: int, substitutions: int) -> bool:
    """Whether so many substitutions in a run of so many tokens can miss all masks."""
    picks = [[k for k, bit in enumerate(mask) if bit == "1"] for mask in MASKS]
    seeds = [{i + k for k in x} for x in picks for i in range(tokens - x[-1])]
    return any(all(x & set(c) for x in seeds) for c in combinations(range(tokens), substitutions))


def blocks_of(overlap: int, substitutions: int) -> dict[int, tuple[int, int]]:
    """Tokens of an item shorter than ``overlap`` that the masks could miss: width and number of its blocks."""
    found = {}
    for n in range(1, overlap):
        allowed = n + (substitutions - overlap) * n // overlap  # the share of its tokens, as in the comparison
        if misses(n, allowed):
            found[n] = n // (allowed + 1), allowed + 1
    return found


def _pair(h: Column, i: Column) -> Column:
    """Hash of the tokens at ``i`` and ``i + 1`` (null at the last one)."""
    return F.when(F.get(h, i + 1).isNotNull(), F.xxhash64(F.get(h, i), F.get(h, i + 1)))


def _mask_seed(mask: str, h: Column, i: Column) -> Column:
    """The seed of a mask laid at token ``i`` (null where it runs over the end)."""
    picks = [k for k, bit in enumerate(mask) if bit == "1"]
    a, b, c = picks[::2]
    if (a, picks) != (0, [a, a + 1, b, b + 1, c, c + 1]):
        raise ValueError("a mask is three pairs of tokens")
    pairs = [F.xxhash64(F.get(h, i + k), F.get(h, i + k + 1)) for k in (a, b, c)]
    return F.when(F.get(h, i + c + 1).isNotNull(), F.xxhash64(F.lit(mask), *pairs))


def _block_seed(width: int, h: Column, i: Column) -> Column:
    whole = F.xxhash64(F.lit(f"block of {width}"), *[F.get(h, i + k) for k in range(width)])
    return F.when(F.get(h, i + width - 1).isNotNull(), whole)


def _seeds(h: Column, i: Column, widths: list[int]) -> Column:
    """All masks and blocks of the widths at token ``i``."""
    return F.array_compact(F.array(*[_mask_seed(m, h, i) for m in MASKS], *[_block_seed(w, h, i) for w in widths]))


def seed_hits(
    docs: DataFrame,
    items: DataFrame,
    block_rows: int = BLOCK_ROWS,
    overlap: int = OVERLAP,
    substitutions: int = SUBSTITUTIONS,
) -> DataFrame:
    """Distinct (text, item, diagonal) with an equal seed.

    ``docs``: columns _doc, _ta, _tb, _h; ``items``: _item, _b (arrays of token hashes).

    All seeds begin with two neighbouring tokens (but those of one token), so
    a place of a document is looked at further only if its pair begins some
    seed of the benchmark: one look-up a token, and seeds are made of what is
    left. Only distinct seeds are broadcast; the items that hold them are
    joined to the hits.
    """
    items = write_scratch_table(items.withColumn("_n", F.size("_b")), "benchmark_items")
    h, i = F.col("_b"), F.col("_item_at")
    placed = items.select("_item", "_b", F.posexplode("_b").alias("_item_at", "_token"))
    found = placed.select("_item", "_item_at", _pair(h, i).alias("_key"), F.explode(_seeds(h, i, [])).alias("_seed"))
    short = blocks_of(overlap, substitutions)
    lengths = [r._n for r in items.filter(F.col("_n").isin(list(short))).select("_n").distinct().collect()]  # below overlap
    widths = sorted({short[n][0] for n in lengths})
    for n in lengths:
        width, count = short[n]
        # The first tokens of equal blocks; what is left over belongs to the last.
        starts = F.explode(F.array(*[F.lit(k * width) for k in range(count)]))
        own = items.filter(F.col("_n") == n).select("_item", "_b", starts.alias("_item_at"))
        key = _pair(h, i) if width > 1 else F.get(h, i)
        found = found.unionByName(own.select("_item", "_item_at", key.alias("_key"), _block_seed(width, h, i).alias("_seed")))
    found = write_scratch_table(found.distinct(), "benchmark_seeds")

    seeds = found.select("_key", "_seed").distinct()
    blocks = max(1, -(-seeds.count() // block_rows))
    block = F.pmod(F.col("_key"), F.lit(blocks))
    # Seeds with one key share a block, so the largest block is counted too.
    largest = seeds.groupBy(block).count().agg(F.max("count")).first()[0] or 0

    def small(part: DataFrame) -> DataFrame:
        return F.broadcast(part) if largest <= 2 * block_rows else part

    h, i = F.col("_h"), F.col("_place")
    places = docs.select("_doc", "_ta", "_tb", "_h", F.posexplode("_h").alias("_place", "_token"))

    def hits(number: int) -> DataFrame:
        part = seeds if blocks == 1 else seeds.filter(block == number)
        keys = small(part.select("_key").distinct())
        begun = places.withColumn("_key", _pair(h, i)).join(keys, "_key", "left_semi")
        if 1 in widths:  # items of one token
            begun = begun.unionByName(places.withColumn("_key", F.col("_token")).join(keys, "_key", "left_semi"))
        tried = begun.select("_doc", "_ta", "_tb", "_place", F.explode(_seeds(h, i, widths)).alias("_seed"))
        return tried.join(small(part.select("_seed").distinct()), "_seed", "left_semi")

    hit = reduce(DataFrame.unionByName, [hits(k) for k in range(blocks)])
    return (
        hit.join(found.select("_seed", "_item", "_item_at"), "_seed")
        .select("_doc", "_ta", "_tb", "_item", (F.col("_place") - F.col("_item_at")).alias("_diagonal"))
        .distinct()
    )


def _judged(
    docs: DataFrame,
    benchmark: DataFrame,
    overlap: int = OVERLAP,
    substitutions: int = SUBSTITUTIONS,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per verified (text, item, diagonal): _doc, digests _ta and _tb of the text, _item, figures."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("_doc"),
        F.col(text_col).alias("_text"),
        F.xxhash64(whole).alias("_ta"),
        F.xxhash64(F.lit("text"), whole).alias("_tb"),
    )
    items = benchmark.select(F.col(item_col).alias("_item"), token_hashes(F.col(item_text_col)).alias("_b"))
    hits = seed_hits(keyed.select("_doc", "_ta", "_tb", token_hashes(F.col("_text")).alias("_h")), items, block_rows, overlap, substitutions)
    hits = write_scratch_table(hits, "seed_hits")

    near = keyed.join(
        hits.withColumnsRenamed({"_doc": "_hd", "_ta": "_ha", "_tb": "_hb"}),
        F.col("_doc").eqNullSafe(F.col("_hd")) & (F.col("_ta") == F.col("_ha")) & (F.col("_tb") == F.col("_hb")),
    ).select("_doc", "_ta", "_tb", "_item", "_diagonal", token_hashes(F.col("_text")).alias("_h"))
    # Written, so that the comparison reads the hashes as a column.
    hashed = write_scratch_table(near, "hit_documents").join(items, "_item")
    at = lambda i: F.when(i >= 0, F.get(F.col("_h"), i))
    same = F.transform(
        F.col("_b"), lambda x, j: F.coalesce(at(F.col("_diagonal") + j) == x, F.lit(False)).cast("int")
    )
    compared = hashed.select("_doc", "_ta", "_tb", "_item", "_diagonal", F.size("_b").alias("_n"), same.alias("_same"))
    width = F.least(F.lit(overlap), F.col("_n"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    windows = F.transform(
        F.sequence(F.lit(1), F.col("_n") - width + 1), lambda i: total(F.slice(F.col("_same"), i, width))
    )
    return compared.select(
        "_doc", "_ta", "_tb", "_item", "_diagonal", width.alias("_width"), F.array_max(windows).alias("_best"), total("_same").alias("_matched")
    ).filter(overlap * F.col("_best") >= (overlap - substitutions) * F.col("_width"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *args, **options) -> DataFrame:
    """One row per (doc_id, item_id) with a verified overlap; options as of ``_judged``.

    ``best_overlap``: most agreeing tokens in a window of ``overlap``;
    ``matched``: agreeing tokens on that diagonal; ``start``: where the item
    would begin in the document (tokens, of the best diagonal, lowest first).
    """
    judged = _judged(docs, benchmark, *args, **options)
    best = F.max(F.struct("_best", "_matched", (-F.col("_diagonal")).alias("_d")))
    return (
        judged.groupBy("_doc", "_item")
        .agg(best.alias("_m"))
        .select(
            F.col("_doc").alias("doc_id"),
            F.col("_item").alias("item_id"),
            F.col("_m._best").cast("long").alias("best_overlap"),
            F.col("_m._matched").cast("long").alias("matched"),
            (-F.col("_m._d")).cast("long").alias("start"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the texts that hold a benchmark passage, whatever their id; other texts of that id stay."""
    found = _judged(docs, benchmark, **options)
    leaks = found.select(F.col("_doc").alias("_leak"), F.col("_ta").alias("_leak_a"), F.col("_tb").alias("_leak_b"))
    leaks = write_scratch_table(leaks.distinct(), "leaks")
    whole = F.coalesce(F.col(options.get("text_col", "text")), F.lit(""))
    columns, id_col = docs.columns, options.get("id_col", "doc_id")
    docs, names = set_aside(docs, id_col, options.get("text_col", "text"))
    same = (
        F.col(id_col).eqNullSafe(F.col("_leak"))
        & (F.xxhash64(whole) == F.col("_leak_a"))
        & (F.xxhash64(F.lit("text"), whole) == F.col("_leak_b"))
    )
    return docs.join(leaks, same, "left_anti").select(*put_back(columns, names))
