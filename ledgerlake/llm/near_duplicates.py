r"""Near-duplicate classes by ProbMinHash.

A text is a set of five-word shingles, each weighted by 1 + ln(times it
occurs). Two texts are linked if the probability Jaccard similarity of their
weighted shingles, or the plain Jaccard similarity of their shingle sets,
is at least 0.8; classes are the connected components of the links, named by
their smallest doc_id and, as one id may have several texts, its text's digest.

Signature: every shingle is a Poisson process whose rate is its weight; each
arrival falls into a random slot, and a slot keeps the shingle that arrived
first. A shingle stops as soon as its next arrival is later than the latest
first arrival of its text's slots. Two texts agree in a slot with probability
J_P. Bands of ``rows`` slots name buckets; at 0.8, ``bands`` x ``rows`` =
26 x 5 miss a pair with probability 3e-5. A text with repeated shingles also
has the bands of its shingle set (all weights 1, which is what the bands of a
text without repeats are), so that this holds for either similarity.

Equal texts are one node, whatever their ids. In each bucket the smallest node is compared with
all others: linear in the bucket. Buckets that then hold more than one
component compare their next nodes in the same way, 16, 256 ... at a time,
each with the later nodes of other components, until one component is left or
every node has had its turn. So a bucket of thousands of near copies costs a
few passes, and no pair of a bucket is left undecided; blocks of its nodes are
compared with one another in as many tasks as there are. In these later passes a
pair is decided in the first bucket that it shares: by its counts of shingles
in CELLS cells of their hashes if these prove both similarities to be below
the threshold (an upper bound, which loses no link), else by the whole texts.

Joins whose sides could be broadcast at small sizes only are merge joins at
every size.

Cases: null and empty texts are equal to each other and to nothing else; a
text of fewer than five words is one shingle; a null id counts as the
smallest; rows that share an id, or have none, are told apart by their texts;
equal rows give equal rows; an empty table gives no rows; columns other than
id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WordHashes, mix64, put_back, set_aside, text_slices, window_hashes
from ledgerlake.llm.components import stars
from ledgerlake.session import write_scratch_table

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 26
ROWS = 5
NO_ID = -(1 << 63)
#: Parts of the hashes in which a text's distinct shingles are counted (a power of two).
CELLS = 128
#: Nodes of a bucket that are compared with as many others at once.
BLOCK = 256
#: Text worked on at once; the arrays of a slice take about 40 times as much.
SLICE_BYTES = 1 << 20


@lru_cache(maxsize=1)
def _word_hashes() -> WordHashes:
    return WordHashes()


def shingles(text: str | None, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (ascending) of a text and their weights."""
    hashes = _word_hashes().of((text or "").encode().split())
    if not len(hashes):
        return np.empty(0, dtype=np.uint64), np.empty(0)
    found, times = np.unique(window_hashes(hashes, min(width, len(hashes))), return_counts=True)
    return found, 1 + np.log(times)


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of probability Jaccard and plain Jaccard."""
    shared, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = one[1][i], two[1][j]
    plain = len(shared) / (len(one[0]) + len(two[0]) - len(shared))
    # Shingles of one text only have an infinite or zero ratio: always counted with their own weight.
    only_x, only_y = one[1].sum() - x.sum(), two[1].sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio)
    r, xs, ys = ratio[order], x[order], y[order]
    first = np.searchsorted(r, r, side="left")  # ratios below: y counts; from here on: x
    above = xs.sum() - np.concatenate([[0], np.cumsum(xs)])[first]
    below = np.concatenate([[0], np.cumsum(ys)])[first]
    probability = float((1 / ((above + only_x) / xs + (below + only_y) / ys)).sum())
    return max(plain, probability)


def _signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, slots: int) -> np.ndarray:
    """ProbMinHash of n texts at once: (n, slots) shingle hashes (0: no shingle)."""
    first = np.full(n * slots, np.inf)
    who = np.zeros(n * slots, dtype=np.uint64)
    time = np.zeros(len(shingle))
    step, rounds = 0, 0
    alive = np.arange(len(shingle))
    while len(alive):
        many = 1 if rounds < 3 else 8  # arrivals a round; few shingles are left after the first
        state = shingle[alive, None] + np.arange(step, step + many, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        draw = mix64(state)
        wait = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[alive, None]
        arrival = time[alive, None] + np.cumsum(wait, axis=1)
        slot = ((mix64(draw ^ np.uint64(0xD1B54A32D192ED03)) >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
        place = (text[alive, None] * slots + slot.astype(np.int64)).ravel()
        flat = arrival.ravel()
        np.minimum.at(first, place, flat)
        won = flat == first[place]
        who[place[won]] = np.repeat(shingle[alive], many)[won]
        time[alive] = arrival[:, -1]
        latest = first.reshape(n, slots).max(axis=1)
        alive = alive[time[alive] < latest[text[alive]]]
        step, rounds = step + many, rounds + 1
    return who.reshape(n, slots)


def _keys_of(who: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The band keys of signatures: (n, bands)."""
    keys = np.zeros((len(who), bands), dtype=np.uint64)
    for r in range(rows):
        keys = mix64(keys * np.uint64(0x100000001B3) + who.reshape(-1, bands, rows)[:, :, r])
    return mix64(keys + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)


def _lists(rows: list[np.ndarray], of: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows), of))


def _band_keys(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Texts in; their band keys (none for texts without words), cells, total and largest weight out."""
    for batch in batches:
        for part in text_slices(batch, "_text", SLICE_BYTES):
            found = []
            for x in part.column(3).to_pylist():
                hashes = _word_hashes().of((x or "").encode().split())
                found.append(window_hashes(hashes, min(SHINGLE, max(1, len(hashes)))))
            n = len(found)
            text = np.repeat(np.arange(n), [len(x) for x in found])
            every = np.concatenate(found)
            # A shingle of a text: by a hash of both.
            both = mix64(every + text.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            _, at, times = np.unique(both, return_index=True, return_counts=True)
            at, times = (x[np.argsort(at)] for x in (at, times))
            text, every, weight = text[at], every[at], 1 + np.log(times)
            keys = _keys_of(_signatures(text, every, weight, n, bands * rows), bands, rows)
            keys = [k if len(x) else k[:0] for k, x in zip(keys, found)]
            repeats = np.unique(text[times > 1])
            if len(repeats):
                these = np.isin(text, repeats)
                of = np.searchsorted(repeats, text[these])
                sets = _signatures(of, every[these], np.ones(len(of)), len(repeats), bands * rows)
                for i, k in zip(repeats, _keys_of(sets, bands, rows)):
                    keys[i] = np.union1d(keys[i], k)
            cell = (every >> np.uint64(64 - (CELLS.bit_length() - 1))).astype(np.int64)
            cells = np.bincount(text * CELLS + cell, minlength=n * CELLS).reshape(n, CELLS)
            most = np.ones(n)
            np.maximum.at(most, text, weight)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:3],
                    _lists(keys, pa.int64()),
                    _lists(list(cells), pa.int32()),
                    pa.array(np.bincount(text, weight, n), pa.float64()),
                    pa.array(most, pa.float64()),
                ],
                names=["_id", "_da", "_db", "_keys", "_cells", "_total", "_most"],
            )


def may_be_similar(shared, one: tuple, two: tuple, threshold: float):
    """False only if the cells of two texts prove both similarities to be below the threshold (arrays or numbers).

    ``shared``: the sum of the smaller counts of their cells; each text: number
    of shingles, total and largest weight. Texts share at most ``shared``
    shingles, so each has at least the rest of its
    shingles (``own``) to itself, all of weight 1 or more. With i over the
    shared shingles, J_P = sum of 1 / sum over j of max(x_j/x_i, y_j/y_i), at
    most x_i / (total_x + own_y x_i / y_i), in sum no more than
    (total_x - own_x) / (total_x + own_y / most_y); likewise for y.
    """
    (nx, tx, mx), (ny, ty, my) = one, two
    own_x, own_y, least = nx - shared, ny - shared, threshold - 1e-9
    plain = shared >= least * (nx + own_y)
    weighted = (tx - own_x >= least * (tx + own_y / my)) & (ty - own_y >= least * (ty + own_x / mx))
    return plain | weighted


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows sorted by their first ``keys`` columns, as one table for each value of these."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(keys)], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(values)]):
            if held and tuple(values[lo]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = tuple(values[lo])
    if held:
        yield pa.Table.from_batches(held)


def _compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Centres and others of a bucket, a block of each, in; pairs (a, b) that may be similar out.

    A pair is given by the first bucket that it shares.
    """
    for table in _grouped(batches, 3):
        key = table.column("_key")[0].as_py()
        centre = np.asarray(table.column("_centre"))
        if centre.all() or not centre.any():
            continue
        parts = [table.filter(pa.array(x)).combine_chunks() for x in (centre, ~centre)]
        cells = [np.asarray(x.column("_cells").combine_chunks().flatten()).reshape(-1, CELLS) for x in parts]
        one, two = ({c: np.asarray(x.column(c)) for c in ("_node", "_class", "_turn", "_size", "_total", "_most")} for x in parts)
        found = []
        for k in range(len(one["_node"])):
            shared = np.minimum(cells[0][k], cells[1]).sum(axis=1)
            ok = may_be_similar(
                shared, tuple(one[c][k] for c in ("_size", "_total", "_most")), tuple(two[c] for c in ("_size", "_total", "_most")), threshold
            )
            ok &= (two["_turn"] > one["_turn"][k]) & (two["_class"] != one["_class"][k])
            hits = np.flatnonzero(ok)
            if len(hits):
                own = set(parts[0].column("_keys")[k].as_py())
                found += [(k, h) for h in hits.tolist() if min(own.intersection(parts[1].column("_keys")[h].as_py())) == key]
        if found:
            a, b = (np.array(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(one["_node"][a]), pa.array(two["_node"][b])], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    cached = lru_cache(maxsize=16)(shingles)
    for batch in batches:
        for part in text_slices(batch, "_ta", SLICE_BYTES):
            linked = [
                similarity(cached(x), shingles(y)) >= threshold
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist())
            ]
            yield part.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _keyed(id_col: str, text_col: str) -> list[Column]:
    """The id (NO_ID for null) and the two digests of the text."""
    whole = F.coalesce(F.col(text_col), F.lit(""))
    return [
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(whole).alias("_da"),
        F.xxhash64(F.lit("text"), whole).alias("_db"),
    ]


def _text_classes(docs: DataFrame, threshold: float, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct text: its digests _ca, _cb and its class _top, the smallest (id, digests) in it."""
    keyed = docs.select(*_keyed(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    signed = keyed.mapInArrow(
        lambda batches: _band_keys(batches, bands, rows),
        "_id long, _da long, _db long, _keys array<long>, _cells array<int>, _total double, _most double",
    )
    size = F.aggregate("_cells", F.lit(0), lambda n, x: n + x)
    sketch = ["_cells", "_size", "_total", "_most"]
    # One row per text, combined before the shuffle, under a number of its own.
    signed = signed.withColumn("_size", size)
    banded = signed.groupBy("_da", "_db").agg(
        F.min("_id").alias("_id"), *[F.first(c).alias(c) for c in ("_keys", *sketch)]
    )
    banded = write_scratch_table(banded.withColumn("_node", F.monotonically_increasing_id()), "nodes")
    nodes = banded.select("_node", "_id", "_da", "_db")
    members = banded.select("_node", F.explode("_keys").alias("_key"))

    # The smallest node of each bucket against all others: sums and joins only.
    buckets = members.groupBy("_key").agg(F.min("_node").alias("a"), F.max("_node").alias("_z")).filter("a < _z")
    buckets = write_scratch_table(buckets.select(F.col("_key").alias("_k"), "a"), "buckets")
    crowded = write_scratch_table(
        members.join(buckets.hint("merge"), F.col("_key") == F.col("_k")).select("_key", "_node", "a"), "bucket_members"
    )
    # The texts of all nodes that share a bucket, fetched once, each by its smallest id.
    wanted = crowded.select(F.col("_node").alias("_wanted")).distinct()
    wanted = nodes.join(wanted.hint("merge"), F.col("_node") == F.col("_wanted"), "left_semi")
    texts = keyed.join(wanted.hint("merge"), ["_id", "_da", "_db"])
    texts = write_scratch_table(texts.groupBy("_node").agg(F.min("_text").alias("_text")), "bucket_texts")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose texts are similar."""
        one = texts.select(F.col("_node").alias("_n1"), F.col("_text").alias("_ta"))
        two = texts.select(F.col("_node").alias("_n2"), F.col("_text").alias("_tb"))
        both = pairs.join(one.hint("merge"), F.col("a") == F.col("_n1")).join(two.hint("merge"), F.col("b") == F.col("_n2"))
        return both.select("a", "b", "_ta", "_tb").mapInArrow(lambda x: _verify(x, threshold), "a long, b long")

    links = stars(verified(crowded.filter("_node > a").select("a", F.col("_node").alias("b")).distinct()))

    done, step = 1, 16
    open_ = crowded.select("_key", "_node")
    while True:
        labels = links.select(F.col("b").alias("_n"), F.col("a").alias("_label"))
        labelled = open_.join(labels, F.col("_node") == F.col("_n"), "left").select(
            "_key", "_node", F.coalesce("_label", "_node").alias("_class")
        )
        mixed = (
            labelled.groupBy("_key")
            .agg(F.min("_class").alias("_low"), F.max("_class").alias("_high"), F.count("*").alias("_size"))
            .filter((F.col("_low") < F.col("_high")) & (F.col("_size") > done + 1))
            .select(F.col("_key").alias("_k"), F.col("_size").alias("_bucket"))
        )
        turn = F.row_number().over(Window.partitionBy("_key").orderBy("_node"))
        open_ = write_scratch_table(
            labelled.join(mixed, F.col("_key") == F.col("_k")).select(
                "_key", "_node", "_class", "_bucket", turn.cast("long").alias("_turn")
            ),
            "open_buckets",
        )
        if open_.isEmpty():
            break
        sketches = banded.select(F.col("_node").alias("_n"), "_keys", *sketch)
        sketched = open_.join(sketches, F.col("_node") == F.col("_n")).drop("_n")
        # Blocks of centres against blocks of others, each pair of blocks for itself.
        turn, block = F.col("_turn"), F.lit(BLOCK)
        columns = ("_node", "_class", "_turn", "_cells", "_size", "_total", "_most", "_keys")
        first = F.floor((turn - done - 1) / block)
        centres = sketched.filter((turn > done) & (turn <= done + step)).select(
            "_key", first.alias("_i"), F.explode(F.sequence(F.floor(turn / block), F.floor(F.col("_bucket") / block))).alias("_j"),
            F.lit(True).alias("_centre"), *columns,
        )
        reached = F.least(F.lit((step - 1) // BLOCK), F.floor((turn - done - 2) / block))
        others = sketched.filter(turn > done + 1).select(
            "_key", F.explode(F.sequence(F.lit(0), reached)).alias("_i"), F.floor(turn / block).alias("_j"),
            F.lit(False).alias("_centre"), *columns,
        )
        dealt = centres.unionByName(others).repartition("_key", "_i", "_j").sortWithinPartitions("_key", "_i", "_j")
        pairs = dealt.mapInArrow(lambda x: _compare(x, threshold), "a long, b long").distinct()
        found = write_scratch_table(verified(pairs), "links")
        if not found.isEmpty():
            links = stars(links.unionByName(found))
        open_ = open_.select("_key", "_node")
        done, step = done + step, step * 16

    labels = links.select(F.col("b").alias("_n"), F.col("a").alias("_label"))
    classed = nodes.join(labels, F.col("_node") == F.col("_n"), "left").select(
        "_id", "_da", "_db", F.coalesce("_label", "_node").alias("_class")
    )
    classed = write_scratch_table(classed, "classes")
    # Written, so that the large classes of the join can be split.
    tops = classed.groupBy("_class").agg(F.min(F.struct("_id", "_da", "_db")).alias("_top"))
    tops = write_scratch_table(tops, "class_names")
    named = classed.join(tops, "_class").select(F.col("_da").alias("_ca"), F.col("_db").alias("_cb"), "_top")
    return write_scratch_table(named, "text_classes")


def near_duplicate_classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its class), class_text.

    ``class_text`` is the digest of the text that names the class (of the
    smallest id's texts in it the smallest digest): classes of one id, and of
    rows without id, differ by it. Intermediate tables are written to the
    shared scratch folder while the plan is built.
    """
    classed = _text_classes(docs, threshold, bands, rows, id_col, text_col)
    plain = lambda c: F.when(c != NO_ID, c)
    return (
        docs.select(*_keyed(id_col, text_col))
        .join(classed, (F.col("_da") == F.col("_ca")) & (F.col("_db") == F.col("_cb")))
        .select(
            plain(F.col("_id")).alias("doc_id"),
            plain(F.col("_top._id")).alias("class_id"),
            F.concat_ws(":", F.hex("_top._da"), F.hex("_top._db")).alias("class_text"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each class: the one that names it (of rows of equal id and text, any one).

    The texts are shuffled once, by id and digest, for the join and to keep one row.
    """
    classed = _text_classes(docs, threshold, bands, rows, id_col, text_col)
    first = write_scratch_table(classed.select("_top").distinct().select("_top.*"), "first_of_class")
    own = ["_near_id", "_near_a", "_near_b"]
    columns = docs.columns
    docs, names = set_aside(docs, id_col, text_col)
    keyed = docs.withColumns(dict(zip(own, _keyed(id_col, text_col))))
    same = reduce(lambda x, y: x & y, [F.col(o) == F.col(c) for o, c in zip(own, first.columns)])
    return keyed.join(first, same, "left_semi").dropDuplicates(own).select(*put_back(columns, names))
