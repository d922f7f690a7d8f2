r"""Substring dedup with difference-cover anchors.

A word goes if some window of 13 consecutive words around it also starts in a
document with a smaller id. To find such windows without moving every window,
short runs of words are hashed only at places whose number modulo ``period``
lies in a difference cover: for any two places there is a shift below the
period that brings both onto the cover, so two equal windows of
``window`` words share an aligned anchor of ``window - period + 1`` words.

1. Anchors are sent to buckets by hash; those that two documents share go
   back to their documents.
2. A document extends its shared anchors to all windows around them; only
   these windows go to buckets, where the smallest document of each is found.
3. Windows with a smaller document go back; the words they cover are dropped.

A task packs its hashes into one row per bucket. Before that it settles what
it can by itself: an anchor or window that many of its documents hold is sent
once, so a passage that a third of all documents share costs one entry a
slice of text, and no bucket depends on how often a passage occurs. What is
found goes back packed by groups of documents, so rows grow with tasks and not
with documents times buckets. Documents are shuffled once by id; all three steps
read that shuffle. Windows are compared by hashes of 96 bits (64, and a check
of 32 from another seed), anchors, which only propose windows, by 64.

Cases: null and empty texts have no words; texts of fewer than 13 words keep
all; a null id counts as smaller than every other; rows that share an id are
one document with several texts, none of which removes words of the other;
equal rows get equal results; an empty table gives no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    WordHashes,
    mix64,
    shuffle_partitions,
    text_slices,
    window_hashes,
)

WINDOW = 13
PERIOD = 7
COVER = (1, 2, 4)
#: Hashes a bucket holds at once (28 bytes each).
BUCKET_ENTRIES = 2_000_000
SLICE_BYTES = 4 << 20
NO_ID = -(1 << 63)
CHECK_SEED = 77

SENT = "_bucket long, _keys binary, _checks binary, _docs binary, _places binary"
PACKED = "_group long, _docs binary, _places binary"
FOUND = "_doc long, _back binary"


@lru_cache(maxsize=1)
def _word_hashes() -> WordHashes:
    return WordHashes()


class _Slice:
    """The words of some texts, one after the other, as hashes."""

    def __init__(self, ids: np.ndarray, variants: np.ndarray, words: list[list[bytes]]):
        table = _word_hashes()
        hashed = [table.of(x) for x in words]
        self.lengths = np.array([len(x) for x in hashed], dtype=np.int64)
        self.hashes = np.concatenate(hashed) if hashed else np.empty(0, dtype=np.uint64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.text = np.repeat(np.arange(len(words)), self.lengths)
        self.at = np.arange(len(self.hashes)) - self.starts[self.text]
        self.ids, self.variants = ids, variants

    def keys(self, chosen: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document and place (variant << 32 | word number) of the chosen runs."""
        text = self.text[chosen]
        places = (self.variants[text] << 32) | self.at[chosen]
        return window_hashes(self.hashes, width)[chosen], self.ids[text], places

    def checks(self, chosen: np.ndarray, width: int) -> np.ndarray:
        """32 further bits of the chosen runs."""
        return (window_hashes(self.hashes, width, CHECK_SEED)[chosen] >> np.uint64(32)).astype("<u4")

    def fits(self, width: int) -> np.ndarray:
        """Whether a run of ``width`` words from each place ends within its text."""
        return self.at + width <= self.lengths[self.text]


def _groups(keys: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by key (and check), start of each one's run, and its smallest and largest document."""
    order = np.argsort(keys) if checks is None else np.lexsort((checks, keys))
    sorted_keys = keys[order]
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    if checks is not None:
        sorted_checks = checks[order]
        new[1:] |= sorted_checks[1:] != sorted_checks[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=len(keys))
    least = np.repeat(np.minimum.reduceat(docs[order], starts), sizes)
    most = np.repeat(np.maximum.reduceat(docs[order], starts), sizes)
    return order, starts, least, most


def _runs(values: np.ndarray) -> Iterator[slice]:
    """The runs of equal values."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    for a, b in zip(starts, np.append(starts[1:], len(values))):
        yield slice(int(a), int(b))


def _packed(docs: np.ndarray, places: np.ndarray, groups: int) -> Iterator[tuple[int, bytes, bytes]]:
    """The places found, one row per group of documents."""
    group = mix64(docs.view(np.uint64)) % np.uint64(groups)
    order = np.lexsort((places, docs, group))
    docs, places, group = docs[order], places[order], group[order]
    for run in _runs(group):
        yield int(group[run.start]), _differences(docs[run]), _narrow(places[run])


def _send(
    keys: np.ndarray, docs: np.ndarray, places: np.ndarray, buckets: int, shared: bool, checks: np.ndarray | None = None
) -> Iterator[tuple]:
    """Rows for the buckets, and rows (bucket -1 - group) with the places found without them.

    ``shared``: a key that two documents hold is found; else the places of all
    but its smallest document are.
    """
    if not len(keys):
        return
    order, starts, least, most = _groups(keys, docs, checks)
    keys, docs, places = keys[order], docs[order], places[order]
    checks = None if checks is None else checks[order]
    if shared:
        found = least != most
        # Such a key is sent once, marked (place -1), for the sake of other slices.
        mark = np.zeros(len(keys), dtype=bool)
        mark[starts] = True
        sent = ~found | mark
        out = np.where(found, -1, places)[sent]
    else:
        found = docs != least
        sent = ~found
        out = places[sent]
    for group, some_docs, some_places in _packed(docs[found], places[found], buckets):
        yield -1 - group, None, None, some_docs, some_places
    keys, docs = keys[sent], docs[sent]
    checks = None if checks is None else checks[sent]
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)  # ascending, as the keys are
    for part in _runs(bucket):
        # By document again: small differences compress.
        back = np.lexsort((out[part], docs[part]))
        yield (
            int(bucket[part.start]),
            keys[part][back].tobytes(),
            None if checks is None else checks[part][back].tobytes(),
            _differences(docs[part][back]),
            _narrow(out[part][back]),
        )


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a few MB."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    types = [{"long": pa.int64(), "binary": pa.binary()}[k] for k in kinds]
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes)) + 32
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _by_first(batches: Iterator[pa.RecordBatch], alone: bool) -> Iterator[tuple[int, list[tuple]]]:
    """Rows sorted by their first column, as (value, the rest of its rows); with
    ``alone``, rows of a negative value one by one."""
    value, rows = None, []
    for batch in batches:
        for first, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and (first != value or alone and first < 0):
                yield value, rows
                rows = []
            value = first
            rows.append(rest)
    if rows:
        yield value, rows


def _differences(docs: np.ndarray) -> bytes:
    return np.diff(docs, prepend=0).astype("<i8").tobytes()


def _docs(rows) -> np.ndarray:
    return np.concatenate([np.cumsum(np.frombuffer(x, dtype="<i8")) for x in rows])


def _narrow(places: np.ndarray) -> bytes:
    """Differences of places in 4 bytes each, if all places fit (those of an id's first text do), else in 8."""
    return np.diff(places, prepend=0).astype("<i4" if places.max() < 1 << 31 else "<i8").tobytes()


def _wide(places: bytes, docs: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(places, dtype="<i8" if len(places) == len(docs) else "<i4").astype(np.int64))


def _joined(parts, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=kind)


def _settle(batches: Iterator[pa.RecordBatch], shared: bool, groups: int) -> Iterator[tuple]:
    """Rows sorted by bucket in; the places found, packed by group, out."""
    for bucket, rows in _by_first(batches, alone=True):
        if bucket < 0:
            for _, _, docs, places in rows:
                yield -1 - bucket, docs, places
            continue
        keys, checks, docs, places = zip(*rows)
        key, doc = _joined(keys, "<u8"), _docs(docs)
        check = None if shared else _joined(checks, "<u4")
        place = np.concatenate([_wide(x, y) for x, y in zip(places, docs)])
        order, starts, least, most = _groups(key, doc, check)
        doc, place = doc[order], place[order]
        if shared:
            marked = np.maximum.reduceat(place < 0, starts)
            hit = ((least != most) | np.repeat(marked, np.diff(starts, append=len(doc)))) & (place >= 0)
        else:
            hit = doc != least
        yield from _packed(doc[hit], place[hit], groups)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows sorted by group in; one row per document out."""
    for _, rows in _by_first(batches, alone=False):
        docs, places = zip(*rows)
        doc, place = _docs(docs), np.concatenate([_wide(x, y) for x, y in zip(places, docs)])
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        for run in _runs(doc):
            yield int(doc[run.start]), place[run].astype("<i8").tobytes()


def _slices(
    batches: Iterator[pa.RecordBatch], size: int, keep: bool = False
) -> Iterator[tuple[_Slice, list[list[bytes]], pa.RecordBatch]]:
    """Rows (_id, _variant, _text, ...) in slices of about ``size`` bytes of text; ``keep``: with their words."""
    for batch in batches:
        for part in text_slices(batch, "_text", size):
            ids, variants = (part.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            words = [(x or "").encode().split() for x in part.column(2).to_pylist()]
            slice_ = _Slice(ids, variants, words)
            if not keep:
                words = []
            yield slice_, words, part


def _places(part: pa.RecordBatch, variants: np.ndarray) -> Iterator[np.ndarray]:
    """The places that came back for each row."""
    for packed, variant in zip(part.column(3).to_pylist(), variants):
        places = np.frombuffer(packed or b"", dtype="<i8")
        yield places[places >> 32 == variant] & 0xFFFFFFFF


def _spread(slice_: _Slice, part: pa.RecordBatch, first: int, last: int) -> np.ndarray:
    """Which places of the slice lie from ``first`` to ``last`` (relative) of a place that came back."""
    steps = np.zeros(len(slice_.hashes) + 1, dtype=np.int64)
    for start, length, places in zip(slice_.starts, slice_.lengths, _places(part, slice_.variants)):
        if len(places):
            np.add.at(steps, start + np.maximum(places + first, 0), 1)
            np.subtract.at(steps, start + np.minimum(places + last + 1, length), 1)
    return np.cumsum(steps[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    period: int = PERIOD,
    cover: tuple[int, ...] = COVER,
    bucket_entries: int = BUCKET_ENTRIES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text (words joined by one space).

    Runs one aggregate over the text sizes to find the number of buckets.
    """
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("not a difference cover of the period")
    width = window - period + 1
    if width < 1:
        raise ValueError("the period is longer than the window")
    cover_flags = np.isin(np.arange(period), cover)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    partitions = shuffle_partitions(docs)
    buckets = max(partitions, int(size / 5 * len(cover) / period / bucket_entries))

    variant = F.dense_rank().over(Window.partitionBy("_id").orderBy("_text")).cast("long") - 1
    texts = (
        docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), F.col(text_col).alias("_text"))
        .repartition(partitions, "_id")
        .select("_id", variant.alias("_variant"), "_text")
    )

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for s, _, _ in _slices(batches, SLICE_BYTES):
                whole = (s.lengths >= window)[s.text]
                chosen = np.flatnonzero(cover_flags[s.at % period] & s.fits(width) & whole)
                yield from _send(*s.keys(chosen, width), buckets, shared=True)

        return _batches(rows(), SENT)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for s, _, part in _slices(batches, SLICE_BYTES):
                chosen = np.flatnonzero(_spread(s, part, 1 - period, 0) & s.fits(window))
                yield from _send(*s.keys(chosen, window), buckets, shared=False, checks=s.checks(chosen, window))

        return _batches(rows(), SENT)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, words, part in _slices(batches, 1 << 20, keep=True):
            gone = _spread(s, part, 0, window - 1)
            removed, left = [], []
            for start, length, all_words in zip(s.starts, s.lengths, words):
                out = gone[start : start + length]
                removed.append(int(out.sum()))
                if removed[-1]:
                    all_words = [w for w, x in zip(all_words, out.tolist()) if not x]
                left.append(b" ".join(all_words).decode())
            ids = pa.array(s.ids, mask=s.ids == NO_ID)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(s.lengths), pa.array(removed, pa.int64()), pa.array(left, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    def settled(sent: DataFrame, shared: bool) -> DataFrame:
        """By document, the places found in the buckets."""
        packed = (
            sent.repartition(partitions, "_bucket")
            .sortWithinPartitions("_bucket")
            .mapInArrow(lambda batches: _batches(_settle(batches, shared, buckets), PACKED), PACKED)
        )
        return (
            packed.repartition(partitions, "_group")
            .sortWithinPartitions("_group")
            .mapInArrow(lambda batches: _batches(_unpack(batches), FOUND), FOUND)
        )

    def with_places(found: DataFrame, how: str) -> DataFrame:
        return texts.join(found, texts["_id"] == found["_doc"], how).select("_id", "_variant", "_text", "_back")

    shared = settled(texts.mapInArrow(anchors, SENT), shared=True)
    earlier = settled(with_places(shared, "inner").mapInArrow(windows, SENT), shared=False)
    return with_places(earlier, "left").mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept_text string")


def repeat_digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], window: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The same by comparing all windows; for small tests."""
    words = {i: (t or "").encode().split() for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p : p + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        left = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return out
