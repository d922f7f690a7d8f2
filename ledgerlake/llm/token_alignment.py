r"""Alignment of two tokenizers by the byte ranges that their tokens share.

A text is encoded by a byte-level BPE (A) and a sentencepiece model (B).
Where tokens of both end at the same byte, the text is cut into groups; every
A token of a group is linked with every B token of it. An id pair's count is
the number of documents that hold it linked; a link is a best one if no other
pair of its A id has a higher count.

Counting is external (pair-document records never meet in one place):

1. Map tasks write *runs*. A run holds the (pair, document, links) records of
   some documents, sorted by pair, cut into ``RADIX`` parts by the low bits of
   the A id and compressed with zstd: pairs with their number of documents
   apart from the documents themselves.
2. Runs are dealt into about sqrt(runs) groups. Per (group, radix) part a heap
   merges the runs' sorted pairs and adds up their document numbers.
3. Per radix part a heap merges the groups' pairs. All pairs of an A id come
   together (A is the major side of the order), so once its counts are known
   its maximum is too, and both are streamed back, in each group's own order.
4. Per (group, radix) part the counts meet the runs again; every run gives its
   documents' sums. Per run these are added up and put beside the documents.

No part depends on how often a pair occurs: before any shuffle a pair is one
entry of a run, and its documents stay with their run. Every intermediate
table is written to the shared scratch folder.

Both tokenizers end a token before every single space or line feed between
two characters that are no white space (checked for the given models), so
texts are cut there and every distinct part is aligned once (``Aligner``
forgets old parts, which changes no result).

Cases: texts null, empty or not reproduced byte by byte by both tokenizers
have no tokens: zeros and an empty hash. Equal documents, also under one id or
without an id, are counted each for itself. Very long texts are encoded part
by part. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import shuffle_partitions, text_slices
from ledgerlake.session import write_scratch_table

SPACE = "▁"  # how sentencepiece writes a space
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
RADIX_BITS = 6
RADIX = 1 << RADIX_BITS
#: Links of a run before it is written; a document is never cut.
RUN_LINKS = 4_000_000
DOC_BITS = 24
#: Bytes of compressed parts that a merge task reads.
TASK_BYTES = 32 << 20


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level BPE writes the 256 bytes: printable bytes as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: Links of a group from which on its distinct ids are paired instead of its tokens.
WIDE_GROUP = 4096


class Grown:
    """Rows of integers that grow at the end."""

    def __init__(self, width: int):
        self.rows = np.empty((1024, width), dtype=np.int64)
        self.used = 0

    def __len__(self) -> int:
        return self.used

    def add(self, rows: np.ndarray) -> None:
        need = self.used + len(rows)
        if need > len(self.rows):
            grown = np.empty((max(need, 2 * len(self.rows)), self.rows.shape[1]), dtype=np.int64)
            grown[: self.used] = self.rows[: self.used]
            self.rows = grown
        self.rows[self.used : need] = rows
        self.used = need


class Aligner:
    """Parts of texts with their tokens, groups and linked id pairs.

    A pair is one number: the A id with its low bits first, then the B id, so
    that sorted pairs are sorted by radix, then A id, then B id.
    """

    def __init__(self, byte_path: str, piece_path: str, limit: int = 400_000):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece runs on over a space")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        numbers = [str(i) for i in range(max(len(self.a_bytes), len(pieces)))]
        self.comma, self.bar, self.semicolon = (np.array([n + c for n in numbers], dtype=object) for c in ",|;")
        self.space_id = self.b.piece_to_id(SPACE)
        self.a_bits = (len(self.a_bytes) - 1).bit_length()
        self.b_bits = (len(pieces) - 1).bit_length()
        if self.a_bits < RADIX_BITS or self.a_bits + self.b_bits > 32 or self.a_bits + self.b_bits + DOC_BITS > 62:
            raise ValueError("vocabularies too small or too large")
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.after_space: dict[str, int] = {}  # parts by what stands before their word
        self.after_feed: dict[str, int] = {}
        self.groups: list[str] = []  # every group ends with a semicolon
        self.sizes = Grown(4)  # A tokens, B tokens, groups, links; -1: not reproduced
        self.starts = Grown(2)  # where the part's pairs begin, and how many there are
        self.pairs = Grown(2)  # pair and its links

    def _learn(self, parts: set[str], known: dict[str, int], before: str, dropped: int) -> None:
        """Align new parts; ``dropped``: B tokens at the start of its result that are not the part's."""
        new = list(parts.difference(known))
        if not new:
            return
        full = [before + x for x in new]
        a = [x.ids for x in self.a.encode_batch_fast(full, add_special_tokens=False)]
        b = self.b.encode([x if dropped else x[1:] for x in full], num_threads=1)
        if dropped:
            if any(x[:1] != [self.space_id] for x in b):
                raise ValueError("the piece model joins its own space with a line feed")
            b = [x[1:] for x in b]
        known.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self._align([x.encode() for x in full], a, b)

    def _align(self, texts: list[bytes], a: list[list[int]], b: list[list[int]]) -> None:
        """Groups and pairs of all texts at once, in byte places of the texts one after the other."""
        bad = set()
        for table, rows in ((self.a_bytes, a), (self.b_bytes, b)):
            if b"".join(map(table.__getitem__, chain.from_iterable(rows))) != b"".join(texts):
                bad.update(k for k, x in enumerate(rows) if b"".join([table[i] for i in x]) != texts[k])
        for k in bad:
            a[k], b[k], texts[k] = [], [], b""
        ids_a, ids_b = (np.fromiter(chain.from_iterable(rows), dtype=np.int64) for rows in (a, b))
        ends_a, ends_b = np.cumsum(self.a_sizes[ids_a]), np.cumsum(self.b_sizes[ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        # Tokens up to each cut, of either side; the group of each token.
        upto_a, upto_b = (np.searchsorted(x, cuts, side="right") for x in (ends_a, ends_b))
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        group_a, group_b = (np.repeat(np.arange(len(cuts)), n) for n in (n_a, n_b))

        # Groups as text: A tokens of a group, then its B tokens.
        told = np.empty(len(ids_a) + len(ids_b), dtype=object)
        last_a, last_b = np.zeros(len(ids_a), dtype=bool), np.zeros(len(ids_b), dtype=bool)
        last_a[upto_a - 1] = last_b[upto_b - 1] = True
        told[np.arange(len(ids_a)) + (upto_b - n_b)[group_a]] = np.where(last_a, self.bar[ids_a], self.comma[ids_a])
        told[np.arange(len(ids_b)) + upto_a[group_b]] = np.where(last_b, self.semicolon[ids_b], self.comma[ids_b])
        told = told.tolist()

        sizes = np.zeros((len(texts), 4), dtype=np.int64)
        sizes[:, 0], sizes[:, 1] = list(map(len, a)), list(map(len, b))
        bounds = np.concatenate([[0], np.cumsum(sizes[:, 0] + sizes[:, 1])]).tolist()
        self.groups += ["".join(told[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
        # Every text ends with a cut, so its groups are a stretch of them.
        first = np.searchsorted(cuts, np.cumsum([len(x) for x in texts]), side="right")
        sizes[:, 2] = np.diff(first, prepend=0)
        of_group = np.concatenate([[0], np.cumsum(n_a * n_b)])
        sizes[:, 3] = np.diff(of_group[first], prepend=0)

        # Pairs of small groups: every A token beside every B token of its group.
        wide = n_a * n_b > WIDE_GROUP
        beside = np.where(wide, 0, n_b)[group_a]
        at_b = np.repeat((upto_b - n_b)[group_a] - np.cumsum(beside) + beside, beside) + np.arange(beside.sum())
        pairs = self.pair(np.repeat(ids_a, beside), ids_b[at_b])
        pairs = np.stack([pairs, np.ones(len(pairs), dtype=np.int64)], axis=1)
        text_of_group = np.repeat(np.arange(len(texts)), sizes[:, 2])
        owner = np.repeat(text_of_group, np.where(wide, 0, n_a * n_b))
        if wide.any():  # distinct ids of a large group, with their occurrences
            for g in np.flatnonzero(wide).tolist():
                x, nx = np.unique(ids_a[upto_a[g] - n_a[g] : upto_a[g]], return_counts=True)
                y, ny = np.unique(ids_b[upto_b[g] - n_b[g] : upto_b[g]], return_counts=True)
                both = np.stack([self.pair(x[:, None], y[None, :]).ravel(), np.outer(nx, ny).ravel()], axis=1)
                pairs, owner = np.concatenate([pairs, both]), np.concatenate([owner, np.full(len(both), text_of_group[g])])
            order = np.argsort(owner, kind="stable")
            pairs, owner = pairs[order], owner[order]
        held = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
        self.starts.add(np.stack([len(self.pairs) + held[:-1], np.diff(held)], axis=1))
        self.pairs.add(pairs)
        for k in bad:
            sizes[k] = -1
        self.sizes.add(sizes)

    def pair(self, a, b):
        low = a & (RADIX - 1)
        return (((low << (self.a_bits - RADIX_BITS)) | (a >> RADIX_BITS)) << self.b_bits) | b

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """For each text the numbers of its parts (none for an empty text)."""
        if len(self.groups) > self.limit:
            self.forget()
        cut: list[tuple[bool, list]] = []
        space, feed, others = set(), set(), set()
        for text in texts:
            lines = text.split("\n")
            words = [x.split(" ") for x in lines] if text and all(map(str.isprintable, lines)) else [[""]]
            if all(all(x) for x in words):  # no white space but single spaces and line feeds
                cut.append((True, words))
                space.add(words[0][0])
                for x in words:
                    space.update(x[1:])
                feed.update(x[0] for x in words[1:])
            else:
                parts = CUT.split(" " + text) if text else []
                cut.append((False, parts))
                space.update(x[1:] for x in parts[:1])
                for x in parts[1:]:
                    (space if x[0] == " " else feed).add(x[1:])
        self._learn(space, self.after_space, " ", 0)
        self._learn(feed, self.after_feed, "\n", 1)
        of_space, of_feed = self.after_space.__getitem__, self.after_feed.__getitem__
        out = []
        for simple, parts in cut:
            if simple:
                found = [of_space(parts[0][0]), *map(of_space, parts[0][1:])]
                for x in parts[1:]:
                    found.append(of_feed(x[0]))
                    found.extend(map(of_space, x[1:]))
            else:
                found = [of_space(x[1:]) if x[0] == " " else of_feed(x[1:]) for x in parts]
            out.append(found)
        return out


@lru_cache(maxsize=2)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return Aligner(byte_path, piece_path)


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers as zstd, the bytes of equal place together."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


class RunWriter:
    """Collects (pair, document, links) records and gives them out as the parts of a run."""

    def __init__(self, task: int, pair_bits: int):
        self.task, self.pair_bits = task, pair_bits
        self.number = 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.records = 0
        self.docs = 0

    @property
    def run(self) -> int:
        return (self.task << 32) | self.number

    def add(self, doc: np.ndarray, pairs: np.ndarray, weights: np.ndarray) -> None:
        """Records of this run's documents ``doc`` (numbers from 0)."""
        records = _summed((pairs << DOC_BITS) | doc, weights)
        self.held.append(records)
        self.records += len(records[0])

    def full(self) -> bool:
        return self.records >= RUN_LINKS or self.docs >= 1 << (DOC_BITS - 1)

    def compact(self) -> None:
        """Records of a document that came in several slices become one."""
        if self.held:
            self.held = [_summed(*map(np.concatenate, zip(*self.held)))]
            self.records = len(self.held[0][0])

    def parts(self) -> Iterator[tuple[int, int, bytes, bytes, bytes, bytes]]:
        """(run, radix, pairs, documents of each, document numbers, links), and the next run begins."""
        self.compact()
        if self.records:
            keys, links = self.held[0]
            pairs, docs = keys >> DOC_BITS, keys & ((1 << DOC_BITS) - 1)
            cuts = np.searchsorted(pairs, np.arange(RADIX + 1, dtype=np.int64) << (self.pair_bits - RADIX_BITS))
            for radix, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                if lo < hi:
                    p = pairs[lo:hi]
                    first = np.flatnonzero(np.diff(p, prepend=-1))
                    sizes = np.diff(first, append=len(p))
                    yield self.run, radix, *_packed_pairs(p[first], sizes), packed(docs[lo:hi]), packed(links[lo:hi])
        self.number += 1
        self.held, self.records, self.docs = [], 0, 0


def _packed_pairs(pairs: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return packed(np.diff(pairs, prepend=0)), packed(counts)


def _unpacked_pairs(pairs: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unpacked(pairs)), unpacked(counts)


DOC_FIELDS = "run long, place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUN_FIELDS = "radix int, pairs binary, counts binary, docs binary, links binary"
ENCODED = f"{DOC_FIELDS}, {RUN_FIELDS}"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields]
    )


#: Parts of a text that are looked at together.
PARTS_AT_ONCE = 200_000


def _encode(batches: Iterator[pa.RecordBatch], aligner: Aligner) -> Iterator[pa.RecordBatch]:
    """A row per document (radix null) and, run by run, the run's parts."""
    writer = RunWriter(TaskContext.get().partitionId(), aligner.a_bits + aligner.b_bits)
    no_run, no_doc = (None,) * 5, (None,) * 7

    def flush() -> Iterator[pa.RecordBatch]:
        for run, *part in writer.parts():
            yield _batch([(run, *no_doc, *part)], ENCODED)

    for batch in batches:
        for part in text_slices(batch, "text"):
            numbers = aligner.numbers([x or "" for x in part.column(1).to_pylist()])
            lengths = list(map(len, numbers))
            bounds = np.cumsum([0, *lengths])
            flat = np.fromiter(chain.from_iterable(numbers), dtype=np.int64, count=bounds[-1])
            sums = np.concatenate([np.zeros((1, 4), dtype=np.int64), np.cumsum(aligner.sizes.rows[flat], axis=0)])
            broken = np.concatenate([[0], np.cumsum(aligner.sizes.rows[flat, 0] < 0)])
            whole = (np.diff(bounds) > 0) & (np.diff(broken[bounds]) == 0)
            sizes = np.where(whole[:, None], sums[bounds[1:]] - sums[bounds[:-1]], 0).tolist()
            rows = []
            for k, doc_id in enumerate(part.column(0).to_pylist()):
                text = "".join(map(aligner.groups.__getitem__, numbers[k]))[:-1] if whole[k] else None
                digest = "" if text is None else hashlib.sha256(text.encode()).hexdigest()
                rows.append((writer.run, writer.docs + k, doc_id, *sizes[k], digest, *no_run))
            if rows:
                yield _batch(rows, ENCODED)
            kept = np.repeat(whole, lengths)
            flat, docs = flat[kept], np.repeat(writer.docs + np.arange(len(numbers)), lengths)[kept]
            writer.docs += len(numbers)
            for lo in range(0, len(flat), PARTS_AT_ONCE):
                starts, n = aligner.starts.rows[flat[lo : lo + PARTS_AT_ONCE]].T
                places = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
                writer.add(np.repeat(docs[lo : lo + PARTS_AT_ONCE], n), *aligner.pairs.rows[places].T)
                if writer.records >= 2 * RUN_LINKS:
                    writer.compact()
            if writer.full():
                yield from flush()
    yield from flush()


def _by_side(number: int, pairs: np.ndarray, b_bits: int) -> Iterator[tuple[int, int, int, int]]:
    """(A side, number of the list, from, to) for every A id of a sorted list of pairs."""
    side = pairs >> b_bits
    first = np.flatnonzero(np.diff(side, prepend=-1))
    bounds = [*first.tolist(), len(pairs)]
    for k, a in enumerate(side[first].tolist()):
        yield a, number, bounds[k], bounds[k + 1]


def merged_sides(
    lists: list[tuple[np.ndarray, np.ndarray]], b_bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """K-way merge of sorted (pairs, counts) lists, one A id after the other.

    Yields the A id's distinct pairs, their total counts, the place of every
    input pair among them, and which stretch (list, from, to) each comes from.
    """
    streams = [_by_side(i, pairs, b_bits) for i, (pairs, _) in enumerate(lists)]
    for _, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        stretches = [x[1:] for x in same]
        pairs = np.concatenate([lists[i][0][lo:hi] for i, lo, hi in stretches])
        counts = np.concatenate([lists[i][1][lo:hi] for i, lo, hi in stretches])
        distinct, place = np.unique(pairs, return_inverse=True)
        totals = np.zeros(len(distinct), dtype=np.int64)
        np.add.at(totals, place, counts)
        yield distinct, totals, place, stretches


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _by_key(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    return groupby(_rows(batches), key=itemgetter(*key))


def _merge_runs(b_bits: int) -> Callable:
    """Runs of a (group, radix) part -> one sorted list of pairs with their document numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group, radix), rows in _by_key(batches, "grp", "radix"):
            lists = [_unpacked_pairs(r["pairs"], r["counts"]) for r in rows]
            merged = [(distinct, totals) for distinct, totals, _, _ in merged_sides(lists, b_bits)]
            pairs, counts = map(np.concatenate, zip(*merged))
            yield _batch([(group, radix, *_packed_pairs(pairs, counts))], GROUP_FIELDS)

    return run


GROUP_FIELDS = "grp long, radix int, pairs binary, counts binary"


def _merge_groups(b_bits: int) -> Callable:
    """Lists of the groups of a radix part -> for each the total count of its pairs, and whether it is its A id's best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for radix, rows in groupby(_rows(batches), key=itemgetter("radix")):
            rows = [(r["grp"], r["pairs"], _unpacked_pairs(r["pairs"], r["counts"])) for r in rows]
            totals = [np.zeros(len(x[2][0]), dtype=np.int64) for x in rows]
            best = [np.zeros(len(x[2][0]), dtype=np.int64) for x in rows]
            for _, count, place, stretches in merged_sides([x[2] for x in rows], b_bits):
                is_best = count == count.max()
                done = 0
                for i, lo, hi in stretches:
                    at = place[done : done + hi - lo]
                    totals[i][lo:hi] = count[at]
                    best[i][lo:hi] = is_best[at]
                    done += hi - lo
            for (group, pairs, _), total, flag in zip(rows, totals, best):
                # A count may be beyond 32 bits: low and high half.
                halves = (packed(total & 0xFFFFFFFF), packed(total >> 32), packed(flag))
                yield _batch([(group, radix, pairs, *halves)], TOTAL_FIELDS)

    return run


TOTAL_FIELDS = "grp long, radix int, pairs binary, low binary, high binary, best binary"
SUM_FIELDS = "run long, n_best binary, count_sum binary"


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (group, radix) part its counts first, then its runs: every run's documents get their sums."""
    for _, rows in _by_key(batches, "grp", "radix"):
        first = next(rows)
        if first["run"] is not None:
            raise ValueError("a part of a run has no counts")
        pairs = np.cumsum(unpacked(first["pairs"]))
        totals = unpacked(first["low"]) | (unpacked(first["high"]) << 32)
        best = unpacked(first["best"])
        for r in rows:
            own, sizes = _unpacked_pairs(r["pairs"], r["counts"])
            at = np.repeat(np.searchsorted(pairs, own), sizes)
            docs, links = unpacked(r["docs"]), unpacked(r["links"])
            n_best, count_sum = (np.zeros(int(docs.max()) + 1, dtype=np.int64) for _ in range(2))
            np.add.at(n_best, docs, links * best[at])
            np.add.at(count_sum, docs, links * totals[at])
            yield _batch([(r["run"], n_best.tobytes(), count_sum.tobytes())], SUM_FIELDS)


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run the sums of its parts first, then its documents."""
    run, sums = None, {}
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    for batch in batches:
        column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        runs = np.asarray(column["run"])
        is_doc = np.asarray(pc.is_valid(column["place"]))
        lo = 0
        while lo < len(runs):
            hi = lo + 1
            if runs[lo] != run:
                run, sums = runs[lo], {"n_best": np.zeros(0, dtype=np.int64), "count_sum": np.zeros(0, dtype=np.int64)}
            if not is_doc[lo]:
                for k, total in sums.items():
                    more = np.frombuffer(column[k][lo].as_py(), dtype=np.int64)
                    if len(more) > len(total):
                        total = np.concatenate([total, np.zeros(len(more) - len(total), dtype=np.int64)])
                    total[: len(more)] += more
                    sums[k] = total
            else:
                while hi < len(runs) and runs[hi] == run:
                    hi += 1
                place = np.asarray(column["place"].slice(lo, hi - lo))
                own = {}
                for k, total in sums.items():
                    known = place < len(total)
                    own[k] = np.zeros(len(place), dtype=np.int64)
                    own[k][known] = total[place[known]]
                cols = {n: column[n].slice(lo, hi - lo) for n in names} | {k: pa.array(v) for k, v in own.items()}
                order = [c.split()[0] for c in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([cols[n] for n in order], names=order)
            lo = hi


def align_tokenizers(
    docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: tokens, groups and links, and how its links stand in the corpus-wide counts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encode(batches, _aligner(byte_path, piece_path))

    b_bits = _aligner(byte_path, piece_path).b_bits
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    encoded = write_scratch_table(texts.mapInArrow(encode, ENCODED), "alignment-runs")
    runs = encoded.filter(F.col("radix").isNotNull())
    sizes = runs.agg(
        F.count_distinct("run").alias("runs"),
        F.sum(F.octet_length("pairs") + F.octet_length("counts")).alias("pairs"),
        F.sum(F.octet_length("docs") + F.octet_length("links")).alias("docs"),
    ).first()
    groups = max(1, math.isqrt(sizes.runs))

    def tasks(size: int | None) -> int:
        return max(shuffle_partitions(docs), -(-(size or 0) // TASK_BYTES))

    runs = runs.select(
        F.pmod(F.xxhash64("run"), F.lit(groups)).alias("grp"), "radix", "run", "pairs", "counts", "docs", "links"
    )
    key = ("grp", "radix")
    lists = write_scratch_table(
        runs.select(*key, "pairs", "counts")
        .repartition(tasks(sizes.pairs), *key)
        .sortWithinPartitions(*key)
        .mapInArrow(_merge_runs(b_bits), GROUP_FIELDS),
        "alignment-groups",
    )
    totals = (
        lists.repartition(max(RADIX, shuffle_partitions(docs)), "radix")
        .sortWithinPartitions("radix")
        .mapInArrow(_merge_groups(b_bits), TOTAL_FIELDS)
    )
    sums = (
        runs.unionByName(totals, allowMissingColumns=True)
        .repartition(tasks((sizes.pairs or 0) + (sizes.docs or 0)), *key)
        .sortWithinPartitions(*key, "run")  # nulls first: the counts
        .mapInArrow(_contribute, SUM_FIELDS)
    )
    rows = encoded.filter(F.col("place").isNotNull()).drop(*[c.split()[0] for c in RUN_FIELDS.split(", ")])
    return (
        rows.unionByName(sums, allowMissingColumns=True)
        .repartition(shuffle_partitions(docs), "run")
        .sortWithinPartitions("run", "place")  # nulls first: the sums
        .mapInArrow(_attach, RESULT)
    )
