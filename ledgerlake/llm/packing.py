"""Harmonic packing of tokenised documents into sequences.

A sequence holds ``capacity`` tokens. Class k takes pieces of at most
capacity // k tokens and its sequences hold exactly k pieces. Each document is
cut into whole-capacity pieces and a rest; the rest is cut so that its pieces
nearly fill the places of their classes (``cut_plan``: least unused tokens
plus ``cut_cost`` for each cut). Every task fills its own sequences class by
class, so nothing is shuffled, counted or sent to the driver, and at most one
open sequence per class is held. What is left in open sequences at a task's
end is packed first-fit by falling length.

Sequence numbers are (task number << 40) + a count, so a rerun of a task
gives the same rows.

Cases: null and empty texts are the one end id; equal documents are packed
each for itself; very long texts give many pieces; an empty table gives no
rows; columns other than id and text are ignored. The string of a special
token inside a text is that token, as the tokenizer has it.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_slices

CAPACITY = 1024
END_ID = 0
#: Pieces a sequence may hold.
CLASSES = (*range(1, 33), 64, 128, 256, 512, 1024)
CUT_COST = 4
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=8)
def cut_plan(capacity: int = CAPACITY, cut_cost: int = CUT_COST) -> list[tuple[tuple[int, int], ...]]:
    """For every rest of 0 to ``capacity`` tokens, its pieces as (class, length)."""
    classes = [k for k in CLASSES if k <= capacity]
    cost, plan = [0], [()]
    for rest in range(1, capacity + 1):
        fits = [k for k in classes if capacity // k >= rest]
        best, pieces = capacity // fits[-1] - rest, ((fits[-1], rest),)
        for k in classes:
            place = capacity // k
            if place < rest and cut_cost + cost[rest - place] < best:
                best, pieces = cut_cost + cost[rest - place], ((k, place), *plan[rest - place])
        cost.append(best)
        plan.append(pieces)
    return plan


class TokenIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer's pre-tokens never run over a single space or line feed
    between two other characters (they only begin with the space), so a text
    is cut there. All parts of a slice of texts are numbered by Arrow, the
    distinct ones looked up or encoded once, and the ids gathered. Texts with
    other white space, or with the string of a special token, are encoded
    whole.

    Remembers parts until there are ``limit`` of them, then forgets all.
    """

    GROUP = 64
    FIRST = "\x01"  # stands before the first part of a text; no text with it is cut

    def __init__(self, path: str, limit: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # In this vocabulary a token that begins with a space is written with this letter.
        self.begins = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.stop, self.comma = self.encode([".", ","])[0].tolist()
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.starts = np.zeros(1, dtype=np.int64)  # of the parts' ids, and their end
        self.ids = np.zeros(0, dtype="<u4")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        rows = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        return np.fromiter(chain.from_iterable(rows), dtype="<u4", count=int(sizes.sum())), sizes

    def can_cut(self, text: str) -> bool:
        if not text or text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
            return False
        return text.replace("\n", "").isprintable() and not any(x in text for x in self.special)

    def learn(self, parts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.numbers.update(zip(parts, range(len(self.numbers), len(self.numbers) + len(parts))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def gather(self, number: np.ndarray, more: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts one after the other with ``more`` free places after each, and their ends."""
        sizes = self.starts[number + 1] - self.starts[number]
        ends = np.cumsum(sizes + more)
        place = np.repeat(self.starts[number] - ends + sizes + more, sizes + more) + np.arange(int(ends[-1]))
        return self.ids[np.minimum(place, len(self.ids) - 1)], ends

    def encode_inner(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that follow a space: many in one string, cut where a token begins with a space."""
        groups = [" " + " ".join(parts[i : i + self.GROUP]) for i in range(0, len(parts), self.GROUP)]
        ids, _ = self.encode(groups)
        cuts = np.flatnonzero(self.begins[ids])
        if len(cuts) != len(parts):
            raise ValueError("the tokenizer joins words over spaces")
        return ids, np.diff(cuts, append=len(ids))

    def of_parts(self, parts: list[str]) -> np.ndarray:
        """Numbers of distinct parts; new ones are encoded with what stands before them."""
        new = [x for x in parts if x not in self.numbers]
        # "word," is "word" and ",": a letter and a stop never share a pre-token.
        stopped = [x for x in new if x[-1] in ".," and x[-2:-1].isalpha()]
        bare = {x[:-1] for x in stopped} | set(new).difference(stopped)
        bare = [x for x in bare if x not in self.numbers]
        inner = [x for x in bare if x[0] != self.FIRST and x[0] != "\n"]
        # A part after a line feed carries it; its pre-token is one of its own.
        others = [x for x in bare if x[0] == self.FIRST or x[0] == "\n"]
        if inner:
            self.learn(inner, *self.encode_inner(inner))
        if others:
            self.learn(others, *self.encode([x.removeprefix(self.FIRST) for x in others]))
        if stopped:
            number = np.fromiter((self.numbers[x[:-1]] for x in stopped), dtype=np.int64, count=len(stopped))
            ids, ends = self.gather(number, 1)
            ids[ends - 1] = np.where([x[-1] == "." for x in stopped], self.stop, self.comma)
            self.learn(stopped, ids, np.diff(ends, prepend=0))
        return np.fromiter(map(self.numbers.__getitem__, parts), dtype=np.int64, count=len(parts))

    def of(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) > self.limit:
            self.forget()
        cut = [self.can_cut(x) for x in texts]
        out: list[bytes] = [b""] * len(texts)
        whole = [i for i, x in enumerate(cut) if not x]
        if whole:
            ids, sizes = self.encode([texts[i] for i in whole])
            for i, part in zip(whole, np.split(ids, np.cumsum(sizes)[:-1])):
                out[i] = part.tobytes()
        simple = [i for i, x in enumerate(cut) if x]
        if simple:
            marked = pa.array([self.FIRST + texts[i].replace("\n", " \n") for i in simple], pa.large_string())
            split = pc.split_pattern(marked, " ")
            coded = split.flatten().dictionary_encode()
            number = self.of_parts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            ids, ends = self.gather(number)
            bounds = np.concatenate([[0], ends])[split.offsets.to_numpy()]
            packed = ids.tobytes()
            for i, lo, hi in zip(simple, (4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist()):
                out[i] = packed[lo:hi]
        return out


@lru_cache(maxsize=2)
def _token_ids(path: str) -> TokenIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return TokenIds(path)


def _pack(docs: Iterator[tuple[int, bytes]], task: int, capacity: int) -> Iterator[tuple]:
    """Pieces with their sequence and offset, as soon as their sequence is full."""
    plan = cut_plan(capacity)
    number = task << 40
    held: dict[int, list[tuple]] = {}
    filled: dict[int, int] = {}

    def put(group: list[tuple]) -> Iterator[tuple]:
        nonlocal number
        at = 0
        for piece in group:
            yield (*piece, number, at)
            at += piece[2]
        number += 1

    for doc_id, ids in docs:
        n, start = len(ids) // 4, 0
        pieces = [(1, capacity)] * (n // capacity) + list(plan[n % capacity])
        for k, length in pieces:
            piece = (doc_id, start, length, ids[4 * start : 4 * (start + length)], n)
            start += length
            group = held.setdefault(k, [])
            group.append(piece)
            if len(group) == k:
                yield from put(held.pop(k))
    bins: list[list[tuple]] = []
    for piece in sorted((p for g in held.values() for p in g), key=lambda p: -p[2]):
        for i, group in enumerate(bins):
            if filled[i] + piece[2] <= capacity:
                group.append(piece)
                filled[i] += piece[2]
                break
        else:
            filled[len(bins)] = piece[2]
            bins.append([piece])
    for group in bins:
        yield from put(group)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, place in it, ids, sequence and offset there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _token_ids(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()

        def encoded():
            for batch in batches:
                for part in text_slices(batch, "text", 4 << 20):
                    texts = [x or "" for x in part.column(1).to_pylist()]
                    for doc_id, ids in zip(part.column(0).to_pylist(), tokens.of(texts)):
                        yield doc_id, ids + end

        held: list[tuple] = []
        for piece in _pack(encoded(), TaskContext.get().partitionId(), capacity):
            held.append(piece)
            if len(held) == 1024:
                yield _rows(held)
                held = []
        if held:
            yield _rows(held)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def _rows(pieces: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), types)], names=names)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """The packed sequences: ids (padded to ``capacity``, but not at a power of two) and loss length.

    A sequence has at most ``capacity`` pieces, so its group is bounded.
    """
    pad = np.array([pad_id] * capacity, dtype="<u4").tobytes()
    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length")
    )
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    power = F.expr("(length & (length - 1)) = 0")
    padded = F.when(power, ids).otherwise(F.substring(F.concat(ids, F.lit(pad)), 1, 4 * capacity))
    return grouped.select("sequence_id", "length", padded.alias("ids"))


def piece_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC in place of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
