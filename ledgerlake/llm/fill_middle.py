r"""Fill-in-the-middle texts, cut at places selected from a boundary set.

The ends of a text's units, and 0, are kept as a Roaring-style set of code
point offsets: blocks of 65,536 offsets, each held as a sorted array, a bitmap
or runs, whichever is smallest, with cumulative counts over the blocks. The
n-th offset is a search of the counts and a select within one block
(:class:`BoundarySet`). Texts are read block by block, so beside the text only
its set is held.

Units are ``words`` (white space and the word after it; white space at the end
is a unit of its own) or ``characters``.

A document keeps its text (``plain``), or becomes prefix, suffix, middle
(``psm``) or suffix, prefix, middle (``spm``) between marks; hashes of the seed
and the id decide. Texts that hold a mark stay plain, so every output can be
taken apart again (:func:`restored`).

Cases: null and empty texts are plain and empty; a null id is hashed as no
digits; equal ids give equal cuts for equal texts; an empty table gives no
rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1 << 16
BITMAP_BYTES = BLOCK // 8
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class FillRules:
    seed: int = 42
    rate_percent: int = 50  # documents that are cut
    spm_percent: int = 80  # of these, suffix first
    units: str = "words"

    def __post_init__(self):
        if self.units not in ("words", "characters"):
            raise ValueError(f"unknown units {self.units!r}")


class ArrayContainer:
    """The low 16 bits, sorted."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, rank: int) -> int:
        return int(self.low[rank])


class BitmapContainer:
    """One bit per offset, and the number of bits before each 64-bit word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(BLOCK, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[rank - int(self.before[word])])


class RunContainer:
    """Starts of runs of offsets, and the number of offsets before each run."""

    def __init__(self, low: np.ndarray, first: np.ndarray):
        self.starts = low[first].astype(np.uint16)
        self.before = first

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def container_of(low: np.ndarray):
    """The smallest container of sorted offsets within a block."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), BITMAP_BYTES):
        return RunContainer(low, first)
    return ArrayContainer(low) if 2 * len(low) <= BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """Sorted offsets in blocks, with the number of offsets before each block."""

    def __init__(self):
        self.blocks: list[int] = []
        self.containers: list = []
        self.before = [0]

    def __len__(self) -> int:
        return self.before[-1]

    def add(self, block: int, low: np.ndarray) -> None:
        """Offsets ``block * 65536 + low``; blocks come in rising order."""
        if len(low):
            self.blocks.append(block)
            self.containers.append(container_of(low))
            self.before.append(self.before[-1] + len(low))

    def select(self, rank: int) -> int:
        """The offset with ``rank`` smaller ones."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        return BLOCK * self.blocks[at] + self.containers[at].select(rank - self.before[at])


def unit_boundaries(text: str, units: str = "words") -> BoundarySet:
    """0 and the end of every unit of the text, in code points."""
    found = BoundarySet()
    n = len(text)
    gap_before = True  # no unit ends at 0, which is added for itself
    for block in range(n // BLOCK + 1):
        at = block * BLOCK
        codes = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le"), dtype="<u4")
        if units == "characters":
            low = np.arange(min(len(codes) + (at + len(codes) == n), BLOCK))
        else:
            gap = (codes == 32) | ((codes >= 9) & (codes <= 13))
            ends = gap.copy()  # a gap after a word
            ends[1:] &= ~gap[:-1]
            if len(codes):
                ends[0] &= not gap_before
                gap_before = bool(gap[-1])
            if block == 0 and len(codes):
                ends[0] = True
            low = np.flatnonzero(ends)
            if at + len(codes) == n and len(codes) < BLOCK:
                low = np.append(low, len(codes))  # the text's own end
        found.add(block, low)
    return found


def fill_one(doc_id: int | None, text: str, rules: FillRules) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one document."""
    bounds = unit_boundaries(text, rules.units)
    n = len(bounds) - 1
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"{rules.seed}:{name}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
    marked = PREFIX in text or SUFFIX in text or MIDDLE in text
    if not text or marked or h3 % 100 >= rules.rate_percent:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = bounds.select(first), bounds.select(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < rules.spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, rules: FillRules = FillRules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: units, form, lengths of prefix and middle, and the output text. No shuffle."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = part.column(0).to_pylist()
                rows = [(i, *fill_one(i, x or "", rules)) for i, x in zip(ids, part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; no mark occurs in its parts, so the marks cut it in one way."""
    parts = F.split(F.substr(output, F.lit(1 + len(PREFIX))), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(parts[0], parts[2], parts[1]))
        .when(form == "spm", F.concat(parts[1], parts[2], parts[0]))
        .otherwise(output)
    )


def fill_digest(filled: DataFrame) -> DataFrame:
    """The outputs as hashes, beside those of the texts rebuilt from them."""
    back = restored(F.col("output"), F.col("form"))
    return filled.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )
