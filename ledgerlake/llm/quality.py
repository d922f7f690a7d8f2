r"""Quality rules with suffix-array repetition.

Every text's words are put in suffix order by prefix doubling; the longest
common prefix of neighbours in that order gives, for each position, the
longest run of words that occurs again elsewhere in the text (the
longest-common-prefix intervals: maximal repeated substrings). The union of
the spans of the repeats of at least ``min_repeat`` words is the covered part.
A document goes if the covered fraction or the longest repeat is above its
limit, or if a base rule fails.

Many texts are ordered in one numpy pass, but a suffix never runs past its
own text. Only suffixes that are not yet unique are sorted again in the next
doubling round.

Cases: null and empty texts have no words and fail the base rule; very long
texts are processed whole; equal documents get equal verdicts; an empty table
gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_slices

SYMBOLS = b"#*$%&|<>"
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules; lengths in words."""

    min_words: int = 50
    max_repeat_percent: int = 50  # words in repeated 3-word windows, of all words
    min_repeat: int = 10  # shorter repeats do not count as covered
    max_covered_percent: int = 40
    max_longest_repeat: int = 100


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def longest_repeats(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each position, how many words from it on occur elsewhere in the same document.

    ``words``: word numbers from 0 of the documents one after the other;
    ``lengths``: how many words each document has.
    """
    n = len(words)
    out = np.zeros(n, dtype=np.int64)
    if n < 2:
        return out
    doc = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    key = doc * (int(words.max()) + 1) + words
    order = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)
    rank[order], active = _ranks(key[order], 0, order)
    ranks = [rank]  # of the first 1, 2, 4 ... words; a rank is the number of smaller suffixes
    width = 1
    while len(active):
        ahead = active + width
        second = np.where(ahead < ends[active], rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[active]
        key = first * (n + 1) + second
        by = np.argsort(key)
        active, first = active[by], first[by]
        rank = rank.copy()
        rank[active], active = _ranks(key[by], first, active)
        ranks.append(rank)
        width *= 2

    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    near = np.flatnonzero(ranks[0][suffixes[1:]] == ranks[0][suffixes[:-1]])  # same document, same first word
    left, right = suffixes[near], suffixes[near + 1]
    common = np.zeros(len(near), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        a, b = left + common, right + common
        ok = (a < ends[left]) & (b < ends[right])
        ok &= ranks[k][np.minimum(a, n - 1)] == ranks[k][np.minimum(b, n - 1)]
        common += ok << k
    out[left] = common  # each suffix is at most once a left and once a right neighbour
    out[right] = np.maximum(out[right], common)
    return out


def _ranks(key: np.ndarray, first: np.ndarray | int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of suffixes sorted by ``key``, whose groups so far start at rank
    ``first``; and the places ``at`` whose key is not unique."""
    n = len(key)
    new = np.ones(n, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    sizes = np.diff(starts, append=n)
    index = np.repeat(starts, sizes)
    if not isinstance(first, int):
        group = np.ones(n, dtype=bool)
        np.not_equal(first[1:], first[:-1], out=group[1:])
        begun = np.flatnonzero(group)
        index = index - np.repeat(begun, np.diff(begun, append=n)) + first
    return index, at[np.repeat(sizes > 1, sizes)]


def _covered(repeats: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of at least ``least`` words."""
    n = len(repeats)
    long = np.flatnonzero(repeats >= least)
    steps = np.bincount(long, minlength=n + 1) - np.bincount(long + repeats[long], minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _judge(ids: list, texts: list[str | None], rules: QualityRules) -> pa.RecordBatch:
    number = defaultdict(count().__next__)
    found, lengths, chars, symbols, dup_lines = [], [], [], [], []
    for text in texts:
        raw = (text or "").encode()
        words = raw.split()
        found.extend(map(number.__getitem__, words))
        lengths.append(len(words))
        chars.append(len(text or "") - len(raw) + len(raw.translate(None, SPACE)))
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
        dup_lines.append(len(lines) - len(set(lines)))
    lengths = np.array(lengths, dtype=np.int64)
    repeats = longest_repeats(np.array(found, dtype=np.int64), lengths)
    bounds = np.concatenate([[0], np.cumsum(lengths)])

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    again = total(_covered(repeats, 3))
    covered = total(_covered(repeats, rules.min_repeat))
    longest = np.zeros(len(texts), dtype=np.int64)
    some = lengths > 0
    if len(repeats):
        longest[some] = np.maximum.reduceat(repeats, bounds[:-1][some])
    failed = (lengths < rules.min_words) | (100 * again > rules.max_repeat_percent * lengths)
    kept = ~failed & (100 * covered <= rules.max_covered_percent * lengths) & (longest <= rules.max_longest_repeat)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(lengths),
            pa.array(chars, pa.int64()),
            pa.array(symbols, pa.int64()),
            pa.array(dup_lines, pa.int64()),
            pa.array(again),
            pa.array(covered),
            pa.array(longest),
            pa.array(failed),
            pa.array(kept),
        ],
        names=[c.split()[0] for c in SCHEMA.split(", ")],
    )


def judge_quality(
    docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: counts, covered words, longest repeat, base_failed and kept. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield _judge(part.column(0).to_pylist(), part.column(1).to_pylist(), rules)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def quality_filter(docs: DataFrame, rules: QualityRules = QualityRules(), text_col: str = "text") -> DataFrame:
    """The documents that pass, all their columns, in place: no join, no shuffle."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for batch in batches:
            for part in text_slices(batch, text_col):
                verdicts = _judge([0] * part.num_rows, part.column(at).to_pylist(), rules)
                yield part.filter(verdicts.column(verdicts.num_columns - 1))

    return docs.mapInArrow(run, docs.schema)
