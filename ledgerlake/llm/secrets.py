r"""Secrets in texts: fixed patterns, and credential values that are hard to guess.

Patterns (``base_spans``; leftmost, not overlapping within a kind; a span is
the whole match): assignments of 12 or more characters, access keys, long
hexadecimal runs.

Values in a credential context (``password: x``, ``token=x``, ``Bearer x``,
``://user:x@``) are judged by what a guesser would pay for them
(:class:`GuessCost`): the cheapest way to cut the value into words, dates,
repeats, keyboard walks and brute-force spans, found by dynamic programming
over its positions. Values of ``min_bits`` and more become spans of the kind
``guess``, whether or not a pattern covers them. Words are ranked by a
vocabulary file, whose path is a parameter.

The cost of a value is settled once it is known to exceed ``MAX_BITS``
whatever follows (no segment but brute force is longer than ``LONGEST``), so
the work for a value of any length is bounded and the verdict is the same.

Cases: null and empty texts have no spans; equal documents get equal spans; a
very long text is searched whole; an empty table gives no rows; columns other
than id and text are ignored by :func:`find_secrets` and kept as they are by
:func:`redact_secrets`.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import text_slices

KINDS = ("assign", "access", "hex", "guess")
MIN_BITS = 40.0
MAX_BITS = 128.0
LONGEST = 64

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_LEAST = 12
# A run of the class is matched from its first place on, so runs below the
# least length can be left out of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret)[_-]?key|auth|credentials?)"""
    r"""["']?(?:\x20*(?::=|=>|[:=])\x20*)["'`]?([^\x20\x09-\x0D"'`<>]{6,})"""
    r"""|bearer\x20+([A-Za-z0-9+/_.=~-]{6,})"""
    r"""|://[^\x20\x09-\x0D/:@"'<>]{1,64}:([^\x20\x09-\x0D/@"'<>]{6,})@""",
    re.I | re.A,
)

# Words that stand for a secret or are the first that a guesser tries.
COMMON_WORDS = (
    "password", "passwd", "secret", "token", "key", "api", "admin", "root", "user", "login", "test", "example",
    "changeme", "letmein", "welcome", "default", "guest", "master", "access", "private", "public", "your", "my",
    "here", "insert", "replace", "placeholder", "dummy", "sample", "none", "null", "true", "false", "undefined",
    "config", "value", "string", "database", "server", "love", "dragon", "monkey", "football", "iloveyou", "sunshine",
)
# Rows of a keyboard with their offsets in half keys, and the two lines that are walked besides.
KEY_ROWS = (("1234567890-=", 0), ("qwertyuiop[]", 1), ("asdfghjkl;'", 2), ("zxcvbnm,./", 3))
SHIFTED = str.maketrans('!@#$%^&*()_+{}:"<>?|', "1234567890-=[];',./\\")
LINES = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
LEET = str.maketrans("013457@$!", "oleastasi")
DATE = re.compile(
    r"(?P<y>19\d\d|20[0-5]\d)(?P<s>[-/._]?)(?P<m>0[1-9]|1[0-2])(?P=s)(?P<d>0[1-9]|[12]\d|3[01])"
    r"|(?P<a>0[1-9]|[12]\d|3[01])(?P<t>[-/._]?)(?P<b>0[1-9]|[12]\d|3[01])(?P=t)(?P<z>19\d\d|20[0-5]\d|\d\d)",
    re.A,
)
YEAR = re.compile(r"19\d\d|20[0-5]\d", re.A)

SEGMENT_BITS = 2.0  # which of the five kinds comes next
YEARS = 160


def _steps() -> dict[tuple[str, str], tuple]:
    """(key, next key) -> direction, for neighbours on the keyboard and on the two lines."""
    place = {c: (2 * i + shift, row) for row, (keys, shift) in enumerate(KEY_ROWS) for i, c in enumerate(keys)}
    steps = {}
    for a, (x, y) in place.items():
        for b, (u, v) in place.items():
            if (y == v and abs(x - u) == 2) or (abs(y - v) == 1 and abs(x - u) == 1):
                steps[a, b] = (u - x, v - y)
    for name in LINES:
        for a, b in zip(name, name[1:]):
            steps[a, b] = ("on", name)
            steps[b, a] = ("back", name)
    return steps


STEPS = _steps()


class GuessCost:
    """Bits that a guesser pays for a value: the least sum over its segmentations."""

    def __init__(self, words: dict[str, int]):
        self.words = words  # lower-case word -> rank from 1
        self.longest_word = min(max(map(len, words), default=0), LONGEST)

    def segments(self, value: str, i: int) -> Iterator[tuple[int, float]]:
        """(end, bits) of every word, date, repeat and walk that begins at ``i``."""
        yield from self._words(value, i)
        yield from _dates(value, i)
        yield from _repeats(value, i)
        yield from _walks(value, i)

    def _words(self, value: str, i: int) -> Iterator[tuple[int, float]]:
        part = value[i : i + self.longest_word]
        lower = part.lower()
        if len(lower) != len(part):  # a letter whose lower case is longer
            return
        plain = lower.translate(LEET)
        for n in range(3, len(part) + 1):
            rank = self.words.get(lower[:n])
            swapped = 0
            if rank is None:
                rank = self.words.get(plain[:n])
                swapped = sum(a != b for a, b in zip(lower[:n], plain))
            if rank is None:
                continue
            upper = sum(a != b for a, b in zip(part[:n], lower))
            # All, none or the first in upper case is one of a few habits; others are chosen places.
            case = 0.0 if not upper else 1.0 if upper == n or part[0] != lower[0] and upper == 1 else math.log2(math.comb(n, upper)) + 1
            yield i + n, math.log2(rank + 1) + case + swapped

    def bits(self, value: str) -> float:
        """The cost of the value, or ``MAX_BITS`` if it is known to be that or more."""
        n = len(value)
        per_char = brute_bits(value)
        best = [math.inf] * (n + 1)
        best[0] = 0.0
        brute = math.inf  # cheapest way to here that ends in a brute-force span
        for i in range(n):
            if i >= LONGEST and min(best[i - LONGEST + 1 : i + 1]) >= MAX_BITS:
                return MAX_BITS
            at = best[i] + SEGMENT_BITS
            for end, cost in self.segments(value, i):
                if at + cost < best[end]:
                    best[end] = at + cost
            brute = min(brute, at) + per_char
            best[i + 1] = min(best[i + 1], brute)
        return min(best[n], MAX_BITS)


def brute_bits(value: str) -> float:
    """Bits per character of the letters that the value draws from."""
    size = 0
    for pattern, letters in ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[ -/:-@\[-`{-~]", 33), (r"[^\x00-\x7f]", 1000)):
        if re.search(pattern, value):
            size += letters
    return math.log2(max(size, 2))


def _dates(value: str, i: int) -> Iterator[tuple[int, float]]:
    if not value[i].isdigit():
        return
    m = DATE.match(value, i)
    if m:
        parted = bool(m["s"] or m["t"])
        yield m.end(), math.log2(YEARS * 372) + 2.0 * parted
    m = YEAR.match(value, i)
    if m:
        yield m.end(), math.log2(YEARS)


def _repeats(value: str, i: int) -> Iterator[tuple[int, float]]:
    for period in (1, 2, 3, 4):
        unit = value[i : i + period]
        if len(unit) < period:
            return
        unit_bits = period * brute_bits(unit)
        least = max(3, 2 * period)
        n = period
        while n < LONGEST and i + n < len(value) and value[i + n] == value[i + n - period]:
            n += 1
            if n >= least:
                yield i + n, unit_bits + math.log2(n)


def _walks(value: str, i: int) -> Iterator[tuple[int, float]]:
    keys = value[i : i + LONGEST].translate(SHIFTED).lower()
    bits, before = math.log2(47), None
    for n in range(1, min(len(keys), len(value) - i)):
        step = STEPS.get((keys[n - 1], keys[n]))
        if step is None:
            return
        bits += 0.5 if step == before else 2.5
        before = step
        if n >= 2:
            yield i + n + 1, bits


def ranked_words(vocabulary_path: str) -> dict[str, int]:
    """Word -> rank from 1: the common words, then the whole words of a vocabulary in its order."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    ranks = {w: i + 1 for i, w in enumerate(COMMON_WORDS)}
    for token in sorted(vocabulary, key=vocabulary.get):
        word = token.removesuffix("</w>")
        if word != token and len(word) > 2 and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


@lru_cache(maxsize=2)
def _costs(vocabulary_path: str):
    cost = GuessCost(ranked_words(vocabulary_path))
    return lru_cache(maxsize=10_000)(cost.bits)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every pattern."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every value in a credential context, without the punctuation after it."""
    for m in CONTEXT.finditer(text):
        start, end = m.span(m.lastindex)
        end = start + len(text[start:end].rstrip(".,;:!?)]}"))
        if end - start >= 6:
            yield start, end


def spans_of(text: str, bits, min_bits: float = MIN_BITS) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, bits) by start, kind and end; bits for the kind ``guess`` only."""
    found = [(*x, None) for x in base_spans(text)]
    for start, end in context_values(text):
        cost = bits(text[start:end])
        if cost >= min_bits:
            found.append((start, 3, end, cost))
    return [(KINDS[kind], start, end, cost) for start, kind, end, cost in sorted(found, key=lambda x: x[:3])]


SPAN = "struct<kind: string, start: bigint, end: bigint, bits: double>"
SCHEMA = f"doc_id long, spans array<{SPAN}>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())])
)


def find_secrets(
    docs: DataFrame,
    vocabulary_path: str,
    min_bits: float = MIN_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: the spans (code points, end exclusive) of its secrets. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _costs(vocabulary_path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [
                    [dict(zip(("kind", "start", "end", "bits"), s)) for s in spans_of(x or "", bits, min_bits)]
                    for x in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, _SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def redact_secrets(
    docs: DataFrame, vocabulary_path: str, mask: str = "[redacted]", min_bits: float = MIN_BITS, text_col: str = "text"
) -> DataFrame:
    """The documents with every secret replaced by the mask (overlapping spans by one), other columns as they are."""
    names = docs.columns

    def masked(text: str | None, bits) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for _, start, end, _ in spans_of(text, bits, min_bits):
            if start >= done:
                out += [text[done:start], mask]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _costs(vocabulary_path)
        at = names.index(text_col)
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = pa.array([masked(x, bits) for x in part.column(at).to_pylist()], part.schema.field(at).type)
                yield part.set_column(at, part.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans and all spans as ``kind:start:end``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
