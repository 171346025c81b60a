r"""Quality rules with suffix-array repetition.

Words are maximal runs of non-space characters.  A batch of documents is one array of word ranks in which the
words of different documents differ, so one suffix array serves them all and no match crosses a document.  It is
built by prefix doubling on the positions whose prefix is still repeated; the ranks of every doubling round stay,
so the longest common prefix of neighbours in suffix order comes from them by binary descent, without a loop over
positions.  The larger of a suffix's two neighbouring prefixes is the longest repeat that begins there: the
maximal repeated substrings.  The union of their spans gives the covered words.

Rules: the base ones (``MIN_WORDS``, ``MAX_REPEAT_PERCENT`` of words in repeated three-word windows), then at most
``max_covered`` of the words in repeats of ``span_words`` words or more, and no repeat longer than ``max_longest`` words,
however long the document is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, rows_of, text_of
from .suffix import SuffixRanks

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Production limits of the suffix-array verdict."""

    span_words: int = 8
    max_covered: float = 0.30
    max_longest: int = 50


#: Words in one suffix array, unless a single document has more.
BATCH_WORDS = 150_000

COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_covered long, longest_repeat long"
KEPT = 6
_ARROW = pa.schema([*((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_covered", pa.int64()), ("longest_repeat", pa.int64())])


def longest_repeats(ranks: np.ndarray) -> np.ndarray:
    """For each position of the array, the length of the longest substring that begins there and occurs elsewhere too."""
    out = np.zeros(len(ranks), np.int64)
    suffixes = SuffixRanks(ranks)
    order = suffixes.order()
    common = suffixes.common_prefix(order[:-1], order[1:])
    np.maximum.at(out, order[:-1], common)
    np.maximum.at(out, order[1:], common)
    return out


def covered(lengths: np.ndarray, least: int) -> np.ndarray:
    """Whether each position lies in a repeat of ``least`` words or more."""
    n = len(lengths)
    at = np.flatnonzero(lengths >= least)
    edge = np.zeros(n + 1, np.int64)
    edge[at] += 1
    edge -= np.bincount(np.minimum(at + lengths[at], n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()


def measure(texts: list[str], limits: Limits) -> list[tuple]:
    """The values of COLUMNS for each text."""
    ids: list[int] = []
    ends: list[int] = []
    base = 0
    for t in texts:
        own: dict[bytes, int] = {}
        ids.extend([base + own.setdefault(w, len(own)) for w in _words(t)])
        base += len(own)
        ends.append(len(ids))
    lengths = longest_repeats(np.asarray(ids, np.int64))
    three, spans = covered(lengths, WINDOW), covered(lengths, limits.span_words)
    sums3, sums = np.r_[0, np.cumsum(three)], np.r_[0, np.cumsum(spans)]
    out, begin = [], 0
    for t, end in zip(texts, ends, strict=True):
        n = end - begin
        n3, cov = int(sums3[end] - sums3[begin]), int(sums[end] - sums[begin])
        longest = int(lengths[begin:end].max()) if n else 0
        full = [x for x in t.split("\n") if x.strip(WS)]
        failed = n < MIN_WORDS or 100 * n3 > MAX_REPEAT_PERCENT * n
        kept = not failed and cov <= limits.max_covered * n and longest <= limits.max_longest
        out.append((n, len(t) - sum(map(t.count, WS)), sum(map(t.count, SYMBOLS)), len(full) - len(set(full)), n3, failed, kept, cov, longest))
        begin = end
    return out


def measured(texts: Iterator[str], limits: Limits) -> Iterator[tuple]:
    some: list[str] = []
    chars = 0
    for t in texts:
        some.append(t)
        chars += len(t)
        if chars >= 6 * BATCH_WORDS:
            yield from measure(some, limits)
            some, chars = [], 0
    if some:
        yield from measure(some, limits)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """doc_id and the columns of COLUMNS for every row.

    Null and empty texts have no words and fail the base rules.  Repeated rows are measured each; very long texts
    are measured whole, in an array of their own; an empty table gives an empty result; further columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(measured((t for (t,) in rows_of(iter([batch]), "text")), limits))
            if found:
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _ARROW, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *_ARROW.names])

    return rows.mapInArrow(run, f"doc_id {id_type}, {COLUMNS}")


def keep_good(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs``, all their columns, that the rules keep; no shuffle.

    Null and empty texts have no words and go; repeated rows stay or go together; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(measured((t or "" for (t,) in rows_of(iter([batch]), text_col)), limits))
            yield batch.filter(pa.array([x[KEPT] for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
