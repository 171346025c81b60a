"""Best-fit packing with vector capacities.

A document's ids and one end id are cut into pieces of ``max_tokens`` only where they are longer.  Pieces are dealt
by hash into groups of about ``group_rows`` rows (the last sequences of a group may be part empty, which costs one sequence
or so in ten thousand), and each group is packed on its own: by falling length, every piece goes to the open
sequence that fits it best.  A sequence has three capacities, tokens, documents and attention cost (the sum of squared
lengths); all must hold.  Of the sequences that can take a piece, ``norm`` picks that with the smallest weighted norm
of what is left after it, ``dot`` that with the largest weighted product of the piece's demand and what is left.

Sequences are kept by the tokens left in them, and in each of these levels by what is left of the other two; of
sequences with the same left in all three, the one that came there last is taken.  Each level keeps a bound of what its
best state can give; levels are looked at in the order of these bounds, which one array operation computes for all, and
their states in the order of their own part, until no bound is better than the best choice found; so the choice is exact.
With the usual weights all three parts weigh: on the given documents they change one choice in thirty and leave the number
of sequences as it is.

The usual documents and attention capacities follow from that of tokens (a piece has a token at least, and a sum of
squares is at most the square of the sum), so only tokens can close a sequence unless a smaller one is given.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer

from .common import batched, free_name, rows_of, text_of, written

MAX_TOKENS = 4096
END_ID = 1
GROUP_ROWS = 50_000
#: Words whose ids are kept in each Python worker, about 200 bytes each, and the longest of them.
CACHE, CACHED_CHARS = 1_000_000, 48


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold, and the weight of each part in the choice."""

    tokens: int = MAX_TOKENS
    documents: int = MAX_TOKENS
    attention: int = MAX_TOKENS * MAX_TOKENS
    # a looser sequence by a few hundred tokens is taken where it leaves less attention and fewer places for documents
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    choose: str = "norm"


#: The words that the supported pre-tokenizer cuts a text into.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {b: chr(b if b in plain else next(free)) for b in range(256)}


class _Made(dict):
    """What ``make`` gives for each key, kept for the short ones until there are too many."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids


class WordIds:
    """Ids of a tokenizer whose words never cross white space, word by word with a bounded cache.

    A word of Latin letters and signs (all below U+0300, where every normal form is the same) that isn't in the
    cache is cut and looked up by the model alone; other words, and tokenizers of another make, go through the
    whole tokenizer, and so do texts that hold an added token such as ``<|endoftext|>``.
    """

    def __init__(self, spec: str):
        self.whole = Tokenizer.from_str(spec)
        made = json.loads(spec)
        added = made.get("added_tokens") or []
        split, level = ((made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}])[:2]
        norm = (made.get("normalizer") or {}).get("normalizers") or []
        self.by_word = (
            made["model"]["type"] == "BPE"
            and not any(t["normalized"] for t in added)
            and [n["type"] for n in norm] == ["NFC", "Replace", "Lowercase"]
            and norm[1]["pattern"] == {"Regex": r"\s+"}
            and norm[1]["content"] == " "
            and split.get("pattern") == {"Regex": WORD_PATTERN}
            and (split.get("behavior"), split.get("invert")) == ("Removed", True)
            and (level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) == ("ByteLevel", False, False)
        )
        # texts that hold one of these go through the whole tokenizer: added tokens are matched before any word is cut,
        # and Python's split also takes the four separators for white space
        self.uncut = ("\x1c", "\x1d", "\x1e", "\x1f", *(t["content"] for t in added))
        self.model = self.whole.model
        self.words = regex.compile(WORD_PATTERN)
        self.letters = _byte_letters()
        self.packed = [k.to_bytes(4, "little") for k in range(self.whole.get_vocab_size(with_added_tokens=True))]
        self.cache = _Made(self._miss)

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _miss(self, word: str) -> bytes:
        if max(word) >= "\u0300":
            ids = self._ids(word)
        else:
            low = word.lower()
            if low.isascii():
                parts = [low] if low.isalpha() else self.words.findall(low)
                if not low.isprintable():
                    parts = [x.translate(self.letters) for x in parts]
            else:
                parts = [x.encode().decode("latin-1").translate(self.letters) for x in self.words.findall(low)]
            packed = self.packed
            ids = b"".join([packed[t.id] for x in parts for t in self.model.tokenize(x)])
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, little-endian unsigned 32-bit integers."""
        if not self.by_word or any(x in text for x in self.uncut):
            return self._ids(text)
        return b"".join(map(self.cache.__getitem__, text.split()))


_WORDS: dict[int, WordIds] = {}


def words_of(spec: str) -> WordIds:
    """The words of a tokenizer, made once in a Python worker."""
    key = hash(spec)
    if key not in _WORDS:
        _WORDS[key] = WordIds(spec)
    return _WORDS[key]


def read_spec(path: str) -> str:
    """A tokenizer's JSON, read on the driver; under two megabytes, so it is broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces(docs: DataFrame, spec: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit integers) of every piece of every row.

    ``spec`` is the tokenizer's JSON.  A null or empty text is the end id alone; a repeated row gives its pieces as often; a very
    long text is encoded whole, then cut; an empty table gives an empty result; further columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    held = rows.sparkSession.sparkContext.broadcast(spec)
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            words = words_of(held.value)
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                ids = words.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                    part = ids[at : at + 4 * max_tokens]
                    yield doc_id, k, at // 4, len(part) // 4, part

        yield from batched(found(), schema, 512)

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids binary")


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the place in it of each length, which fall from first to last."""
    c, (w1, w2, w3) = capacity, capacity.weights
    norm = c.choose == "norm"
    # the value of a choice is far (by tokens alone) + own (by the sequence alone) - slope * attention left + a constant of the length
    steps = np.arange(c.tokens + 1)
    far = w1 * (steps / c.tokens) ** 2 if norm else -w1 * steps / c.tokens**2
    own_of = lambda docs, cost: w2 * ((docs - 1) / c.documents) ** 2 + w3 * (cost / c.attention) ** 2 if norm else -w2 * docs / c.documents**2
    # open sequences by the tokens left, then by the documents and attention left; of each level the states by their own part
    levels: list[dict[tuple[int, int], list[int]]] = [{} for _ in steps]
    states: list[list[tuple[float, int, int]]] = [[] for _ in steps]
    # the least own part and the most attention left in each level: no state there has a value below what these give
    low, most = np.full(c.tokens + 1, np.inf), np.zeros(c.tokens + 1)
    left: list[tuple[int, int]] = []  # documents and attention left in each sequence
    room: list[int] = []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        cost_n = n * n
        if n > c.tokens or cost_n > c.attention:
            raise ValueError(f"a piece of {n} tokens fits no sequence")
        slope = (2 if norm else 1) * w3 * cost_n / c.attention**2
        by_tokens = far[: c.tokens + 1 - n] if norm else n * far[n:]
        bound = by_tokens + low[n:] - slope * most[n:]
        best, best_at = np.inf, -1
        while bound[k := int(bound.argmin())] < best:
            for own, docs, cost in states[n + k]:
                value = by_tokens[k] + own - slope * cost
                if value < best and cost >= cost_n:
                    best, best_at = value, levels[n + k][docs, cost][-1]
                if by_tokens[k] + own - slope * most[n + k] >= best:
                    break
            bound[k] = np.inf
        if best_at < 0:
            best_at = len(room)
            room.append(c.tokens)
            left.append((c.documents, c.attention))
        else:
            level, state = room[best_at], left[best_at]
            alike = levels[level][state]
            alike.pop()
            if not alike:
                del levels[level][state]
                states[level].remove((own_of(*state), *state))
                low[level] = states[level][0][0] if states[level] else np.inf
                most[level] = most[level] if states[level] else 0
        sequence[i], offset[i] = best_at, c.tokens - room[best_at]
        room[best_at] -= n
        docs, cost = left[best_at]
        docs, cost = left[best_at] = (docs - 1, cost - cost_n)
        level = room[best_at]
        if level and docs:
            if (docs, cost) not in levels[level]:
                bisect.insort(states[level], (own_of(docs, cost), docs, cost))
                low[level], most[level] = states[level][0][0], max(most[level], cost)
            levels[level].setdefault((docs, cost), []).append(best_at)
    return sequence, offset


def pack(rows: DataFrame, capacity: Capacity = Capacity(), group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` (doc_id, piece, start, length and any other columns) with sequence_id and offset, which replace columns of these names.

    Sequence ids are unique, not gapless; offsets are gapless in each sequence.  Repeated rows are packed each.  An empty
    table gives an empty result.  ``rows`` is read twice, so it should be a written table.
    """
    n = rows.count()
    groups = max(1, -(-n // group_rows))
    rows = rows.drop("sequence_id", "offset")
    name = free_name(rows, "group")
    dealt = rows.withColumn(name, F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(groups)))
    schema = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        sequence, offset = best_fit(group.column("length").to_numpy(), capacity)
        first = group.column(name)[0].as_py() << 32
        return group.drop_columns([name]).append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))

    return dealt.groupBy(name).applyInArrow(run, schema)


def pack_documents(docs: DataFrame, spec: str, capacity: Capacity = Capacity(), end_id: int = END_ID, group_rows: int = GROUP_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    Null and empty texts are one piece of the end id; very long texts are tokenised whole and cut; an empty table
    gives an empty result; repeated rows are packed each; further columns are not read.
    """
    cut = pieces(docs, spec, capacity.tokens, end_id, id_col, text_col)
    narrow = written(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(narrow, capacity, group_rows)
