"""SentencePiece BPE encoding and decoding by a merge-type prefix table.

The library merges the best-scored adjacent pair until none is a piece.  A sequence of pieces is its result exactly
if every piece and every adjacent pair of pieces comes out of merging unchanged, so each prefix of a text has one
last piece: the one, among the pieces that end there (found by an Aho-Corasick automaton), that is *compatible*
with the last piece of the prefix before it.  The table of last pieces is filled from left to right and the ids are
recovered backwards.

No piece but a run of spaces holds a space after another character (checked when a model is read), so texts fall
into words that are encoded on their own; the results of frequent words are kept in a bounded cache.  A text
without spaces is one long word and costs time in proportion to its length.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from sentencepiece import sentencepiece_model_pb2

from .common import text_of

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words whose results are kept in each of two generations, and the longest of them.
CACHE, CACHED_CHARS = 350_000, 48


class Recent(dict):
    """A cache of two generations: a full one becomes the old one, from which what is asked for again is taken over."""

    def __init__(self, make, size: int = CACHE):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found


class PieceTable:
    """A BPE model with identity normalisation and byte fallback."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with identity normalisation and byte fallback are supported")
        if {p.type for p in proto.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.dummy = norm.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with inner spaces are not supported")
        self.scores = [p.score for p in proto.pieces]
        self.byte = [0] * 256
        self.surface: list[bytes] = []
        self.plain: list[bool] = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.byte[int(p.piece[3:5], 16)] = i
            self.surface.append(bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else " ⁇ ".encode() if p.type == UNKNOWN else p.piece.replace(SPACE, " ").encode())
            self.plain.append(p.type == NORMAL and p.piece.startswith(SPACE))
        self.eos = proto.trainer_spec.eos_id
        self.control = {i for i, p in enumerate(proto.pieces) if p.type == CONTROL}
        self.chars = {c for p in self.ids for c in p}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [i]:  # others never come out of merging
                self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.names = [p.piece for p in proto.pieces]
        self.pairs: dict[int, bool] = {}
        self.spaced, self.bare = Recent(lambda w: self.encode_word(SPACE + w)), Recent(self.encode_word)
        self.newline_alone = "\n" not in self.chars
        self.newline = np.array([self.byte[10]], "<i4").tobytes()
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # for decoding: all surfaces in one buffer
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(self.surface), np.uint8)

    def merged(self, text: str) -> list[int]:
        """The ids of a short text of known characters by plain merging: the best score first, then the leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = self.ids.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.scores[j] > best):
                    best, at = self.scores[j], i
            if at < 0:
                return [self.ids.get(p, -1) for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves this pair of pieces as it is."""
        if len(self.pairs) >= 1_000_000:
            self.pairs.clear()
        found = self.pairs[left << 20 | right] = self.merged(self.names[left] + self.names[right]) == [left, right]
        return found

    def encode_word(self, word: str) -> bytes:
        """The ids of a word, little-endian; the prefix table."""
        n = len(word)
        size, last = [0] * (n + 1), [-1] * (n + 1)  # of each prefix: length and id of its last piece
        last[0] = -2
        known = self.pairs.get
        for end, (length, i) in self.automaton.iter(word):
            end += 1
            if size[end]:
                continue
            before = last[end - length]
            if before >= 0:
                ok = known(before << 20 | i)
                if ok is None:
                    ok = self.compatible(before, i)
            else:
                ok = before == -2 or word[end - length - 1] not in self.chars
            if ok:
                size[end], last[end] = length, i
        out: list[int] = []
        at = n
        while at:
            if size[at]:
                out.append(last[at])
                at -= size[at]
            else:  # a character that no piece has
                out.extend(reversed([self.byte[b] for b in word[at - 1].encode("utf-8", "surrogatepass")]))
                at -= 1
        out.reverse()
        return struct.pack(f"<{len(out)}i", *out)

    def _spaces(self, text: str) -> bytes:
        """The ids of text in which spaces are marked, whatever runs of them there are."""
        return b"".join([self.bare[w] for w in self.word.findall(text)])

    def encode(self, text: str) -> bytes:
        """The ids of a whole text without begin and end ids, little-endian 32-bit integers."""
        if not text:
            return b""
        if not self.newline_alone or SPACE in text:
            return self._spaces((SPACE if self.dummy else "") + text.replace(" ", SPACE))
        out, spaced = [], self.spaced
        for k, line in enumerate(text.split("\n")):
            first = k == 0 and self.dummy
            if not line or "  " in line or line[0] == " " or line[-1] == " ":
                out.append(self._spaces((SPACE if first else "") + line.replace(" ", SPACE)))
                continue
            words = line.split(" ")
            out.append((b"" if first else self.bare[words.pop(0)]) + b"".join([spaced[w] for w in words]))
        return self.newline.join(out)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of several documents' ids as the library's decode gives them; ``ends``: where each ends in ``ids``."""
        sizes = self.lengths[ids]
        stops = np.r_[0, np.cumsum(sizes)]
        data = self.letters[np.repeat(self.places[ids] - stops[:-1], sizes) + np.arange(stops[-1])].tobytes()
        out, begin = [], 0
        for end in ends.tolist():
            a = int(stops[begin])
            if self.dummy:
                first = next((i for i in ids[begin : min(end, begin + 8)].tolist() if i not in self.control), None)
                a += first is not None and self.plain[first]
            out.append(data[a : stops[end]].decode("utf-8", "replace"))
            begin = end
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.asarray(ids, np.int64), np.array([len(ids)]))[0]


_TABLES: dict[int, PieceTable] = {}


def _table(model: bytes) -> PieceTable:
    """One table for each model and Python worker; tasks share its cache."""
    key = hash(model)
    if key not in _TABLES:
        _TABLES[key] = PieceTable(model)
    return _TABLES[key]


def read_model(spark: SparkSession, path: str) -> bytes:
    """The model's bytes, read on the driver; half a megabyte, so they travel with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", end_id: bool = True) -> DataFrame:
    """doc_id, ids (array<int>) of every row; no begin id, no sampling.

    Null texts are empty: no ids but the end id.  Repeated rows are encoded each, very long texts whole; an empty table
    gives an empty result; further columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(held.value)
        end = np.array([table.eos], "<i4").tobytes() if end_id else b""
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [table.encode(t) + end for t in part.column("text").to_pylist()]
                offsets = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, ids, text of every row; null ids are none and give an empty text.

    Repeated rows are decoded each; very long lists are decoded whole; an empty table gives an empty result; further columns are
    not read.
    """
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.expr("cast(array() as array<int>)")).alias("ids"))
    id_type = rows.schema["doc_id"].dataType
    held = rows.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("ids", pa.list_(pa.int32())), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists = part.column("ids")
                ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                texts = pa.array(table.decode_all(lists.flatten().to_numpy(zero_copy_only=False), ends), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids").cast(schema.field("ids").type), texts], schema=schema)

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, ids array<int>, text string")
