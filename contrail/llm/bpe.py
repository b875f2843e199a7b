"""BPE encoding and decoding with the vocabulary file of a public byte-level tokenizer."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_arrow

# Fixed: the split pattern of the byte-level vocabulary; merges stay within its pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A worker remembers at most twice so many words.
REMEMBERED = 400_000
# Rows turned into Python values at a time.
SLICE_ROWS = 128
# Longer pieces are encoded anew each time, so that memory stays bounded.
LONGEST_REMEMBERED = 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable Latin-1 bytes stand for themselves, the rest for the characters
    from U+0100 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        symbols = byte_symbols()
        to_byte = {symbol: byte for byte, symbol in enumerate(symbols)}
        vocabulary = model["vocab"]
        self.byte_ids = [vocabulary[symbol] for symbol in symbols]
        self.merges = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        self.strings = {number: bytes(to_byte[c] for c in symbol)
                        for symbol, number in vocabulary.items()}
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.strings |= {number: text.encode() for text, number in self.special.items()}
        # Decoding starts from the decimal ids.
        self.by_digits = {str(number): string for number, string in self.strings.items()}
        self.pieces = regex.compile(PATTERN)
        self.specials = (regex.compile("|".join(map(regex.escape, self.special)))
                         if self.special else None)
        self.not_plain = regex.compile(r"\s ")
        self.memory = _Memory(self)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece.

        The symbols form a doubly linked list; a heap holds the merge of each
        neighbouring pair by (rank, position).  An entry whose symbols have
        changed since it was pushed is stale and skipped.
        """
        ids = [self.byte_ids[b] for b in data]
        size = len(ids)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        merges = self.merges
        heap = []
        for i in range(size - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                found = merges.get((merged, ids[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], merged))
                if found:
                    heapq.heappush(heap, (found[0], h, ids[h], merged, found[1]))
        return [number for number in ids if number >= 0]

    def _plain(self, text: str) -> list[str]:
        """Texts without special tokens: decimal ids of each piece, joined by commas."""
        memory = self.memory
        if self.not_plain.search(text):
            return [memory[piece] for piece in self.pieces.findall(text)]
        # A space after a visible character always starts a piece, so the words
        # between single spaces can be looked up whole, each with its space.
        words = text.split(" ")
        first = words[0]
        out = [memory[" " + word] for word in words[1:]]
        return [memory[first], *out] if first else out

    def encode(self, text: str) -> str:
        """The ids of ``text`` as decimal numbers joined by commas."""
        if not text:
            return ""
        if self.specials is None or not self.specials.search(text):
            return ",".join(self._plain(text))
        parts, at = [], 0
        for match in self.specials.finditer(text):
            if match.start() > at:
                parts += self._plain(text[at:match.start()])
            parts.append(str(self.special[match.group()]))
            at = match.end()
        if at < len(text):
            parts += self._plain(text[at:])
        return ",".join(parts)

    def decode(self, digits: str) -> str:
        """The text of decimal ids: their vocabulary strings joined, as UTF-8."""
        if not digits:
            return ""
        return b"".join(map(self.by_digits.__getitem__, digits.split(","))).decode(
            "utf-8", "replace")


class _Memory(dict):
    """Encodings of words seen before, of bounded size.

    When full, what was not used since the last time it was full is forgotten.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec
        self.older: dict[str, str] = {}

    def __missing__(self, word: str) -> str:
        value = self.older.get(word)
        if value is None:
            pieces = self.codec.pieces.findall(word)
            if len(pieces) == 1:
                value = ",".join(map(str, self.codec.merge(word.encode())))
            else:
                value = ",".join([self[piece] for piece in pieces])
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


_codecs: dict[str, Codec] = {}


def codec_of(content: str) -> Codec:
    """The codec of a vocabulary file's content, built once per worker."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def read_vocabulary(path: str) -> str:
    """The vocabulary file, read on the driver; it is of a fixed size."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that what Python makes of one stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(first, SLICE_ROWS)


def encode(documents: DataFrame, vocabulary: str, digests: bool = False,
           decoded: bool = False) -> DataFrame:
    """All columns of ``documents`` and the encoding of ``text``.

    Adds ``n_tokens`` and ``ids`` (an int array); with ``digests`` instead of the
    ids ``ids_sha256`` of the comma-joined ids and ``decoded_sha256`` of the text
    they decode to; with ``decoded`` that text.  NULL and empty texts have no
    tokens.  One pass without a shuffle; every row stands alone, repeated rows
    give equal results.  Columns of these names already there are replaced.
    """
    fields = [T.StructField("n_tokens", T.LongType())]
    fields += ([T.StructField("ids_sha256", T.StringType()),
                T.StructField("decoded_sha256", T.StringType())] if digests
               else [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    kept = documents.drop(*(field.name for field in fields))
    names = [*kept.columns, *(field.name for field in fields)]
    text_at = kept.columns.index("text")
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in _slices(batches):
            every = [codec.encode(text.as_py() or "") for text in batch.column(text_at)]
            texts = [codec.decode(digits) for digits in every] if digests or decoded else []
            added = [pa.array([digits.count(",") + 1 if digits else 0 for digits in every],
                              pa.int64())]
            if digests:
                added += [pa.array([hashlib.sha256(part.encode()).hexdigest() for part in parts])
                          for parts in (every, texts)]
            else:
                added.append(pa.array([np.array(digits.split(",") if digits else [], np.int32)
                                       for digits in every], pa.list_(pa.int32())))
            if decoded:
                added.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names)

    return map_arrow(kept, apply, T.StructType([*kept.schema.fields, *fields]))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """All columns of ``encoded`` and ``decoded``, the text of its ids (NULL: NULL)."""
    kept = encoded.drop("decoded")
    at, names = kept.columns.index(ids), [*kept.columns, "decoded"]
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in _slices(batches):
            texts = [codec.decode(",".join(map(str, row.values.to_pylist())))
                     if row.is_valid else None for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return map_arrow(kept, apply, T.StructType(
        [*kept.schema.fields, T.StructField("decoded", T.StringType())]))
