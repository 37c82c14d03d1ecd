"""Byte-level BPE by sentencepiece: a rank file becomes a sentencepiece model, ids become bytes again.

Each byte of the vocabulary is written as one letter, each token as one piece of such letters with
the negative of its rank as score, and the model file is serialised from these pieces with identity
normalisation. Merging the neighbours of the highest score first is then merging those of the
lowest rank, so sentencepiece gives the ids of the rank file. Texts are cut into pre-tokens by the
vocabulary's pattern and every pre-token is encoded by itself; decoding looks the bytes of each id up.

Nulls: a null text is an empty one and has no ids; null ids decode to null. An id that the
vocabulary lacks decodes to the three bytes of U+FFFD. All columns of the input are kept; one that
already has the name of the result is replaced.
"""

from __future__ import annotations

import base64
import functools
import itertools
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bundlelake.llm.common import slices

#: Pre-tokens whose ids a Python worker remembers, and the longest that it remembers.
CACHE_PIECES, CACHE_CHARS = 100_000, 64
#: Pre-tokens of one text that are held at a time.
HELD_PIECES = 500_000
#: Text encoded at a time and ids decoded at a time, one row at least.
HELD_BYTES, HELD_IDS = 1 << 20, 1 << 18
#: The letter of byte 0; the letters of the others follow it. None of the 256 is white space.
_FIRST_LETTER = 0x100
_LETTERS = {b: chr(_FIRST_LETTER + b) for b in range(256)}
_MISSING = "�".encode()


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of every line of a rank file."""
    with open(path, "rb") as lines:
        parts = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in parts if p}


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1  # a negative number takes the ten bytes of its two's complement
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def letters(data: bytes) -> str:
    """Bytes written in the letters of the model."""
    return data.decode("latin-1").translate(_LETTERS)


def letters_of(texts: list[bytes]) -> list[str]:
    """:func:`letters` of many byte strings in one pass."""
    flat = (np.frombuffer(b"".join(texts), np.uint8).astype("<u2") + _FIRST_LETTER).astype("<u2")
    shown, at, out = flat.tobytes().decode("utf-16-le"), 0, []
    for text in texts:
        out.append(shown[at : at + len(text)])
        at += len(text)
    return out


def serialise(ranks: dict[bytes, int]) -> tuple[bytes, np.ndarray]:
    """A sentencepiece model file of a vocabulary, and the rank of each of its pieces.

    Pieces stand in the order of their ranks; the piece for unknown text, which the file format
    demands and byte letters never reach, comes last.
    """
    lacking = [b for b in range(256) if bytes([b]) not in ranks]
    if lacking:
        raise ValueError(f"the vocabulary lacks single bytes: {lacking[:5]}")
    ordered = sorted(ranks.items(), key=lambda item: item[1])
    # Field numbers and enumerations of the sentencepiece model format (fixed values):
    # model: 1 pieces, 2 trainer, 3 normaliser; piece: 1 text, 2 score, 3 kind (2 = unknown);
    # trainer: 3 kind of model (2 = BPE), 4 size, 40 to 43 ids of unknown, begin, end, padding;
    # normaliser: 1 name, 3 prefix, 4 fewer spaces, 5 escaped spaces.
    model = [
        _bytes(1, _bytes(1, letters(token).encode()) + b"\x15" + struct.pack("<f", -rank))
        for token, rank in ordered
    ]
    unknown = _bytes(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)
    trainer = _number(3, 2) + _number(4, len(ordered) + 1) + _number(40, len(ordered))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43))
    normaliser = _bytes(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    model += [_bytes(1, unknown), _bytes(2, trainer), _bytes(3, normaliser)]
    return b"".join(model), np.array([rank for _, rank in ordered], np.uint32)


class PieceIds(dict):
    """Ids of pre-tokens as bytes, remembered in two generations.

    When the young generation is full it becomes the old one, and a pre-token found there moves to
    the young one, so frequent pre-tokens stay and memory does not grow with the vocabulary.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import sentencepiece

        super().__init__()
        model, self.rank = serialise(ranks)
        self.in_order = bool((self.rank == np.arange(len(self.rank))).all())
        self.whole = ranks
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.old: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Know all the given pre-tokens; returns those that are too long to remember."""
        new = [p for p in pieces if p not in self]
        if len(self) + len(new) > CACHE_PIECES:
            self.old = dict(self)
            self.clear()
            new = list(pieces)
        known, self_old = self.old, []
        for p in new:
            ids = known.get(p)
            if ids is None:
                self_old.append(p)
            else:
                self[p] = ids
        long, encoded = {}, []
        for p in self_old:
            data = p.encode()
            rank = self.whole.get(data)  # a token by itself needs no merging
            if rank is None:
                encoded.append((p, data))
            else:
                self[p] = struct.pack("<I", rank)
        if encoded:
            found = self.encoder.encode(letters_of([data for _, data in encoded]), num_threads=1)
            for (p, _), ids in zip(encoded, found, strict=True):
                data = array("I", ids).tobytes() if self.in_order else self.rank[ids].tobytes()
                (self if len(p) <= CACHE_CHARS else long)[p] = data
        return long


@functools.lru_cache(maxsize=1)
def _pieces(path: str) -> PieceIds:
    """One per Python worker: what a task has learned serves the worker's next tasks."""
    return PieceIds(read_ranks(path))


@functools.lru_cache(maxsize=1)
def _tokens(path: str) -> list[bytes]:
    """Bytes of each id: the vocabulary turned round."""
    ranks = read_ranks(path)
    table = [_MISSING] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _in_parts(text: str, cut: regex.Pattern) -> Iterator[list[str]]:
    """The pre-tokens of a text; a very long text's come in several lists."""
    if len(text) < HELD_PIECES:
        yield cut.findall(text)
        return
    found = (m.group() for m in cut.finditer(text))
    while part := list(itertools.islice(found, HELD_PIECES)):
        yield part


def _with_column(frame: DataFrame, source: str, name: str, kind: T.DataType, made: Callable) -> DataFrame:
    """``frame`` with a column that ``made`` computes from slices of the column ``source``."""
    fields = frame.schema.fields
    at = [f.name.lower() for f in fields].index(source.lower())
    kept = [k for k, f in enumerate(fields) if f.name.lower() != name.lower()]
    # columns travel under plain names: Spark cannot send names with a dot to Python
    plain = [f"c{k}" for k in range(len(fields))]
    schema = T.StructType([*[T.StructField(plain[k], fields[k].dataType) for k in kept], T.StructField("made", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, column in made(batches, at):
            yield pa.RecordBatch.from_arrays([*[rows.column(k) for k in kept], column], schema.names)

    return frame.toDF(*plain).mapInArrow(run, schema).toDF(*[fields[k].name for k in kept], name)


def encode(
    documents: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "token_ids"
) -> DataFrame:
    """Add the ids of every text. ``vocabulary`` is a rank file that every executor has."""

    def made(batches: Iterator[pa.RecordBatch], at: int):
        known, cut = _pieces(vocabulary), regex.compile(pattern)
        for batch in batches:
            for rows in slices([batch], batch.schema.names[at], HELD_BYTES):
                values, ends = [], [0]
                texts = [t or "" for t in rows.column(at).to_pylist()]
                short = [cut.findall(t) if len(t) < HELD_PIECES else None for t in texts]
                long = known.learn(set().union(*[p for p in short if p is not None]))
                get = (lambda p: known.get(p) or long[p]) if long else known.__getitem__
                # the short texts of the slice first: a long one may turn the generations over
                done = [None if p is None else b"".join(map(get, p)) for p in short]
                for k, t in enumerate(texts):
                    if done[k] is None:
                        done[k] = b"".join(_long(t, cut, known))
                    values.append(done[k])
                    ends.append(ends[-1] + len(done[k]) // 4)
                flat = pa.array(np.frombuffer(b"".join(values), np.int32))
                yield rows, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    return _with_column(documents, text, ids, T.ArrayType(T.IntegerType()), made)


def _long(text: str, cut: regex.Pattern, known: PieceIds) -> Iterator[bytes]:
    for part in _in_parts(text, cut):
        long = known.learn(set(part))
        yield b"".join(known.get(p) or long[p] for p in part)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that the ids stand for, which need not be whole characters."""

    def made(batches: Iterator[pa.RecordBatch], at: int):
        table = _tokens(vocabulary)
        size = len(table)
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.list_value_length(batch.column(at)), 0).to_numpy().cumsum()
            first = 0
            while first < batch.num_rows:
                before = int(lengths[first - 1]) if first else 0
                last = max(first + 1, int(lengths.searchsorted(before + HELD_IDS, "right")))
                rows = batch.slice(first, last - first)
                yield rows, pa.array([_bytes_of(v, table, size) for v in rows.column(at)], pa.binary())
                first = last

    return _with_column(encoded, ids, out, T.BinaryType(), made)


def _bytes_of(value: pa.ListScalar, table: list[bytes], size: int) -> bytes | None:
    if not value.is_valid:
        return None
    numbers = value.values
    listed = numbers.to_pylist()
    if not listed:
        return b""
    least = pa.compute.min_max(numbers).as_py()
    if numbers.null_count or least["min"] < 0 or least["max"] >= size:
        return b"".join(table[i] if i is not None and 0 <= i < size else _MISSING for i in listed)
    return b"".join(map(table.__getitem__, listed))
