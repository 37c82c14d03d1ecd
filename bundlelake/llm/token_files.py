"""Token files: ids in bit or byte planes, compressed plane by plane, with a chunk index.

A file holds the ids of consecutive documents in blocks of fixed size. A block is transposed into
byte planes (or bit planes), so that the rarely used high bytes compress to almost nothing, and each
plane is compressed with zstandard. After the blocks come the documents' ids and lengths, coded the
same way, the chunk index, and a footer that points to it:

    "BPS1" | plane data ... | index: JSON | index offset and length, u64 each | "BPS1"
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import slices, stored
from bundlelake.llm.grams import numbered

MAGIC = b"BPS1"
BLOCK_IDS, LEVEL = 1 << 16, 3
#: Words and pieces whose ids a Python worker remembers in each of two generations, so that memory
#: does not grow with the vocabulary. Those that keep coming stay: a hit in the old one is taken over.
CACHE_WORDS, CACHE_PIECES = 250_000, 250_000
#: Documents in one block of document numbers and lengths.
BLOCK_DOCS = 1 << 14


def planes(values: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes of an array of unsigned integers, low byte first, or their bit planes."""
    bytes_ = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    if not bits:
        return [p.tobytes() for p in bytes_]
    return [np.packbits((p >> k) & 1).tobytes() for p in bytes_ for k in range(8)]


def unplane(parts: list[bytes], count: int, dtype, bits: bool = False) -> np.ndarray:
    """The array that :func:`planes` took apart."""
    size = np.dtype(dtype).itemsize
    if bits:
        rows = []
        for b in range(size):
            row = np.zeros(count, np.uint8)
            for k in range(8):
                row |= np.unpackbits(np.frombuffer(parts[b * 8 + k], np.uint8), count=count) << k
            rows.append(row)
    else:
        rows = [np.frombuffer(p, np.uint8) for p in parts]
    return np.ascontiguousarray(np.stack(rows, 1)).view(dtype).reshape(count) if count else np.zeros(0, dtype)


class Writer:
    """Writes one token file; holds one block of ids and one of documents."""

    def __init__(self, out, bits: bool = False):
        self.out, self.bits, self.at = out, bits, 0
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.ids, self.held, self.docs, self.lengths = [], 0, [], []
        self.index = {"bits": bits, "ids": [], "docs": [], "lengths": []}
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _chunk(self, kind: str, values: np.ndarray) -> None:
        entry = {"at": self.at, "n": len(values), "sizes": []}
        for plane in planes(values, self.bits):
            packed = self.pack.compress(plane)
            entry["sizes"].append(len(packed))
            self._put(packed)
        self.index[kind].append(entry)

    def add(self, doc: int, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK_IDS:
            ready = np.concatenate(self.ids)
            whole = len(ready) // BLOCK_IDS * BLOCK_IDS
            for k in range(0, whole, BLOCK_IDS):
                self._chunk("ids", ready[k : k + BLOCK_IDS])
            self.ids, self.held = [ready[whole:].copy()], len(ready) - whole
        if len(self.docs) >= BLOCK_DOCS:
            self._documents()

    def _documents(self) -> None:
        self._chunk("docs", np.array(self.docs, np.int64).view(np.uint64))
        self._chunk("lengths", np.array(self.lengths, np.uint64))
        self.docs, self.lengths = [], []

    def close(self) -> None:
        if self.held:
            self._chunk("ids", np.concatenate(self.ids))
        if self.docs:
            self._documents()
        index, at = json.dumps(self.index).encode(), self.at
        self._put(index)
        self._put(struct.pack("<QQ", at, len(index)) + MAGIC)


class Reader:
    """Reads one token file chunk by chunk through its index."""

    def __init__(self, file):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        file.seek(file.size() - 20)
        tail = file.read(20)
        if tail[16:] != MAGIC:
            raise ValueError("not a token file")
        at, size = struct.unpack("<QQ", tail[:16])
        file.seek(at)
        self.index = json.loads(file.read(size))

    def chunks(self, kind: str) -> Iterator[np.ndarray]:
        dtype = np.uint32 if kind == "ids" else np.uint64
        for entry in self.index[kind]:
            self.file.seek(entry["at"])
            data, parts = self.file.read(sum(entry["sizes"])), []
            for size in entry["sizes"]:
                parts.append(self.unpack.decompress(data[:size]))
                data = data[size:]
            yield unplane(parts, entry["n"], dtype, self.index["bits"])

    def documents(self) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Every document's number and its ids, in pieces of a block at most."""
        blocks, rest = self.chunks("ids"), np.zeros(0, np.uint32)
        for docs, lengths in zip(self.chunks("docs"), self.chunks("lengths"), strict=True):
            for doc, length in zip(docs.view(np.int64).tolist(), lengths.tolist(), strict=True):
                pieces = []
                while length:
                    if not len(rest):
                        rest = next(blocks)
                    pieces.append(rest[:length])
                    length -= len(pieces[-1])
                    rest = rest[len(pieces[-1]) :]
                yield doc, pieces


#: Words whose code points every Unicode version classes alike; no white space among them.
_LATIN = re.compile("[\\x21-\\x7e\\xa1-\\u024f]+")
#: What no line of ASCII words of that kind has.
_NOT_PLAIN = re.compile("[^\\x21-\\x7e\\n]")

#: Stands between words among ids; no vocabulary has it.
_NO_ID = np.uint32(0xFFFFFFFF)
_BREAK = _NO_ID.tobytes()


def _cut_pattern(path: str) -> regex.Pattern | None:
    """The pattern of a lower-cased word's pieces and of line ends, if the tokenizer works that way."""
    with open(path, encoding="utf-8") as file:
        plan = json.load(file)
    normal, pre = plan.get("normalizer") or {}, plan.get("pre_tokenizer") or {}
    steps = [s["type"] for s in normal.get("normalizers", ())]
    cuts = pre.get("pretokenizers", ())
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, bytes_ = cuts
    usual = split["behavior"] == "Removed" and split["invert"] and "Regex" in split["pattern"]
    if not usual or bytes_["add_prefix_space"] or bytes_["use_regex"]:
        return None
    return regex.compile(f"{split['pattern']['Regex']}|\n")


def _take_over(missing: set, young: dict, old: dict) -> set:
    """Moves what the old generation knows to the young one; returns the rest."""
    back = missing & old.keys()
    young.update((w, old[w]) for w in back)
    return missing - back


class WordIds(dict):
    """Ids of white-space separated words as bytes; unknown words are encoded by the tokenizer.

    The vocabulary drops white space and no piece spans it, so the ids of a text are those of its
    words one after the other. Where the tokenizer's file says that it lower-cases a word and cuts
    it by a pattern, words of Latin letters are cut here first, and only pieces never seen before
    are encoded: words with other capitals or punctuation share them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder()
        special = [(i, t) for i, t in added.items() if t.special]
        #: A special token that stands between words, so that many are encoded in one call.
        self.mark = (special[0][0], special[0][1].content) if special else None
        self.added = re.compile("|".join(re.escape(t.content) for t in added.values()) or r"(?!)", re.I)
        self.cut = _cut_pattern(path)
        # the bytes of a piece are written in the letters of the vocabulary; ASCII ones stand for themselves
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: All bytes of code points up to U+024F beyond ASCII, by their letters.
        self.letters = {}
        for c in map(chr, range(0x80, 0x250)):
            self.letters |= zip(c.encode(), byte_level.pre_tokenize_str(c)[0][0], strict=True)

    def learn(self, words: set[bytes]) -> None:
        missing = words - self.keys()
        if len(self) + len(missing) > CACHE_WORDS:
            self.old = dict(self)
            self.clear()
            missing = words
        new = list(_take_over(missing, self, self.old))
        if new and self.cut is not None:
            new = self._learn_by_pieces(new)
        mark = self.mark[1].encode() if self.mark else b""
        plain = [w for w in new if mark and mark not in w]
        for w in new if len(plain) < len(new) else ():
            if not mark or mark in w:
                self[w] = self._encoded(w.decode())
        for k in range(0, len(plain), 4096):
            part = plain[k : k + 4096]
            ids = np.array(self.tokenizer.encode(mark.join(part).decode(), add_special_tokens=False).ids, np.uint32)
            cuts = [-1, *np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)]
            data = ids.tobytes()
            for w, before, end in zip(part, cuts[:-1], cuts[1:], strict=True):
                self[w] = data[4 * before + 4 : 4 * end]

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _plain(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """The words of Latin letters, digits and symbols, and the others."""
        plain = [bool(_LATIN.fullmatch(t := w.decode()) and not self.added.search(t)) for w in words]
        return list(compress(words, plain)), [w for w, is_plain in zip(words, plain, strict=True) if not is_plain]

    def _learn_by_pieces(self, words: list[bytes]) -> list[bytes]:
        """Learn the words of Latin letters, digits and symbols; returns the others."""
        keys, others = [w for w in words if w.isascii()], []
        text = b"\n".join(keys).decode()
        if _NOT_PLAIN.search(text) or self.added.search(text):
            keys, others = self._plain(keys)
            text = b"\n".join(keys).decode()
        shown = [text.lower()] if keys else []
        accented, more = self._plain([w for w in words if not w.isascii()])
        others += more
        if accented:
            text = self.tokenizer.normalizer.normalize_str(b" ".join(accented).decode())
            shown.append(text.replace(" ", "\n"))
            keys += accented
        flat = self.cut.findall("\n".join(shown))
        seen = set(flat)
        missing = seen - self.pieces.keys()
        if len(self.pieces) + len(missing) > CACHE_PIECES:
            self.old_pieces, self.pieces = self.pieces, {}
            missing = seen
        missing = _take_over(missing, self.pieces, self.old_pieces)
        model, letters = self.tokenizer.model, self.letters
        for p in missing - {"\n"}:
            known = p if p.isascii() else p.encode().decode("latin-1").translate(letters)
            self.pieces[p] = array("I", [t.id for t in model.tokenize(known)]).tobytes()
        self.pieces["\n"] = _BREAK
        data = b"".join(map(self.pieces.__getitem__, flat))
        ends = [*(np.flatnonzero(np.frombuffer(data, np.uint32) == _NO_ID) * 4).tolist(), len(data)]
        before = 0
        for w, end in zip(keys, ends if keys else (), strict=True):
            self[w] = data[before:end]
            before = end + 4
        return others

    def of(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, words))

    def of_column(self, column: pa.Array, end_id: int) -> list[np.ndarray]:
        """Ids of binary texts, ``end_id`` after each; every different word is looked up once."""
        numbers, bounds, words = numbered(column)
        self.learn(set(words))
        known = [*map(self.__getitem__, words), struct.pack("<I", end_id)]
        ids, sizes = np.frombuffer(b"".join(known), np.uint32), np.fromiter(map(len, known), np.int64, len(known)) // 4
        numbers = np.insert(numbers, bounds[1:], len(words))
        lengths = sizes[numbers]
        ends = np.cumsum(lengths)
        at = np.arange(lengths.sum()) + np.repeat((np.cumsum(sizes) - sizes)[numbers] - (ends - lengths), lengths)
        return np.split(ids[at], ends[bounds[1:] + np.arange(len(column))])[: len(column)]


@functools.lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One per Python worker: what a task has learned serves the worker's next tasks."""
    return WordIds(path)


def _place(path: str):
    """File system and path of a folder or file, by its address."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write(
    documents: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text",
    bits: bool = False,
) -> DataFrame:
    """Encode all documents and write them to ``folder`` in ascending order of their key.

    Documents are dealt out by key range, one token file a range, named in order. A file is
    written under a name of its own and then renamed, so a repeated task replaces it by the same
    content. Returns one row per file: ``part, path, n_docs, n_tokens``. Every document ends with
    ``end_id``; a null or empty text has that id only. Rows without a key come first, under the
    key -1; rows with equal keys follow one another, ordered by text. ``tokenizer`` is the path
    of a vocabulary file that every executor has.
    """
    ordered = (
        documents.select(
            F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("doc"),
            F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        )
        .repartitionByRange("doc")
        .sortWithinPartitions("doc", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = TaskContext.get().partitionId(), _word_ids(tokenizer)
        system, top = _place(folder)
        system.create_dir(top, recursive=True)
        final, draft = f"{top}/part-{part:06d}.bps", f"{top}/_draft-{part:06d}-{uuid.uuid4().hex}"
        docs, total = 0, 0
        with system.open_output_stream(draft) as out:
            writer = Writer(out, bits)
            for batch in slices(batches, "text"):
                texts = words.of_column(batch.column("text"), end_id)
                for doc, ids in zip(batch.column("doc").to_pylist(), texts, strict=True):
                    writer.add(doc, ids)
                    docs, total = docs + 1, total + len(ids)
            writer.close()
        system.move(draft, final)
        yield pa.record_batch(
            [pa.array([part]), pa.array([f"{folder.rstrip('/')}/part-{part:06d}.bps"]), pa.array([docs]), pa.array([total])],
            names=["part", "path", "n_docs", "n_tokens"],
        )

    manifest = ordered.mapInArrow(run, "part long, path string, n_docs long, n_tokens long")
    return stored(manifest, "token-manifest")


def read(manifest: DataFrame, columns: str, row: Callable[[int, int, list[np.ndarray]], tuple]) -> DataFrame:
    """Read token files back, file by file and chunk by chunk.

    ``row(doc, start, pieces)`` makes a result row of a document's number, the number of ids
    before it in all files, and its ids; ``columns`` is the rows' schema.
    """
    names = [c.split()[0] for c in columns.split(",")]
    schema = manifest.sparkSession.createDataFrame([], columns).schema
    kinds = [{"long": pa.int64()}.get(f.dataType.typeName(), pa.string()) for f in schema]
    # one row a file: their running total is all that meets in one task
    placed = manifest.selectExpr("path", "part", "sum(n_tokens) OVER (ORDER BY part) - n_tokens AS start")
    files = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, at = _place(path)
                rows = []
                with system.open_input_file(at) as file:
                    for doc, pieces in Reader(file).documents():
                        rows.append(row(doc, start, pieces))
                        start += sum(map(len, pieces))
                        if len(rows) >= 10_000:
                            yield _batch(rows, kinds, names)
                            rows = []
                yield _batch(rows, kinds, names)

    return placed.repartition(files, "part").mapInArrow(run, columns)


def _batch(rows, kinds, names) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def facts(doc: int, start: int, pieces: list[np.ndarray]) -> tuple[int, int, int, int]:
    """A document's number, start, number of ids and the CRC-32 of its ids."""
    crc = 0
    for p in pieces:
        crc = zlib.crc32(p.astype("<u4").tobytes(), crc)
    return doc, start, sum(map(len, pieces)), crc
