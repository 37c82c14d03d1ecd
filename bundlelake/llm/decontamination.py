"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are windows of consecutive item words, grouped by length. For each length a
shift table says how far a block of words may be from the end of any string, so a search jumps
over positions where no string can end; where the shift is zero, the block's hash bucket names
the strings to compare word by word. Many text segments are searched in step with numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted, slices, stored, with_arrow

WINDOW = 10
#: Words of a shift-table block; shorter strings use blocks of their own length.
BLOCK = 2
#: Entries of a shift table, a power of two.
TABLE = 1 << 20
#: Words a segment advances before the next begins.
SEGMENT = 512
#: Benchmarks are searched in parts of at most this many words, so that what a task holds is bounded.
PART_WORDS = 2_000_000

#: ASCII digits and letters, folded to lower case, and every byte of a non-ASCII character.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words of a text; none for null."""
    return text.translate(_FOLD).split() if text else []


class Patterns:
    """Search tables for one part of a benchmark: ``items`` are (item number, text) pairs."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, set[int]]] = {}
        for number, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            size = min(window, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(number)
        self.searches = [Search(n, strings) for n, strings in sorted(by_length.items())]

    def find(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
        """Hit flags of all words of all texts, the texts' bounds, and the items found in each."""
        bounds = np.cumsum([0, *map(len, texts)])
        get = self.ids.get
        ids = np.fromiter((get(w, 0) for t in texts for w in t), np.int64, int(bounds[-1]))
        hit, found = np.zeros(len(ids) + 1, np.int32), [set() for _ in texts]
        for search in self.searches:
            for at, numbers in search.run(ids, bounds):
                hit[at] += 1
                hit[at + search.size] -= 1
                found[int(np.searchsorted(bounds, at, "right")) - 1] |= numbers
        return np.cumsum(hit[:-1]) > 0, bounds, found


class Search:
    """Shift table, hash buckets and strings of one length."""

    def __init__(self, size: int, strings: dict[tuple, set[int]]):
        self.size, self.block = size, min(BLOCK, size)
        self.strings = np.array(list(strings), np.int64).reshape(-1, size)
        self.items = list(strings.values())
        self.shift = np.full(TABLE, size - self.block + 1, np.int16)
        for end in range(self.block, size + 1):
            slots = self._slots(self.strings[:, end - self.block : end].T)
            np.minimum.at(self.shift, slots, size - end)
        suffix = self._slots(self.strings[:, size - self.block :].T)
        order = np.argsort(suffix, kind="stable")
        self.order, self.suffix = order, suffix[order]

    def _slots(self, words) -> np.ndarray:
        mixed = np.zeros(len(words[0]), np.uint64)
        for w in words:
            mixed = (mixed + w.astype(np.uint64) + np.uint64(1)) * _MIX
            mixed ^= mixed >> np.uint64(29)
        return (mixed >> np.uint64(20)).astype(np.int64) & (TABLE - 1)

    def run(self, ids: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, set[int]]]:
        """(start, items) of every occurrence within the texts that ``bounds`` delimit."""
        m, b = self.size, self.block
        first, last = [], []
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            for s in range(a, z - m + 1, SEGMENT):  # ends s+m .. min(z, s+m+SEGMENT-1)
                first.append(s + m)
                last.append(min(z, s + m + SEGMENT - 1))
        end, last = np.array(first, np.int64), np.array(last, np.int64)
        while len(end):
            slots = self._slots([ids[end - b + k] for k in range(b)])
            step = self.shift[slots].astype(np.int64)
            stop = step == 0
            if stop.any():
                yield from self._compare(ids, end[stop], slots[stop])
            end = end + np.maximum(step, 1)
            going = end <= last
            end, last = end[going], last[going]

    def _compare(self, ids, ends, slots) -> Iterator[tuple[int, set[int]]]:
        low, high = np.searchsorted(self.suffix, slots, "left"), np.searchsorted(self.suffix, slots, "right")
        while (open_ := low < high).any():
            low, high, ends = low[open_], high[open_], ends[open_]
            which = self.order[low]
            same = np.ones(len(ends), bool)
            for k in range(self.size):
                same &= ids[ends - self.size + k] == self.strings[which, k]
                if not same.any():
                    break
            for e, w in zip(ends[same].tolist(), which[same].tolist(), strict=True):
                yield e - self.size, self.items[w]
            low = low + 1


def benchmark_parts(
    benchmark: DataFrame, item: str = "item_id", text: str = "text", part_words: int = PART_WORDS
) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's items in parts of bounded size, one at a time.

    An item of more words than a part is a part by itself. One without an id cannot be named and is
    left out. There is one part at least, which may be empty.
    """
    rows = (
        benchmark.where(quoted(item).isNotNull())
        .select(quoted(item).cast("string").alias("i"), quoted(text).cast("binary").alias("t"))
        .distinct()
    )
    part, held = [], 0
    for i, t in rows.toLocalIterator():
        t = bytes(t) if t is not None else b""
        size = 1 + len(words_of(t))
        if part and held + size > part_words:
            yield part
            part, held = [], 0
        part.append((i, t))
        held += size
    yield part


_KIND = (
    "struct<n_words: bigint, n_hit: bigint, n_items: bigint, item_ids: array<string>,"
    " spans: array<struct<first: bigint, end: bigint>>>"
)
_HITS = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("item_ids", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
])


def _searched(part, body: str, before: str | None, window: int):
    """Search one part, adding to what the parts before it have found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = part.value
        patterns, ids = Patterns([(k, t) for k, (_, t) in enumerate(items)], window), [i for i, _ in items]
        for batch in slices(batches, body):
            texts = [words_of(t) for t in batch.column(body).to_pylist()]
            flags, bounds, found = patterns.find(texts)
            earlier = batch.column(before).to_pylist() if before else [None] * len(texts)
            rows = []
            for k, (numbers, old) in enumerate(zip(found, earlier, strict=True)):
                own, mine = flags[bounds[k] : bounds[k + 1]], {ids[n] for n in numbers}
                if old:
                    mine.update(old["item_ids"])
                    for span in old["spans"]:
                        own[span["first"] : span["end"]] = True
                edges = np.flatnonzero(np.diff(np.r_[0, own.view(np.int8), 0])).tolist() if mine else []
                rows.append({
                    "n_words": len(own), "n_hit": int(own.sum()), "n_items": len(mine), "item_ids": sorted(mine),
                    "spans": [{"first": a, "end": z} for a, z in zip(edges[::2], edges[1::2], strict=True)],
                })
            out = batch.drop_columns([c for c in (body, before) if c])
            yield out.append_column("benchmark_hits", pa.array(rows, _HITS))

    return run


def search(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, part_words: int = PART_WORDS
) -> DataFrame:
    """Add ``benchmark_hits`` to every document.

    A struct of ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``n_items``,
    ``item_ids`` (sorted as strings), ``spans`` (start and end word of every hit run). One row per
    input row; null and empty texts have no words. Items without words match nothing; an item id
    that occurs with several texts is one item. A column named ``benchmark_hits`` is replaced.
    Documents are not shuffled. Driver and tasks hold one part of ``part_words`` benchmark words at a
    time, an item at least; a larger benchmark takes a pass over the documents for each part, whose
    result is written before the next.
    """
    found = documents.drop("benchmark_hits")
    body, before = own_name(documents, "body"), None
    for part in benchmark_parts(benchmark, part_words=part_words):
        if before:  # there is another part: settle the last one
            found = stored(found, "benchmark-hits").withColumnRenamed("benchmark_hits", before)
        sent = documents.sparkSession.sparkContext.broadcast(part)
        helpers = [body, before] if before else [body]
        found = with_arrow(
            found.withColumn(body, quoted(text).cast("binary")), _searched(sent, body, before, window), helpers, "benchmark_hits", _KIND
        )
        before = before or own_name(documents, "before")
    return found


def digest(item_ids: list[str]) -> str:
    return hashlib.sha256(",".join(item_ids).encode()).hexdigest()


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Keep the documents without any benchmark window; the columns stay as they are."""
    return search(documents, benchmark, text).where("benchmark_hits.n_hit = 0").select(*[quoted(c) for c in documents.columns])
