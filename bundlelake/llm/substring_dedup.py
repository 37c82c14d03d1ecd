"""Removal of repeated passages by relative Lempel-Ziv parsing.

Every document is parsed greedily into factors relative to all documents with a smaller id: a
factor begins where a window of 13 words occurs in one of them and grows word by word as long as
the next window does too; words in no factor are literals. The reference is indexed in blocks (a
slice of the input each): a block's index holds one entry per window with the smallest document
that has it, so a passage that very many documents share costs one row per block and not one
per document. Blocks meet by hash:

1. Seeds. The window's least 5-word gram (its minimizer) stands for it, about one seed per five
   words. Equal windows have equal seeds, so only windows whose seed occurs in two documents can
   be factors; all others, most of the corpus, go no further.
2. Windows with shared seeds are indexed and looked up; this checks every factor at its
   boundaries, since a factor ends exactly where the next window is in no smaller document.
3. Covered windows return to their documents as spans.

Exact copies are settled before by a digest of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted, slices, with_arrow
from bundlelake.llm.grams import WordHashes, rolling, split, starts

WINDOW, SEED = 13, 5
#: Bytes of text in one reference block, which is what a task holds at a time.
BLOCK_BYTES = 8 << 20
#: A table of exact copies up to this many rows is sent to every task (16 bytes a row); a larger
#: one is joined by shuffling.
BROADCAST_COPIES = 2_000_000

_ROWS = pa.schema([("settled", pa.bool_()), ("key", pa.int64()), ("doc", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
_ROWS_SQL = "settled boolean, key bigint, doc bigint, first bigint, last bigint"


def _windows(texts, hashes, window):
    """Hash, seed, start and text number of every window."""
    values, bounds = hashes.of(texts)
    at, owner = starts(bounds, window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    seeds = rolling(values, SEED)
    view = np.lib.stride_tricks.sliding_window_view(seeds, window - SEED + 1)
    place = np.arange(len(view)) + view.argmin(1)
    keys = rolling(values, window)
    return keys[at].view(np.int64), seeds[place[at]].view(np.int64), at - bounds[:-1][owner], owner


def _rows(settled, key, doc, first, last) -> pa.RecordBatch:
    return pa.record_batch([pa.array(settled, pa.bool_()), pa.array(key), pa.array(doc), pa.array(first), pa.array(last)], schema=_ROWS)


def _first_of(keys: np.ndarray) -> np.ndarray:
    """Marks the first row of each run of equal keys."""
    return np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)


def _seed_rows(window):
    """Per block and seed one row to look up; (document, seed) pairs shared within it are settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", BLOCK_BYTES):
            ids = batch.column("doc").to_numpy()
            _, seed, _, owner = _windows(split(batch.column("text")), hashes, window)
            if not len(seed):
                continue
            order = np.lexsort((ids[owner], seed))
            seed, doc = seed[order], ids[owner[order]]
            once = _first_of(seed)
            once[1:] |= doc[1:] != doc[:-1]
            seed, doc = seed[once], doc[once]
            new = _first_of(seed)
            shared = ~new | np.r_[~new[1:], False]
            zero = np.zeros(len(seed), np.int64)
            yield _rows(np.zeros(int(new.sum()), bool), seed[new], doc[new], zero[new], zero[new])
            yield _rows(np.ones(int(shared.sum()), bool), seed[shared], doc[shared], zero[shared], zero[shared])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: those whose key occurs in two blocks or more."""
    held = None  # the last open row that had no partner so far
    last_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        key, doc = batch.column("key").to_numpy(), batch.column("doc").to_numpy()
        yield batch.filter(pa.array(settled))
        key, doc = key[~settled], doc[~settled]
        if not len(key):
            continue
        new = _first_of(key)
        new[0] = key[0] != last_key
        keep = ~new | np.r_[~new[1:], False]
        if held is not None and not new[0]:
            yield _rows([True], [held[0]], [held[1]], [0], [0])
        held = (int(key[-1]), int(doc[-1])) if not keep[-1] else None
        last_key = key[-1]
        zero = np.zeros(int(keep.sum()), np.int64)
        yield _rows(np.ones(len(zero), bool), key[keep], doc[keep], zero, zero)


def _window_rows(window):
    """Windows with a shared seed: per block and window one document to look up, the rest settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", BLOCK_BYTES):
            ids = batch.column("doc").to_numpy()
            key, seed, at, owner = _windows(split(batch.column("text")), hashes, window)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            marked = np.zeros(len(key), bool)
            for k, mine in enumerate(batch.column("seeds")):
                a, z = cuts[k], cuts[k + 1]
                marked[a:z] = np.isin(seed[a:z], mine.values.to_numpy())
            key, at, doc = key[marked], at[marked], ids[owner[marked]]
            order = np.lexsort((at, doc, key))
            key, at, doc = key[order], at[order], doc[order]
            if not len(key):
                continue
            new = _first_of(key)
            least = doc[new][np.cumsum(new) - 1]
            covered = doc > least
            open_ = int((~covered).sum())
            # a window to look up has no last start: what is the same in all rows shuffles for little
            yield _rows(np.zeros(open_, bool), key[~covered], doc[~covered], at[~covered], np.zeros(open_, np.int64))
            yield _runs(doc[covered], at[covered])

    return run


def _runs(doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """Consecutive window starts of a document as spans; their keys only spread the rows."""
    order = np.lexsort((at, doc))
    doc, at = doc[order], at[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + 1)] if len(doc) else np.zeros(0, bool)
    end = np.r_[new[1:], True] if len(doc) else new
    return _rows(np.ones(int(new.sum()), bool), doc[new] * 31 + at[new], doc[new], at[new], at[end])


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and document: windows that a smaller document has too."""
    last_key, least = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(settled))
        key, doc, at = (batch.column(c).to_numpy()[~settled] for c in ("key", "doc", "first"))
        if not len(key):
            continue
        new = _first_of(key)
        new[0] = True
        firsts = doc[new]
        if key[0] == last_key:
            firsts = firsts.copy()
            firsts[0] = least
        group = np.cumsum(new) - 1
        hit = doc > firsts[group]
        last_key, least = key[-1], int(firsts[-1])
        yield _runs(doc[hit], at[hit])


def _kept(window, body, found, copied):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            rows = []
            spans = batch.column(found).to_pylist()
            copies = batch.column(copied).to_pylist()
            for words, mine, copy in zip(split(batch.column(body)), spans, copies, strict=True):
                n, factors = len(words), []
                if copy and n >= window:
                    factors = [(0, n)]
                for first, last in sorted((s["first"], s["last"]) for s in mine or ()):
                    end = min(last + window, n)
                    if factors and first <= factors[-1][1]:
                        factors[-1] = (factors[-1][0], max(end, factors[-1][1]))
                    else:
                        factors.append((first, end))
                kept, done = [], 0
                for first, end in factors:
                    kept += words[done:first]
                    done = end
                kept += words[done:]
                rows.append({
                    "n_words": n, "n_removed": n - len(kept), "kept_text": b" ".join(kept).decode(errors="replace"),
                    "factors": [{"first": a, "end": z} for a, z in factors],
                })
            kind = pa.struct([
                ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
                ("factors", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            ])
            yield batch.drop_columns([body, found, copied]).append_column("repeats", pa.array(rows, kind))

    return run


def find_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``repeats`` to every document: what a document with a smaller id already says.

    A struct of ``n_words``, ``n_removed``, ``kept_text`` (words in no factor, joined by one
    space) and ``factors`` (first and end word; touching ones are joined). One row per input
    row. Texts shorter than a window, empty and null ones keep all their words. Rows without an
    id are neither reference nor shortened; rows that repeat an id and a text get the same result. The
    id must be an integer. A column named ``repeats`` is replaced, other names are free.
    """
    documents = documents.drop("repeats")
    source = documents.select(quoted(key).cast("long").alias("doc"), quoted(text).cast("binary").alias("text")).where(
        "doc IS NOT NULL AND length(text) > 0"
    )
    hashed = source.select("doc", F.sha2("text", 256).alias("digest"))
    least = hashed.groupBy("digest").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    copies = (
        hashed.join(least.where("least < most"), "digest").where("doc > least").select("doc").distinct()
        .withColumn("copy", F.lit(True))
    )
    if copies.count() <= BROADCAST_COPIES:
        copies = F.broadcast(copies)
    originals = source.join(copies, "doc", "left").where("copy IS NULL").select("doc", "text")

    shared = (
        originals.mapInArrow(_seed_rows(window), _ROWS_SQL)
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_shared, _ROWS_SQL)
        .groupBy("doc").agg(F.collect_set("key").alias("seeds"))
    )
    spans = (
        originals.join(shared, "doc")
        .mapInArrow(_window_rows(window), _ROWS_SQL)
        .repartition("key").sortWithinPartitions("key", "doc")
        .mapInArrow(_covered, _ROWS_SQL)
        .groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("_spans"))
    )
    number, found, copied, body = (own_name(documents, n) for n in ("_doc", "_spans", "_copy", "_body"))
    joined = (
        documents.withColumn(number, quoted(key).cast("long"))
        .join(copies.select(F.col("doc").alias(number), F.col("copy").alias(copied)), number, "left")
        .join(spans.select(F.col("doc").alias(number), F.col("_spans").alias(found)), number, "left")
        .drop(number)
        .withColumn(body, quoted(text).cast("binary"))  # here, so that the joins move the text once
    )
    kind = (
        "struct<n_words: bigint, n_removed: bigint, kept_text: string,"
        " factors: array<struct<first: bigint, end: bigint>>>"
    )
    return with_arrow(joined, _kept(window, body, found, copied), [body, found, copied], "repeats", kind)
