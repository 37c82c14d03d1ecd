"""Near-duplicate documents by consistent weighted sampling.

A document is a bag of five-word shingles with TF-IDF weights. Improved consistent weighted sampling
draws shingles such that two documents draw the same one with a probability equal to their
weighted Jaccard similarity; bands of draws bring candidates together, and the similarity itself
is computed for every candidate pair that is compared. Document frequencies are exact in it: those of
common shingles are sent to every task, the others are joined to the candidates. Draws are made before that
join, with the weight of a shingle of one document for all that are not common.

A text is named by a digest of 128 bits, whatever its rows' keys, so rows that share a key by mistake
stay apart. Exact copies are folded first, so a group of copies costs one row per document. In a bucket every
document is compared with one pivot, the member that meets most others over all its buckets (the
text that a group's copies were made from meets more than any copy does); linked documents
form components. Documents of buckets that still have several components are then compared
across components, as far as prefix filtering over their rarest shingles allows the similarity, which
loses no pair. So every link between two texts of a bucket is found or both already are in one
component, without pairing up the members of a large group of copies.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted, quoted_name, slices, stored
from bundlelake.llm.grams import WordHashes, rolling, starts

SHINGLE, SIMILARITY = 5, 0.8
#: A pair at the threshold shares no band of draws with probability (1 - 0.8**6)**23 = 0.0009; one
#: of similarity 0.3, such as two texts with one passage in common, shares one with 0.017.
BANDS, DRAWS = 23, 6
#: Shingles in at least this share of all documents are sent to every task with their document
#: frequencies: at most the mean number of shingles of a document divided by the share.
COMMON_SHARE = 1 / 1024
#: Weight of a shingle: (1 + ln tf) * (1 + IDF_SHARE * idf / ln N). The share is small because
#: copies make their shingles frequent: with the full idf the few changed words of a copy would
#: outweigh the many that it shares with a large group.
IDF_SHARE = 0.25
SLICE_BYTES = 1 << 20
#: Words whose hashes a task remembers.
CACHE_WORDS = 100_000
#: A table of documents to drop up to this many rows (24 bytes each) is sent to every task.
BROADCAST_DROPPED = 1_000_000
_TABLE_BITS = 18
#: A text's name: half of its SHA-256.
_NAME = "substring(unhex(sha2(CAST({} AS BINARY), 256)), 1, 16)"


def shingles(texts: list[list[bytes]], hashes: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and their texts' numbers; a shorter text with words is one shingle."""
    return _shingled(*hashes.of(texts), texts.__getitem__, size)


def column_shingles(column: pa.Array, hashes: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`shingles`, for a column of binary texts."""
    return _shingled(*hashes.of_column(column), lambda k: column[k].as_py().split(), size)


def _shingled(values, bounds, words_of, size):
    at, owner = starts(bounds, size)
    keys = rolling(values, size)[at] if len(at) else np.zeros(0, np.uint64)
    lengths = np.diff(bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < size)).tolist()
    if short:
        more = [xxhash.xxh3_64_intdigest(b" ".join(words_of(k))) for k in short]
        keys, owner = np.r_[keys, np.array(more, np.uint64)], np.r_[owner, short]
    return keys, owner


def _bags(keys, owner):
    """Distinct (text, shingle) pairs with their counts, by text."""
    order = np.argsort(keys)
    # few texts: their numbers are sorted by radix
    numbers = owner.astype(np.uint16) if not len(owner) or owner.max() < 1 << 16 else owner
    order = order[np.argsort(numbers[order], kind="stable")]
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return keys[first], owner[first], np.diff(np.r_[first, len(keys)])


class Counts:
    """Document frequencies of some shingles."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The frequencies; 0 for other shingles."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by shingle, null first: the sums over 1, and that of the null rows."""
    names, documents = ["shingle", "n"], 0
    last, total = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the shingle that may go on, and its sum
    for batch in batches:
        nulls, n = batch.column("shingle").null_count, batch.column("n").to_numpy()
        documents += int(n[:nulls].sum())
        keys, n = np.r_[last, batch.column("shingle").slice(nulls).to_numpy()], np.r_[total, n[nulls:]]
        if not len(keys):
            continue
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        keys, n = keys[first], np.add.reduceat(n, first)
        last, total = keys[-1:], n[-1:]
        several = n[:-1] > 1
        yield pa.record_batch([pa.array(keys[:-1][several]), pa.array(n[:-1][several])], names=names)
    yield pa.record_batch([pa.array(last[total > 1]), pa.array(total[total > 1])], names=names)
    if documents:
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([documents], pa.int64())], names=names)


def frequencies(source: DataFrame) -> tuple[int, DataFrame]:
    """Number of documents with words, and ``shingle, n``: how many have it, for all that several have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, documents = WordHashes(CACHE_WORDS), 0
        for batch in slices(batches, "text", SLICE_BYTES):
            keys, owner, _ = _bags(*column_shingles(batch.column("text"), hashes))
            documents += len(np.unique(owner))
            keys, n = np.unique(keys, return_counts=True)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([documents], pa.int64())], names=["shingle", "n"])

    # almost every row is of a shingle of its own: sums in front of the shuffle would merge nothing
    counted = (
        source.select("text").mapInArrow(run, "shingle long, n long")
        .repartition("shingle").sortWithinPartitions("shingle").mapInArrow(_summed, "shingle long, n long")
    )
    counted = stored(counted, "frequencies")
    documents = counted.where("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    return documents, counted.where("shingle IS NOT NULL")


def idf_weights(documents: int, counts: np.ndarray, share: float = IDF_SHARE) -> np.ndarray:
    return 1 + share * np.log((1 + documents) / (1 + counts)) / np.log(2 + documents)


def _known(common) -> Counts:
    """Frequencies from a broadcast pair of arrays; executors need no copy of this module for that."""
    value = common.value
    return Counts(*value) if isinstance(value, tuple) else value


@functools.lru_cache(maxsize=1)
def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables of Gamma(2, 1), log Gamma(2, 1) and uniform variates, the same in every task."""
    rng, n = np.random.default_rng(20_240_229), 1 << _TABLE_BITS
    return (
        rng.gamma(2.0, 1.0, n).astype(np.float32),
        np.log(rng.gamma(2.0, 1.0, n)).astype(np.float32),
        rng.random(n).astype(np.float32),
    )


def _level(logs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The quantised log weight of the method, for the variates at these places of the tables."""
    r, _, beta = _variates()
    return np.floor(logs / r[at] + beta[at])


def _race(logs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What is least for the shingle drawn, as integers of the same order in the upper 32 bits."""
    r, log_gamma, beta = (values.take(at, mode="clip") for values in _variates())
    a = (log_gamma - r * (np.floor(logs / r + beta) - beta + np.float32(1))).view(np.int32)
    return np.where(a < 0, a ^ 0x7FFFFFFF, a).astype(np.int64) << 32


@functools.lru_cache(maxsize=4)
def _usual_race(log: np.float32) -> np.ndarray:
    return _race(log, np.arange(1 << _TABLE_BITS))


def draw(keys: np.ndarray, weights: np.ndarray, first: np.ndarray, times: int) -> np.ndarray:
    """Consistent weighted samples: for every text, ``times`` draws as 64-bit hashes.

    ``first`` holds where each text's shingles begin. A draw deals every shingle a place in the
    tables of variates. Most shingles have one weight, for which the outcome at each place is
    tabulated; the others are computed. Equal outcomes go to the first shingle of a text.
    """
    logs = np.log(weights).astype(np.float32)
    values, n = np.unique(logs, return_counts=True)
    usual = values[n.argmax()] if len(values) else np.float32(0)
    table, other = _usual_race(usual), np.flatnonzero(logs != usual)
    other_logs, place = logs[other], np.arange(len(keys))
    odd = np.random.default_rng(20_240_301).integers(0, 1 << 63, times, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((times, len(first)), np.uint64)
    spread, race = np.empty(len(keys), np.uint64), np.empty(len(keys), np.int64)
    dealt = spread.view(np.int64)
    for k in range(times):
        np.multiply(keys, odd[k], out=spread)
        np.right_shift(spread, np.uint64(64 - _TABLE_BITS), out=spread)
        table.take(dealt, out=race, mode="clip")  # no place is out of range
        race[other] = _race(other_logs, dealt[other])
        race += place
        at = np.minimum.reduceat(race, first) & 0xFFFFFFFF
        level = _level(logs[at], dealt[at]).astype(np.int64).view(np.uint64)
        out[k] = keys[at] + level * np.uint64(0xD6E8FEB86659FD93)
    return out


def _weights(counts, found, documents):
    return (1 + np.log(counts)) * idf_weights(documents, np.maximum(found, 1))


def _signatures(common, documents, bands, draws):
    """Draws by the weights that tasks know: a shingle that is not common counts as in one document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(CACHE_WORDS), _known(common)
        for batch in slices(batches, "text", SLICE_BYTES):
            keys, owner, counts = _bags(*column_shingles(batch.column("text"), hashes))
            if not len(keys):
                continue
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            real = owner[first]  # texts with words
            weights = _weights(counts, known.of(keys), documents)
            drawn = draw(keys, weights, first, bands * draws)
            names = np.empty((len(real), bands), np.uint64)
            for b in range(bands):
                name = np.full(len(real), b + 1, np.uint64)
                for d in range(draws):
                    name = (name ^ drawn[b * draws + d]) * np.uint64(0x9E3779B97F4A7C15)
                    name ^= name >> np.uint64(29)
                names[:, b] = name
            offsets = np.arange(0, len(real) * bands + 1, bands)
            yield pa.record_batch(
                [
                    *(batch.column(c).take(pa.array(real)) for c in ("row", "doc", "name")),
                    pa.array(np.add.reduceat(weights, first)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(names.reshape(-1).view(np.int64))),
                ],
                names=["row", "doc", "name", "weight", "buckets"],
            )

    return run


def _uncommon(common):
    """``doc, shingle`` for the shingles whose frequencies tasks do not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = WordHashes(CACHE_WORDS), _known(common)
        for batch in slices(batches, "text", SLICE_BYTES):
            keys, owner, _ = _bags(*column_shingles(batch.column("text"), hashes))
            open_ = known.of(keys) == 0
            docs = batch.column("doc").take(pa.array(owner[open_], pa.int64()))
            yield pa.record_batch([docs, pa.array(keys[open_].view(np.int64))], names=["doc", "shingle"])

    return run


def _features(common):
    """Every text's shingles as sorted 32-bit hashes, enough to tell them apart, with the numbers of
    documents and of places that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, low = WordHashes(CACHE_WORDS), _known(common), np.uint64(0xFFFFFFFF)
        for batch in slices(batches, "text", SLICE_BYTES):
            keys, owner, counts = _bags(*column_shingles(batch.column("text"), hashes))
            listed = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("shingles", "ns")]
            rest = Counts(listed[0].astype(np.int64).view(np.uint64), listed[1].astype(np.int64))
            found = np.maximum(np.maximum(known.of(keys), rest.of(keys)), 1)
            order = np.lexsort((keys & low, owner))
            keys, owner, counts, found = (keys & low)[order], owner[order], counts[order], found[order]
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])][: len(keys)])
            if len(first):
                counts, found = np.add.reduceat(counts, first), np.maximum.reduceat(found, first)
            rows = np.array([keys[first], found, counts]).astype(np.uint32)
            cuts = np.searchsorted(owner[first], np.arange(batch.num_rows + 1))
            bags = [rows[:, a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.record_batch([batch.column("doc"), pa.array(bags, pa.binary())], names=["doc", "bag"])

    return run


def _bag(data: bytes, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles, their weights and document frequencies."""
    keys, found, counts = np.frombuffer(data, np.uint32).reshape(3, -1)
    return keys, _weights(counts, found.astype(np.int64), documents), found


def bags(source: DataFrame, counted: DataFrame, common, least: int) -> DataFrame:
    """``doc, bag`` of texts with distinct keys; frequencies under ``least`` are joined by shuffling."""
    doc = f"doc {source.schema['doc'].dataType.simpleString()}"
    rest = (
        source.mapInArrow(_uncommon(common), f"{doc}, shingle long").join(counted.where(F.col("n") < least), "shingle")
        .groupBy("doc").agg(F.collect_list(F.struct("shingle", "n")).alias("rest"))
        .select("doc", F.col("rest.shingle").alias("shingles"), F.col("rest.n").alias("ns"))
    )
    return source.join(rest, "doc", "left").mapInArrow(_features(common), f"{doc}, bag binary")


def weighted_jaccard(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum())
    return least / (float(a[1].sum() + b[1].sum()) - least)


def _rare_shingles(features: DataFrame, documents: int, similarity: float) -> DataFrame:
    """``shingle, rep, component, weight, rest`` for each text's rarest shingles: prefix filtering.

    All texts order their shingles alike, rare ones first. If two texts are similar enough, the
    first shingle that they share comes before either has used up a share of ``1 - similarity`` of
    its weight, so only those are listed; ``rest`` is the weight from the shingle on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bag", SLICE_BYTES):
            kept, sizes, totals, rests = [], [], [], []
            for bag in batch.column("bag").to_pylist():
                keys, weights, found = _bag(bag, documents)
                order = np.lexsort((keys, found))
                keys, weights = keys[order], weights[order]
                before = np.cumsum(weights) - weights
                total = float(weights.sum())
                n = int(np.searchsorted(before, (1 - similarity + 1e-6) * total, "right"))
                kept.append(keys[:n].view(np.int32))
                sizes.append(n)
                totals.append(np.full(n, total))
                rests.append(total - before[:n])
            at = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(kept)), batch.column("doc").take(at), batch.column("component").take(at),
                    pa.array(np.concatenate(totals)), pa.array(np.concatenate(rests)),
                ],
                names=["shingle", "rep", "component", "weight", "rest"],
            )

    return features.mapInArrow(run, "shingle int, rep binary, component binary, weight double, rest double")


def _verified(pairs: DataFrame, features: DataFrame, documents: int, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in slices(batches, "bag_b", 4 * SLICE_BYTES):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            bags_a, bags_b = batch.column("bag_a"), batch.column("bag_b")
            keep = []
            for k in range(batch.num_rows):
                if a[k] != last:
                    last, left = a[k], _bag(bags_a[k].as_py(), documents)
                if weighted_jaccard(left, _bag(bags_b[k].as_py(), documents)) >= similarity:
                    keep.append(k)
            yield pa.record_batch([pa.array([side[k] for k in keep], pa.binary()) for side in (a, b)], names=["a", "b"])

    return (
        pairs.join(features.select(F.col("doc").alias("b"), F.col("bag").alias("bag_b")), "b")
        .join(features.select(F.col("doc").alias("a"), F.col("bag").alias("bag_a")), "a")
        .select("a", "b", "bag_a", "bag_b")
        .mapInArrow(run, "a binary, b binary")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of an undirected graph: its least node, for every node with an edge.

    Alternates large-star and small-star steps until nothing changes; each step is a grouped minimum
    and a join, and its result is written to the shared folder.
    """

    def state(frame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = state(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if (after := state(edges)) == before:
            break
        before = after
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def _near(a: Column, b: Column, similarity: float) -> Column:
    """What the similarity can be at most, by the total weights, reaches the threshold."""
    return F.least(a, b) >= (similarity - 1e-9) * F.greatest(a, b)


def _classes(documents: DataFrame, key: str, text: str, similarity: float, bands: int, draws: int) -> DataFrame:
    """``name, component, class_id`` for every text with words of a row with a key."""
    spark = documents.sparkSession
    source = documents.select(quoted(key).cast("long").alias("doc"), quoted(text).cast("binary").alias("text")).where(
        "doc IS NOT NULL AND length(text) > 0"
    )
    named = source.select(F.monotonically_increasing_id().alias("row"), "doc", F.expr(_NAME.format("text")).alias("name"), "text")
    n_documents, counted = frequencies(source)
    least_common = max(2, math.ceil(COMMON_SHARE * n_documents))
    many = counted.where(F.col("n") >= least_common).toArrow()
    common = spark.sparkContext.broadcast((many["shingle"].to_numpy().view(np.uint64), many["n"].to_numpy()))
    # a shingle that tasks do not know weighs at most this much less than they assume
    lowest, highest = idf_weights(n_documents, np.array([least_common - 1, 1]))
    like_weight = similarity * float(lowest / highest)
    columns = "row long, doc long, name binary, weight double, buckets array<bigint>"
    drawn = stored(named.mapInArrow(_signatures(common, n_documents, bands, draws), columns), "signatures")
    # one row a text: the least key of its rows, and the row whose draws stand for all
    texts = stored(drawn.groupBy("name").agg(F.min("doc").alias("least"), F.min("row").alias("row")), "texts")
    placed = drawn.join(texts.select("row"), "row", "left_semi").select(
        F.explode("buckets").alias("bucket"), F.col("name").alias("rep"), "weight"
    )
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(placed.join(sizes, "bucket"), "buckets")
    central = shared.groupBy("rep").agg(F.sum("n").alias("centre"))
    shared = shared.join(central, "rep")
    pivots = shared.groupBy("bucket").agg(F.max(F.struct("centre", "rep", "weight")).alias("pivot"))
    shared = stored(shared.join(pivots, "bucket").drop("n", "centre"), "pivots")
    met = shared.select(F.col("rep").alias("name")).distinct().join(texts.select("name", F.col("least").alias("doc")), "name")
    candidates = named.join(met, ["doc", "name"], "left_semi").dropDuplicates(["doc", "name"])
    candidates = stored(candidates.select(F.col("name").alias("doc"), "text"), "candidates")
    features = stored(bags(candidates, counted, common, least_common), "features")
    first = shared.where((F.col("rep") != F.col("pivot.rep")) & _near(F.col("weight"), F.col("pivot.weight"), like_weight)).select(
        F.col("pivot.rep").alias("a"), F.col("rep").alias("b")
    ).distinct()
    first = stored(first, "first-pairs")
    links = stored(_verified(first, features, n_documents, similarity), "links")
    found = components(links)

    grouped = shared.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    )
    grouped = stored(grouped, "grouped")
    several = grouped.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_ = grouped.join(several, "bucket", "left_semi").select(F.col("rep").alias("doc"), "component").distinct()
    rare = stored(_rare_shingles(features.join(open_, "doc"), n_documents, similarity), "rare")
    other = rare.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("rep", "component", "weight", "rest")])
    # with this shingle the first in common, the pair has the lesser rest in common at most
    common_rest = F.least("rest", "rest_b")
    second = (
        rare.join(other, "shingle")
        .where((F.col("rep") < F.col("rep_b")) & (F.col("component") != F.col("component_b")))
        .where(common_rest >= (similarity - 1e-6) * (F.col("weight") + F.col("weight_b") - common_rest))
        .select(F.col("rep").alias("a"), F.col("rep_b").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    links = links.unionAll(_verified(second, features, n_documents, similarity))
    found = stored(components(links).select(F.col("node").alias("name"), "component").join(texts.select("name", "least"), "name"), "components")
    least = found.groupBy("component").agg(F.min("least").alias("class_id"))
    linked = found.join(least, "component").select("name", "component", "class_id")
    return stored(
        texts.join(linked, "name", "left").select(
            "name", F.coalesce("component", "name").alias("component"), F.coalesce("class_id", "least").alias("class_id")
        ),
        "text-classes",
    )


def classes(
    documents: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    bands: int = BANDS, draws: int = DRAWS,
) -> DataFrame:
    """The near-duplicate class of every document: its key and ``class_id``, the class's least key.

    One row per input row. Documents with the same words are one class; so are documents linked by
    a chain of pairs of at least ``similarity``. A text of fewer than five words is one shingle;
    one without words, empty or null, is a class of its own, as is a row without a key
    (``class_id`` null). The key must be an integer; rows that share one and have unlike texts are
    classed each by its own text.
    """
    found = _classes(documents, key, text, similarity, bands, draws)
    rows = documents.select(quoted(key).alias("key"), F.expr(_NAME.format(quoted_name(text))).alias("name"))
    number = F.col("key").cast("long")
    return rows.join(found, "name", "left").select(
        F.col("key").alias(key), F.when(number.isNotNull(), F.coalesce("class_id", number)).alias("class_id")
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each near-duplicate class, that with the least key; columns stay.

    Rows without a key or without words stay. Of rows that repeat a key within a class one stays.
    """
    found = _classes(documents, key, text, SIMILARITY, BANDS, DRAWS)
    name, number, gone, group = (own_name(documents, n) for n in ("_name", "_key", "_gone", "_group"))
    rows = documents.withColumns({name: F.expr(_NAME.format(quoted_name(text))), number: quoted(key).cast("long")})
    classed = stored(
        rows.where(F.col(number).isNotNull()).select(F.col(name).alias("name"), F.col(number).alias("number"))
        .join(found, "name", "left"),
        "classes",
    )
    dropped = classed.where("number <> class_id").select(F.col("name").alias(name), F.col("number").alias(number)).distinct()
    if dropped.count() <= BROADCAST_DROPPED:
        dropped = F.broadcast(dropped)
    kept = rows.join(dropped, [name, number], "left_anti")
    if classed.groupBy("number", "component").count().where("count > 1").isEmpty():
        return kept.drop(name, number)
    alone = F.when(F.col(number).isNull(), F.monotonically_increasing_id())
    groups = found.select(F.col("name").alias(name), F.col("component").alias(group))
    once = kept.join(groups, name, "left").withColumn(gone, alone).dropDuplicates([number, group, gone])
    return once.select(*[quoted(c) for c in documents.columns])
