"""Groups of spelling variants: words one edit apart, found in a frequency-vector trie.

A word is described by how often each letter group occurs in it. Words one edit apart differ by at
most one in at most two of these counts: one surplus, one deficit. The trie arranges words by
their length and the counts of one group after the other. Its top levels are dealt out: a word is
stored under the path of its length and first counts, and asks at the paths that a surplus and a
deficit of one reach. Below, every task arranges the words of a path by the other groups and
searches depth first, many asking words in step, each with what is left of its budget. Words at the
leaves are compared letter by letter.

Each near pair is met at one path and by one of its words: the longer asks, and of equal lengths
the one whose step to the other takes from a group before it gives to a later one (in the same
path, the smaller word). A path with more than ``BLOCK`` words is split into blocks, and all that
ask there ask in every block.

Null texts have no words; a null doc_id counts as empty text. Repeated rows count as often as they
occur. Extra columns are ignored. Words are compared by code points; very long runs are words too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import let, stored

#: Letter groups, one trie level each; letters in none of them make the last level.
GROUPS = ("e", "n", "a", "t", "i", "o", "r", "h", "s", "u", "l", "c", "d", "bfp", "gjkq", "mvw", "xyz")
#: Levels that are dealt out to tasks.
TOP = 4
#: Words of one path that a task holds, asking words searched in step, and words of a leaf.
BLOCK, ASKING, LEAF = 50_000, 4_096, 8
#: Candidate pairs compared at a time, in letters.
PAIR_LETTERS = 4_000_000
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10


def count_words(documents: DataFrame) -> DataFrame:
    """``word, n``: letter runs of all texts after their fixed misspelling, counted.

    A run is lower-cased from A to Z; where the CRC-32 of ``<doc_id>:<run>`` divides by 31, the
    letter at that number modulo the run's length is left out. Words have ``MIN_LENGTH`` letters
    and ``MIN_COUNT`` occurrences at least.
    """
    pattern = rf"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}+"  # the longest run: no backing off
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run"),
    )
    lower = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = runs.select(
        lower.alias("run"), F.crc32(F.concat("doc", F.lit(":"), lower).cast("binary")).alias("h")
    )
    gone = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 31 != 0, F.col("run")).otherwise(
        F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    )
    counted = hashed.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH)
    return counted.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _count(word: str, letters: str) -> Column:
    return F.length(word) - F.length(F.translate(word, letters, ""))


def _path(length: Column, counts: list[Column]) -> Column:
    return F.concat_ws(",", length.cast("string"), *[c.cast("string") for c in counts])


def _moved(counts: list[Column], less: int | None, more: int | None) -> list[Column]:
    return [c - int(g == less) + int(g == more) for g, c in enumerate(counts)]


def _routes(words: DataFrame) -> DataFrame:
    """``path, role, word, n``: where each word is stored (0) and asks.

    It asks for others of its own path (1), for words of its length (2) and for shorter ones (3).
    """
    counted = words.select(
        "word", "n", F.length("word").alias("size"),
        *[_count("word", GROUPS[g]).alias(f"c{g}") for g in range(TOP)],
    )
    size, counts = F.col("size"), [F.col(f"c{g}") for g in range(TOP)]

    def route(role: int, length: Column, less: int | None = None, more: int | None = None) -> Column:
        to = F.struct(_path(length, _moved(counts, less, more)).alias("path"), F.lit(role).alias("role"))
        return to if less is None else F.when(counts[less] > 0, to)

    own = [route(0, size), route(1, size)]
    one_shorter = [route(3, size - 1, less) for less in (None, *range(TOP))]
    replaced = [route(2, size, less) for less in range(TOP)]
    moved = [route(2, size, less, more) for less in range(TOP) for more in range(less + 1, TOP)]
    routes = F.array_compact(F.array(*own, *one_shorter, *replaced, *moved))
    return counted.select("word", "n", F.explode(routes).alias("to")).select("to.path", "to.role", "word", "n")


def _dealt(words: DataFrame) -> DataFrame:
    """Routes with the block of the path: full paths are split, and what asks there is repeated."""
    routes = _routes(words)
    full = (
        words.groupBy(_path(F.length("word"), [_count("word", GROUPS[g]) for g in range(TOP)]).alias("path"))
        .agg(F.count("*").alias("stored"))
        .where(F.col("stored") > BLOCK)
        .select("path", F.ceil(F.col("stored") / BLOCK).cast("int").alias("blocks"))
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.array(F.pmod(F.xxhash64("word"), blocks).cast("int"))
    return (
        routes.join(full, "path", "left")
        .withColumn("block", F.explode(F.when(F.col("role") == 0, own).otherwise(F.sequence(F.lit(0), blocks - 1))))
        .select("path", "block", "role", "word", "n")
    )


def _table() -> np.ndarray:
    """Letter group of every code point below 256."""
    groups = np.full(256, len(GROUPS), np.int64)
    for g, letters in enumerate(GROUPS):
        groups[[ord(c) for c in letters]] = g
    return groups


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    size = len(words[0])
    points = np.array(words, f"U{size}").view(np.uint32).reshape(len(words), size)
    return points.astype(np.uint8) if points.max() < 256 else points


def vectors_of(points: np.ndarray) -> np.ndarray:
    """How often each letter group occurs in each word."""
    n, width = len(points), len(GROUPS) + 1
    groups = _table()[np.minimum(points, 255)]
    groups[points > 255] = len(GROUPS)
    flat = (groups + np.arange(n)[:, None] * width).ravel()
    return np.bincount(flat, minlength=n * width).reshape(n, width).astype(np.int32)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` are one edit from those of ``b``, of the same length or one letter shorter."""
    size = b.shape[1]
    if a.shape[1] == size:
        return (a != b).sum(1) == 1
    ahead, behind = a[:, :size] != b, a[:, 1:] != b
    first = np.where(ahead.any(1), ahead.argmax(1), size)
    last = np.where(behind.any(1), size - 1 - behind[:, ::-1].argmax(1), -1)
    return last < first


class Trie:
    """Words of one path, arranged by the counts of the groups below the top levels."""

    def __init__(self, words: list[str], counts: list[int]):
        points = letters_of(words)
        vectors = vectors_of(points)
        order = np.lexsort(vectors[:, :TOP - 1:-1].T)
        self.points, self.vectors = points[order], vectors[order]
        self.words, self.counts = [words[k] for k in order], np.array(counts, np.int64)[order]

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of an asking word and a stored one whose vectors the budget bridges."""
        own = self.vectors[0, :TOP] - vectors[:, :TOP]
        surplus, deficit = np.maximum(own, 0).sum(1), np.maximum(-own, 0).sum(1)
        asking = np.flatnonzero((surplus <= 1) & (deficit <= 1))
        todo = [(TOP, 0, len(self.words), asking, surplus[asking], deficit[asking])]
        levels = self.vectors.shape[1]
        while todo:
            level, first, end, asking, surplus, deficit = todo.pop()
            if not len(asking):
                continue
            if level == levels:
                yield np.repeat(asking, end - first), np.tile(np.arange(first, end), len(asking))
                continue
            if end - first <= LEAF:
                step = self.vectors[first:end, level:][None] - vectors[asking, level:][:, None]
                fits = (np.maximum(step, 0).sum(2) + surplus[:, None] <= 1) & (
                    np.maximum(-step, 0).sum(2) + deficit[:, None] <= 1
                )
                a, b = np.nonzero(fits)
                yield asking[a], b + first
                continue
            column, wanted = self.vectors[first:end, level], vectors[asking, level]
            cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), end - first]
            for k, cut in enumerate(cuts[:-1]):
                step = column[cut] - wanted
                more, less = surplus + (step == 1), deficit + (step == -1)
                ok = np.flatnonzero((np.abs(step) <= 1) & (more <= 1) & (less <= 1))
                todo.append((level + 1, first + cut, first + cuts[k + 1], asking[ok], more[ok], less[ok]))

    def pairs(self, words: list[str], inside: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs of asking and stored words; ``inside`` the path the smaller word asks."""
        points = letters_of(words)
        for first in range(0, len(words), ASKING):
            part = points[first : first + ASKING]
            held, letters = [], 0
            for asked, found in self.search(vectors_of(part)):
                held.append((asked, found))
                letters += len(asked) * part.shape[1]
                if letters >= PAIR_LETTERS:
                    yield self._verified(words, part, first, held, inside)
                    held, letters = [], 0
            if held:
                yield self._verified(words, part, first, held, inside)

    def _verified(self, words, part, first, held, inside) -> tuple[np.ndarray, np.ndarray]:
        asked, found = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        step = max(1, PAIR_LETTERS // part.shape[1])
        good = [np.zeros(0, bool)]
        for k in range(0, len(asked), step):
            good.append(near(part[asked[k : k + step]], self.points[found[k : k + step]]))
        ok = np.flatnonzero(np.concatenate(good))
        asked, found = asked[ok] + first, found[ok]
        if inside:
            smaller = np.array([words[a] < self.words[b] for a, b in zip(asked.tolist(), found.tolist())], bool)
            asked, found = asked[smaller], found[smaller]
        return asked, found


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str], list[int]]]:
    """Rows of one path, block and role at a time; stored words whole, asking ones in batches."""
    label, words, counts = None, [], []
    for batch in batches:
        paths, blocks, roles, all_words, all_counts = (c.to_pylist() for c in batch.columns)
        labels = list(zip(paths, blocks, roles, strict=True))
        start = 0
        while start < len(labels):
            end = start + 1
            while end < len(labels) and labels[end] == labels[start]:
                end += 1
            if labels[start] != label:
                if words:
                    yield label, words, counts
                label, words, counts = labels[start], [], []
            words += all_words[start:end]
            counts += all_counts[start:end]
            if label[2] and len(words) >= ASKING:
                yield label, words, counts
                words, counts = [], []
            start = end
    if words:
        yield label, words, counts


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once. ``words`` has ``word, n``, a row a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, place = None, None
        for (path, block, role), asking, counts in _runs(batches):
            if role == 0:
                trie, place = Trie(asking, counts), (path, block)
                continue
            if place != (path, block):
                continue  # nothing is stored here
            numbers = np.array(counts, np.int64)
            for a, b in trie.pairs(asking, role == 1):
                if len(a):
                    yield pa.record_batch(
                        [
                            pa.array([asking[k] for k in a.tolist()]), pa.array(numbers[a]),
                            pa.array([trie.words[k] for k in b.tolist()]), pa.array(trie.counts[b]),
                        ],
                        names=["a", "a_n", "b", "b_n"],
                    )

    dealt = _dealt(words).repartition("path", "block").sortWithinPartitions("path", "block", "role")
    return dealt.mapInArrow(run, "a string, a_n long, b string, b_n long")


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word.

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (of equal ones the
    first by code points) if it occurs at least ``times`` as often; ``root`` follows forms to the last.
    """
    if times <= 1:
        raise ValueError("a form must occur more often than its word")
    words = stored(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    both = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
            )
        ).alias("pair")
    ).select("pair.*")
    better = F.when(
        F.col("other_n") >= times * F.col("n"), F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))
    )
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(better).alias("best"))
    formed = stored(
        words.join(found, "word", "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.col("best.word").alias("form"),
            (-F.col("best.n")).alias("form_n"),
        ),
        "variants",
    )
    return formed.join(_roots(formed), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form.

    Each round follows the forms of what is not yet at its root once more. A form occurs ``times`` as
    often as its word, so the rounds are the decimal places of the largest count at most.
    """
    links = formed.where("form IS NOT NULL").select("word", "form")
    steps = links.select(F.col("word").alias("at"), F.col("form").alias("next"))
    open_, done = links.select("word", F.col("form").alias("root")), None
    while True:
        moved = stored(
            open_.join(steps, F.col("root") == F.col("at"), "left").select("word", F.col("root"), "next"), "roots"
        )
        ended = moved.where("next IS NULL").select("word", "root")
        done = ended if done is None else done.unionByName(ended)
        open_ = moved.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
        if open_.isEmpty():
            return done
