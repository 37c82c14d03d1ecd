"""Mixing sources to target weights by pivotal rounding.

A source's documents all get the same expected number of copies, its target over its size. The
whole part is taken as is; the fractional parts are rounded by pairs: of two documents with
fractional copies, word mass moves at random from one to the other, fairly, until one has a whole
number of copies. The words taken so far never change, so each source ends within one document of
its target. Documents are rounded in blocks of bounded size, a fold over an array each; what
is left of a block is one fractional document at most, and the remainders are combined
the same way, level by level, until one is left per source. Only built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from bundlelake.llm.common import count_words, let, quoted, stored

#: Weights of the sources in order, repeating, and the mix's size as a share of all sizes.
WEIGHTS, SHARE = (3, 1, 2), 1.5
#: No document is taken more often than this.
MAX_COPIES = 2.0
#: Documents a block holds on average.
BLOCK = 256
SEED = 7
#: Source tables up to this many rows are sent to every task; larger ones are shuffled.
BROADCAST_SOURCES = 100_000


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES) -> DataFrame:
    """Add ``target`` to rows of ``source, source_size``, one per source.

    Sources are ordered by code point, null last, and weighted by ``weights`` in turn. They share
    ``share`` times all sizes by weight; a target stops at ``most`` times its source's size, and
    the excess is shared by weight among the others until none is above. A source of size 0
    has target 0. One row per source is all that meets in one task.
    """
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = sizes.select(
        *sizes.columns, place.alias("place"), weight.alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("cap"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("total"),
    )
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # a word share per weight if all sources with less room than this one are at their limit
    rate = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rated = ranked.withColumn("rate", rate).withColumn("full", F.col("cap") <= F.col("rate") * F.col("weight"))
    level = F.min_by(F.when(~F.col("full"), F.col("rate")), F.when(~F.col("full"), F.col("cap") / F.col("weight"))).over(every)
    target = F.when(F.col("full") | level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return rated.select(*sizes.columns, target.alias("target"))


def _draw(*of: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the arguments."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 53)) / F.lit(float(1 << 53))


_ITEM = "struct<size: bigint, doc: bigint, twin: int, part: double>"


def _fold(items: Column, level: int) -> Column:
    """Round an array of documents to those that get one more copy and one remainder at most.

    ``part`` is the fractional number of copies, strictly between 0 and 1; sizes are positive.
    """
    none, nothing = F.lit(None).cast(_ITEM), F.array().cast(f"array<{_ITEM}>")

    def with_part(one, part):
        return F.struct(one["size"].alias("size"), one["doc"].alias("doc"), one["twin"].alias("twin"), part.alias("part"))

    def pair(old, new):
        # words the older can gain from the newer, and words it can give to it
        up = F.least((1 - old["part"]) * old["size"], new["part"] * new["size"])
        down = F.least(old["part"] * old["size"], (1 - new["part"]) * new["size"])
        gains = _draw(F.lit(SEED), F.lit(level), *[x[c] for x in (old, new) for c in ("doc", "twin")]) * (up + down) < down
        return let(
            F.struct(gains.alias("gains"), up.alias("up"), down.alias("down")), lambda c: shares(old, new, c)
        )

    def shares(old, new, c):
        moved = F.when(c["gains"], c["up"]).otherwise(-c["down"])
        old_done = F.when(c["gains"], (1 - old["part"]) * old["size"] <= c["up"]).otherwise(
            old["part"] * old["size"] <= c["down"]
        )
        old_part = F.when(old_done, F.when(c["gains"], 1.0).otherwise(0.0)).otherwise(old["part"] + moved / old["size"])
        new_part = F.when(~old_done, F.when(c["gains"], 0.0).otherwise(1.0)).otherwise(new["part"] - moved / new["size"])
        return F.array(with_part(old, old_part), with_part(new, new_part))

    def step(state, new):
        def decided(both):
            return F.struct(
                F.concat(state["taken"], F.filter(both, lambda x: x["part"] >= 1.0)).alias("taken"),
                F.get(F.filter(both, lambda x: (x["part"] > 0.0) & (x["part"] < 1.0)), 0).alias("rest"),
            )

        return F.when(
            state["rest"].isNull(), F.struct(state["taken"].alias("taken"), new.alias("rest"))
        ).otherwise(let(pair(state["rest"], new), decided))

    return F.aggregate(items, F.struct(nothing.alias("taken"), none.alias("rest")), step)


def plan(
    documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
) -> DataFrame:
    """How often each document is taken into the mix.

    One row per input row: ``doc, twin`` (the key, or a hash of the content where it is null, and a
    number among rows with that key), ``key``, ``size`` (words; 0 for null and empty texts),
    ``source_size``, ``target`` and ``copies``. A row of size 0 adds no words; its copies are
    drawn by itself. The result depends on the rows alone, not on their order or partitions.
    """
    narrow = documents.select(
        quoted(key).alias("key"), quoted(source).cast("string").alias("source"), count_words(quoted(text)).alias("size"),
        F.xxhash64(quoted(text), quoted(source)).alias("content"),
    ).withColumn("doc", F.coalesce(F.col("key").cast("long"), "content"))
    twin = F.row_number().over(Window.partitionBy("doc").orderBy("content"))
    rows = stored(narrow.withColumn("twin", twin).drop("content"), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    sources = stored(targets(sizes, weights, share), "mix-targets")
    listed = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    listed = listed.withColumnRenamed("source", "of")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = rows.join(listed, F.col("source").eqNullSafe(F.col("of"))).withColumns(
        {"whole": F.floor(rate).cast("long"), "part": rate - F.floor(rate)}
    )
    blocks = F.ceil(F.col("documents") / BLOCK).cast("long")
    open_ = base.where("size > 0 AND part > 0").select(
        "source", F.pmod(F.xxhash64("doc", "twin", F.lit(SEED)), blocks).alias("block"),
        F.struct("size", "doc", "twin", "part").alias("item"),
    )
    chosen, level = [], 0
    while True:
        folded = stored(
            open_.groupBy("source", "block")
            .agg(F.sort_array(F.collect_list("item"), asc=False).alias("items"))
            .select("source", "block", _fold(F.col("items"), level).alias("done")),
            f"mix-level-{level}",
        )
        chosen.append(folded.select(F.explode("done.taken").alias("item")))
        rest = folded.where("done.rest IS NOT NULL").select(
            "source", F.floor(F.col("block") / BLOCK).alias("block"), F.col("done.rest").alias("item")
        )
        if folded.agg(F.max("block")).first()[0] in (None, 0):
            break
        open_, level = rest, level + 1
    last = rest.select("item").where(_draw(F.lit(SEED), F.lit(-1), F.col("item.doc"), F.col("item.twin")) < F.col("item.part"))
    more = reduce(DataFrame.unionAll, [*chosen, last]).select("item.doc", "item.twin", F.lit(1).alias("more"))
    empty = F.when(
        (F.col("size") == 0) & (_draw(F.lit(SEED), F.lit(-2), F.col("doc"), F.col("twin")) < F.col("part")), 1
    ).otherwise(0)
    return base.join(more, ["doc", "twin"], "left").select(
        "doc", "twin", "key", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("more", empty)).cast("long").alias("copies"),
    )


def mix(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every document as often as its plan says, in the input's columns."""
    copies = plan(documents, key, text, source).select(
        F.col("doc").alias("_doc"), F.col("twin").alias("_twin"), "copies"
    ).where("copies > 0")
    body = F.struct(*[quoted(c) for c in documents.columns]).alias("_row")
    content = F.xxhash64(quoted(text), quoted(source))
    # rows alike in text and source are numbered by their other columns, so that reruns agree
    other = F.xxhash64(*[quoted(f.name) for f in documents.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    rows = documents.select(
        body, F.coalesce(quoted(key).cast("long"), content).alias("_doc"), content.alias("_content"), other.alias("_other")
    )
    twin = F.row_number().over(Window.partitionBy("_doc").orderBy("_content", "_other"))
    return (
        rows.withColumn("_twin", twin)
        .join(copies, ["_doc", "_twin"])
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_n"))
        .select("_row.*")
    )
