"""Conversation repair: a generalised LR parse of the roles with weighted edits.

The roles of a conversation are parsed by an LR(0) automaton of the role grammar. Where a row has
several continuations (keep it, give it another role, delete it, insert rows before it) the parse
follows all of them at once: a frontier holds every stack that the rows so far can lead to, stacks
share their lower parts, and equal stacks merge into the one with the least (cost, audit). Audits
are never compared as whole strings: after each row the stacks' audits have a rank, which the next
row's edits refine. Steps are remembered by frontier, so a row costs one lookup as a rule.

A conversation is one result with one digest over its whole text, so its rows stream through one
task in order; of a row that task holds one reference and no text. Ties of a turn are ordered by
role and text. Null turns come first, a null role or text is one space, a null id is a conversation
of its own. Conversations without rows have no result. Columns other than the four are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bundlelake.llm.common import stored

#: What a repaired conversation looks like: an optional system row, then pairs of user and
#: assistant. Left-recursive, so that stacks stay short.
GRAMMAR = {"S": ("", "T"), "T": ("sua", "ua", "Tua")}
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Initials of adjacent roles that are in order.
LEGAL = ("su", "ua", "au")
BLANKS = " \t\n\x0b\x0c\r"


class Automaton:
    """LR(0) states of a grammar whose first symbol is the start; stacks are (state, rest)."""

    def __init__(self, grammar: dict[str, tuple[str, ...]]):
        self.grammar, self.start = grammar, next(iter(grammar))
        first = self._closed({("", self.start, 0)})
        self.states, self.moves, todo = [first], [], [first]
        while todo:
            items = todo.pop(0)
            moves = {}
            for symbol in sorted({body[dot] for _, body, dot in items if dot < len(body)}):
                after = self._closed({(h, b, d + 1) for h, b, d in items if b[d : d + 1] == symbol})
                if after not in self.states:
                    self.states.append(after)
                    todo.append(after)
                moves[symbol] = self.states.index(after)
            self.moves.append(moves)
        self.complete = [
            sorted((h, len(b)) for h, b, d in items if d == len(b) and h) for items in self.states
        ]
        self.final = self.moves[0][self.start]

    def _closed(self, items: set) -> frozenset:
        found, todo = set(items), list(items)
        while todo:
            _, body, dot = todo.pop()
            for body_of in self.grammar.get(body[dot : dot + 1], ()):
                item = (body[dot], body_of, 0)
                if item not in found:
                    found.add(item)
                    todo.append(item)
        return frozenset(found)

    def reduced(self, stack: tuple) -> list[tuple]:
        """The stack and all that reductions make of it."""
        found, todo = [], [stack]
        while todo:
            stack = todo.pop()
            found.append(stack)
            for head, size in self.complete[stack[0]]:
                below = stack
                for _ in range(size):
                    below = below[1]
                if head in self.moves[below[0]]:
                    todo.append((self.moves[below[0]][head], below))
        return found

    def shifted(self, stack: tuple, symbol: str) -> list[tuple]:
        """Stacks after a terminal that can still take another or end."""
        state = self.moves[stack[0]].get(symbol)
        if state is None:
            return []
        return [
            s for s in self.reduced((state, stack)) if set(self.moves[s[0]]) - self.grammar.keys()
        ]

    def accepts(self, stack: tuple) -> bool:
        return any(s[0] == self.final for s in self.reduced(stack))


class Repair:
    """Cheapest edits of a row of role codes.

    A code is the initial of a role and a fault: ``-`` none, ``t`` truncated, ``x`` to be deleted.
    An edit is written as the initials of rows inserted before, then ``K``, ``D`` or ``R`` with
    the new initial.
    """

    def __init__(self, grammar: dict[str, tuple[str, ...]] = GRAMMAR):
        self.automaton = Automaton(grammar)
        self.first = (((0, None), 0, 0),)
        self.step = functools.lru_cache(maxsize=200_000)(self._step)
        self.close = functools.lru_cache(maxsize=200_000)(self._close)

    def _with_inserts(self, frontier: tuple) -> dict:
        """Per stack the least (cost, rank of the audit before, inserted initials, place in the frontier)."""
        found = {s: (cost, rank, "", k) for k, (s, cost, rank) in enumerate(frontier)}
        todo = list(found.items())
        while todo:
            later = {}
            for stack, (cost, rank, inserted, k) in todo:
                for symbol in ROLES:
                    label = (cost + INSERT, rank, inserted + symbol, k)
                    for after in self.automaton.shifted(stack, symbol):
                        known = found.get(after)
                        if known is None or _order(label) < _order(known):
                            found[after] = later[after] = label
            todo = list(later.items())
        return found

    def _step(self, frontier: tuple, code: str) -> tuple:
        """The frontier after a row, what it costs at least, and per stack (stack before, edit)."""
        initial, fault = code
        late = TRUNCATED if fault == "t" else 0
        edits = [("D", DELETE, None)]
        if fault != "x":
            edits.append(("K", KEEP + late, initial))
            edits += [(f"R{symbol}", REROLE + late, symbol) for symbol in ROLES]
        best = {}
        for stack, (cost, rank, inserted, k) in self._with_inserts(frontier).items():
            for edit, price, symbol in edits:
                audit = "I" * len(inserted) + edit[0]
                label = (cost + price, rank, audit, k, inserted + edit)
                for after in [stack] if symbol is None else self.automaton.shifted(stack, symbol):
                    if after not in best or label < best[after]:
                        best[after] = label
        ranks = {key: r for r, key in enumerate(sorted({(x[1], x[2]) for x in best.values()}))}
        least = min(x[0] for x in best.values())
        stacks = sorted(best, key=_depth_first)
        after = tuple((s, best[s][0] - least, ranks[best[s][1], best[s][2]]) for s in stacks)
        return after, least, tuple((best[s][3], best[s][4]) for s in stacks)

    def _close(self, frontier: tuple) -> tuple:
        """Cost, initials to insert at the end, and the place of the stack that ends best."""
        ends = [
            label for s, label in self._with_inserts(frontier).items() if self.automaton.accepts(s)
        ]
        cost, _, inserted, k = min(ends, key=_order)
        return cost, inserted, k

    def edits(self, codes: list[str]) -> tuple[int, list[str]]:
        """Cost and the edit of each row, and the initials to insert after the last."""
        frontier, total, back = self.first, 0, []
        for code in codes:
            frontier, cost, links = self.step(frontier, code)
            total += cost
            back.append(links)
        cost, tail, k = self.close(frontier)
        found = [tail]
        for links in reversed(back):
            k, edit = links[k]
            found.append(edit)
        found.reverse()
        return total + cost, found


def _order(label: tuple) -> tuple:
    return label[0], label[1], len(label[2]), label[2]


def _depth_first(stack: tuple | None) -> list[int]:
    states = []
    while stack:
        states.append(stack[0])
        stack = stack[1]
    return states[::-1]


@functools.lru_cache(maxsize=1)
def _repair() -> Repair:
    return Repair()


def audit_of(edits: list[str]) -> str:
    """Initials of the edits in order: I, D, K and R."""
    parts = (re.fullmatch("([ua]*)([DKR]?).?", e) for e in edits)
    return "".join("I" * len(p[1]) + p[2] for p in parts)


def key_of(conv_id: str) -> Column:
    """A text that stands for an id, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation, numbered in order; ``key`` is never null."""
    blank = F.lit(" ")
    # a repartition of its own: all windows below and the join keep these partitions
    dealt = rows.select(
        key_of("conv_id").alias("key"),
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    ).repartition("key")
    place = Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return dealt.withColumn("pos", F.row_number().over(place))


def _codes(ordered: DataFrame) -> DataFrame:
    """Initial and first fault of every row."""
    copies = Window.partitionBy("key", "role", "text").orderBy("pos")
    trimmed = F.trim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    fault = (
        F.when(trimmed == "", "b")
        .when(F.row_number().over(copies) > 1, "d")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "t")
        .otherwise("-")
    )
    return ordered.select(
        "key", "conv_id", "pos", "turn",
        F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), fault).alias("code"),
    )


def verdicts(rows: DataFrame) -> DataFrame:
    """Faults, cost and edits of every conversation of ``conv_id, turn, role, text``.

    ``edits`` has an entry for each row in order and one for what follows the last; ``key`` stands
    for the id and is never null.
    """
    codes = _codes(_ordered(rows)).sortWithinPartitions("key", "pos")
    kind = codes.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, key, conv, id_type = [], [], None, None, None
        turns = []  # least, largest and number of different turns so far
        for batch in batches:
            id_type = batch.column(1).type
            for row in zip(*[batch.column(k).to_pylist() for k in (0, 1, 3, 4)], strict=True):
                if row[0] != key:
                    if key is not None:
                        made.append(_verdict(key, conv, turns, held))
                    key, conv, turns, held = row[0], row[1], [], []
                if row[2] is not None:
                    if not turns:
                        turns = [row[2], row[2], 1]
                    elif row[2] != turns[1]:
                        turns = [turns[0], row[2], turns[2] + 1]
                held.append(row[3])
            if len(made) >= 10_000:
                yield _verdict_batch(made, id_type)
                made = []
        if key is not None:
            made.append(_verdict(key, conv, turns, held))
        if made:
            yield _verdict_batch(made, id_type)

    return codes.mapInArrow(
        run,
        f"key string, conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, "
        "cost long, audit string, edits array<string>",
    )


#: How the parse sees a fault: what is blank or repeated must go.
_SEEN = {"b": "x", "d": "x", "t": "t", "-": "-"}


def _verdict(key: str, conv, turns: list[int], codes: list[str]) -> tuple:
    cost, edits = _repair().edits([c[0] + _SEEN[c[1]] for c in codes])
    faults = [c[1] for c in codes]
    pairs = sum(a[0] + b[0] not in LEGAL for a, b in zip(codes[:-1], codes[1:], strict=True))
    gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
    return (
        key, conv, gaps, faults.count("b"), faults.count("d"), faults.count("t"), pairs, cost, audit_of(edits), edits
    )


def _verdict_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.string(), id_type, *[pa.int64()] * 6, pa.string(), pa.list_(pa.string())]
    names = ["key", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "edits"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _lines(roles: Column) -> Column:
    """Rows with empty texts for the initials of inserted roles."""
    named = F.transform(
        F.split(roles, ""), lambda r: F.when(r == "u", ROLES["u"]).otherwise(ROLES["a"])
    )
    return F.when(roles == "", F.array().cast("array<struct<role:string,text:string>>")).otherwise(
        F.transform(named, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    )


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows after the edits of :func:`verdicts`: ``key, conv_id, pos, step, role, text``.

    ``pos`` and ``step`` give the order in a conversation.
    """
    edit = F.get("edits", F.col("pos") - 1)
    joined = _ordered(rows).join(found.select("key", "edits"), "key").select(
        "key", "conv_id", "pos", "role", "text",
        F.regexp_extract(edit, "^[ua]*", 0).alias("before"),
        F.regexp_extract(edit, "[KDR].?$", 0).alias("edit"),
        F.when(F.col("pos") == F.size("edits") - 1, F.get("edits", F.col("pos"))).otherwise("").alias("after"),
    )
    own = F.struct(
        F.when(F.col("edit") == "Ru", ROLES["u"]).when(F.col("edit") == "Ra", ROLES["a"])
        .otherwise(F.col("role")).alias("role"),
        F.col("text"),
    )
    kept = F.when(F.col("edit") == "D", F.array().cast("array<struct<role:string,text:string>>"))
    lines = F.concat(_lines(F.col("before")), kept.otherwise(F.array(own)), _lines(F.col("after")))
    return joined.select("key", "conv_id", "pos", F.posexplode(lines).alias("step", "line")).select(
        "key", "conv_id", "pos", "step", "line.role", "line.text"
    )


def digests(lines: DataFrame) -> DataFrame:
    """``key, sha256`` of every conversation's ``role:text`` lines, streamed in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, made = None, None, []
        for batch in batches:
            for nth, k, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if nth == 1:
                    if key is not None:
                        made.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if len(made) >= 10_000:
                yield _digest_batch(made)
                made = []
        if key is not None:
            made.append((key, state.hexdigest()))
        if made:
            yield _digest_batch(made)

    # numbered by a window: it deals out and sorts only what does not lie so already
    place = Window.partitionBy("key").orderBy("pos", "step")
    ordered = lines.select(F.row_number().over(place).alias("nth"), "key", "role", "text")
    return ordered.mapInArrow(run, "key string, sha256 string")


def _digest_batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    keys, values = zip(*rows, strict=True)
    return pa.record_batch([pa.array(keys, pa.string()), pa.array(values, pa.string())], names=["key", "sha256"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verdicts, written once to the shared folder, and the repaired rows."""
    found = stored(verdicts(rows), "conversation-verdicts")
    return found, repaired(rows, found)
