"""Spelling variants, byte-level BPE and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bundlelake.llm import byte_bpe, conversations, oracle, queries, variants

DATA = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


# Spelling variants


def brute_words(rows):
    counts = Counter()
    capitals = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(capitals)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))


def brute_variants(counts):
    """By trying every edit of a pattern with one hole."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            holes[w[:k], w[k + 1 :]].add(w)
            if (s := w[:k] + w[k + 1 :]) in counts:
                near[w].add(s)
                near[s].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 10 * counts[w]:
            form[w] = best
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), counts.get(form.get(w)))
    return out


def variant_rows(found):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect()}


def test_variants_of_the_corpus(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert variant_rows(queries.op11_spelling_variants(spark, DATA)) == brute_variants(brute_words(rows))


@pytest.mark.parametrize("block,leaf", [(50_000, 8), (7, 1)])
def test_variants_of_chosen_words(spark, monkeypatch, block, leaf):
    """Chains of forms, ties, letters outside the groups, very long words, full paths."""
    monkeypatch.setattr(variants, "BLOCK", block)
    monkeypatch.setattr(variants, "LEAF", leaf)
    pick = random.Random(5)
    counts = {"chainab": 3, "chainabc": 40, "chainabcd": 500, "chainabcde": 9000}
    counts |= {"tieword": 2, "tiewora": 30, "tieworb": 30, "tieworé": 30}
    counts |= {"ÿäöüßÀÿ": 2, "ÿäöüßÁÿ": 25, "漢字漢字漢字漢": 4, "漢字漢字漢字漣": 60}
    counts |= {"long" * 900: 2, "long" * 900 + "x": 77, "aaaaaaaa": 5, "aaaaaaa": 500}
    base = "abcdefg"
    for _ in range(400):  # many words on one path
        letters = list(base)
        pick.shuffle(letters)
        counts.setdefault("".join(letters), pick.choice([2, 3, 30, 400]))
    for w in list(counts)[:200]:
        k = pick.randrange(len(w))
        counts.setdefault(w[:k] + pick.choice(["", "e", "zz"[:1], w[k] + "n"]) + w[k + 1 :], pick.randrange(2, 900))
    words = spark.createDataFrame(list(counts.items()), "word string, n long").withColumn("path", F.lit(1))
    assert variant_rows(variants.group_variants(words)) == brute_variants(counts)


@settings(max_examples=200, deadline=None)
@given(st.text("abé", min_size=1, max_size=7), st.text("abé", min_size=1, max_size=7))
def test_one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) < 2:
        got = variants.near(variants.letters_of([a]), variants.letters_of([b]))[0]
        assert got == one_edit(a, b)


def test_words_with_nulls_and_no_rows(spark):
    rows = [(1, None), (2, ""), (None, "anything ANYTHING"), (3, "sevenle sevenle ab" + "x" * 20_000), (3, "x" * 20_000)]
    clash = frame(spark, rows).withColumn("word", F.lit("w")).withColumn("n", F.lit(0)).withColumn("a.b", F.lit(0))
    got = {r["word"]: r["n"] for r in variants.count_words(clash).collect()}
    expected = brute_words([("" if d is None else d, t) for d, t in rows])
    assert got == expected and expected
    empty = variants.group_variants(variants.count_words(frame(spark, [])))
    assert empty.count() == 0
    assert variants.group_variants(variants.count_words(frame(spark, [(1, None)]))).count() == 0
    with pytest.raises(ValueError):
        variants.group_variants(variants.count_words(frame(spark, [])), times=1)


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(VOCABULARY)
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_of_the_corpus(spark, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op12_byte_bpe(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_ids_of_odd_texts(spark, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "HELD_PIECES", 3000)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)  # generations turn over within a slice
    byte_bpe._pieces.cache_clear()
    pick = random.Random(3)
    texts = [None, "", " ", "\n\n  a", "it's we'll", "a" * 5000, "漢" * 4000, " " * 3500, "\x00\x1c é🙂", "<|endoftext|>"]
    texts += ["".join(pick.choice(" aàb\n\t 'sÅé漢🙂İ12١​") for _ in range(pick.randrange(80))) for _ in range(150)]
    texts += [" ".join(f"w{pick.randrange(10**6)}" for _ in range(2000))] + texts[5:9]
    rows = list(enumerate(texts))
    documents = frame(spark, rows).withColumn("token_ids", F.lit("old")).withColumn("a.b", F.lit(7)).repartition(3)
    encoded = byte_bpe.encode(documents, VOCABULARY, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, VOCABULARY)
    assert back.columns == ["doc_id", "text", "a.b", "token_ids", "decoded"]
    got = back.collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert r["token_ids"] == reference.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode() and r["a.b"] == 7
    byte_bpe._pieces.cache_clear()


def test_decoding_what_is_not_in_the_vocabulary(spark):
    rows = [(1, None), (2, []), (3, [0, 60_000, -1, None]), (4, [0])]
    got = byte_bpe.decode(spark.createDataFrame(rows, "doc_id long, token_ids array<int>"), VOCABULARY).collect()
    first = byte_bpe.letters(b"!")
    assert ord(first) - 0x100 == 33
    found = {r["doc_id"]: r["decoded"] for r in got}
    assert found[1] is None and bytes(found[2]) == b""
    assert bytes(found[3]) == bytes(found[4]) + "�".encode() * 3
    assert byte_bpe.encode(frame(spark, []), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_model_needs_all_bytes():
    with pytest.raises(ValueError):
        byte_bpe.serialise({b"a": 0})


# Conversation repair

#: Progress through an optional system row and pairs of user and assistant.
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\r\x0b\x0c")
        if not core:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            out.append("-" if core[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def brute_repair(rows, faults):
    """Best-first search over (cost, audit)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, k, state, out = heapq.heappop(heap)
        if (k, state) in done:
            continue
        done.add((k, state))
        if k == len(rows) and state in ("", "a"):
            return cost, audit, out
        steps = [("I", 3, 0, r, (r2, "")) for r, r2 in (("u", "user"), ("a", "assistant"))]
        if k < len(rows):
            _, role, text = rows[k]
            steps.append(("D", 4, 1, None, None))
            if faults[k] not in "bd":
                late = 3 * (faults[k] == "t")
                steps.append(("K", late, 1, role[:1], (role, text)))
                steps += [("R", 3 + late, 1, r, (r2, text)) for r, r2 in (("u", "user"), ("a", "assistant"))]
        for letter, price, used, symbol, line in steps:
            after = state if symbol is None else AFTER.get((state, symbol))
            if after is not None:
                lines = out if line is None else (*out, line)
                heapq.heappush(heap, (cost + price, audit + letter, k + used, after, lines))


def brute_conversations(rows):
    """Every conversation of (conv_id, turn, role, text) rows that are already damaged."""
    groups, found = defaultdict(list), {}
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, held in groups.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults = faults_of(held)
        cost, audit, out = brute_repair(held, faults)
        turns = [r[0] for r in held if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:], strict=False))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        found[conv] = (
            gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return found


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", shown[3])}.get(kind, shown[3])
        out += [(conv, turn, "user" if kind == 4 else shown[2], text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_the_corpus(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = brute_conversations(damaged(rows))
    got = {r["conv_id"]: tuple(r[c] for c in NAMES) for r in queries.op13_conversation_repair(spark, DATA).collect()}
    assert got == {conv: expected.get(conv, EMPTY) for conv, *_ in rows}


def chosen_conversations():
    pick, rows = random.Random(11), []
    for conv in range(160):
        for turn in range(pick.randrange(1, 9)):
            role = pick.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User", None])
            text = pick.choice(["Fine.", "Fine.", "cut", "", " \t\n", "Why?", None, "Ends. \n", f"Says {turn}!"])
            rows.append((conv, pick.choice([turn, turn, turn + 3, None]), role, text))
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "None.")]
    rows += [(500, k, ("user", "assistant")[k % 3 == 1], f"Row {k}.") for k in range(3000)]  # one long conversation
    rows += [(501, 1, "user", "Same."), (501, 1, "user", "Same."), (501, 1, "assistant", "Same.")]
    rows += [(502, 0, "system", "x" * 300_000 + "."), (502, 9, "user", "y" * 300_000)]
    return rows


def test_repair_of_chosen_conversations(spark):
    rows = chosen_conversations()
    frame_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = frame_.withColumn("pos", F.lit(1)).withColumn("key", F.lit("k")).withColumn("edits", F.lit(0)).repartition(5)
    found, lines = conversations.repair(clash)
    digests = {r["key"]: r["sha256"] for r in conversations.digests(lines).collect()}
    got = {
        r["conv_id"]: (*[r[c] for c in NAMES[:-1]], digests.get(r["key"], EMPTY[-1])) for r in found.collect()
    }
    assert got == brute_conversations(rows)


def test_repair_of_nothing(spark):
    found, lines = conversations.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert found.count() == 0 and lines.count() == 0 and conversations.digests(lines).count() == 0


def test_parse_against_all_edits():
    """Every sequence of up to three rows, against all sequences of edits with few inserts."""
    wanted = re.compile("(s?(ua)+)?")
    repair = conversations.Repair()
    inserts = ["", "u", "a", "ua", "au"]
    for size in range(4):
        for codes in product(("s-", "u-", "a-", "--", "ut", "ax") if size < 3 else ("s-", "u-", "at", "-x"), repeat=size):
            best = None
            edits = [
                [("D", 4, "")] + ([] if c[1] == "x" else [(o, p + 3 * (c[1] == "t"), r) for o, p, r in (("K", 0, c[0]), ("R", 3, "u"), ("R", 3, "a"))])
                for c in codes
            ]
            for choice in product(*edits):
                for added in product(inserts, repeat=size + 1):
                    if sum(map(len, added)) > 2:
                        continue
                    roles = "".join(a + e[2] for a, e in zip(added, choice, strict=False)) + added[-1]
                    if wanted.fullmatch(roles):
                        audit = "".join("I" * len(a) + e[0] for a, e in zip(added, choice, strict=False)) + "I" * len(added[-1])
                        cost = 3 * sum(map(len, added)) + sum(e[1] for e in choice)
                        best = min(best or (99, ""), (cost, audit))
            cost, found = repair.edits(list(codes))
            assert (cost, conversations.audit_of(found)) == best


def test_other_grammars():
    """The parse is that of a grammar, not of one pattern."""
    repair = conversations.Repair({"S": ("", "L"), "L": ("ua", "Lua", "uaa")})
    assert repair.edits(["u-", "a-", "a-"])[0] == 0
    assert repair.edits(["u-", "a-", "a-", "u-"])[0] == 3  # another assistant row follows
    assert conversations.Repair().edits(["u-", "a-", "a-"])[0] == 3


def test_oracles_of_the_new_queries():
    assert set(oracle.oracles()) <= set(queries.registered())
