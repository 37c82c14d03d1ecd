"""Licence scan, quality rules, decontamination and toxicity on small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bundlelake.llm import decontamination, licenses, mixing, quality_rules, queries, sharding, substring_dedup, toxicity

DATA = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] for r in rows}


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def test_licence_forms(spark):
    mit = licenses.LICENSES["MIT"][0]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ;")),
        (3, mit + " More."),
        (4, "Some prose.\nreleased under the  MIT licence\nAll rights reserved"),
        (5, None),
        (6, ""),
        (7, "?!"),
        (7, "?!"),
    ]
    found = licenses.scan(frame(spark, rows), licenses.known_licenses(spark)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[k]["license_id"] for k in range(1, 8)] == ["MIT", "MIT", None, None, None, None, None]
    assert by_id[4]["notices"] == "MIT,all-rights-reserved" and by_id[4]["n_notice_lines"] == 2
    assert by_id[7]["text_digest"] is None and by_id[5]["notices"] == ""


def test_whole_licences_and_phrases(spark):
    whole = {p.stem: p.read_text("utf-8") for p in licenses.WHOLE_TEXTS.glob("*.txt")}
    for wanted in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "CC0-1.0"):
        assert wanted in whole
    apache = whole["Apache-2.0"].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2021 Somebody")
    texts = [*whole.items(), ("Apache-2.0", apache), ("Apache-2.0", whole["Apache-2.0"].partition("APPENDIX")[0])]
    texts += [("BSD-3-Clause", "Copyright (c) 2019, Somebody\n\n" + whole["BSD-3-Clause"].upper())]
    found = licenses.scan(frame(spark, [(k, t) for k, (_, t) in enumerate(texts)]), licenses.known_licenses(spark))
    assert {r["doc_id"]: r["license_id"] for r in found.collect()} == {k: n for k, (n, _) in enumerate(texts)}
    lines = {
        "Released under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the GNU General Public License, version 3.": "GPL-3.0-only",
        "Licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0-only",
        "This program is distributed under the terms of the GNU GPL v2 or later": "GPL-2.0-or-later",
        "This work is licensed under a licence of our own, version 3.": "",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Licensed under the BSD 2-Clause License": "BSD-2-Clause", "Released under the Unlicense": "Unlicense",
        "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0-or-later",
    }
    found = licenses.scan(frame(spark, [(k, f"A\n{t}\nb") for k, t in enumerate(lines)]), licenses.known_licenses(spark))
    assert [r["notices"] for r in sorted(found.collect())] == list(lines.values())
    assert licenses.known_licenses(spark).count() <= licenses.BROADCAST_ROWS


def test_licence_scan_without_known_or_documents(spark):
    nothing = frame(spark, [])
    assert licenses.scan(nothing, licenses.known_licenses(spark)).count() == 0
    found = licenses.scan(frame(spark, [(1, "a")]), licenses.known_licenses(spark, {})).first()
    assert found["license_id"] is None


def brute_quality(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_statistics_against_brute_force(spark, texts):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    short = {k: t for k, t in texts.items() if len(t or "") < 4000}
    for r in queries.op3_quality_rules(spark, DATA).collect():
        if r["doc_id"] not in short:
            continue
        expected = brute_quality(short[r["doc_id"]])
        assert tuple(r[n] for n in names) == expected
        assert r["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])


def test_quality_lines_and_edges(spark):
    prose = "The quick brown fox jumps over the lazy dog near a river bank.\nAnother line of plain prose follows here."
    rows = [
        (1, prose + "\nHome\nClick here to subscribe to our news"),
        (2, "\n".join(["buy### now$$$ %%% &&& **" for _ in range(5)])),
        (3, None),
        (4, ""),
        (5, prose),
        (5, prose),
    ]
    out = quality_rules.assess(frame(spark, rows).withColumn("quality", F.lit(1))).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r["quality"] for r in out}
    assert by_id[1]["kept"] and by_id[1]["clean_text"] == prose
    assert not by_id[2]["kept"] and not by_id[3]["kept"] and by_id[4]["base_failed"]
    cleaned = quality_rules.clean(frame(spark, rows).withColumn("n_chars", F.lit(0))).collect()
    assert sorted(r["doc_id"] for r in cleaned) == [1, 5, 5]
    assert {r["n_chars"] for r in cleaned} == {len(prose)}


def test_long_text_is_judged_whole(spark):
    text = " ".join(f"w{k}" for k in range(60_000)) + " " + " ".join(f"w{k}" for k in range(5))
    row = quality_rules.assess(frame(spark, [(1, text)])).first()["quality"]
    assert (row["n_words"], row["n_repeat_words"]) == (60_005, 10)


FOLD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return FOLD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, window=10):
    words, hit, found = fold(text), set(), set()
    for name, item in items:
        own = fold(item)
        size = min(window, len(own))
        wanted = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    for r in queries.op8_benchmark_decontamination(spark, DATA).collect():
        n, hit, found = brute_hits(texts[r["doc_id"]], items)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(found), digest)
        assert r["contaminated"] == (hit > 0)


def test_decontamination_edges(spark):
    items = [(2, "one two"), (10, "one TWO"), (3, None), (4, ""), (5, "x"), (None, "y"), (6, " ".join("abcdefghijklm"))]
    benchmark = frame(spark, items, "item_id long, text string")
    rows = [
        (1, "One, two; x"), (2, None), (3, ""), (4, "two one"), (5, "one two one two"),
        (6, "z b c d e f g h i j k z"), (7, "y"), (8, "filler " * 3000 + "one two"),
    ]
    documents = frame(spark, rows).withColumn("benchmark_hits", F.lit("old"))
    for r in decontamination.search(documents, benchmark).collect():
        n, hit, found = brute_hits(dict(rows)[r["doc_id"]], [(k, t) for k, t in items if k is not None])
        got = r["benchmark_hits"]
        assert (got["n_words"], got["n_hit"], got["item_ids"]) == (n, hit, found)
        assert sum(s["end"] - s["first"] for s in got["spans"]) == hit
    assert decontamination.search(frame(spark, []), benchmark).count() == 0
    kept = decontamination.remove_contaminated(frame(spark, rows), benchmark.where("item_id IS NULL"))
    assert kept.count() == len(rows)


def test_toxicity_learns_from_training_rows_only(spark):
    found = queries.op6_toxicity(spark, "/root/testdata/sf0.01")
    rows = {r["doc_id"]: r for r in found.collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    right = []
    for label in labels:
        r = rows[label["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(label["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"]:
            right.append(r["predicted"] == label["toxic"])
    assert np.mean(right) > 0.85


def test_toxicity_misspellings_and_edges(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"{a}{b}" for a in ("lamp", "tree", "stone", "river", "cloud") for b in ("s", "ed", "ing", "er", "ly")]
    rows = []
    for k in range(200):
        words = list(rng.choice(vocabulary, 20))
        if k % 2:
            words[3:5] = ["wretched", "wretchedly"]
        rows.append((k, " ".join(words), k % 2))
    labelled = frame(spark, rows, "doc_id long, text string, label int")
    model = toxicity.train(labelled.drop("label"), labelled.select("doc_id", "label"))
    plain = " ".join(vocabulary[:18])
    asked = frame(spark, [(1, plain + " wretcheed wrretched"), (2, plain), (3, None), (4, ""), (5, "!!")])
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(asked.withColumn("score", F.lit(9)), model).collect()}
    assert scores[1] > 0.5 > scores[2] and scores[3] == scores[4] == scores[5]
    lone = toxicity.train(labelled.drop("label"), labelled.select("doc_id", F.lit(0).alias("label")))
    assert toxicity.score(asked, lone).agg(F.max("score")).first()[0] < 0.5


def test_any_names_of_columns(spark):
    """Dots in names and names that the operators use themselves, in every operator on documents."""
    kinds = "`a.id` long, `a.text` string, `a.source` string, `x.y` int, _copy int, _spans int, label int, body int, _key int, _doc int"
    texts = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(3)]
    rows = [(k, texts[k % 3], "s", k, 1, 2, 3, 4, 5, 6) for k in range(6)] + [(None,) * 10]
    docs = spark.createDataFrame(rows, kinds)
    bench = spark.createDataFrame([("q", texts[0])], "item_id string, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "`a.id` long, label int")
    names = docs.columns
    repeats = substring_dedup.find_repeats(docs, "a.id", "a.text")
    assert repeats.columns == [*names, "repeats"]
    assert sorted(r["repeats"]["n_removed"] for r in repeats.collect()) == [0, 0, 0, 0, 30, 30, 30]
    clean = quality_rules.clean(docs, "a.text")
    assert clean.columns == names and clean.count() == 6
    kept = decontamination.remove_contaminated(docs, bench, "a.text")
    assert kept.columns == names and kept.count() == 5
    mixed = mixing.mix(docs, "a.id", "a.text", "a.source")
    assert mixed.columns == names and mixed.where("`a.id` IS NOT NULL").count() == 9
    placed = sharding.place(docs, key="a.id")
    assert placed.columns == [*names, "slot", "shard"] and placed.count() == 7
    model = toxicity.train(docs, labels, "a.id", "a.text")
    scored = toxicity.score(docs, model, "a.text")
    assert scored.columns == [*names, "score"] and scored.where("score BETWEEN 0 AND 1").count() == 7


def test_shard_weights_are_positive():
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "b"], 7, {"a": 0})


def test_benchmark_in_parts(spark):
    """Every item in a part of its own gives what one part gives."""
    words = [f"w{i}" for i in range(60)]
    items = [(f"q{k}", " ".join(words[k * 7 : k * 7 + 14])) for k in range(6)] + [("e", ""), ("n", None), (None, "w1 w2")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(1, " ".join(words)), (2, " ".join(words[5:25])), (3, "clean text"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("x.y", F.lit(1)).withColumn("before", F.lit(2))
    whole = decontamination.search(docs, bench).orderBy("doc_id").collect()
    assert len(list(decontamination.benchmark_parts(bench, part_words=1))) == 8
    parts = decontamination.search(docs, bench, part_words=20).orderBy("doc_id").collect()
    assert parts == whole and whole[0]["benchmark_hits"]["n_items"] == 6 and whole[2]["benchmark_hits"]["n_hit"] == 0
    nothing = decontamination.search(docs, bench.where("false"))
    assert nothing.count() == 5 and nothing.where("benchmark_hits.n_hit > 0").count() == 0
