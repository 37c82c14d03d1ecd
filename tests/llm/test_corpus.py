"""Deduplication, mixing, sharding, token files, page text and the pipeline on small inputs."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bundlelake.llm import html_text, mixing, near_dedup, queries, sharding, substring_dedup, token_files

DATA = "/root/testdata/sf0.001"


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def brute_repeats(rows, window=13):
    first, out = {}, {}
    split = {k: (t or "").encode().split() for k, t in rows}
    for k in sorted(split):
        for i in range(len(split[k]) - window + 1):
            first.setdefault(tuple(split[k][i : i + window]), k)
    for k, w in split.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone |= set(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_repeats(rows)
    for r in queries.op2_substring_dedup(spark, DATA).collect():
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == expected[r["doc_id"]]


def test_repeats_edges(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 200)  # several reference blocks
    words = [f"w{k}" for k in range(60)]
    passage = " ".join(words[:20])
    rows = [
        (5, passage), (3, "a b " + passage), (9, passage + " tail " + passage), (7, " ".join(words[:12])),
        (11, None), (12, ""), (13, passage), (14, " ".join(words[30:43])), (15, " ".join(words[30:43])),
        (16, " ".join(words) * 1), (17, " ".join(words[:20])),
    ] + [(100 + k, f"x{k} " + passage + f" y{k}") for k in range(40)]
    documents = frame(spark, rows).withColumn("repeats", F.lit(0)).withColumn("_doc", F.lit("clash")).repartition(4)
    expected = brute_repeats(rows)
    for r in substring_dedup.find_repeats(documents).collect():
        got = r["repeats"]
        digest = hashlib.sha256(got["kept_text"].encode()).hexdigest()
        assert (got["n_words"], got["n_removed"], digest) == expected[r["doc_id"]]
        assert sum(f["end"] - f["first"] for f in got["factors"]) == got["n_removed"]
    twice = substring_dedup.find_repeats(frame(spark, [(1, passage), (1, passage), (None, passage)]))
    assert [r["repeats"]["n_removed"] for r in twice.collect()] == [0, 0, 0]
    assert substring_dedup.find_repeats(frame(spark, [])).count() == 0


def test_repeats_move_little(spark):
    found = substring_dedup.find_repeats(frame(spark, [(1, "a " * 20), (2, "a " * 20 + "b")]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_body" in plan and "_body" not in plan[plan.index("Join"):]  # the joins move the text once
    words = " ".join(str(n % 40) for n in range(100)).encode()
    rows = pa.record_batch([pa.array([7]), pa.array([words])], names=["doc", "text"])
    seeds = substring_dedup._windows([words.split()], substring_dedup.WordHashes(), 13)[1]
    batch = rows.append_column("seeds", pa.array([seeds.tolist()], pa.list_(pa.int64())))
    looked_up = [r for b in substring_dedup._window_rows(13)(iter([batch])) for r in b.to_pylist() if not r["settled"]]
    assert {r["first"] for r in looked_up} == set(range(88)) and {r["last"] for r in looked_up} == {0}


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates(spark):
    rng = random.Random(3)
    base = [f"term{rng.randrange(5000)}" for _ in range(300)]

    def edited(n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
        return " ".join(out)

    rows = [(0, " ".join(base)), (1, " ".join(base)), (2, edited(1)), (3, edited(2)), (4, edited(40))]
    rows += [(k, " ".join(f"t{k}x{i}" for i in range(80))) for k in range(10, 30)]
    rows += [(40, "one two"), (41, "one two"), (42, "one three"), (50, None), (51, ""), (52, "  \n")]
    found = {r[0]: r[1] for r in near_dedup.classes(frame(spark, rows)).collect()}
    assert {k: found[k] for k in (0, 1, 2, 3, 40, 41)} == {0: 0, 1: 0, 2: 0, 3: 0, 40: 40, 41: 40}
    alone = [4, *range(10, 30), 42, 50, 51, 52]
    assert {k: found[k] for k in alone} == {k: k for k in alone}
    kept = near_dedup.keep_one(frame(spark, [*rows, (40, "one two"), (None, "one two")]))
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([0, 40, None, *alone])
    assert near_dedup.classes(frame(spark, [])).count() == 0


def test_near_duplicates_against_brute_force(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {r[0]: shingles(r[1]) for r in documents.collect()}
    found = {r[0]: r[1] for r in near_dedup.classes(documents).collect()}
    having = defaultdict(list)
    for k, s in sets.items():
        for g in s:
            having[g].append(k)
    pairs = Counter((a, b) for ks in having.values() for a in ks for b in ks if a < b)
    links = {}
    for (a, b), n in pairs.items():
        links[a, b] = n / (len(sets[a]) + len(sets[b]) - n)
    # the weights move a similarity a little, so pairs right at the threshold may go either way
    assert all(found[a] == found[b] for (a, b), j in links.items() if j >= 0.83)
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), j in links.items():
        if j >= 0.77:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert all(root(k) == root(c) for k, c in found.items())


def test_document_frequencies_are_exact(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(1000))) for k in range(200)]
    rows += [(200 + k, f"{rows[k % 7][1]} x{k} y{k} again again again again again again again") for k in range(30)]
    source = frame(spark, rows).select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    n, counted = near_dedup.frequencies(source)
    having = Counter(g for _, t in rows for g in shingles(t))
    assert n == len(rows)  # 200,000 shingles: hash buckets would be shared by several
    assert Counter(r["n"] for r in counted.collect()) == Counter(c for c in having.values() if c > 1)
    for least in (2, 6, 1000):  # all sent to tasks, some, none
        many = counted.where(F.col("n") >= least).toArrow()
        counts = near_dedup.Counts(many["shingle"].to_numpy().view(np.uint64), many["n"].to_numpy())
        common = spark.sparkContext.broadcast(counts)
        bags = {r["doc"]: r["bag"] for r in near_dedup.bags(source, counted, common, least).collect()}
        for k, t in rows:
            _, weights, found = near_dedup._bag(bags[k], n)
            places = Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4))
            assert Counter(found.tolist()) == Counter(having[g] for g in places)
            exact = [(1 + np.log(c)) * (1 + 0.25 * np.log((1 + n) / (1 + having[g])) / np.log(2 + n)) for g, c in places.items()]
            assert np.allclose(np.sort(weights), np.sort(exact))


def test_sorted_shingles_are_summed_across_batches():
    def batch(keys, n):
        return pa.record_batch([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["shingle", "n"])

    rows = [batch([None, None, 3], [4, 5, 1]), batch([3], [1]), batch([], []), batch([3, 5, 6], [1, 1, 2]), batch([6, 9], [1, 1])]
    found = [(r["shingle"], r["n"]) for b in near_dedup._summed(iter(rows)) for r in b.to_pylist()]
    assert sorted(found, key=str) == [(3, 3), (6, 3), (None, 9)]
    assert [b.num_rows for b in near_dedup._summed(iter([]))] == [0]
    assert [r for b in near_dedup._summed(iter([batch([8, 9], [1, 2])])) for r in b.to_pylist()] == [{"shingle": 9, "n": 2}]


def test_near_duplicates_with_joined_frequencies(spark, monkeypatch):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    sent = sorted(tuple(r) for r in near_dedup.classes(documents).collect())
    monkeypatch.setattr(near_dedup, "COMMON_SHARE", 0.5)
    assert sorted(tuple(r) for r in near_dedup.classes(documents).collect()) == sent


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 100), (7, 7)]
    found = {r[0]: r[1] for r in near_dedup.components(frame(spark, edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100}


def test_draws_estimate_weighted_jaccard():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = rng.random(300) + 0.5
    b = a.copy()
    b[:60] *= 2
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    drawn = [near_dedup.draw(keys, w, np.array([0]), 2000)[:, 0] for w in (a, b)]
    assert abs((drawn[0] == drawn[1]).mean() - expected) < 0.04


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[k % 3] for k, n in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[n] for n in full)
        open_ = sum(weight[n] for n in names if n not in full)
        target = {n: most * sizes[n] if n in full else rest * weight[n] / open_ for n in names}
        over = {n for n in names if n not in full and target[n] > most * sizes[n]}
        if not over:
            return target
        full |= over


def test_mix(spark):
    rows = [(k, "w " * (1 + k * 7 % 50), [None, "a", "b", "é", "Z"][k % 5]) for k in range(700)]
    rows += [(1000, None, "a"), (1001, "", "empty"), (None, "null id", "a"), (3, "again", "b"), (3, "again", "b")]
    documents = frame(spark, rows, "doc_id long, text string, source string")
    planned = mixing.plan(documents).collect()
    assert len(planned) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    expected = brute_targets(sizes)
    rounded = sorted(round(v, 6) for v in expected.values())
    assert sorted({round(r["target"], 6) for r in planned}) == sorted(set(rounded))
    taken = defaultdict(int)
    for r in planned:
        assert 0 <= r["copies"] <= 2
        taken[round(r["target"], 6)] += r["copies"] * r["size"]
    alike = Counter(rounded)  # sources with equal targets are added up
    assert all(abs(n - t * alike[t]) <= 50 * alike[t] for t, n in taken.items())
    again = mixing.plan(documents.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, planned))
    mixed = mixing.mix(documents.withColumn("copies", F.lit("clash")))
    assert mixed.columns == [*documents.columns, "copies"]
    assert mixed.count() == sum(r["copies"] for r in planned)
    assert mixing.plan(documents.where("false")).count() == 0


def test_lookup_table_is_even_and_stable():
    names = [f"s{k}" for k in range(10)]
    full = sharding.lookup_table(names, 1009)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(full, fewer, strict=True) if a != 9)
    assert moved < 0.1 * 1009
    heavy = Counter(sharding.lookup_table(names, 1009, {"s0": 3}))
    assert abs(heavy[0] - 3 * heavy[1]) <= 6
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_placement(spark, tmp_path):
    documents = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("slot", F.lit(-1))
    placed = sharding.place(documents)
    table = sharding.lookup_table([f"shard-{k:05d}" for k in range(64)])
    for r in placed.select("doc_id", "slot", "shard").collect():
        slot = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16) % 65_537
        assert (r["slot"], r["shard"]) == (slot, f"shard-{table[slot]:05d}")
    odd = sharding.place(frame(spark, [(None, "a"), (1, None), (1, "b")])).collect()
    assert len(odd) == 3 and len({r["shard"] for r in odd if r["doc_id"] == 1}) == 1
    sharding.write_shards(placed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == documents.count()


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for n in (0, 1, 7, 8, 1000):
        values = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
        parts = token_files.planes(values, bits)
        assert len(parts) == (32 if bits else 4)
        assert (token_files.unplane(parts, n, np.uint32, bits) == values).all()


def expected_tokens(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    at, out = 0, []
    for doc, text in sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0], r[1].encode())):
        ids = np.array([*encode(text, add_special_tokens=False).ids, 1], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_against_whole_texts(spark, monkeypatch, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in queries.op4_token_files(spark, DATA).collect())
    assert found == expected_tokens(rows)


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_edges(spark, tmp_path, bits):
    import public_tokenizers

    rows = [
        (3, None), (1, ""), (2, "  \n"), (5, "it's ÉCOLE école x <|endoftext|>\x1cend ß İ"), (5, "twice"),
        (-7, "first"), (9, "long text " * 40_000),
    ]
    files = token_files.write(
        frame(spark, rows).withColumn("part", F.lit(1)), str(tmp_path / "t"), public_tokenizers.path("word_bpe_49k.json"), bits=bits
    )
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long"
    found = sorted(tuple(r) for r in token_files.read(files, columns, token_files.facts).collect())
    assert found == sorted(expected_tokens(rows))
    empty = token_files.write(frame(spark, []), str(tmp_path / "e"), public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.read(empty, columns, token_files.facts).count() == 0


ARTICLE = "<h1>Title &amp; more</h1><p>First  para<br>graph with <b>bold</b> and <a href=x>a link</a>.<p>Second &#233;.</p>"


def test_page_text():
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><div class=ad-box>Buy</div>"
        f"<article>{ARTICLE}<script>if (a<b) '</p>'</script><form>Field</form><!-- note --></article>"
        "<div id=comments><p>Reader says a very long thing that is not part of the article at all</div>"
        "<aside>Side</aside><footer>&copy; me</footer>"
    )
    text = "Title & more\n\nFirst para graph with bold and a link.\n\nSecond é."
    assert html_text.extract(page) == text
    assert html_text.extract(page.replace("article", "div")) == text
    assert html_text.extract("") == "" and html_text.extract("a < b &lt; c") == "a < b < c"
    assert html_text.extract("<p>" * 3000 + "deep" + "</div>" * 10) == "deep"


def test_pages_follow_their_host(spark):
    def page(main, side, n):
        return (
            f"<body><div class='post-{n}'><p>{main}</p></div>"
            f"<div class='links{n}'><p>{side}</p></div></body>"
        )

    rows = [(k, "http://A.example/x", page("word " * 200, "few words", k)) for k in range(5)]
    rows += [(6, "http://a.example/y", page("short main text", "unusual long side text " * 50, 7))]
    rows += [(7, None, "<p>no host</p>"), (8, "http://b.example", None), (9, "http://b.example", ""), (9, "http://b.example", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_path", F.lit(1)).withColumn("text", F.lit("old"))
    found = html_text.main_text(pages).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r["text"] for r in found}
    assert by_id[6] == "short main text" and by_id[7] == "no host" and by_id[8] == by_id[9] == ""
    assert html_text.main_text(pages.where("false")).count() == 0


def test_page_text_is_whole():
    body = "<p>" + "Long text of the body. " * 20 + "</p>"
    text = ("Long text of the body. " * 20).strip()
    for page in (
        f"<div id=content><h1>Title</h1><p>Lead</p><div class=body>{body}</div><p>End</p></div>",
        f"<p>Title</p><div><div><p>Lead</div><div>{body}<p>End</div></div>",
        f"<div><nav>Menu</nav><div class=intro><h2>Title</h2><p>Lead</p></div><div class=body>{body}</div><div><h2>End</h2></div></div>",
        f"<main><h1>Title</h1><article><p>Lead</p>{body}<p>End</article></main><div>Side</div>",
        f"<main><article><p>Title<p>Lead</article><article class=b>{body}</article><p>End</main>",
        f"<body><article><p>Title</p><p>Lead</article><article>{body}<p>End</article><aside>Side</aside></body>",
    ):
        assert html_text.extract(page) == f"Title\n\nLead\n\n{text}\n\nEnd"
        assert html_text.extract(page, "/no/such") == html_text.extract(page)


BODY, BODY_TEXT = "<p>Body text one is here.</p><p>And a second one, longer.</p>", "Body text one is here.\n\nAnd a second one, longer."


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<div class="content no-sidebar">{BODY}</div>', BODY_TEXT),
        (f'<div id=page class="layout-sidebar-right">{BODY}</div>', BODY_TEXT),
        (f"<form id=aspnetForm><div class=nav>Menu</div><h1>Title</h1>{BODY}</form>", f"Title\n\n{BODY_TEXT}"),
        (f"<form id=aspnetForm>{BODY}</form>", BODY_TEXT),
        (f'<main class="search-page"><div class="post related-posts-enabled">{BODY}</div></main>', BODY_TEXT),
        (f'<article><p class="alert">Mind.</p>{BODY}</article>', f"Mind.\n\n{BODY_TEXT}"),
        (f'<article>{BODY}<section class="comment-policy"><p>Policy.</section></article>', f"{BODY_TEXT}\n\nPolicy."),
        (f"<article><header><div><h1>Title</h1></div></header>{BODY}</article>", f"Title\n\n{BODY_TEXT}"),
        (f"<body><header><h1>Site</h1></header><div class=post><header><h1>Title</h1></header>{BODY}</div>", f"Title\n\n{BODY_TEXT}"),
        (f"<body><header><h1>Site</h1></header>{BODY}</body>", BODY_TEXT),
        (f'<article>{BODY}<div class="share-buttons">Share</div></article><div class=sidebar>{BODY * 5}</div>', BODY_TEXT),
        (f"<div class=post>{BODY}</div><div id=comments>{BODY * 9}<article class=comment-body>x</article></div>", BODY_TEXT),
        (f"<div class=post>{BODY * 50}</div><div>Side words</div>", "\n\n".join([BODY_TEXT] * 50 + ["Side words"])),
    ],
)
def test_furniture_is_told_by_whole_names_and_evidence(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize("piece", ["<font>x", "<div>x", "<p>a<font>", "<a href=x>y", "<h1>x"])
def test_unclosed_tags_take_linear_time(piece):
    import time

    begin = time.perf_counter()
    assert html_text.extract(piece * 100_000) or piece.startswith("<a")
    assert time.perf_counter() - begin < 30


def test_page_columns_with_dots(spark):
    pages = spark.createDataFrame([("u", "<p>Text</p>", 1)], "`a.url` string, `a.html` string, `x.y` int")
    found = html_text.main_text(pages, "a.url", "a.html", "a.text")
    assert found.columns == [*pages.columns, "a.text"] and found.first()["a.text"] == "Text"


def test_all_containers_at_a_host_path(spark):
    page = "<body><div class=top>a b</div><article><p>One</p></article><article><p>Two is longer</p></article></body>"
    rows = [(k, "http://a.example/x", f"<body><article><p>Story {k}</p></article></body>") for k in range(3)]
    pages = spark.createDataFrame([*rows, (9, "http://a.example/y", page)], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert found == {0: "Story 0", 1: "Story 1", 2: "Story 2", 9: "One\n\nTwo is longer"}


def test_page_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    for r in queries.op10_html_text(spark, DATA).collect():
        html = pages[r["page_id"]]["html"]
        inner = html.partition("<article>")[2].partition("</article>")[0]
        assert r["n_chars"] == len(r["text"])
        from html import unescape
        import re

        blocks = re.split(r"</?(?:p|h1)>", inner)
        plain = [" ".join(unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks]
        assert r["text"] == "\n\n".join(b for b in plain if b)


def test_pipeline(spark):
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], DATA).cache())
    assert all(f.columns == columns for f in seen[:-1]) and seen[-1].columns == [*columns, "slot", "shard"]
    counts = [f.count() for f in seen]
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[5] == counts[4]
    whole = corpus_pipeline.run(spark, DATA)
    assert sorted(map(str, whole.collect())) == sorted(map(str, seen[-1].collect()))


def exact_similarities(rows):
    """Weighted Jaccard of all pairs that share a shingle, by the documented weights."""
    bags = {k: Counter(tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))) for k, t in rows if t and t.split()}
    having = defaultdict(list)
    for k, bag in bags.items():
        for g in bag:
            having[g].append(k)
    n = len(bags)
    weights = {
        k: {g: (1 + np.log(c)) * near_dedup.idf_weights(n, np.array([len(having[g])]))[0] for g, c in bag.items()} for k, bag in bags.items()
    }
    total = {k: sum(w.values()) for k, w in weights.items()}
    common = Counter()
    for g, ks in having.items():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                common[a, b] += min(weights[a][g], weights[b][g])
    return {(a, b): m / (total[a] + total[b] - m) for (a, b), m in common.items()}


def test_near_duplicate_recall_on_planted_links(spark):
    rng = random.Random(21)
    rows = []
    for k in range(400):  # pairs around and above the threshold, each text in one pair only
        words = [f"v{rng.randrange(20_000)}" for _ in range(rng.randrange(120, 400))]
        edits = rng.randrange(1, max(2, len(words) // 40))
        other = list(words)
        for at in rng.sample(range(len(words)), edits):
            other[at] = f"n{rng.randrange(10**6)}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    exact = exact_similarities(rows)
    links = {p for p, j in exact.items() if j >= 0.8}
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(frame(spark, rows)).collect()}
    caught = {(a, b) for a, b in links if found[a] == found[b]}
    assert len(links) > 200 and len(caught) >= 0.98 * len(links)
    close = [p for p in links if exact[p] < 0.85]
    assert len(close) > 30 and len(caught.intersection(close)) >= 0.95 * len(close)
    assert all(exact[2 * k, 2 * k + 1] >= 0.8 for k in range(400) if found[2 * k + 1] == 2 * k)


def test_near_duplicate_recall_by_exact_weights(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    exact = exact_similarities([tuple(r) for r in documents.collect()])
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(documents).collect()}
    assert all(found[a] == found[b] for (a, b), j in exact.items() if j >= 0.8)
    parent = {k: k for k in found}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), j in exact.items():
        if j >= 0.8 - 1e-9:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert found == {k: root(k) for k in found}


def test_draws_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(5)
    keys = np.sort(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    a = np.where(rng.random(900) < 0.7, 1.25, rng.uniform(1, 3, 900))
    b = np.where(rng.random(900) < 0.8, a, rng.uniform(1, 3, 900))
    shared = slice(100, 900)
    first = [np.zeros(1, np.int64)]
    drawn_a = near_dedup.draw(keys[:800], a[:800], first[0], 4000)
    drawn_b = near_dedup.draw(keys[shared], b[shared], first[0], 4000)
    least = np.minimum(a[100:800], b[100:800]).sum()
    similarity = least / (a[:800].sum() + b[shared].sum() - least)
    assert abs((drawn_a == drawn_b).mean() - similarity) < 0.03


def test_near_duplicates_of_clashing_keys_and_names(spark):
    t1, t2, t3 = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    columns = "doc_id long, text string, `a.b` string, _name string, _key int"
    rows = [(1, t1, "x", "n", 1), (1, t2, "y", "n", 2), (2, t2, "z", "n", 3), (3, t3, "w", None, 4), (3, t3, "w", None, 4), (None, t2, "u", "n", 5)]
    documents = frame(spark, rows, columns)
    assert sorted(tuple(r) for r in near_dedup.classes(documents.where("doc_id IS NOT NULL")).collect()) == [(1, 1), (1, 1), (2, 1), (3, 3), (3, 3)]
    kept = near_dedup.keep_one(documents)
    assert kept.columns == documents.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(1, t1), (1, t2), (3, t3), (None, t2)])
    dotted = documents.select("doc_id", F.col("text").alias("the.text"))
    assert near_dedup.classes(dotted, text="the.text").count() == 6
    assert near_dedup.keep_one(documents.where("false")).count() == 0


def test_near_duplicates_of_long_texts(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**5)}" for _ in range(60_000)]
    other = list(words)
    for at in rng.sample(range(len(words)), 1_000):
        other[at] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:30_000])), (4, " ".join(words).replace(" ", "  "))]
    assert {r[0]: r[1] for r in near_dedup.classes(frame(spark, rows)).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}


ODD_TEXTS = [b"", None, b"  ", b" a b\t\x0bc\x0cd\re\n", b"x", bytes(range(1, 128)), " a b\x1c c\x85d é".encode(),
             b"a  b   c d e f a b c d e f", b"\xff no utf-8 \xfe"]


def test_words_told_apart_by_arrow_are_those_of_split():
    """Every different word is looked up once; empty ends, nulls and slices change nothing."""
    from bundlelake.llm import grams

    class Counted(grams.WordHashes):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    whole = pa.array(ODD_TEXTS, pa.binary())
    for column in (whole, whole.slice(1, 7), pa.array([b"", None], pa.binary()), whole.slice(0, 0)):
        texts = grams.split(column)
        numbers, bounds, words = grams.numbered(column)
        assert [[words[k] for k in numbers[a:z]] for a, z in zip(bounds[:-1], bounds[1:], strict=True)] == texts
        hashes = Counted()
        found = near_dedup.column_shingles(column, hashes)
        assert hashes.asked == len({w for t in texts for w in t})
        for a, b in zip(found, near_dedup.shingles(texts, grams.WordHashes()), strict=True):
            assert a.tolist() == b.tolist()


def test_ids_of_a_column_are_those_of_its_words():
    import public_tokenizers

    words = token_files.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t or b"" for t in ODD_TEXTS[:-1]]
    found = words.of_column(pa.array(texts, pa.binary()), 1)
    assert [f.tolist() for f in found] == [[*np.frombuffer(words.of(t.split()), np.uint32).tolist(), 1] for t in texts]
    assert words.of_column(pa.array([], pa.binary()), 1) == []
